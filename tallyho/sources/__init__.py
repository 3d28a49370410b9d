"""File sources / sinks and adapters from the driver's parquet tables."""
