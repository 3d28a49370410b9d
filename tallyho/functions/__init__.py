"""Column expressions (JVM-side) used inside the operators."""
