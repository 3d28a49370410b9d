"""Tables that are replaced as one step.

``commit`` writes all tables of a model into a new version folder and then adds
one row to the ``versions`` table beside it, in a single small file.  Readers
follow the highest version there, so they see either all tables of a version or
none: a writer that dies in between leaves the last version as it is, and a
model may be replaced by something that is computed from itself.  Versions are
never overwritten; of two writers at a time the one with the higher folder name
is read.  Old version folders may be deleted once nobody reads them.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSIONS = "version LONG, folder STRING"


def _last(spark: SparkSession, path: str):
    """The row of the version that readers follow; None before the first."""
    try:
        rows = spark.read.schema(VERSIONS).parquet(f"{path.rstrip('/')}/versions")
        return rows.orderBy(F.desc("version"), F.desc("folder")).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def exists(spark: SparkSession, path: str) -> bool:
    return _last(spark, path) is not None


def commit(path: str, **tables: DataFrame) -> None:
    """Replace the tables at ``path`` by ``tables``, all at once."""
    spark = next(iter(tables.values())).sparkSession
    folder, last = uuid.uuid4().hex, _last(spark, path)
    for name, df in tables.items():
        df.write.parquet(f"{path.rstrip('/')}/{folder}/{name}")
    row = spark.createDataFrame([(0 if last is None else last["version"] + 1, folder)], VERSIONS)
    row.coalesce(1).write.mode("append").parquet(f"{path.rstrip('/')}/versions")


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Table ``name`` of the last version at ``path``."""
    last = _last(spark, path)
    if last is None:
        raise FileNotFoundError(f"no version at {path}")
    return spark.read.parquet(f"{path.rstrip('/')}/{last['folder']}/{name}")
