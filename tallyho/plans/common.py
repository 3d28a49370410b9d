"""Helpers shared by the registered query plans and their SQL oracles.

Registered queries end with :func:`rounded`, and every oracle with
:func:`sql_round`, so both engines present doubles identically (6 decimals,
``-0.0`` folded into ``0.0``).  The operators themselves never round.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..session import checkpoint_dir

DIGITS = 6


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for field in df.schema.fields:
        if isinstance(field.dataType, (DoubleType, FloatType)):
            cols.append((F.round(F.col(field.name).cast("double"), digits) + F.lit(0.0))
                        .alias(field.name))
        else:
            cols.append(F.col(field.name))
    return df.select(*cols)


def sql_round(expr: str, name: str, digits: int = DIGITS) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits}) + 0.0 AS {name}"
