"""Sparse vectors as long tables ``feat STRING, value DOUBLE``.

A missing feature means 0.0; a present one is kept even when its value is 0
(the union of keys defines the support, as in the dictionary vectors the
operators are modelled on).

Addition-like operations are ``unionByName`` + ``groupBy(feat).sum``: one
shuffle with map-side partial sums, so a feature present in many inputs
costs one row per map task, and no outer join is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _vec(df: DataFrame, feat: str = "feat", value: str = "value") -> DataFrame:
    return df.select(F.col(feat).alias("feat"), F.col(value).cast("double").alias("value"))


def vec_scale(a: DataFrame, s: float) -> DataFrame:
    """``s * a``."""
    return _vec(a).select("feat", (F.col("value") * F.lit(float(s))).alias("value"))


def vec_axpy(a: DataFrame, b: DataFrame, t: float = 1.0) -> DataFrame:
    """``a + t * b`` over the union of keys (absent = 0)."""
    parts = _vec(a).unionByName(vec_scale(b, t))
    return parts.groupBy("feat").agg(F.sum("value").alias("value"))


def vec_add(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a + b`` over the union of keys."""
    return vec_axpy(a, b, 1.0)


def vec_sub(a: DataFrame, b: DataFrame) -> DataFrame:
    """``a - b`` over the union of keys."""
    return vec_axpy(a, b, -1.0)


def vec_get(a: DataFrame, keys: DataFrame) -> DataFrame:
    """``feat, value`` for every key of ``keys`` (column ``feat``), 0.0 if absent."""
    return keys.select("feat").join(_vec(a), "feat", "left").select(
        "feat", F.coalesce(F.col("value"), F.lit(0.0)).alias("value"))


def vec_norm_sq(a: DataFrame) -> DataFrame:
    """One row ``norm_sq`` = sum of squared values."""
    return _vec(a).agg(F.coalesce(F.sum(F.col("value") * F.col("value")), F.lit(0.0)).alias("norm_sq"))


def vec_dot(a: DataFrame, b: DataFrame) -> DataFrame:
    """One row ``dot`` = <a, b> over the common keys (0 when none)."""
    pairs = _vec(a).join(_vec(b).withColumnRenamed("value", "other"), "feat")
    return pairs.agg(F.coalesce(F.sum(F.col("value") * F.col("other")), F.lit(0.0)).alias("dot"))


def paired(a: DataFrame, b: DataFrame, a_name: str = "a", b_name: str = "b") -> DataFrame:
    """``feat, a, b`` over the union of keys with absent entries 0.0 (one shuffle)."""
    left = _vec(a).select("feat", F.col("value").alias(a_name), F.lit(0.0).alias(b_name))
    right = _vec(b).select("feat", F.lit(0.0).alias(a_name), F.col("value").alias(b_name))
    return left.unionByName(right).groupBy("feat").agg(
        F.sum(a_name).alias(a_name), F.sum(b_name).alias(b_name))
