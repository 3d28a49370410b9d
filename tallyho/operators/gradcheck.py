"""Numerical gradient checking (capability E).

A forward-difference check perturbs one coordinate at a time:

    numeric_k = (F(b + delta e_k) - F(b)) / delta

The reference evaluates F twice per coordinate (2d full passes).  Here every
coordinate is checked in a single pass: perturbing coordinate k only changes
the rows that touch k, so the difference F(b + delta e_k) - F(b) is a sum of
per-row differences of the loss, computed row by row (which also avoids
subtracting two large totals).

* :func:`linreg_check` – dense least squares for any d, one partial vector per
  task.
* :func:`logreg_check` – sparse logistic loss, every feature at once: one
  join of the cells with the margins, then a group-by on the feature.
* :func:`mf_check` – matrix-factorisation objective w.r.t. every coordinate
  of one side: one pass over the joined ratings grouped by user or item.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import logistic_loss, logistic_weight
from .linreg import moments


def _finish(df: DataFrame) -> DataFrame:
    return df.withColumn("abs_diff", F.abs(F.col("analytic") - F.col("numeric")))


def linreg_check(points: DataFrame, beta: Sequence[float], lam: float = 0.0,
                 delta: float = 1e-5) -> DataFrame:
    """``k, analytic, numeric, abs_diff`` for F(b) = mean sq. error + lam ||b||^2."""
    # (r - delta x)^2 - r^2 = delta^2 x^2 - 2 delta r x, row by row
    sums = moments(points, beta).where("idx >= 0")
    b = F.get(F.lit([float(v) for v in beta]), F.col("idx"))
    step = F.lit(float(delta))
    change = (step * step * F.col("xx") - 2 * step * F.col("xr")) / F.col("n")
    ridge = F.lit(float(lam)) * ((b + step) * (b + step) - b * b)
    return _finish(sums.select(
        F.col("idx").alias("k"), (-2 * F.col("xr") / F.col("n") + F.lit(2.0 * lam) * b).alias("analytic"),
        ((change + ridge) / step).alias("numeric")))


def logreg_check(points: DataFrame, cells: DataFrame, beta: DataFrame, lam: float = 0.0,
                 delta: float = 1e-6) -> DataFrame:
    """``feat, analytic, numeric, abs_diff`` for the total logistic loss
    L(b) = sum log(1 + exp(-y <b,x>)) + lam ||b||^2, over every feature of
    ``beta`` (``feat, value``)."""
    from .logreg import margins  # local import: logreg imports this module's peers
    m = margins(points, cells, beta)
    per_cell = cells.join(m, "id").select(
        "feat", "x",
        (logistic_weight("y", "margin") * F.col("x")).alias("g"),
        (logistic_loss("y", F.col("margin") + F.lit(delta) * F.col("x"))
         - logistic_loss("y", "margin")).alias("dl"))
    data = per_cell.groupBy("feat").agg(F.sum("g").alias("g"), F.sum("dl").alias("dl"))
    b = beta.select("feat", F.col("value").alias("b"))
    joined = b.join(data, "feat", "left").fillna(0.0, subset=["g", "dl"])
    bcol = F.col("b")
    out = joined.select(
        "feat",
        (F.col("g") + F.lit(2.0 * lam) * bcol).alias("analytic"),
        ((F.col("dl") + F.lit(lam) * ((bcol + F.lit(delta)) * (bcol + F.lit(delta)) - bcol * bcol))
         / F.lit(delta)).alias("numeric"))
    return _finish(out)


def mf_check(ratings: DataFrame, U: DataFrame, V: DataFrame, d: int, lam: float = 0.0,
             delta: float = 1e-6, side: str = "user") -> DataFrame:
    """``i, k, analytic, numeric, abs_diff`` of the regularised squared error
    with respect to every user coordinate u_i[k]; with ``side='item'`` (and
    the item weight as ``lam``) ``j, ...`` for every item coordinate."""
    from .mf import join_predict
    key, own, other, profiles = ("i", "u", "v", U) if side == "user" else ("j", "v", "u", V)
    J = join_predict(ratings, U, V, d)
    aggs = []
    for k in range(d):
        vk = F.col(other).getItem(k)
        shifted = F.col("delta") + F.lit(delta) * vk
        aggs.append(F.sum(F.lit(2.0) * F.col("delta") * vk).alias(f"a{k}"))
        aggs.append(F.sum(shifted * shifted - F.col("delta") * F.col("delta")).alias(f"n{k}"))
    per_key = J.groupBy(key).agg(*aggs).join(profiles.select(key, own), key)
    rows = []
    for k in range(d):
        uk = F.col(own).getItem(k)
        reg_diff = F.lit(lam) * ((uk + F.lit(delta)) * (uk + F.lit(delta)) - uk * uk)
        rows.append(F.struct(
            F.lit(k).alias("k"),
            (F.col(f"a{k}") + F.lit(2.0 * lam) * uk).alias("analytic"),
            ((F.col(f"n{k}") + reg_diff) / F.lit(delta)).alias("numeric")))
    out = per_key.select(key, F.explode(F.array(*rows)).alias("e")).select(
        key, "e.k", "e.analytic", "e.numeric")
    return _finish(out)
