"""Sparse least squares by Frank-Wolfe, in long form.

Points are ``points(id, y)`` and ``cells(id, feat, x)``; the problem is

    min 1/n sum (y - <x, b>)^2   subject to   ||b||_1 <= K

The best vertex of the ball for a gradient has one non-zero entry, so the model
is a sum of at most one atom a step: it has at most k + 1 entries after k steps,
however many features there are, and no vector of the length of the features
leaves the cluster.  A step is two jobs: the gradient by feature, of which only
the entry of largest size is fetched; and that feature's column, which moves the
predictions.  The cells stay where they are or in their blocks
(:mod:`.blocks`); only residuals move, and over the broadcast bound none of them
through the driver.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .blocks import HOT_CELLS, co_partitioned
from .linreg import fw_step_size
from .logreg import laid_out

HISTORY_SCHEMA = "k INT, objective DOUBLE, gap DOUBLE, feat STRING, gamma DOUBLE, converged BOOLEAN, elapsed DOUBLE"
TIE_DIGITS = 9              # gradients that agree so far are a tie: the first feature by name


@dataclass
class SparseFit:
    atoms: dict[str, float]
    history: list
    converged: bool

    def beta_df(self, spark) -> DataFrame:
        return spark.createDataFrame(sorted(self.atoms.items()), "feat STRING, value DOUBLE")

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def lmo_l1(gradient: DataFrame, K: float) -> tuple[str, float, float] | None:
    """(feat, its gradient, the vertex's entry) of the vertex s of the ball with
    the least <g, s>, from ``feat, value``: -K sign(g) at the largest |g|, the
    first feature on ties, -K if all are 0.  None without features."""
    top = gradient.orderBy(F.round(F.abs("value"), TIE_DIGITS).desc(), "feat").first()
    return None if top is None else (top["feat"], top["value"], K if top["value"] < 0 else -K)


def train_fw(points: DataFrame, cells: DataFrame, K: float = 100.0, max_iter: int = 100, eps: float = 0.01,
             blocks: int | None = None, hot_cells: int = HOT_CELLS) -> SparseFit:
    """Frank-Wolfe with exact (clipped) line search from b = 0; stops after
    ``max_iter`` steps or when <b - s, gradient> <= eps.  ``blocks`` and
    ``hot_cells`` as for the logistic trainer.  No points or no cells give an
    empty model."""
    spark = points.sparkSession
    at = cut_lineage(points.select("id", "y", F.lit(0.0).alias("p")))
    n = at.count()
    laid = laid_out(points.select("id", "y"), cells, blocks, hot_cells)
    atoms, history, small, started = {}, [], False, time.perf_counter()
    r = F.col("y") - F.col("p")
    with co_partitioned(spark):
        for k in range(max_iter if n else 0):
            sums = laid.weighted(at.select("id", r.alias("w"))).groupBy("feat").agg(F.sum("g").alias("g"))
            top = lmo_l1(sums.select("feat", (F.lit(-2.0 / n) * F.col("g")).alias("value")), K)
            if top is None:
                break
            feat, slope, entry = top
            column = laid.products(spark.createDataFrame([(feat, entry)], "feat STRING, value DOUBLE"))
            column = column.groupBy("id").agg(F.sum("c").alias("q"))
            # merged: predictions and columns do not pass through the driver, whatever their number
            at = cut_lineage(at.join(column.hint("shuffle_merge"), "id", "left").select("id", "y", "p", (F.coalesce("q", F.lit(0.0)) - F.col("p")).alias("dq")))
            s = at.agg(F.sum(r * r).alias("rr"), F.sum(r * F.col("p")).alias("rp"), F.sum(r * F.col("dq")).alias("rd"),
                       F.sum(F.col("dq") * F.col("dq")).alias("dd")).first()
            gap = -2.0 * s["rp"] / n - entry * slope
            gamma = fw_step_size(s["dd"] / n, -2.0 * s["rd"] / n)
            small = gap < eps
            history.append((k, s["rr"] / n, gap, feat, gamma, small, time.perf_counter() - started))
            atoms = {f: (1 - gamma) * v for f, v in atoms.items()}
            atoms[feat] = atoms.get(feat, 0.0) + gamma * entry
            atoms = {f: v for f, v in atoms.items() if v != 0.0}
            at = at.select("id", "y", (F.col("p") + F.lit(gamma) * F.col("dq")).alias("p"))
            if gap <= eps:
                break
    laid.drop()
    return SparseFit(atoms, history, small)


def objective(points: DataFrame, cells: DataFrame, beta: DataFrame) -> DataFrame:
    """One row ``n, objective``: the mean squared error of ``beta(feat, value)``."""
    p = cells.join(beta, "feat").groupBy("id").agg(F.sum(F.col("x") * F.col("value")).alias("p"))
    r = F.col("y") - F.coalesce("p", F.lit(0.0))
    return points.join(p, "id", "left").agg(F.count(F.lit(1)).alias("n"), F.avg(r * r).alias("objective"))
