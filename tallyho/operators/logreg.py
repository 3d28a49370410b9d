"""L2-regularised sparse logistic regression (capability C).

Data model (long tables, nothing packed into per-partition lists):

* ``points(id BIGINT, y DOUBLE)`` with y in {-1, +1}
* ``cells(id BIGINT, feat STRING, x DOUBLE)`` – the non-zero features
* ``beta(feat STRING, value DOUBLE)`` – the model, kept distributed

Loss (a sum, not a mean):  L(b) = sum log(1 + exp(-y <b, x>)) + lam ||b||^2

Plan shape per descent iteration; when the model or the points are over the
broadcast bound, the trainer packs the cells once in blocks of documents
(:mod:`blocks`) and never exchanges, sorts or looks them up by a word again:

1. gradient: the points' weights go to the blocks, which sum by feature and send
   one array to each part of the features; the parts' sums meet 2*lam*beta.  A
   document holding a third of all cells lies in all blocks; a hot feature is
   one number of each block.
2. direction per point ``dm = <g, x>``: the parts send each block its slice of
   g, and sums by document are formed inside the block.
3. one aggregate evaluates the loss at every backtracking step t = b^k
   (a block of trials) from ``m - t*dm`` (one Arrow batch of points becomes one
   row per step), together with bb, bg, gg over the features; the regulariser ``lam (bb - 2t bg + t^2 gg)`` is added to
   the block's sums on the driver.  The first accepted t is taken; when the
   whole block is rejected the next block of shorter steps is tried, until one
   is accepted or the step is too short for a double.
4. ``beta <- beta - t g`` and ``m <- m - t dm`` (incremental margins, fully
   recomputed every ``refresh_every`` iterations to stop drift).

beta/gradient and the per-point table are checkpointed (reliable, in the
cluster's checkpoint directory) every iteration, so lineage stays constant.
"""

from __future__ import annotations

import time
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import logistic_loss, logistic_weight
from ..session import (DEFAULT_BROADCAST_ROWS, DISK_BACKED, bounded_broadcast, cut_lineage,
                       fits_broadcast, salted_join)
from .blocks import HOT_CELLS, BroadcastCells, PackedCells, co_partitioned, lay_out, pack_cells
from .progress import Progress
from .vectors import paired

# Backtracking parameters (Armijo fraction a, shrink factor b).
ARMIJO_A = 0.2
SHRINK_B = 0.6
# Trial steps that one aggregate over the points evaluates at once; when all of
# them are rejected the next block follows, so there is no last trial.
TRIAL_BLOCK = 40


# ------------------------------------------------------------- features --

def sparse_features(cells: DataFrame) -> DataFrame:
    """``feat``: distinct feature labels present in the data."""
    return cells.select("feat").distinct()


def zero_beta(cells: DataFrame) -> DataFrame:
    """Initial model: 0.0 for every feature of the data."""
    return sparse_features(cells).select("feat", F.lit(0.0).alias("value"))


def bucket_points(points: DataFrame, n: int, method: str = "hash") -> DataFrame:
    """Add ``bucket INT`` in [0, n): ``hash`` = pmod(xxhash64(id), n) (even for
    any id distribution), ``mod`` = id mod n.  Depends only on the id, so it
    is stable across re-execution."""
    if method == "hash":
        b = F.pmod(F.xxhash64("id"), F.lit(n))
    elif method == "mod":
        b = F.pmod(F.col("id"), F.lit(n))
    else:
        raise ValueError("method must be hash or mod")
    return points.withColumn("bucket", b.cast("int"))


def feature_buckets(cells: DataFrame, n: int, method: str = "hash") -> DataFrame:
    """``feat, bucket``: every (feature, bucket) pair that occurs."""
    return bucket_points(cells.select("id", "feat"), n, method).select("feat", "bucket").distinct()


def bucket_stats(points: DataFrame, cells: DataFrame, n: int, method: str = "hash") -> DataFrame:
    """One row: min / max / mean of points and of distinct features per bucket
    (over the buckets that hold points)."""
    per_points = bucket_points(points.select("id"), n, method).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_points"))
    per_feats = feature_buckets(cells, n, method).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n_features"))
    per = per_points.join(per_feats, "bucket", "left").fillna(0, subset=["n_features"])
    return per.agg(
        F.min("n_points").alias("points_min"), F.max("n_points").alias("points_max"),
        F.avg("n_points").alias("points_avg"),
        F.min("n_features").alias("features_min"), F.max("n_features").alias("features_max"),
        F.avg("n_features").alias("features_avg"))


# ------------------------------------------------------- margins / loss --

def _dim_side(vec: DataFrame, max_rows: int | None, broadcast: bool | None) -> DataFrame:
    """Model-side join input: broadcast when known (``broadcast=True``) or
    checked (``None``: bounded scan) to be small, else a shuffle join."""
    if broadcast is True:
        return F.broadcast(vec)
    if broadcast is False:
        return vec
    return bounded_broadcast(vec, max_rows if max_rows is not None else DEFAULT_BROADCAST_ROWS)


def _cell_products(cells: DataFrame, vec: DataFrame, max_broadcast_rows: int | None,
                   broadcast: bool | None) -> DataFrame:
    """``id, c`` = x * vec[feat] for every cell whose feature is in ``vec``."""
    side = _dim_side(vec.select("feat", F.col("value").alias("_v")), max_broadcast_rows, broadcast)
    return cells.join(side, "feat").select("id", (F.col("x") * F.col("_v")).alias("c"))


def _with_dot(rows: DataFrame, keep: list, cells: DataFrame, vec: DataFrame, name: str,
              max_broadcast_rows: int | None, broadcast: bool | None) -> DataFrame:
    """``keep..., name``: per-point rows plus <vec, x> (0 when no common key).

    The point rows and the per-cell products are unioned and summed by id in
    ONE aggregate (partial sums per task, one shuffle keyed by id) instead of
    an aggregate followed by an outer join back to the points."""
    return _add_products(rows, keep, _cell_products(cells, vec, max_broadcast_rows, broadcast), name)


def _add_products(rows: DataFrame, keep: list, products: DataFrame, name: str) -> DataFrame:
    """``keep..., name``: the rows of the points plus the sum of their products (id, c)."""
    none = F.lit(None).cast("double")
    own = rows.select("id", *keep, F.lit(0.0).alias("c"))
    prods = products.select("id", *[none.alias(k) for k in keep], "c")
    out = own.unionByName(prods).groupBy("id").agg(
        *[F.max(k).alias(k) for k in keep], F.sum("c").alias(name))
    return out.filter(F.col(keep[0]).isNotNull())       # ids of the points only


def margins(points: DataFrame, cells: DataFrame, beta: DataFrame,
            max_broadcast_rows: int | None = None, broadcast: bool | None = None) -> DataFrame:
    """``id, y, margin``: <beta, x> for every point; 0 for points that share
    no feature with beta (absent entries are 0, so no point is dropped)."""
    return _with_dot(points, ["y"], cells, beta, "margin", max_broadcast_rows, broadcast)


def dot_sparse(cells: DataFrame, vec: DataFrame, points: DataFrame,
               max_broadcast_rows: int | None = None) -> DataFrame:
    """``id, dot``: <vec, x_id> for every point (0 when no common key)."""
    return margins(points, cells, vec, max_broadcast_rows).select(
        "id", F.col("margin").alias("dot"))


def _loss_parts(m: DataFrame, beta: DataFrame) -> DataFrame:
    data = m.select(logistic_loss("y", "margin").alias("data"), F.lit(None).cast("double").alias("reg"))
    reg = beta.select(F.lit(None).cast("double").alias("data"),
                      (F.col("value") * F.col("value")).alias("reg"))
    return data.unionByName(reg)


def loss(points: DataFrame, cells: DataFrame, beta: DataFrame, lam: float = 0.0,
         max_broadcast_rows: int | None = None) -> DataFrame:
    """One row ``data_loss, norm_sq, loss`` (loss = data_loss + lam * norm_sq)."""
    m = margins(points, cells, beta, max_broadcast_rows)
    return loss_from_margins(m, beta, lam)


def loss_from_margins(m: DataFrame, beta: DataFrame, lam: float = 0.0) -> DataFrame:
    agg = _loss_parts(m, beta).agg(
        F.coalesce(F.sum("data"), F.lit(0.0)).alias("data_loss"),
        F.coalesce(F.sum("reg"), F.lit(0.0)).alias("norm_sq"))
    return agg.withColumn("loss", F.col("data_loss") + F.lit(float(lam)) * F.col("norm_sq"))


def gradient_pairs(m: DataFrame, cells: DataFrame, beta: DataFrame, lam: float = 0.0,
                   broadcast_points: bool | None = False, salt_buckets: int = 1) -> DataFrame:
    """``feat, b, g``: the model and its gradient side by side, over the union
    of the data's features and beta's (absent = 0), from ONE aggregate:
    beta rows contribute (b, 2 lam b), cell rows (0, -y/(1+exp(y m)) x).

    The per-point weights join the cells by id: broadcast when the number of
    points is known (``True``) or checked (``None``) to be small, otherwise a
    shuffle join in which AQE splits a document that holds many cells, or,
    with ``salt_buckets > 1``, an explicitly salted join."""
    w = m.select("id", logistic_weight("y", "margin").alias("_w"))
    if broadcast_points is None:
        w = bounded_broadcast(w, DEFAULT_BROADCAST_ROWS, materialize=True)
    elif broadcast_points:
        w = F.broadcast(w)
    if broadcast_points is False and salt_buckets > 1:
        joined = salted_join(cells, w, ["id"], salt_buckets)
    else:
        joined = cells.join(w, "id")
    return _pairs(joined.select("feat", (F.col("_w") * F.col("x")).alias("g")), beta, lam)


def _pairs(parts: DataFrame, beta: DataFrame, lam: float) -> DataFrame:
    """``feat, b, g`` from the cells' parts (feat, g) of the gradient and beta."""
    data = parts.select("feat", F.lit(0.0).alias("b"), "g")
    model = beta.select("feat", F.col("value").alias("b"),
                        (F.lit(2.0 * lam) * F.col("value")).alias("g"))
    return model.unionByName(data).groupBy("feat").agg(F.sum("b").alias("b"), F.sum("g").alias("g"))


def gradient_from_margins(m: DataFrame, cells: DataFrame, beta: DataFrame,
                          lam: float = 0.0, broadcast_points: bool | None = False) -> DataFrame:
    """``feat, value``: sum over cells of -y/(1+exp(y m)) x, plus 2 lam beta."""
    return gradient_pairs(m, cells, beta, lam, broadcast_points).select(
        "feat", F.col("g").alias("value"))


def cell_gradients(points: DataFrame, cells: DataFrame, beta: DataFrame,
                   max_broadcast_rows: int | None = None) -> DataFrame:
    """``id, feat, value``: each point's loss gradient -y/(1+exp(y<b,x>)) x,
    one row per non-zero feature of the point."""
    m = margins(points, cells, beta, max_broadcast_rows)
    w = m.select("id", logistic_weight("y", "margin").alias("_w"))
    return cells.join(w, "id").select("id", "feat", (F.col("_w") * F.col("x")).alias("value"))


def gradient(points: DataFrame, cells: DataFrame, beta: DataFrame, lam: float = 0.0,
             max_broadcast_rows: int | None = None) -> DataFrame:
    return gradient_from_margins(margins(points, cells, beta, max_broadcast_rows), cells, beta, lam,
                                 broadcast_points=None)


# ---------------------------------------------------------- line search --

@dataclass
class SearchResult:
    t: float                  # accepted step (0.0 when none was accepted)
    backtracks: int           # number of shrinks before acceptance
    accepted: bool
    f0: float                 # L(beta)
    f_new: float              # L(beta - t g)
    grad_sq: float            # ||g||^2


def trial_losses(mdm: DataFrame, bg: DataFrame, b: float = SHRINK_B, block: int = TRIAL_BLOCK,
                 first: int = 0) -> DataFrame:
    """``k, loss, bb, bgs, gg`` from ONE aggregate.

    Rows k = first..first+block-1: data loss at the trial step t = b^k, summed
    over ``mdm(id, y, margin, dm)`` from ``margin - t*dm``; k = -1: the data
    loss at t = 0; k = -2: sum b^2, b*g, g^2 over the feature rows ``bg(feat,
    b, g)``.  A batch of points becomes one row per step before the aggregate,
    so points are neither expanded nor shuffled.
    """
    steps = np.array([0.0] + [b ** k for k in range(first, first + block)])

    def losses(batches):
        import pyarrow as pa

        for batch in batches:
            y, margin, dm = (np.asarray(c) for c in batch.columns)
            total = np.zeros(len(steps))
            for lo in range(0, len(y), 4096):
                part = slice(lo, lo + 4096)
                total += np.logaddexp(0.0, -y[part] * (margin[part] - steps[:, None] * dm[part])).sum(axis=1)
            yield pa.RecordBatch.from_arrays([pa.array([-1, *range(first, first + block)], pa.int32()), pa.array(total)], ["k", "loss"])

    zero = F.lit(0.0)
    point_rows = mdm.select("y", "margin", "dm").mapInArrow(losses, "k int, loss double").select(
        "k", "loss", zero.alias("bb"), zero.alias("bgs"), zero.alias("gg"))
    feat_rows = bg.select(
        F.lit(-2).alias("k"), zero.alias("loss"),
        (F.col("b") * F.col("b")).alias("bb"), (F.col("b") * F.col("g")).alias("bgs"),
        (F.col("g") * F.col("g")).alias("gg"))
    return point_rows.unionByName(feat_rows).groupBy("k").agg(
        *[F.sum(c).alias(c) for c in ("loss", "bb", "bgs", "gg")])


def trial_objectives(trials: DataFrame, lam: float, b: float = SHRINK_B, block: int = TRIAL_BLOCK,
                     first: int = 0) -> dict:
    """Collect the ``block + 2`` rows of :func:`trial_losses` and add
    the regulariser lam ||beta - t g||^2 = lam (bb - 2t bg + t^2 gg)."""
    rows = {r["k"]: r for r in trials.collect()}
    feats = rows.get(-2)
    bb, bgs, gg = ((feats["bb"], feats["bgs"], feats["gg"]) if feats is not None else (0.0, 0.0, 0.0))
    out = {"f0": (rows[-1]["loss"] if -1 in rows else 0.0) + lam * bb, "gg": gg}
    for k in range(first, first + block):
        t = b ** k
        data = rows[k]["loss"] if k in rows else 0.0
        out[f"l{k}"] = data + lam * (bb - 2.0 * t * bgs + t * t * gg)
    return out


def choose_step(row, gg: float | None = None, a: float = ARMIJO_A, b: float = SHRINK_B,
                block: int = TRIAL_BLOCK, first: int = 0) -> SearchResult:
    """First k whose L(beta - b^k g) is not above the Armijo line."""
    gg = float(row["gg"]) if gg is None else gg
    f0 = float(row["f0"])
    for k in range(first, first + block):
        t = b ** k
        fk = float(row[f"l{k}"])
        if not fk > f0 - a * t * gg:       # accept unless strictly above the Armijo line
            return SearchResult(t, k, True, f0, fk, gg)
    return SearchResult(0.0, first + block, False, f0, f0, gg)


def search(mdm: DataFrame, bg: DataFrame, lam: float, a: float = ARMIJO_A, b: float = SHRINK_B,
           block: int = TRIAL_BLOCK) -> SearchResult:
    """Blocks of trials over the same written ``mdm`` until one is accepted.
    A step that underflows to 0 ends the search: it no longer moves the model."""
    first = 0
    while True:
        row = trial_objectives(trial_losses(mdm, bg, b, block, first), lam, b, block, first)
        found = choose_step(row, None, a, b, block, first)
        first += block
        if found.accepted and found.t > 0.0 or b ** first == 0.0:
            return found if found.t > 0.0 else SearchResult(0.0, found.backtracks, False, found.f0, found.f0, found.grad_sq)


def line_search(points: DataFrame, cells: DataFrame, beta: DataFrame, g: DataFrame,
                lam: float = 0.0, a: float = ARMIJO_A, b: float = SHRINK_B,
                block: int = TRIAL_BLOCK, blocks: int | None = None) -> SearchResult:
    """Backtracking search along -g from beta, one scan for a block of trials.

    Model and direction meet the cells in one join, which serves once, so the
    cells are laid out in blocks only with ``blocks`` given."""
    bg = cut_lineage(paired(beta, g, "b", "g"))
    if blocks is None:
        mdm = cut_lineage(margins_along(points, cells, bg))
    else:
        laid = lay_out(cells, blocks)
        with co_partitioned(cells.sparkSession):
            m = _add_products(points, ["y"], laid.products(bg.select("feat", F.col("b").alias("value"))), "margin")
            mdm = cut_lineage(_add_products(m, ["y", "margin"], laid.products(bg.select("feat", F.col("g").alias("value"))), "dm"))
        laid.drop()
    return search(mdm, bg, lam, a, b, block)


def margins_along(points: DataFrame, cells: DataFrame, bg: DataFrame) -> DataFrame:
    """``id, y, margin, dm``: <b, x> and <g, x> of every point, from one join of
    the cells with ``bg(feat, b, g)`` and one aggregate by id."""
    near = cells.select("id", "feat", "x").join(bounded_broadcast(bg.select("feat", "b", "g")), "feat")
    parts = points.select("id", "y", F.lit(0.0).alias("margin"), F.lit(0.0).alias("dm")).unionByName(
        near.select("id", F.lit(None).cast("double").alias("y"), (F.col("x") * F.col("b")).alias("margin"), (F.col("x") * F.col("g")).alias("dm")))
    rows = parts.groupBy("id").agg(F.max("y").alias("y"), F.sum("margin").alias("margin"), F.sum("dm").alias("dm"))
    return rows.filter(F.col("y").isNotNull())          # ids of the points only


# ------------------------------------------------------------- training --

HISTORY_SCHEMA = ("k INT, objective DOUBLE, grad_norm_before_step DOUBLE, step DOUBLE, "
                  "backtracks INT, accepted BOOLEAN, converged BOOLEAN, acc DOUBLE, pre DOUBLE, "
                  "rec DOUBLE, elapsed DOUBLE")


@dataclass
class LogRegFit:
    beta: DataFrame
    history: list
    converged: bool
    iterations: int

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


def train(points: DataFrame, cells: DataFrame, lam: float = 0.0, max_iter: int = 40,
          eps: float = 0.1, beta0: DataFrame | None = None, test: tuple | None = None,
          refresh_every: int = 10, block: int = TRIAL_BLOCK, blocks: int | None = None,
          hot_cells: int = HOT_CELLS, log: str | None = None) -> LogRegFit:
    """Gradient descent with backtracking line search.

    Stops after ``max_iter`` iterations, when ||grad|| <= eps, or when no
    step that a double can hold satisfies the Armijo condition.
    ``test=(points, cells)`` adds ACC / PRE / REC of each iterate to the
    history.  History reports the gradient norm at the point before the step.
    A model or points over the broadcast bound have the cells laid out once in
    ``blocks`` blocks of documents (given: always); a document of over
    ``hot_cells`` cells is dealt over all of them.  ``log``: a folder that keeps
    model, margins and history of every iteration, and from which a run goes on.
    """
    progress = Progress(points.sparkSession, log, HISTORY_SCHEMA)
    points = points.select("id", "y").persist(DISK_BACKED)
    laid = laid_out(points, cells, blocks, hot_cells, beta0)
    tested = (test[0], laid_out(test[0], test[1], blocks, hot_cells, zero_beta(cells))) if test is not None else None
    with co_partitioned(points.sparkSession):
        fit = _descend(points, laid, lam, max_iter, eps, beta0, tested, refresh_every, block, progress)
    points.unpersist()
    laid.drop()
    if tested is not None:
        tested[1].drop()
    return fit


def laid_out(points: DataFrame, cells: DataFrame, blocks: int | None, hot_cells: int, *models) -> PackedCells | BroadcastCells:
    """``cells`` as they lie if points and models fit a broadcast, else packed in blocks."""
    if blocks is None and fits_broadcast(points.select("id", F.lit(0.0).alias("w"))) and all(
            fits_broadcast(m) for m in (zero_beta(cells), *models) if m is not None):
        return BroadcastCells(cells)
    return pack_cells(cells, blocks, hot_cells)


def _descend(points: DataFrame, laid: PackedCells | BroadcastCells, lam: float, max_iter: int, eps: float, beta0: DataFrame | None,
             test: tuple | None, refresh_every: int, block: int, progress: Progress) -> LogRegFit:
    def at(points, laid, beta):
        return _add_products(points, ["y"], laid.products(beta), "margin")

    history, converged, started = progress.history(), False, time.perf_counter()
    if history:
        beta, m = progress.state("beta"), progress.state("margins")
        accepted, converged, norm = history[-1][5], history[-1][6], history[-1][2]
        started -= history[-1][10]
        if not accepted or norm <= eps:
            return LogRegFit(beta, history, converged, sum(h[5] for h in history))
    else:
        beta = cut_lineage(beta0.select("feat", "value") if beta0 is not None else zero_beta(laid.feats))
        m = cut_lineage(at(points, laid, beta))
    for k in range(len(history), max_iter):
        # job 1: gradient (weights to the blocks) and beta, summed by feature in one aggregate
        weight = m.select("id", logistic_weight("y", "margin").alias("w"))
        bg = cut_lineage(_pairs(laid.weighted(weight), beta, lam))
        # job 2: per-point direction dm = <g, x> (slices of g to the blocks)
        mdm = cut_lineage(_add_products(m, ["y", "margin"], laid.products(bg.select("feat", F.col("g").alias("value"))), "dm"))
        # job 3: loss at every trial step + bb, bg, gg in one aggregate
        res = search(mdm, bg, lam, block=block)
        norm = float(np.sqrt(res.grad_sq))
        if not res.accepted:
            history.append((k, res.f0, norm, 0.0, res.backtracks, False, False, None, None, None,
                            time.perf_counter() - started))
            progress.commit(history, beta=beta, margins=m)
            break
        t = res.t
        # beta and margins stay projections of this iteration's two checkpoints
        beta = bg.select("feat", (F.col("b") - F.lit(t) * F.col("g")).alias("value"))
        if refresh_every and (k + 1) % refresh_every == 0:
            m = cut_lineage(at(points, laid, beta))
        else:
            m = mdm.select("id", "y", (F.col("margin") - F.lit(t) * F.col("dm")).alias("margin"))
        converged = norm < eps
        acc = pre = rec = None
        if test is not None:
            mt = metrics(confusion(at(test[0], test[1], beta))).first()
            acc, pre, rec = mt["acc"], mt["pre"], mt["rec"]
        history.append((k, res.f_new, norm, t, res.backtracks, True, converged, acc, pre, rec,
                        time.perf_counter() - started))
        progress.commit(history, beta=beta, margins=m)
        if norm <= eps:
            break
    return LogRegFit(beta, history, converged, sum(h[5] for h in history))


# -------------------------------------------------------------- metrics --

def confusion(m: DataFrame, tie: str = "negative") -> DataFrame:
    """One row ``P, N, TP, FP, TN, FN`` (BIGINT) from ``id, y, margin``.

    P: margin > 0.  N: margin <= 0 (``tie='negative'``) or margin < 0
    (``tie='drop'``: a zero margin is in no class)."""
    pos = F.col("margin") > 0
    if tie == "negative":
        neg = F.col("margin") <= 0
    elif tie == "drop":
        neg = F.col("margin") < 0
    else:
        raise ValueError("tie must be negative or drop")
    yp, yn = F.col("y") > 0, F.col("y") < 0

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast("long")

    agg = m.agg(cnt(pos & yp).alias("TP"), cnt(pos & yn).alias("FP"),
                cnt(neg & yn).alias("TN"), cnt(neg & yp).alias("FN"))
    return agg.select((F.col("TP") + F.col("FP")).alias("P"), (F.col("TN") + F.col("FN")).alias("N"),
                      "TP", "FP", "TN", "FN")


def metrics(conf: DataFrame) -> DataFrame:
    """``acc, pre, rec`` from a confusion row; NULL where a denominator is 0."""
    d = F.col
    return conf.select(
        F.try_divide((d("TP") + d("TN")).cast("double"), d("P") + d("N")).alias("acc"),
        F.try_divide(d("TP").cast("double"), d("TP") + d("FP")).alias("pre"),
        F.try_divide(d("TP").cast("double"), d("TP") + d("FN")).alias("rec"))


def predict(points: DataFrame, cells: DataFrame, beta: DataFrame,
            max_broadcast_rows: int | None = None) -> DataFrame:
    """``id, y, margin, prediction`` (+1 when margin > 0, else -1)."""
    m = margins(points, cells, beta, max_broadcast_rows)
    return m.withColumn("prediction", F.when(F.col("margin") > 0, 1.0).otherwise(-1.0))
