"""Matrix factorisation of ratings by full-batch gradient descent, with
K-fold cross-validation (capability D).

Tables:

* ``ratings(i BIGINT, j BIGINT, r DOUBLE[, fold INT])`` – a bag: a repeated
  (i, j) pair is two ratings.
* ``U(i BIGINT, u ARRAY<DOUBLE>)``, ``V(j BIGINT, v ARRAY<DOUBLE>)``.

Objective:  sum (<u_i, v_j> - r_ij)^2 + lam sum ||u_i||^2 + mu sum ||v_j||^2

When the profiles are over the broadcast bound, the trainer writes the ratings
once, in a grid of blocks by hash of user and item (:mod:`blocks`), and keeps the
profiles packed.  Per iteration and model a block gets the profiles of its users
and items and gives the sums of both; ratings are never exchanged.  Models are
stepped one after the other, and what a step has moved is deleted before the
next, so the disk does not grow with models or iterations.  With ``blocks`` given, or with ids that are not whole
numbers, the ratings are written twice instead, in blocks of users and in blocks
of items: profiles are joined four times an iteration, two for each layout,
held-out ratings riding along in the first.  All folds of a
cross-validation are trained on one layout, if not in a grid in one plan: profiles
carry their model ``f``, and a rating of fold k is held out from model k only.
U and V are checkpointed every iteration, so the plan never grows.
"""

from __future__ import annotations

import math
import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import column_dot
from ..session import (DEFAULT_BROADCAST_BYTES, DEFAULT_BROADCAST_ROWS, DISK_BACKED,
                       bounded_broadcast, cut_lineage, fits_broadcast, release, salted_join, shuffles_freed)
from .blocks import (HOT_CELLS, PACKED_COLUMNS, BroadcastRatings, RatingBlocks, RatingGrid, co_partitioned, fits_grid, joined_on_grid,
                     lay_out_grid, lay_out_ratings, short_batches)
from .progress import Progress

# The seeded-normal generator (Box-Muller on 52-bit uniforms).
TWO_POW_52 = float(2 ** 52)
SIDE_SALT = {"user": 1, "item": 2}


# --------------------------------------------------------------- basics --

def distinct_ids(ratings: DataFrame) -> DataFrame:
    """``kind, id``: distinct users (kind 'user') and items (kind 'item'),
    from one scan with grouping sets (i) and (j)."""
    g = ratings.groupingSets([["i"], ["j"]], "i", "j").agg(F.grouping_id().alias("_gid"))
    return g.select(F.when(F.col("_gid") == 1, F.lit("user")).otherwise(F.lit("item")).alias("kind"),
                    F.coalesce(F.col("i"), F.col("j")).alias("id"))


def fold_split(ratings: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(train, test): every fold but ``k`` (bag union), and fold ``k``."""
    return ratings.filter(F.col("fold") != k), ratings.filter(F.col("fold") == k)


def fold_counts(ratings: DataFrame) -> DataFrame:
    """``fold, n_train, n_test, n_users, n_items`` for every fold held out.

    One scan: grouping sets (i), (j), (fold) give each user's and item's
    first and last fold and each fold's size; that summary (users + items +
    folds rows) is written once and everything else is derived from it.  No
    data is replicated per fold: a user is missing from the training set of
    fold k exactly when all of their ratings are in fold k."""
    summary = cut_lineage(ratings.groupingSets([["i"], ["j"], ["fold"]], "i", "j", "fold").agg(
        F.grouping_id().alias("_gid"), F.min("fold").alias("f"), F.max("fold").alias("g"),
        F.count(F.lit(1)).alias("n")))
    gid = F.col("_gid")
    users, items, folds = summary.filter(gid == 3), summary.filter(gid == 5), summary.filter(gid == 6)
    n_users, n_items = users.count(), items.count()
    n_all = folds.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]

    def lone(per, name):
        return per.filter(F.col("f") == F.col("g")).groupBy(F.col("f").alias("fold")).agg(
            F.count(F.lit(1)).alias(name))

    out = folds.select("fold", F.col("n").alias("n_test")).join(
        lone(users, "lone_i"), "fold", "left").join(lone(items, "lone_j"), "fold", "left")
    return out.select(
        "fold", (F.lit(n_all) - F.col("n_test")).alias("n_train"), "n_test",
        (F.lit(n_users) - F.coalesce(F.col("lone_i"), F.lit(0))).alias("n_users"),
        (F.lit(n_items) - F.coalesce(F.col("lone_j"), F.lit(0))).alias("n_items"))


# ------------------------------------------------------------- profiles --

def _uniform(*parts) -> F.Column:
    """Deterministic uniform in (0, 1): the first 13 hex digits (52 bits) of
    the MD5 of ``parts`` joined by ``:``."""
    digits = F.substring(F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + F.lit(0.5)) / F.lit(TWO_POW_52)


def random_profiles(ratings: DataFrame, side: str, d: int, seed: int) -> DataFrame:
    """Standard-normal profiles for every distinct user (``side='user'``) or
    item (``'item'``) of ``ratings``.  Each coordinate is a Box-Muller draw
    from hashes of (id, k, seed, side), so the result does not depend on
    partitioning or on how many times a task is retried."""
    key, vec = ("i", "u") if side == "user" else ("j", "v")
    ids = ratings.select(key).distinct()
    salt = F.lit(SIDE_SALT[side])
    coords = []
    for k in range(d):
        u1 = _uniform(F.col(key), F.lit(k), F.lit(seed), salt, F.lit(1))
        u2 = _uniform(F.col(key), F.lit(k), F.lit(seed), salt, F.lit(2))
        coords.append(F.sqrt(F.lit(-2.0) * F.log(u1)) * F.cos(F.lit(2.0 * math.pi) * u2))
    return ids.select(key, F.array(*coords).alias(vec))


def rule_profiles(ratings: DataFrame, side: str, d: int, freq: float = 0.37,
                  scale: float = 0.1) -> DataFrame:
    """Deterministic profiles ``scale * sin(id * (k+1) * freq)`` (for
    reproducible runs and SQL cross-checks)."""
    key, vec = ("i", "u") if side == "user" else ("j", "v")
    ids = ratings.select(key).distinct()
    coords = [F.sin(F.col(key).cast("double") * F.lit(float(k + 1)) * F.lit(freq)) * F.lit(scale)
              for k in range(d)]
    return ids.select(key, F.array(*coords).alias(vec))


def expand(profiles: DataFrame, d: int, key: str, vec: str, prefix: str) -> DataFrame:
    """Array column -> ``prefix0..prefix{d-1}`` columns."""
    return profiles.select(key, *[F.col(vec).getItem(k).alias(f"{prefix}{k}") for k in range(d)])


# -------------------------------------------------------- join / update --

def profile_broadcast_rows(d: int) -> int:
    """Most profile rows (an id and d doubles) a broadcast may hold."""
    return min(DEFAULT_BROADCAST_ROWS, DEFAULT_BROADCAST_BYTES // (24 + 8 * d))


def _side(df: DataFrame, broadcast: bool | None, max_rows: int | None) -> DataFrame:
    if broadcast is True:
        return F.broadcast(df)
    if broadcast is False:
        return df
    return bounded_broadcast(df, max_rows if max_rows is not None else DEFAULT_BROADCAST_ROWS,
                             materialize=True)


def join_predict(ratings: DataFrame, U: DataFrame, V: DataFrame, d: int,
                 broadcast_u: bool | None = None, broadcast_v: bool | None = None,
                 max_broadcast_rows: int | None = None, salt_buckets: int = 1) -> DataFrame:
    """``i, j, r, u, v, delta`` with delta = <u, v> - r, for ratings whose
    user and item both have a profile (inner joins).  When neither side is
    within the broadcast bound, ratings and profiles meet in a grid of blocks
    (:func:`blocks.joined_on_grid`), so that no rating is exchanged with a
    vector.  With ``salt_buckets > 1`` a profile side that is not broadcast is joined by a salted join, so
    a user or item holding a large share of the ratings is split explicitly."""
    limit = max_broadcast_rows if max_broadcast_rows is not None else profile_broadcast_rows(d)
    R, us, vs = ratings.select("i", "j", "r"), U.select("i", "u"), V.select("j", "v")
    if broadcast_u is None and broadcast_v is None and salt_buckets <= 1 and fits_grid(R, us, vs):
        us, vs = cut_lineage(us), cut_lineage(vs)
        broadcast_u, broadcast_v = (fits_broadcast(p, limit) for p in (us, vs))
        if not (broadcast_u or broadcast_v):
            return joined_on_grid(R, us, vs).select(
                "i", "j", "r", "u", "v", (column_dot("u", "v", d) - F.col("r")).alias("delta"))
    us, vs = _side(us, broadcast_u, limit), _side(vs, broadcast_v, limit)
    R = salted_join(R, us, ["i"], salt_buckets) if broadcast_u is False else R.join(us, "i")
    J = salted_join(R, vs, ["j"], salt_buckets) if broadcast_v is False else R.join(vs, "j")
    return J.select("i", "j", "r", "u", "v", (column_dot("u", "v", d) - F.col("r")).alias("delta"))


def squared_error(J: DataFrame) -> DataFrame:
    """One row ``n, se`` = number of joined ratings and sum of delta^2."""
    return J.agg(F.count(F.lit(1)).alias("n"),
                 F.coalesce(F.sum(F.col("delta") * F.col("delta")), F.lit(0.0)).alias("se"))


def norm_sq(profiles: DataFrame, vec: str, d: int, param: float = 1.0) -> DataFrame:
    """One row ``norm_sq`` = param * sum ||p||^2."""
    return profiles.agg((F.lit(float(param)) * F.coalesce(F.sum(column_dot(vec, vec, d)), F.lit(0.0)))
                        .alias("norm_sq"))


def objective(J: DataFrame, U: DataFrame, V: DataFrame, d: int, lam: float = 0.0,
              mu: float = 0.0) -> DataFrame:
    """One row ``se, norm_u, norm_v, objective`` = se + lam norm_u + mu norm_v,
    from a single aggregate over the union of the three inputs."""
    none = F.lit(None).cast("double")
    parts = (J.select((F.col("delta") * F.col("delta")).alias("se"), none.alias("nu"), none.alias("nv"))
             .unionByName(U.select(none.alias("se"), column_dot("u", "u", d).alias("nu"), none.alias("nv")))
             .unionByName(V.select(none.alias("se"), none.alias("nu"), column_dot("v", "v", d).alias("nv"))))
    agg = parts.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in ("se", "nu", "nv")])
    return agg.select(F.col("se"), F.col("nu").alias("norm_u"), F.col("nv").alias("norm_v"),
                      (F.col("se") + F.lit(float(lam)) * F.col("nu") + F.lit(float(mu)) * F.col("nv"))
                      .alias("objective"))


def _step(J: DataFrame, profiles: DataFrame, key: str, own: str, other: str, gamma: float,
          reg: float, d: int, broadcast: bool | None) -> DataFrame:
    # fixed-width sums only, so Spark uses a hash aggregate with partial sums
    aggs = [F.sum(F.lit(2.0) * F.col("delta") * F.col(other).getItem(k)).alias(f"_g{k}")
            for k in range(d)]
    aggs.append(F.sum(F.col("delta") * F.col("delta")).alias("se"))
    per = J.groupBy(key).agg(*aggs)
    # the old profile comes from the profile table (one row per key), not
    # from the joined ratings
    joined = per.join(_side(profiles.select(key, own), broadcast, profile_broadcast_rows(d)), key)
    shrink = gamma * 2 * reg
    new = [F.col(own).getItem(k) - F.lit(gamma) * F.col(f"_g{k}") - F.lit(shrink) * F.col(own).getItem(k)
           for k in range(d)]
    return joined.select(key, F.array(*new).alias(own), "se",
                         column_dot(own, own, d).alias("old_norm_sq"))


def step_u(J: DataFrame, U: DataFrame, gamma: float, lam: float, d: int,
           broadcast: bool | None = None) -> DataFrame:
    """``i, u, se, old_norm_sq``: u - gamma * sum(2 delta v) - 2 gamma lam u
    for every user with ratings in ``J``, plus that user's squared error and
    ||u||^2 before the step."""
    return _step(J, U, "i", "u", "v", gamma, lam, d, broadcast)


def step_v(J: DataFrame, V: DataFrame, gamma: float, mu: float, d: int,
           broadcast: bool | None = None) -> DataFrame:
    """``j, v, se, old_norm_sq``: the item-side update with mu."""
    return _step(J, V, "j", "v", "u", gamma, mu, d, broadcast)


def rmse(test: DataFrame, U: DataFrame, V: DataFrame, d: int,
         broadcast_u: bool | None = None, broadcast_v: bool | None = None) -> DataFrame:
    """One row ``n_test, n_scored, rmse, rmse_scored``.  ``rmse`` divides by
    all test ratings, ``rmse_scored`` by those whose user and item were seen
    in training (the others cannot be predicted).  One aggregate over the
    test ratings left-joined with the profiles."""
    us = _side(U.select("i", "u"), broadcast_u, profile_broadcast_rows(d))
    vs = _side(V.select("j", "v"), broadcast_v, profile_broadcast_rows(d))
    J = test.select("i", "j", "r").join(us, "i", "left").join(vs, "j", "left")
    delta = column_dot("u", "v", d) - F.col("r")
    agg = J.agg(F.count(F.lit(1)).alias("n_test"), F.count(delta).alias("n_scored"),
                F.sum(delta * delta).alias("se"))
    return agg.select(
        "n_test", "n_scored",
        F.sqrt(F.try_divide(F.col("se"), F.col("n_test"))).alias("rmse"),
        F.sqrt(F.try_divide(F.col("se"), F.col("n_scored"))).alias("rmse_scored"))


# ------------------------------------------------------------- training --

HISTORY_SCHEMA = ("iteration INT, objective DOUBLE, change DOUBLE, test_rmse DOUBLE, "
                  "test_rmse_scored DOUBLE, gamma DOUBLE, diverged BOOLEAN, elapsed DOUBLE")


@dataclass
class MFFit:
    U: DataFrame
    V: DataFrame
    history: list
    diverged: bool

    @property
    def last_rmse(self):
        for row in reversed(self.history):
            if row[3] is not None:
                return row[3]
        return None

    def history_df(self, spark) -> DataFrame:
        return spark.createDataFrame(self.history, HISTORY_SCHEMA)


NOBODY = -1                     # the fold of ratings that no model holds out


def _moved(laid: RatingBlocks | BroadcastRatings, U: DataFrame, V: DataFrame, side: str, gamma: float, reg: float, d: int) -> DataFrame:
    """``f, i, u`` (or ``f, j, v``) after a step, with per row ``se`` and ``n``
    of its training ratings, ``se_held`` and ``n_held`` of its held-out ones and
    ``norm_sq`` of its profile before the step."""
    key, own, other, profiles = ("i", "u", "v", U) if side == "i" else ("j", "v", "u", V)
    delta, trained = column_dot("u", "v", d) - F.col("r"), F.col("fold") != F.col("f")
    rows = laid.joined(U, V).select("block", "f", key, other, F.when(trained, delta).alias("e"), F.when(~trained, delta).alias("h"))
    one = F.lit(1).cast("long")
    parts = laid.summed(rows.select(
        "block", "f", key, *[(F.lit(2.0) * F.col("e") * F.col(other).getItem(k)).alias(f"g{k}") for k in range(d)],
        (F.col("e") * F.col("e")).alias("se"), F.when(F.col("e").isNotNull(), one).alias("n"),
        (F.col("h") * F.col("h")).alias("se_held"), F.when(F.col("h").isNotNull(), one).alias("n_held")), ["f", key])
    sums = [f"g{k}" for k in range(d)] + ["se", "n", "se_held", "n_held"]
    none = F.lit(None)
    parts = parts.select("f", key, *sums, *[none.cast("double").alias(f"p{k}") for k in range(d)])
    old = profiles.select("f", key, *[none.cast("long" if c in ("n", "n_held") else "double").alias(c) for c in sums],
                          *[F.col(own).getItem(k).alias(f"p{k}") for k in range(d)])
    rows = old.unionByName(parts).groupBy("f", key).agg(*[F.sum(c).alias(c) for c in [*sums, *[f"p{k}" for k in range(d)]]])
    new = [F.col(f"p{k}") - F.lit(gamma) * F.coalesce(f"g{k}", F.lit(0.0)) - F.lit(gamma * 2 * reg) * F.col(f"p{k}") for k in range(d)]
    norm = sum((F.col(f"p{k}") * F.col(f"p{k}") for k in range(1, d)), F.col("p0") * F.col("p0"))
    return rows.select("f", key, F.array(*new).alias(own), "se", "n", "se_held", "n_held",
                       F.when(F.col("n") > 0, norm).alias("norm_sq"))


def _moved_on_grid(grid: RatingGrid, state: DataFrame, gamma: float, lam: float, mu: float, d: int) -> tuple[DataFrame, DataFrame]:
    """Packed profiles after a step, and its rows ``f, se, n, se_held, n_held, nu,
    nv``: one for all of a block's errors, one for the norms of each packed row."""
    moved = cut_lineage(grid.stepped(state, gamma, lam, mu, d))
    norm = lambda kind, name: F.when(F.col("kind") == kind, F.col("norm")).alias(name)
    return (moved.where("kind < 2").select(PACKED_COLUMNS),
            moved.select("f", "se", "n", "se_held", "n_held", norm(0, "nu"), norm(1, "nv")))


class _GridModels:
    """The models of a training, packed, each a table of its own: one is stepped
    after the other, so that the disk holds what one of them moves.  U and V as
    they were given, until a model's first step."""

    def __init__(self, grid: RatingGrid, U: DataFrame, V: DataFrame, d: int):
        self.grid, self.given, self.d, self.state, self.moved = grid, (U, V), d, {}, set()

    def add(self, f: int, u: DataFrame, v: DataFrame) -> None:
        self.state[f] = cut_lineage(self.grid.packed(u, v, self.d))

    def step(self, gamma: float, lam: float, mu: float) -> tuple[dict, DataFrame]:
        """The packed profiles of every model after a step, and the sums of all."""
        new, parts = {}, []
        spark = self.grid.ratings.sparkSession
        with short_batches(spark), shuffles_freed(spark):
            for f, old in self.state.items():
                new[f], sums = _moved_on_grid(self.grid, old, gamma, lam, mu, self.d)
                parts.append(sums)
                release(spark)
        return new, reduce(DataFrame.unionAll, parts)

    def move(self, new: dict, still: list) -> None:
        """On to ``new``, but for the models of ``still``."""
        for f in new:
            if f not in still:
                self.state[f] = new[f]
                self.moved.add(f)

    def keep(self, models: list) -> None:
        self.state = {f: s for f, s in self.state.items() if f in models}

    def profiles(self) -> tuple[DataFrame, DataFrame]:
        """(f, i, u) and (f, j, v) of all models."""
        sides = ([], [])
        for f, s in self.state.items():
            found = self.grid.unpacked(s, self.d) if f in self.moved else [t.where(F.col("f") == f) for t in self.given]
            for side, rows, like, key, own in zip(sides, found, self.given, "ij", "uv"):
                side.append(rows.select("f", F.col(key).cast(like.schema[key].dataType).alias(key), own))
        return tuple(reduce(DataFrame.unionAll, side) for side in sides)


def _of_model(profiles: DataFrame, f: int) -> DataFrame:
    return cut_lineage(profiles.where(F.col("f") == f))


def _in_grid(ratings: DataFrame, models: list, U: DataFrame, V: DataFrame, first: list | None, d: int) -> _GridModels:
    """The grid of ``ratings`` and the models' profiles in it; ``first``: the
    written ones of the first model."""
    spark = ratings.sparkSession
    sizes = [max((r["count"] for r in t.groupBy("f").count().collect()), default=0) for t in (first or (U, V))]
    with shuffles_freed(spark):
        grid = _GridModels(lay_out_grid(ratings, users=sizes[0], items=sizes[1]), U, V, d)
        for f in models:
            grid.add(f, *(first or [_of_model(t, f) for t in (U, V)]))
            if first:
                first.clear()
            release(spark)
    return grid


def _descend(ratings: DataFrame, models: list, U: DataFrame, V: DataFrame, d: int, gain: float, power: float, epsilon: float,
             lam: float, mu: float, maxiter: int, held: bool, blocks: int | None = None,
             hot_ratings: int = HOT_CELLS, log: str | None = None) -> tuple[DataFrame, DataFrame, dict]:
    """Train every model ``f`` of ``models`` on the ratings (i, j, r, fold) of
    other folds; (U, V, {f: history}) with U (f, i, u), V (f, j, v).  ``held``:
    the RMSE is that of the model's own fold, else of its training ratings.
    Each model stops by itself."""
    spark = ratings.sparkSession
    progress = Progress(spark, log, f"f INT, {HISTORY_SCHEMA}")
    kept = progress.history()
    if kept:
        U, V = progress.state("U"), progress.state("V")
    ratings = ratings.persist(DISK_BACKED)
    tested = {r["fold"]: r["count"] for r in ratings.where(F.col("fold").isin(models)).groupBy("fold").count().collect()}
    U, V, grid = U.select("f", "i", "u"), V.select("f", "j", "v"), None
    with shuffles_freed(spark):
        first = [_of_model(t, models[0]) for t in (U, V)]
    # profile tables never grow, so one check holds for all iterations
    small = lambda tables: blocks is None and all(fits_broadcast(p, profile_broadcast_rows(d)) for p in tables)
    fits, gridded = small(first), blocks is None and fits_grid(ratings, U, V)
    if fits or not gridded:
        given, profiles = (U, V), [first, *([_of_model(t, f) for t in (U, V)] for f in models[1:])]
        U, V = (reduce(DataFrame.unionAll, side) for side in zip(*profiles))
        fits = fits and (len(models) == 1 or small((U, V)))
        if not fits and gridded:
            grid = _in_grid(ratings, models, U, V, None, d)
            U, V = given
        profiles = None
    else:
        grid = _in_grid(ratings, models, U, V, first, d)
    first = None
    if grid:
        by_user = by_item = grid.grid
        ratings.unpersist()
        release(spark)
    elif fits:
        by_user = by_item = BroadcastRatings(ratings)
    else:
        by_user, by_item = (lay_out_ratings(ratings, side, blocks, hot_ratings) for side in "ij")
        ratings.unpersist()
    histories, previous, active, started = {f: [] for f in models}, {}, list(models), time.perf_counter()
    for f, *row in kept:
        histories[f].append(tuple(row))
    if kept:
        previous = {f: h[-1][1] for f, h in histories.items()}
        started -= kept[-1][-1]
        last = max(h[-1][0] for h in histories.values())
        active = [f for f, h in histories.items()
                  if h[-1][0] == last and not h[-1][6] and (h[-1][2] is None or h[-1][2] > epsilon)]
        if active:
            U, V = U.where(F.col("f").isin(active)), V.where(F.col("f").isin(active))
            if grid:
                grid.keep(active)
    root = lambda se, n: math.sqrt(se / n) if n and se is not None else None
    with co_partitioned(spark):
        for it in range(1 + max((h[-1][0] for h in histories.values() if h), default=0), max(maxiter, 1) + 1 if active else 0):
            gamma = gain / it ** power if maxiter > 0 else 0.0
            if grid:
                moved, parts = grid.step(gamma, lam, mu)
            else:
                new_u = cut_lineage(_moved(by_user, U, V, "i", gamma, lam, d))
                new_v = cut_lineage(_moved(by_item, U, V, "j", gamma, mu, d))
                zero = F.lit(0.0)
                parts = new_u.select("f", "se", "n", "se_held", "n_held", F.col("norm_sq").alias("nu"), zero.alias("nv")).unionByName(
                    new_v.select("f", *[F.lit(None).cast(t).alias(c) for c, t in
                                        (("se", "double"), ("n", "long"), ("se_held", "double"), ("n_held", "long"))],
                                 zero.alias("nu"), F.col("norm_sq").alias("nv")))
            found = {r["f"]: r for r in parts.groupBy("f").agg(*[F.sum(c).alias(c) for c in parts.columns[1:]]).collect()}
            going, diverged = [], []
            for f in active:
                s = found.get(f)
                value = lambda c: (s[c] if s is not None and s[c] is not None else 0)  # noqa: B023, E731
                obj = float(value("se") + lam * value("nu") + mu * value("nv"))
                change = abs(obj - previous[f]) if f in previous else None
                se, scored, total = ((s and s["se_held"], value("n_held"), tested.get(f, 0)) if held
                                     else (s and s["se"], value("n"), value("n")))
                elapsed = time.perf_counter() - started
                if maxiter <= 0:
                    histories[f].append((0, None, None, root(se, total), root(se, scored), 0.0, False, elapsed))
                    continue
                broken = not math.isfinite(obj)
                histories[f].append((it, obj, change, root(se, total), root(se, scored), gamma, broken, elapsed))
                previous[f] = obj
                if broken:
                    diverged.append(f)
                elif change is None or change > epsilon:
                    going.append(f)
            if maxiter <= 0:
                break
            # a model that has diverged keeps its last finite profiles
            if grid:
                grid.move(moved, diverged)
                parts = moved = None
                U, V = grid.profiles()
                release(spark)
            else:
                fine = F.col("n") > 0
                if diverged:
                    U_last, V_last = U.where(F.col("f").isin(diverged)), V.where(F.col("f").isin(diverged))
                    fine = fine & ~F.col("f").isin(diverged)
                U, V = new_u.where(fine).select("f", "i", "u"), new_v.where(fine).select("f", "j", "v")
                if diverged:
                    U, V = U.unionByName(U_last), V.unionByName(V_last)
            active = going
            progress.commit([(f, *row) for f, rows in histories.items() for row in rows], U=U, V=V)
            if not active:
                break
            if len(active) < len(models):
                U, V = U.where(F.col("f").isin(active)), V.where(F.col("f").isin(active))
                if grid:
                    grid.keep(active)
    for laid in (by_user, by_item):
        laid.drop()
    return U, V, histories


def train(train_r: DataFrame, test_r: DataFrame | None = None, d: int = 10, gain: float = 0.001,
          power: float = 0.2, epsilon: float = 1e-99, lam: float = 0.0, mu: float = 0.0,
          maxiter: int = 20, seed: int = 1234567, U0: DataFrame | None = None,
          V0: DataFrame | None = None, blocks: int | None = None, hot_ratings: int = HOT_CELLS, log: str | None = None) -> MFFit:
    """Gradient descent with gain ``gain / iteration**power``.

    Each iteration measures the objective and the test RMSE of the current
    U, V (before the update), then moves both from the same profiles.
    Stops after ``maxiter`` iterations, when the objective changes by at most
    ``epsilon``, or when it is no longer finite (``diverged``).  With no test
    set the RMSE is measured on the training ratings.  Profiles over the
    broadcast bound have the ratings laid out in a grid of blocks, or always in ``blocks`` blocks of users and of items if that is
    given; a user or item of over ``hot_ratings`` ratings is dealt over all of the latter.  ``log``: a folder that keeps profiles and history of every
    iteration, and from which a run goes on.
    """
    model = F.lit(0).alias("f")
    U = U0 if U0 is not None else random_profiles(train_r, "user", d, seed)
    V = V0 if V0 is not None else random_profiles(train_r, "item", d, seed)
    ratings = train_r.select("i", "j", "r", F.lit(NOBODY).alias("fold"))
    if test_r is not None:
        ratings = ratings.unionByName(test_r.select("i", "j", "r", F.lit(0).alias("fold")))
    U, V, histories = _descend(ratings, [0], U.select(model, "i", "u"), V.select(model, "j", "v"), d, gain, power, epsilon, lam, mu,
                               maxiter, test_r is not None, blocks, hot_ratings, log)
    return MFFit(U.select("i", "u"), V.select("j", "v"), histories[0], histories[0][-1][6])


def cross_validate(ratings: DataFrame, folds: int | None = None, init=None, d: int = 10, gain: float = 0.001,
                   power: float = 0.2, epsilon: float = 1e-99, lam: float = 0.0, mu: float = 0.0, maxiter: int = 20,
                   seed: int = 1234567, blocks: int | None = None, hot_ratings: int = HOT_CELLS,
                   log: str | None = None) -> tuple[DataFrame, list]:
    """Train on all folds but k and test on fold k, for every fold, all in one
    plan: the ratings are laid out once, and each serves the models of all
    other folds for training and its own fold's for testing.

    ``init(train) -> (U0, V0)`` overrides the seeded random profiles.  Returns
    (one row ``folds, cv_rmse`` = mean of each fold's last test RMSE, per-fold
    ``(fold, rmse, history)``)."""
    spark = ratings.sparkSession
    ratings = ratings.select("i", "j", "r", F.col("fold").cast("int").alias("fold")).persist(DISK_BACKED)
    ks = list(range(folds)) if folds is not None else sorted(
        r["fold"] for r in ratings.select("fold").distinct().collect())
    U = V = None
    for k in ks:
        tr, _ = fold_split(ratings, k)
        u, v = init(tr) if init is not None else (random_profiles(tr, "user", d, seed), random_profiles(tr, "item", d, seed))
        u, v = u.select(F.lit(k).alias("f"), "i", "u"), v.select(F.lit(k).alias("f"), "j", "v")
        U, V = (u, v) if U is None else (U.unionByName(u), V.unionByName(v))
    results = []
    if ks:
        _, _, histories = _descend(ratings, ks, U, V, d, gain, power, epsilon, lam, mu, maxiter, True, blocks, hot_ratings, log)
        results = [(k, next((h[3] for h in reversed(histories[k]) if h[3] is not None), None), histories[k]) for k in ks]
    ratings.unpersist()
    rmses = [r for _, r, _ in results if r is not None]
    mean = sum(rmses) / len(rmses) if rmses else None
    summary = spark.createDataFrame([(len(ks), mean)], "folds INT, cv_rmse DOUBLE")
    return summary, results


def fit_all(ratings: DataFrame, output: str | None = None, **kw) -> MFFit:
    """Train on every rating (RMSE measured on the training data) and
    optionally save both profiles at ``output`` (``files.write_factors``)."""
    fit = train(ratings, None, **kw)
    if output:
        from ..sources.files import write_factors
        write_factors(fit.U, fit.V, output)
    return fit
