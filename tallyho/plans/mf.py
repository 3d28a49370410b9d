"""Registered matrix-factorisation queries (capability D) and DuckDB oracles.

Ratings: customer x part from lineitem JOIN orders (``sources.tables.lineitem_ratings``),
four folds.  Every query except ``mf_init`` starts from the deterministic
profiles ``0.1 * sin(id * (k+1) * 0.37)``; ``mf_init`` draws Box-Muller normals
from MD5 digits, which the oracle computes as well.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import gradcheck, mf
from ..sources import tables
from ..session import cut_lineage, shuffles_freed
from .common import rounded, scratch, sql_round

D = 10
FOLDS = 4
TEST_FOLD = 0
GAIN = 0.001
POWER = 0.2
LAM = 0.1
MU = 0.2
STEPS = 2
FULL_STEPS = 20     # the trainers' default; epsilon 1e-99 never stops them earlier
SEED = 1234567
FREQ = 0.37
INIT_SCALE = 0.1
CHECK_DELTA = 1e-6


def _ratings(spark, sf_dir):
    """The derived ratings (lineitem JOIN orders), written once: the initial
    profiles, the training set and the test set all read them.  A table takes a
    fraction of the disk of a checkpoint, whose rows are not compressed."""
    path = scratch(spark, "ratings")
    with shuffles_freed(spark):
        tables.lineitem_ratings(spark, sf_dir, FOLDS).write.parquet(path)
    return spark.read.parquet(path)


def _split(spark, sf_dir):
    return mf.fold_split(_ratings(spark, sf_dir), TEST_FOLD)


def _rules(train):
    """Both rule profiles; the trainers write them."""
    return tuple(mf.rule_profiles(train, side, D, FREQ, INIT_SCALE) for side in ("user", "item"))


def _init(train):
    """Both rule profiles, written once: the join and the step read them."""
    return tuple(map(cut_lineage, _rules(train)))


def _both(U, V):
    cols = [f"f{k}" for k in range(D)]
    u = mf.expand(U, D, "i", "u", "f").select(F.lit("user").alias("side"), F.col("i").alias("id"), *cols)
    v = mf.expand(V, D, "j", "v", "f").select(F.lit("item").alias("side"), F.col("j").alias("id"), *cols)
    return u.unionByName(v)


def q_distinct_ids(spark, sf_dir):
    return mf.distinct_ids(tables.lineitem_ratings(spark, sf_dir, FOLDS))


def q_counts(spark, sf_dir):
    return mf.fold_counts(tables.lineitem_ratings(spark, sf_dir, FOLDS))


def q_fold_split(spark, sf_dir):
    train, test = mf.fold_split(tables.lineitem_ratings(spark, sf_dir, FOLDS), TEST_FOLD)
    return rounded(train.withColumn("split", F.lit("train"))
                   .unionByName(test.withColumn("split", F.lit("test"))))


def q_join_predict(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, V = _init(train)
    return rounded(mf.join_predict(train, U, V, D).select("i", "j", "r", "delta"))


def q_se(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, V = _init(train)
    return rounded(mf.squared_error(mf.join_predict(train, U, V, D)))


def q_norm_sq(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, _ = _init(train)
    return rounded(mf.norm_sq(U, "u", D, LAM))


def q_objective(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, V = _init(train)
    return rounded(mf.objective(mf.join_predict(train, U, V, D), U, V, D, LAM, MU))


def q_step_u(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, V = _init(train)
    new = mf.step_u(mf.join_predict(train, U, V, D), U, GAIN, LAM, D)
    return rounded(mf.expand(new, D, "i", "u", "u"))


def q_step_v(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, V = _init(train)
    new = mf.step_v(mf.join_predict(train, U, V, D), V, GAIN, MU, D)
    return rounded(mf.expand(new, D, "j", "v", "v"))


def q_fit_all(spark, sf_dir):
    ratings = _ratings(spark, sf_dir)
    U, V = _rules(ratings)
    fit = mf.fit_all(ratings, d=D, gain=GAIN, power=POWER, lam=LAM, mu=MU, maxiter=STEPS,
                     U0=U, V0=V)
    return rounded(_both(fit.U, fit.V))


def q_rmse(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    U, V = _init(train)
    return rounded(mf.rmse(test, U, V, D))


def q_train(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    U, V = _rules(train)
    fit = mf.train(train, test, d=D, gain=GAIN, power=POWER, lam=LAM, mu=MU, maxiter=STEPS,
                   U0=U, V0=V)
    return rounded(_both(fit.U, fit.V))


def q_cv_rmse(spark, sf_dir):
    summary, _ = mf.cross_validate(_ratings(spark, sf_dir), folds=FOLDS, init=_rules,
                                   d=D, gain=GAIN, power=POWER, lam=LAM,
                                   mu=MU, maxiter=STEPS)
    return rounded(summary)


# To the trainers' own stop (20 iterations, epsilon 1e-99).

def q_train_full(spark, sf_dir):
    train, test = _split(spark, sf_dir)
    U, V = _rules(train)
    fit = mf.train(train, test, d=D, gain=GAIN, power=POWER, lam=LAM, mu=MU, U0=U, V0=V)
    return rounded(_both(fit.U, fit.V))


def q_fit_all_full(spark, sf_dir):
    ratings = _ratings(spark, sf_dir)
    U, V = _rules(ratings)
    fit = mf.fit_all(ratings, d=D, gain=GAIN, power=POWER, lam=LAM, mu=MU, U0=U, V0=V)
    return rounded(_both(fit.U, fit.V))


def q_cv_rmse_full(spark, sf_dir):
    summary, _ = mf.cross_validate(_ratings(spark, sf_dir), folds=FOLDS, init=_rules, d=D,
                                   gain=GAIN, power=POWER, lam=LAM, mu=MU)
    return rounded(summary)


def q_gradient_check(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, V = _init(train)
    return rounded(gradcheck.mf_check(train, U, V, D, LAM, CHECK_DELTA))


def q_gradient_check_items(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    U, V = _init(train)
    return rounded(gradcheck.mf_check(train, U, V, D, MU, CHECK_DELTA, side="item"))


def random_init(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return mf.random_profiles(train, "user", D, SEED), mf.random_profiles(train, "item", D, SEED)


def q_init(spark, sf_dir):
    return rounded(_both(*random_init(spark, sf_dir)))


QUERIES = {
    "distinct_ids": q_distinct_ids,
    "mf_counts": q_counts,
    "fold_split": q_fold_split,
    "mf_join_predict": q_join_predict,
    "mf_se": q_se,
    "mf_norm_sq": q_norm_sq,
    "mf_objective": q_objective,
    "mf_step_u": q_step_u,
    "mf_step_v": q_step_v,
    "mf_train": q_train,
    "mf_train_full": q_train_full,
    "mf_fit_all": q_fit_all,
    "mf_fit_all_full": q_fit_all_full,
    "mf_rmse": q_rmse,
    "mf_cv_rmse": q_cv_rmse,
    "mf_cv_rmse_full": q_cv_rmse_full,
    "mf_gradient_check": q_gradient_check,
    "mf_gradient_check_items": q_gradient_check_items,
    "mf_init": q_init,
}


# ---------------------------------------------------------------- oracles --

def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


_R = ("R AS MATERIALIZED (SELECT o_custkey AS i, l_partkey AS j, l_quantity / 50.0 AS r, "
      f"CAST((l_orderkey + l_linenumber) % {FOLDS} AS INTEGER) AS fold "
      "FROM lineitem JOIN orders ON l_orderkey = o_orderkey)")


def _profiles(name: str, src: str, key: str, p: str) -> str:
    cols = ", ".join(f"sin(CAST({key} AS DOUBLE) * {_d(float(k + 1))} * {_d(FREQ)}) * {_d(INIT_SCALE)} AS {p}{k}"
                     for k in range(D))
    return f"{name} AS MATERIALIZED (SELECT {key}, {cols} FROM (SELECT DISTINCT {key} FROM {src}))"


def _dot(a: str, b: str) -> str:
    return "(" + " + ".join(f"{a}{k} * {b}{k}" for k in range(D)) + ")"


def _join(name: str, src: str, U: str, V: str, how: str = "JOIN") -> str:
    us = ", ".join(f"{U}.u{k}" for k in range(D))
    vs = ", ".join(f"{V}.v{k}" for k in range(D))
    return (f"{name} AS MATERIALIZED (SELECT x.i, x.j, x.r, {us}, {vs}, {_dot('u', 'v')} - x.r AS delta FROM {src} x "
            f"{how} {U} ON x.i = {U}.i {how} {V} ON x.j = {V}.j)")


def _step(name: str, J: str, key: str, own: str, other: str, gamma: float, reg: float) -> str:
    shrink = gamma * 2 * reg
    cols = ", ".join(
        f"any_value({own}{k}) - {_d(gamma)} * sum(2.0 * delta * {other}{k}) - {_d(shrink)} * any_value({own}{k}) "
        f"AS {own}{k}" for k in range(D))
    return f"{name} AS MATERIALIZED (SELECT {key}, {cols} FROM {J} GROUP BY {key})"


def _base(extra=()) -> str:
    ctes = [_R, f"T AS (SELECT * FROM R WHERE fold <> {TEST_FOLD})",
            f"E AS (SELECT * FROM R WHERE fold = {TEST_FOLD})",
            _profiles("U0", "T", "i", "u"), _profiles("V0", "T", "j", "v")] + list(extra)
    return "WITH " + ", ".join(ctes) + " "


def _rmse_select(J: str) -> str:
    return (f"SELECT count(*) AS n_test, count(delta) AS n_scored, "
            f"{sql_round('sqrt(sum(delta * delta) / count(*))', 'rmse')}, "
            f"{sql_round('sqrt(sum(delta * delta) / nullif(count(delta), 0))', 'rmse_scored')} FROM {J}")


def _train_ctes(tag: str, T: str, U0: str, V0: str, steps: int) -> list[str]:
    ctes = []
    U, V = U0, V0
    for it in range(1, steps + 1):
        gamma = GAIN / it ** POWER
        ctes.append(_join(f"J{tag}_{it}", T, U, V))
        ctes.append(_step(f"U{tag}_{it}", f"J{tag}_{it}", "i", "u", "v", gamma, LAM))
        ctes.append(_step(f"V{tag}_{it}", f"J{tag}_{it}", "j", "v", "u", gamma, MU))
        U, V = f"U{tag}_{it}", f"V{tag}_{it}"
    return ctes


def _expand_both(U: str, V: str) -> str:
    fu = ", ".join(sql_round(f"u{k}", f"f{k}") for k in range(D))
    fv = ", ".join(sql_round(f"v{k}", f"f{k}") for k in range(D))
    return (f"SELECT 'user' AS side, i AS id, {fu} FROM {U} UNION ALL "
            f"SELECT 'item' AS side, j AS id, {fv} FROM {V}")


def _cv_sql(steps: int = STEPS) -> str:
    ctes = [_R]
    rm = []
    for f in range(FOLDS):
        ctes.append(f"T{f} AS (SELECT * FROM R WHERE fold <> {f})")
        ctes.append(f"E{f} AS (SELECT * FROM R WHERE fold = {f})")
        ctes.append(_profiles(f"UA{f}", f"T{f}", "i", "u"))
        ctes.append(_profiles(f"VA{f}", f"T{f}", "j", "v"))
        # the last reported RMSE belongs to the profiles before the last update
        ctes += _train_ctes(f"c{f}", f"T{f}", f"UA{f}", f"VA{f}", steps - 1)
        last_u = f"Uc{f}_{steps - 1}" if steps > 1 else f"UA{f}"
        last_v = f"Vc{f}_{steps - 1}" if steps > 1 else f"VA{f}"
        ctes.append(_join(f"X{f}", f"E{f}", last_u, last_v, "LEFT JOIN"))
        rm.append(f"SELECT sqrt(sum(delta * delta) / count(*)) AS rmse FROM X{f}")
    ctes.append("F AS (" + " UNION ALL ".join(rm) + ")")
    return ("WITH " + ", ".join(ctes) + f" SELECT {FOLDS} AS folds, {sql_round('avg(rmse)', 'cv_rmse')} FROM F")


_ud = ", ".join(sql_round(f"u{k}", f"u{k}") for k in range(D))
_vd = ", ".join(sql_round(f"v{k}", f"v{k}") for k in range(D))

ORACLE = {
    "distinct_ids": ("WITH " + _R + " SELECT DISTINCT 'user' AS kind, i AS id FROM R "
                     "UNION ALL SELECT DISTINCT 'item' AS kind, j AS id FROM R"),
    "mf_counts": (
        "WITH " + _R + ", F AS (SELECT DISTINCT fold FROM R) "
        "SELECT F.fold, "
        "(SELECT count(*) FROM R WHERE R.fold <> F.fold) AS n_train, "
        "(SELECT count(*) FROM R WHERE R.fold = F.fold) AS n_test, "
        "(SELECT count(DISTINCT i) FROM R WHERE R.fold <> F.fold) AS n_users, "
        "(SELECT count(DISTINCT j) FROM R WHERE R.fold <> F.fold) AS n_items FROM F"),
    "fold_split": ("WITH " + _R + f" SELECT i, j, {sql_round('r', 'r')}, fold, "
                   f"CASE WHEN fold = {TEST_FOLD} THEN 'test' ELSE 'train' END AS split FROM R"),
    "mf_join_predict": _base([_join("J", "T", "U0", "V0")])
                       + f"SELECT i, j, {sql_round('r', 'r')}, {sql_round('delta', 'delta')} FROM J",
    "mf_se": _base([_join("J", "T", "U0", "V0")]) + f"SELECT count(*) AS n, {sql_round('sum(delta * delta)', 'se')} FROM J",
    "mf_norm_sq": _base() + f"SELECT {sql_round(f'{_d(LAM)} * sum({_dot(chr(117), chr(117))})', 'norm_sq')} FROM U0",
    "mf_objective": _base([_join("J", "T", "U0", "V0"),
                           "S AS (SELECT sum(delta * delta) AS se FROM J)",
                           f"NU AS (SELECT sum({_dot('u', 'u')}) AS nu FROM U0)",
                           f"NV AS (SELECT sum({_dot('v', 'v')}) AS nv FROM V0)"]) + (
        f"SELECT {sql_round('se', 'se')}, {sql_round('nu', 'norm_u')}, {sql_round('nv', 'norm_v')}, "
        f"{sql_round(f'se + {_d(LAM)} * nu + {_d(MU)} * nv', 'objective')} FROM S, NU, NV"),
    "mf_step_u": _base([_join("J", "T", "U0", "V0"), _step("U1", "J", "i", "u", "v", GAIN, LAM)])
                 + f"SELECT i, {_ud} FROM U1",
    "mf_step_v": _base([_join("J", "T", "U0", "V0"), _step("V1", "J", "j", "v", "u", GAIN, MU)])
                 + f"SELECT j, {_vd} FROM V1",
    "mf_train": _base(_train_ctes("t", "T", "U0", "V0", STEPS)) + _expand_both(f"Ut_{STEPS}", f"Vt_{STEPS}"),
    "mf_fit_all": ("WITH " + ", ".join([_R, _profiles("UF", "R", "i", "u"), _profiles("VF", "R", "j", "v")]
                                       + _train_ctes("f", "R", "UF", "VF", STEPS)) + " "
                   + _expand_both(f"Uf_{STEPS}", f"Vf_{STEPS}")),
    "mf_rmse": _base([_join("X", "E", "U0", "V0", "LEFT JOIN")]) + _rmse_select("X"),
    "mf_cv_rmse": _cv_sql(),
    "mf_gradient_check": _base([
        _join("J", "T", "U0", "V0"),
        "S AS (SELECT i, " + ", ".join(
            f"sum(2.0 * delta * v{k}) AS a{k}, "
            f"sum((delta + {_d(CHECK_DELTA)} * v{k}) * (delta + {_d(CHECK_DELTA)} * v{k}) - delta * delta) AS n{k}"
            for k in range(D)) + " FROM J GROUP BY i)",
        "C AS (" + " UNION ALL ".join(
            f"SELECT S.i, {k} AS k, a{k} + {_d(2.0 * LAM)} * U0.u{k} AS analytic, "
            f"(n{k} + {_d(LAM)} * ((U0.u{k} + {_d(CHECK_DELTA)}) * (U0.u{k} + {_d(CHECK_DELTA)}) "
            f"- U0.u{k} * U0.u{k})) / {_d(CHECK_DELTA)} AS numeric FROM S JOIN U0 ON S.i = U0.i"
            for k in range(D)) + ")"]) + (
        f"SELECT i, k, {sql_round('analytic', 'analytic')}, {sql_round('numeric', 'numeric')}, "
        f"{sql_round('abs(analytic - numeric)', 'abs_diff')} FROM C"),
}


def _uniform_sql(key: str, k: int, side: str, n: int) -> str:
    text = f"CAST({key} AS VARCHAR) || ':{k}:{SEED}:{mf.SIDE_SALT[side]}:{n}'"
    return f"((CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) + 0.5::DOUBLE) / {_d(mf.TWO_POW_52)})"


def _init_sql() -> str:
    parts = []
    for side, key in (("user", "i"), ("item", "j")):
        cols = ", ".join(sql_round(f"sqrt(-2.0 * ln({_uniform_sql(key, k, side, 1)})) * "
                                   f"cos({_d(2.0 * math.pi)} * {_uniform_sql(key, k, side, 2)})", f"f{k}") for k in range(D))
        parts.append(f"SELECT '{side}' AS side, {key} AS id, {cols} FROM (SELECT DISTINCT {key} FROM T)")
    return _base() + " UNION ALL ".join(parts)


ORACLE["mf_init"] = _init_sql()
ORACLE["mf_gradient_check_items"] = _base([
    _join("J", "T", "U0", "V0"),
    "S AS (SELECT j, " + ", ".join(
        f"sum(2.0 * delta * u{k}) AS a{k}, "
        f"sum((delta + {_d(CHECK_DELTA)} * u{k}) * (delta + {_d(CHECK_DELTA)} * u{k}) - delta * delta) AS n{k}"
        for k in range(D)) + " FROM J GROUP BY j)",
    "C AS (" + " UNION ALL ".join(
        f"SELECT S.j, {k} AS k, a{k} + {_d(2.0 * MU)} * V0.v{k} AS analytic, "
        f"(n{k} + {_d(MU)} * ((V0.v{k} + {_d(CHECK_DELTA)}) * (V0.v{k} + {_d(CHECK_DELTA)}) "
        f"- V0.v{k} * V0.v{k})) / {_d(CHECK_DELTA)} AS numeric FROM S JOIN V0 ON S.j = V0.j"
        for k in range(D)) + ")"]) + (
    f"SELECT j, k, {sql_round('analytic', 'analytic')}, {sql_round('numeric', 'numeric')}, "
    f"{sql_round('abs(analytic - numeric)', 'abs_diff')} FROM C")

# the full trainings: the same steps, as often as the trainers take them
ORACLE["mf_train_full"] = _base(_train_ctes("t", "T", "U0", "V0", FULL_STEPS)) + _expand_both(f"Ut_{FULL_STEPS}", f"Vt_{FULL_STEPS}")
ORACLE["mf_fit_all_full"] = "WITH " + ", ".join([
    _R, _profiles("U0", "R", "i", "u"), _profiles("V0", "R", "j", "v"), *_train_ctes("a", "R", "U0", "V0", FULL_STEPS)]) + (
    " " + _expand_both(f"Ua_{FULL_STEPS}", f"Va_{FULL_STEPS}"))
ORACLE["mf_cv_rmse_full"] = _cv_sql(FULL_STEPS)
