"""Registered sparse-vector and logistic-regression queries (capability C)
and their DuckDB oracles.

Data: labelled documents as sparse points (``sources.tables.labelled_points``).
Two data-derived sparse vectors drive the fixed-model queries: ``a`` and
``b`` are the per-feature sums of x over the positive and the negative
points, and ``beta = 0.01 * (a - b)``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gradcheck, logreg, vectors
from ..sources import tables
from ..session import cut_lineage
from .common import rounded, sql_round
from .text import _counts, _words_token

LAM = 0.1
SCALE = 0.5
BETA_SCALE = 0.01
BUCKETS = 8
STEEP = 1e5
STEEP_TRIALS = 120
TRAIN_STEPS = 2
NEVER = 1e-12
FULL_STEPS, FULL_EPS = 40, 0.1      # the trainer's defaults
# forward-difference step of the registered check: large enough that the
# rounding of each loss (~1e-16) divided by it stays far below 1e-6
CHECK_DELTA = 1e-3


def _data(spark, sf_dir):
    """Points and their bag-of-words cells; the cells (tokenised text) are
    written once to the checkpoint folder because every query below reads
    them several times."""
    points, cells = tables.labelled_points(spark, sf_dir)
    return points, cut_lineage(cells)


def _class_sums(points, cells):
    """(a, b): per-feature sums of x over the positive / negative points,
    each holding only the features that occur in its class.  One aggregate,
    written once (both vectors are read by several joins)."""
    joined = cells.join(points, "id")
    both = cut_lineage(joined.groupBy("feat").agg(
        F.sum(F.when(F.col("y") > 0, F.col("x"))).alias("pos"),
        F.sum(F.when(F.col("y") < 0, F.col("x"))).alias("neg")))
    a = both.filter(F.col("pos").isNotNull()).select("feat", F.col("pos").alias("value"))
    b = both.filter(F.col("neg").isNotNull()).select("feat", F.col("neg").alias("value"))
    return a, b


def _fixed_beta(points, cells):
    """``0.01 * (a - b)``, materialised: the model is read by several joins."""
    a, b = _class_sums(points, cells)
    return cut_lineage(vectors.vec_scale(vectors.vec_sub(a, b), BETA_SCALE))


def q_vec_add(spark, sf_dir):
    return rounded(vectors.vec_add(*_class_sums(*_data(spark, sf_dir))))


def q_vec_sub(spark, sf_dir):
    return rounded(vectors.vec_sub(*_class_sums(*_data(spark, sf_dir))))


def q_vec_scale(spark, sf_dir):
    a, _ = _class_sums(*_data(spark, sf_dir))
    return rounded(vectors.vec_scale(a, SCALE))


def q_vec_dot(spark, sf_dir):
    return rounded(vectors.vec_dot(*_class_sums(*_data(spark, sf_dir))))


def q_vec_norm_sq(spark, sf_dir):
    a, _ = _class_sums(*_data(spark, sf_dir))
    return rounded(vectors.vec_norm_sq(a))


def q_vec_get(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    a, _ = _class_sums(points, cells)
    return rounded(vectors.vec_get(a, logreg.sparse_features(cells)))


def q_bucket_points(spark, sf_dir):
    points, _ = tables.labelled_points(spark, sf_dir)      # cells not needed
    return logreg.bucket_points(points, BUCKETS, method="mod")


def q_dot_sparse(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    return rounded(logreg.dot_sparse(cells, _fixed_beta(points, cells), points))


def q_sparse_features(spark, sf_dir):
    _, cells = _data(spark, sf_dir)
    return logreg.sparse_features(cells)


def q_feature_buckets(spark, sf_dir):
    _, cells = _data(spark, sf_dir)
    return logreg.feature_buckets(cells, BUCKETS, method="mod")


def q_bucket_stats(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    return rounded(logreg.bucket_stats(points, cells, BUCKETS, method="mod"))


def q_margins(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    return rounded(logreg.margins(points, cells, _fixed_beta(points, cells)))


def q_loss(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    return rounded(logreg.loss(points, cells, _fixed_beta(points, cells), LAM))


def q_gradient(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    return rounded(logreg.gradient(points, cells, _fixed_beta(points, cells), LAM))


def q_cell_gradients(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    return rounded(logreg.cell_gradients(points, cells, _fixed_beta(points, cells)))


def q_line_search(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    beta = _fixed_beta(points, cells)
    g = logreg.gradient(points, cells, beta, LAM)
    r = logreg.line_search(points, cells, beta, g, LAM)
    return rounded(spark.createDataFrame(
        [(r.t, r.backtracks, r.f0, r.f_new)], "t DOUBLE, backtracks INT, f0 DOUBLE, f_new DOUBLE"))


def q_line_search_steep(spark, sf_dir):
    """Cells so large that the first accepted step lies beyond one block of
    trials."""
    points, cells = _data(spark, sf_dir)
    cells = cut_lineage(cells.withColumn("x", F.col("x") * STEEP))
    beta = cut_lineage(logreg.zero_beta(cells))
    g = logreg.gradient(points, cells, beta, LAM)
    r = logreg.line_search(points, cells, beta, g, LAM)
    return rounded(spark.createDataFrame([(r.backtracks, r.f0, r.f_new, r.f_new < r.f0)],
                                         "backtracks INT, f0 DOUBLE, f_new DOUBLE, lower BOOLEAN"))


def q_train(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    fit = logreg.train(points, cells, lam=LAM, max_iter=TRAIN_STEPS, eps=NEVER)
    return rounded(fit.beta)


def q_train_full(spark, sf_dir):
    """To the trainer's own stop (40 iterations, eps 0.1)."""
    points, cells = _data(spark, sf_dir)
    return rounded(logreg.train(points, cells, lam=LAM).beta)


def q_gradient_check(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    beta = _fixed_beta(points, cells)
    return rounded(gradcheck.logreg_check(points, cells, beta, LAM, CHECK_DELTA))


def q_confusion(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    return logreg.confusion(logreg.margins(points, cells, _fixed_beta(points, cells)))


def q_metrics(spark, sf_dir):
    points, cells = _data(spark, sf_dir)
    conf = logreg.confusion(logreg.margins(points, cells, _fixed_beta(points, cells)))
    return rounded(logreg.metrics(conf))


QUERIES = {
    "vec_add": q_vec_add,
    "vec_sub": q_vec_sub,
    "vec_scale": q_vec_scale,
    "vec_dot": q_vec_dot,
    "vec_norm_sq": q_vec_norm_sq,
    "vec_get": q_vec_get,
    "bucket_points": q_bucket_points,
    "dot_sparse": q_dot_sparse,
    "sparse_features": q_sparse_features,
    "feature_buckets": q_feature_buckets,
    "bucket_stats": q_bucket_stats,
    "margins": q_margins,
    "logreg_loss": q_loss,
    "logreg_gradient": q_gradient,
    "logreg_cell_gradients": q_cell_gradients,
    "logreg_line_search": q_line_search,
    "logreg_line_search_steep": q_line_search_steep,
    "logreg_train": q_train,
    "logreg_train_full": q_train_full,
    "logreg_gradient_check": q_gradient_check,
    "confusion": q_confusion,
    "classification_metrics": q_metrics,
}


# ---------------------------------------------------------------- oracles --

def _d(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


_LABELLED = "(SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))"
_BASE = [
    "pts AS MATERIALIZED (SELECT doc_id AS id, CASE WHEN quality = 1 THEN 1.0 ELSE -1.0 END::DOUBLE AS y FROM labels)",
    f"cells AS MATERIALIZED (SELECT doc_id AS id, word AS feat, CAST(n AS DOUBLE) / 100.0 AS x "
    f"FROM {_counts(_words_token(_LABELLED, 'doc_id'), 'doc_id')})",
    "va AS (SELECT feat, sum(x) AS value FROM cells JOIN pts USING (id) WHERE y > 0 GROUP BY feat)",
    "vb AS (SELECT feat, sum(x) AS value FROM cells JOIN pts USING (id) WHERE y < 0 GROUP BY feat)",
    f"beta AS MATERIALIZED (SELECT coalesce(va.feat, vb.feat) AS feat, "
    f"(coalesce(va.value, 0.0) - coalesce(vb.value, 0.0)) * {_d(BETA_SCALE)} AS value "
    "FROM va FULL OUTER JOIN vb ON va.feat = vb.feat)",
]


def _with(*extra: str) -> str:
    return "WITH " + ", ".join(_BASE + list(extra)) + " "


def _log1pexp(z: str) -> str:
    return f"(CASE WHEN ({z}) > 0 THEN ({z}) + ln(1.0 + exp(-({z}))) ELSE ln(1.0 + exp({z})) END)"


def _loss(y: str, m: str) -> str:
    return _log1pexp(f"-({y}) * ({m})")


def _margins_cte(name: str, beta: str) -> str:
    return (f"{name} AS MATERIALIZED (SELECT p.id, p.y, coalesce(sum(c.x * bt.value), 0.0) AS margin FROM pts p "
            f"LEFT JOIN cells c ON c.id = p.id LEFT JOIN {beta} bt ON bt.feat = c.feat GROUP BY p.id, p.y)")


def _gradient_cte(name: str, m: str, beta: str, lam: float) -> str:
    return (f"{name} AS MATERIALIZED (SELECT feat, sum(v) AS value FROM ("
            f"SELECT c.feat, (-mm.y / (1.0 + exp(mm.y * mm.margin))) * c.x AS v FROM cells c JOIN {m} mm ON mm.id = c.id "
            f"UNION ALL SELECT feat, {_d(2.0 * lam)} * value AS v FROM {beta}) GROUP BY feat)")


def _search_ctes(tag: str, m: str, beta: str, g: str, lam: float, kmax: int = logreg.TRIAL_BLOCK):
    """CTEs bg{tag}, st{tag}, md{tag}, ls{tag}, ch{tag} (the chosen step)."""
    a, b = logreg.ARMIJO_A, logreg.SHRINK_B
    ctes = [
        f"bg{tag} AS MATERIALIZED (SELECT coalesce(x1.feat, x2.feat) AS feat, coalesce(x1.value, 0.0) AS b, "
        f"coalesce(x2.value, 0.0) AS g FROM {beta} x1 FULL OUTER JOIN {g} x2 ON x1.feat = x2.feat)",
        f"st{tag} AS (SELECT sum(b * b) AS bb, sum(b * g) AS bg, sum(g * g) AS gg FROM bg{tag})",
        f"md{tag} AS MATERIALIZED (SELECT mm.id, mm.y, mm.margin, coalesce(dd.dm, 0.0) AS dm FROM {m} mm LEFT JOIN "
        f"(SELECT c.id, sum(c.x * q.g) AS dm FROM cells c JOIN bg{tag} q ON q.feat = c.feat GROUP BY c.id) dd "
        "ON dd.id = mm.id)",
    ]
    sums = [f"sum({_loss('y', 'margin')}) AS f0d"]
    sums += [f"sum({_loss('y', f'margin - {_d(b ** k)} * dm')}) AS l{k}" for k in range(kmax)]
    ctes.append(f"ls{tag} AS MATERIALIZED (SELECT {', '.join(sums)} FROM md{tag})")
    lam_d = _d(lam)
    f0 = f"(f0d + {lam_d} * bb)"
    fk = [f"(l{k} + {lam_d} * (bb - 2.0 * {_d(b ** k)} * bg + {_d(b ** k * b ** k)} * gg))" for k in range(kmax)]
    conds = [f"NOT ({fk[k]} > {f0} - {_d(a)} * {_d(b ** k)} * gg)" for k in range(kmax)]
    t = "CASE " + " ".join(f"WHEN {conds[k]} THEN {_d(b ** k)}" for k in range(kmax)) + " ELSE 0.0 END"
    nb = "CASE " + " ".join(f"WHEN {conds[k]} THEN {k}" for k in range(kmax)) + f" ELSE {kmax} END"
    fnew = "CASE " + " ".join(f"WHEN {conds[k]} THEN {fk[k]}" for k in range(kmax)) + f" ELSE {f0} END"
    ctes.append(f"ch{tag} AS (SELECT {t} AS t, {nb} AS backtracks, {f0} AS f0, {fnew} AS f_new "
                f"FROM ls{tag}, st{tag})")
    return ctes


def _train_sql(steps: int = TRAIN_STEPS, eps: float = NEVER) -> str:
    """``steps`` iterations; those after the stop rule hold have step 0."""
    ctes = ["b0 AS (SELECT DISTINCT feat, 0.0::DOUBLE AS value FROM cells)", _margins_cte("m0", "b0"), "k0 AS (SELECT false AS done)"]
    for s in range(1, steps + 1):
        p = s - 1
        ctes.append(_gradient_cte(f"g{s}", f"m{p}", f"b{p}", LAM))
        ctes += _search_ctes(str(s), f"m{p}", f"b{p}", f"g{s}", LAM)
        ctes.append(f"k{s} AS MATERIALIZED (SELECT CASE WHEN k{p}.done THEN 0.0 ELSE ch{s}.t END AS t, "
                    f"k{p}.done OR ch{s}.t = 0.0 OR sqrt(gg) <= {_d(eps)} AS done FROM ch{s}, st{s}, k{p})")
        ctes.append(f"b{s} AS MATERIALIZED (SELECT feat, b - k{s}.t * g AS value FROM bg{s}, k{s})")
        ctes.append(f"m{s} AS MATERIALIZED (SELECT id, y, margin - k{s}.t * dm AS margin FROM md{s}, k{s})")
    return _with(*ctes) + f"SELECT feat, {sql_round('value', 'value')} FROM b{steps}"


def _steep_sql() -> str:
    ctes = [f"steep AS (SELECT id, feat, x * {_d(STEEP)} AS x FROM cells)",
            "b0 AS (SELECT DISTINCT feat, 0.0::DOUBLE AS value FROM cells)"]
    rest = [_margins_cte("m0", "b0"), _gradient_cte("g0", "m0", "b0", LAM),
            *_search_ctes("9", "m0", "b0", "g0", LAM, STEEP_TRIALS)]
    ctes += [c.replace("cells c", "steep c") for c in rest]
    return _with(*ctes) + (f"SELECT backtracks, {sql_round('f0', 'f0')}, {sql_round('f_new', 'f_new')}, "
                           "f_new < f0 AS lower FROM ch9")


def _confusion_select() -> str:
    return ("SELECT CAST(sum(CASE WHEN margin > 0 THEN 1 ELSE 0 END) AS BIGINT) AS P, "
            "CAST(sum(CASE WHEN margin <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS N, "
            "CAST(sum(CASE WHEN margin > 0 AND y > 0 THEN 1 ELSE 0 END) AS BIGINT) AS TP, "
            "CAST(sum(CASE WHEN margin > 0 AND y < 0 THEN 1 ELSE 0 END) AS BIGINT) AS FP, "
            "CAST(sum(CASE WHEN margin <= 0 AND y < 0 THEN 1 ELSE 0 END) AS BIGINT) AS TN, "
            "CAST(sum(CASE WHEN margin <= 0 AND y > 0 THEN 1 ELSE 0 END) AS BIGINT) AS FN FROM m")


_FULL = ("SELECT coalesce(va.feat, vb.feat) AS feat, "
         "{expr} FROM va FULL OUTER JOIN vb ON va.feat = vb.feat")

ORACLE = {
    "vec_add": _with() + _FULL.format(expr=sql_round("coalesce(va.value, 0.0) + coalesce(vb.value, 0.0)", "value")),
    "vec_sub": _with() + _FULL.format(expr=sql_round("coalesce(va.value, 0.0) - coalesce(vb.value, 0.0)", "value")),
    "vec_scale": _with() + f"SELECT feat, {sql_round(f'value * {_d(SCALE)}', 'value')} FROM va",
    "vec_dot": _with() + f"SELECT {sql_round('coalesce(sum(va.value * vb.value), 0.0)', 'dot')} "
                         "FROM va JOIN vb ON va.feat = vb.feat",
    "vec_norm_sq": _with() + f"SELECT {sql_round('coalesce(sum(value * value), 0.0)', 'norm_sq')} FROM va",
    "vec_get": _with() + ("SELECT f.feat, " + sql_round("coalesce(va.value, 0.0)", "value")
                          + " FROM (SELECT DISTINCT feat FROM cells) f LEFT JOIN va ON va.feat = f.feat"),
    "bucket_points": _with() + f"SELECT id, y, CAST(id % {BUCKETS} AS INTEGER) AS bucket FROM pts",
    "dot_sparse": _with(_margins_cte("m", "beta")) + f"SELECT id, {sql_round('margin', 'dot')} FROM m",
    "sparse_features": _with() + "SELECT DISTINCT feat FROM cells",
    "feature_buckets": _with() + f"SELECT DISTINCT feat, CAST(id % {BUCKETS} AS INTEGER) AS bucket FROM cells",
    "bucket_stats": _with(
        f"bp AS (SELECT id % {BUCKETS} AS bucket, count(*) AS n_points FROM pts GROUP BY 1)",
        f"bf AS (SELECT id % {BUCKETS} AS bucket, count(DISTINCT feat) AS n_features FROM cells GROUP BY 1)",
        "per AS (SELECT bp.bucket, n_points, coalesce(n_features, 0) AS n_features FROM bp "
        "LEFT JOIN bf ON bp.bucket = bf.bucket)") + (
        "SELECT min(n_points) AS points_min, max(n_points) AS points_max, "
        f"{sql_round('avg(n_points)', 'points_avg')}, min(n_features) AS features_min, "
        f"max(n_features) AS features_max, {sql_round('avg(n_features)', 'features_avg')} FROM per"),
    "margins": _with(_margins_cte("m", "beta")) + f"SELECT id, {sql_round('y', 'y')}, {sql_round('margin', 'margin')} FROM m",
    "logreg_loss": _with(_margins_cte("m", "beta"),
                         f"dl AS (SELECT sum({_loss('y', 'margin')}) AS data_loss FROM m)",
                         "nq AS (SELECT sum(value * value) AS norm_sq FROM beta)") + (
        f"SELECT {sql_round('data_loss', 'data_loss')}, {sql_round('norm_sq', 'norm_sq')}, "
        f"{sql_round(f'data_loss + {_d(LAM)} * norm_sq', 'loss')} FROM dl, nq"),
    "logreg_gradient": _with(_margins_cte("m", "beta"), _gradient_cte("g", "m", "beta", LAM))
                       + f"SELECT feat, {sql_round('value', 'value')} FROM g",
    "logreg_cell_gradients": _with(_margins_cte("m", "beta")) + (
        "SELECT c.id, c.feat, " + sql_round("(-mm.y / (1.0 + exp(mm.y * mm.margin))) * c.x", "value")
        + " FROM cells c JOIN m mm ON mm.id = c.id"),
    "logreg_line_search": _with(_margins_cte("m", "beta"), _gradient_cte("g", "m", "beta", LAM),
                                *_search_ctes("1", "m", "beta", "g", LAM)) + (
        f"SELECT {sql_round('t', 't')}, backtracks, {sql_round('f0', 'f0')}, {sql_round('f_new', 'f_new')} FROM ch1"),
    "logreg_line_search_steep": _steep_sql(),
    "logreg_train": _train_sql(),
    "logreg_train_full": _train_sql(FULL_STEPS, FULL_EPS),
    "logreg_gradient_check": _with(
        _margins_cte("m", "beta"),
        f"pc AS (SELECT c.feat, (-mm.y / (1.0 + exp(mm.y * mm.margin))) * c.x AS g, "
        f"{_loss('mm.y', f'mm.margin + {_d(CHECK_DELTA)} * c.x')} - {_loss('mm.y', 'mm.margin')} AS dl "
        "FROM cells c JOIN m mm ON mm.id = c.id)",
        "ag AS (SELECT feat, sum(g) AS g, sum(dl) AS dl FROM pc GROUP BY feat)",
        f"ck AS (SELECT beta.feat, coalesce(ag.g, 0.0) + {_d(2.0 * LAM)} * beta.value AS analytic, "
        f"(coalesce(ag.dl, 0.0) + {_d(LAM)} * ((beta.value + {_d(CHECK_DELTA)}) * (beta.value + {_d(CHECK_DELTA)}) "
        f"- beta.value * beta.value)) / {_d(CHECK_DELTA)} AS numeric FROM beta LEFT JOIN ag ON ag.feat = beta.feat)") + (
        f"SELECT feat, {sql_round('analytic', 'analytic')}, {sql_round('numeric', 'numeric')}, "
        f"{sql_round('abs(analytic - numeric)', 'abs_diff')} FROM ck"),
    "confusion": _with(_margins_cte("m", "beta")) + _confusion_select(),
    "classification_metrics": _with(_margins_cte("m", "beta"), f"cf AS ({_confusion_select()})") + (
        f"SELECT {sql_round('CAST(TP + TN AS DOUBLE) / nullif(P + N, 0)', 'acc')}, "
        f"{sql_round('CAST(TP AS DOUBLE) / nullif(TP + FP, 0)', 'pre')}, "
        f"{sql_round('CAST(TP AS DOUBLE) / nullif(TP + FN, 0)', 'rec')} FROM cf"),
}
