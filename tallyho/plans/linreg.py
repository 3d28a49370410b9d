"""Registered linear-regression queries (capability B, E) and DuckDB oracles.

Data: lineitem points, d = 3 (see ``sources.tables.lineitem_points``).
The oracles recompute every statistic from the raw lineitem columns; the
descent oracles are recursive CTEs over the sufficient statistics, written out
from the update formulas, with the stop rule.
"""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..operators import gradcheck, linreg
from ..sources import tables
from .common import rounded, scratch, sql_round

D = 3
BETA = [math.sin(k) for k in range(D)]          # tests.py-style fixed point
BETA2 = [math.cos(k) for k in range(D)]
LAM = 1.0
GD_LAM = 0.1
FW_K = 1.0
FW_VERTEX = [0.0, FW_K, 0.0]      # a vertex of the L1 ball for the single-step query
MAX_ITER = 100      # the reference's defaults: the trainers run to their own stop
EPS = 0.01
STOPPED_AFTER = 1
DELTA = 1e-5


def _points(spark, sf_dir, keys=False):
    return tables.lineitem_points(spark, sf_dir, keys=keys)


def q_residuals(spark, sf_dir):
    pts = _points(spark, sf_dir, keys=True)
    return rounded(linreg.residuals(pts, BETA, keep=["l_orderkey", "l_linenumber"]))


def q_gram(spark, sf_dir):
    return rounded(linreg.gram(_points(spark, sf_dir), D))


def q_objective(spark, sf_dir):
    return rounded(linreg.objective(_points(spark, sf_dir), BETA, LAM))


def q_gradient(spark, sf_dir):
    return rounded(linreg.gradient(_points(spark, sf_dir), BETA, LAM))


def q_line_coeffs(spark, sf_dir):
    return rounded(linreg.line_coeffs(_points(spark, sf_dir), BETA, BETA2, LAM))


def q_exact_step(spark, sf_dir):
    pts = _points(spark, sf_dir)
    g = linreg.vector_from_df(linreg.gradient(pts, BETA, LAM))
    return rounded(linreg.exact_step(pts, BETA, g, LAM))


def q_fw_step(spark, sf_dir):
    return rounded(linreg.fw_step(_points(spark, sf_dir), BETA, FW_VERTEX))


def q_local_gradients(spark, sf_dir):
    pts = _points(spark, sf_dir, keys=True)
    grads = linreg.local_gradients(pts, BETA, keep=["l_orderkey", "l_linenumber"])
    return rounded(grads.select("l_orderkey", "l_linenumber",
                                *[F.col("grad").getItem(k).alias(f"g{k}") for k in range(D)]))


def q_mse(spark, sf_dir):
    return rounded(linreg.mse(_points(spark, sf_dir), BETA))


def q_gd(spark, sf_dir):
    fit = linreg.train_gd(_points(spark, sf_dir), lam=GD_LAM, max_iter=MAX_ITER, eps=EPS, d=D)
    return rounded(fit.beta_df(spark))


def q_gd_history(spark, sf_dir):
    """The history of a run that is stopped after some iterations and then goes
    on from its log."""
    points, log = _points(spark, sf_dir), scratch(spark, "gd-log")
    linreg.train_gd(points, lam=GD_LAM, max_iter=STOPPED_AFTER, eps=EPS, d=D, log=log)
    fit = linreg.train_gd(points, lam=GD_LAM, max_iter=MAX_ITER, eps=EPS, d=D, log=log)
    return rounded(fit.history_df(spark).select("k", "objective", "grad_norm_before_step", "gamma", "converged"))


def q_gd_poly(spark, sf_dir):
    pts = tables.lineitem_points(spark, sf_dir, degree=2)
    fit = linreg.train_gd(pts, lam=GD_LAM, max_iter=MAX_ITER, eps=EPS, d=D * (D + 3) // 2)
    return rounded(fit.beta_df(spark))


def q_fw(spark, sf_dir):
    fit = linreg.train_fw(_points(spark, sf_dir), K=FW_K, max_iter=MAX_ITER, eps=EPS, d=D)
    return rounded(fit.beta_df(spark))


def q_fw_poly(spark, sf_dir):
    pts = tables.lineitem_points(spark, sf_dir, degree=2)
    fit = linreg.train_fw(pts, K=FW_K, max_iter=MAX_ITER, eps=EPS, d=D * (D + 3) // 2)
    return rounded(fit.beta_df(spark))


def q_gradient_check(spark, sf_dir):
    return rounded(gradcheck.linreg_check(_points(spark, sf_dir), BETA, LAM, DELTA))


def _embeddings(spark, sf_dir):
    pts = tables.embedding_points(spark, sf_dir)
    return pts, linreg.peek_dim(pts)


def q_gram_embeddings(spark, sf_dir):
    pts, d = _embeddings(spark, sf_dir)
    return rounded(linreg.gram(pts, d))


def q_gradient_embeddings(spark, sf_dir):
    pts, d = _embeddings(spark, sf_dir)
    return rounded(linreg.gradient(pts, [math.sin(k) for k in range(d)], LAM))


QUERIES = {
    "linreg_gram_embeddings": q_gram_embeddings,
    "linreg_gradient_embeddings": q_gradient_embeddings,
    "residuals": q_residuals,
    "linreg_gram": q_gram,
    "linreg_objective": q_objective,
    "linreg_gradient": q_gradient,
    "linreg_line_coeffs": q_line_coeffs,
    "linreg_exact_step": q_exact_step,
    "linreg_fw_step": q_fw_step,
    "linreg_local_gradients": q_local_gradients,
    "linreg_mse": q_mse,
    "linreg_gd": q_gd,
    "linreg_gd_poly": q_gd_poly,
    "linreg_gd_history": q_gd_history,
    "linreg_fw": q_fw,
    "linreg_fw_poly": q_fw_poly,
    "gradient_check": q_gradient_check,
}


# ---------------------------------------------------------------- oracles --

_X = ["l_quantity / 50.0", "l_discount * 10.0", "l_tax * 10.0"]
_Y = "l_extendedprice / 100000.0"
_PTS = ("(SELECT l_orderkey, l_linenumber, "
        + ", ".join(f"{e} AS x{i}" for i, e in enumerate(_X)) + f", {_Y} AS y FROM lineitem)")


_X2 = _X + [f"({_X[i]}) * ({_X[j]})" for i in range(D) for j in range(i, D)]
_PTS2 = ("(SELECT " + ", ".join(f"{e} AS x{i}" for i, e in enumerate(_X2)) + f", {_Y} AS y FROM lineitem)")
D2 = len(_X2)


def _lit(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def _pred(beta, prefix="") -> str:
    return "(" + " + ".join(f"{prefix}x{i} * {_lit(b)}" for i, b in enumerate(beta)) + ")"


def _dot(u, v) -> str:
    return "(" + " + ".join(f"{a} * {b}" for a, b in zip(u, v)) + ")"


def _sums_cte(d: int = D, pts: str = _PTS) -> str:
    cols = ["CAST(count(*) AS DOUBLE) AS n", "sum(y * y) AS yy"]
    cols += [f"sum(x{i} * y) AS c{i}" for i in range(d)]
    cols += [f"sum(x{i} * x{j}) AS g{i}_{j}" for i in range(d) for j in range(i, d)]
    return f"s AS (SELECT {', '.join(cols)} FROM {pts})"


def _G(i, j) -> str:
    return f"s.g{min(i, j)}_{max(i, j)}"


def _quad(u, v) -> str:
    """u' G v for lists of SQL expressions."""
    d = len(u)
    return "(" + " + ".join(f"{u[i]} * {_G(i, j)} * {v[j]}" for i in range(d) for j in range(d)) + ")"


def _grad_exprs(b, lam) -> list[str]:
    d = len(b)
    return [f"(2.0 / s.n) * ((" + " + ".join(f"{_G(i, j)} * {b[j]}" for j in range(d))
            + f") - s.c{i}) + 2.0 * {_lit(lam)} * {b[i]}" for i in range(d)]


def _vector_out(state: str, d: int = D) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS idx, {sql_round(f'b{i}', 'value')} FROM {state}" for i in range(d))


def _descent(d: int, pts: str, body: str, stop: str, more: str = "", out: str = "") -> str:
    """Recursive CTE ``st(k, done, b0..)``: one row per iterate, until the
    reference's stop rule or its last iteration; ``more``: names of further
    columns of ``body``, ``out``: what is selected instead of the last b."""
    start = ", ".join([f"0.0::DOUBLE AS b{i}" for i in range(d)] + [f"0.0::DOUBLE AS {c}" for c in more.split()])
    return (f"WITH RECURSIVE {_sums_cte(d, pts)}, st AS (SELECT 0 AS k, false AS done, {start} UNION ALL "
            f"SELECT k + 1 AS k, {stop} AS done, {body} WHERE k < {MAX_ITER} AND NOT done), "
            "fin AS (SELECT * FROM st ORDER BY k DESC LIMIT 1) " + (out or _vector_out("fin", d)))


def _gd_sql(d: int = D, pts: str = _PTS, lam_value: float = GD_LAM, history: bool = False) -> str:
    b = [f"b{i}" for i in range(d)]
    g = [f"g{i}" for i in range(d)]
    c = [f"s.c{i}" for i in range(d)]
    lam = _lit(lam_value)
    gr = ", ".join(f"{e} AS g{i}" for i, e in enumerate(_grad_exprs(b, lam_value)))
    a = f"{lam} * {_dot(g, g)} + {_quad(g, g)} / s.n"
    bq = f"2.0 * {_dot(g, c)} / s.n - 2.0 * {lam} * {_dot(b, g)} - 2.0 * {_quad(b, g)} / s.n"
    upd = ", ".join(f"b{i} - (CASE WHEN a = 0 THEN 0.0 ELSE -bq / (2.0 * a) END) * g{i} AS b{i}" for i in range(d))
    norm = f"sqrt({_dot(g, g)})"
    if history:
        obj = f"(s.yy - 2.0 * {_dot(b, c)} + {_quad(b, b)}) / s.n + {lam} * {_dot(b, b)}"
        body = (f"{upd}, obj, {norm} AS norm, CASE WHEN a = 0 THEN 0.0 ELSE -bq / (2.0 * a) END AS gamma "
                f"FROM (SELECT t1.* EXCLUDE (obj), {obj} AS obj, {a} AS a, {bq} AS bq FROM (SELECT st.*, {gr} FROM st, s) t1, s) t2")
        return _descent(d, pts, body, f"{norm} <= {_lit(EPS)}", "obj norm gamma", (
            f"SELECT k - 1 AS k, {sql_round('obj', 'objective')}, {sql_round('norm', 'grad_norm_before_step')}, "
            f"{sql_round('gamma', 'gamma')}, norm < {_lit(EPS)} AS converged FROM st WHERE k > 0"))
    body = (f"{upd} FROM (SELECT t1.*, {a} AS a, {bq} AS bq FROM (SELECT st.*, {gr} FROM st, s) t1, s) t2")
    return _descent(d, pts, body, f"{norm} <= {_lit(EPS)}")


def _fw_sql(d: int = D, pts: str = _PTS) -> str:
    b = [f"b{i}" for i in range(d)]
    g = [f"g{i}" for i in range(d)]
    c = [f"s.c{i}" for i in range(d)]
    K = _lit(FW_K)
    gr = ", ".join(f"{e} AS g{i}" for i, e in enumerate(_grad_exprs(b, 0.0)))
    # first coordinate of largest |g|: strictly above earlier ones, not below later ones
    conds = [" AND ".join([f"abs(g{i}) > abs(g{j})" for j in range(i)]
                          + [f"abs(g{i}) >= abs(g{j})" for j in range(i + 1, d)] or ["true"])
             for i in range(d)]
    arg = "CASE " + " ".join(f"WHEN {cond} THEN {i}" for i, cond in enumerate(conds)) + " END"
    svec = ", ".join(f"CASE WHEN kstar = {i} THEN (CASE WHEN g{i} < 0 THEN {K} ELSE -{K} END) "
                     f"ELSE 0.0 END AS s{i}" for i in range(d))
    dv = [f"(s{i} - b{i})" for i in range(d)]
    a = f"{_quad(dv, dv)} / s.n"
    bq = f"-2.0 * {_dot(dv, c)} / s.n + 2.0 * {_quad(b, dv)} / s.n"
    gamma = ("CASE WHEN a = 0 THEN (CASE WHEN bq >= 0 THEN 0.0 ELSE 1.0 END) "
             "ELSE least(1.0, greatest(0.0, -bq / (2.0 * a))) END")
    upd = ", ".join(f"(1.0 - gamma) * b{i} + gamma * s{i} AS b{i}" for i in range(d))
    body = (f"{upd} FROM (SELECT t4.*, {gamma} AS gamma FROM (SELECT t3.*, {a} AS a, {bq} AS bq FROM ("
            f"SELECT t2.*, {svec} FROM (SELECT t1.*, {arg} AS kstar FROM (SELECT st.*, {gr} FROM st, s) t1) t2) t3, s) t4) t5")
    gap = "(" + " + ".join(f"(b{i} - s{i}) * g{i}" for i in range(d)) + ")"
    return _descent(d, pts, body, f"{gap} <= {_lit(EPS)}")


def _gram_sql() -> str:
    aug = [f"x{i}" for i in range(D)] + ["y"]
    parts = [f"SELECT -1 AS i, -1 AS j, {sql_round('count(*)', 'value')} FROM {_PTS}"]
    for i in range(D + 1):
        for j in range(i, D + 1):
            parts.append(f"SELECT {i} AS i, {j} AS j, {sql_round(f'sum({aug[i]} * {aug[j]})', 'value')} FROM {_PTS}")
    return " UNION ALL ".join(parts)


def _gradient_sql(beta, lam) -> str:
    r = f"(y - {_pred(beta)})"
    return " UNION ALL ".join(
        f"SELECT {k} AS idx, {sql_round(f'sum(-2.0 * {r} * x{k}) / count(*) + {2.0 * lam * beta[k]!r}', 'value')} "
        f"FROM {_PTS}" for k in range(D))


def _line_coeffs_parts(b1, b2, lam):
    p1, p2 = _pred(b1), _pred(b2)
    b11 = sum(v * v for v in b1)
    b22 = sum(v * v for v in b2)
    b12 = sum(u * v for u, v in zip(b1, b2))
    a = f"{_lit(lam * b22)} + sum({p2} * {p2}) / count(*)"
    b = (f"-2.0 * sum({p2} * y) / count(*) + {_lit(2.0 * lam * b12)} "
         f"+ 2.0 * sum({p1} * {p2}) / count(*)")
    c = (f"sum(y * y) / count(*) - 2.0 * sum({p1} * y) / count(*) + {_lit(lam * b11)} "
         f"+ sum({p1} * {p1}) / count(*)")
    return a, b, c


def _fw_step_sql() -> str:
    dv = [si - bi for si, bi in zip(FW_VERTEX, BETA)]
    a, b, _ = _line_coeffs_parts(BETA, dv, 0.0)
    return (f"WITH co AS (SELECT {a} AS a, {b} AS b FROM {_PTS}) SELECT " + sql_round(
        "CASE WHEN a = 0 THEN (CASE WHEN b >= 0 THEN 0.0 ELSE 1.0 END) "
        "ELSE least(1.0, greatest(0.0, -b / (2.0 * a))) END", "gamma") + " FROM co")


def _exact_step_sql() -> str:
    r = f"(y - {_pred(BETA)})"
    gsel = ", ".join(f"sum(-2.0 * {r} * x{k}) / count(*) + {2.0 * LAM * BETA[k]!r} AS g{k}"
                     for k in range(D))
    # h(t) = F(b - t g): a = lam g'g + sum(<x,g>^2)/n, b = 2 sum(<x,g> y)/n - 2 lam b'g - 2 sum(<x,b><x,g>)/n
    pg = "(" + " + ".join(f"p.x{i} * gv.g{i}" for i in range(D)) + ")"
    pb = _pred(BETA, "p.")
    bg = "(" + " + ".join(f"{_lit(BETA[i])} * gv.g{i}" for i in range(D)) + ")"
    gg = "(" + " + ".join(f"gv.g{i} * gv.g{i}" for i in range(D)) + ")"
    lam = _lit(LAM)
    coeff = (f"SELECT {lam} * max({gg}) + sum({pg} * {pg}) / count(*) AS a, "
             f"2.0 * sum({pg} * p.y) / count(*) - 2.0 * {lam} * max({bg}) "
             f"- 2.0 * sum({pb} * {pg}) / count(*) AS b FROM {_PTS} p, gv")
    return (f"WITH gv AS (SELECT {gsel} FROM {_PTS}), co AS ({coeff}) "
            f"SELECT {sql_round('CASE WHEN a = 0 THEN 0.0 ELSE -b / (2.0 * a) END', 'gamma')} FROM co")


def _gradient_check_sql() -> str:
    r = f"(y - {_pred(BETA)})"
    parts = []
    for k in range(D):
        bk = BETA[k]
        reg = LAM * ((bk + DELTA) ** 2 - bk ** 2)
        analytic = f"sum(-2.0 * {r} * x{k}) / count(*) + {_lit(2.0 * LAM * bk)}"
        numeric = (f"(sum(({r} - {_lit(DELTA)} * x{k}) * ({r} - {_lit(DELTA)} * x{k}) - {r} * {r}) "
                   f"/ count(*) + {_lit(reg)}) / {_lit(DELTA)}")
        parts.append(f"SELECT {k} AS k, {sql_round(analytic, 'analytic')}, {sql_round(numeric, 'numeric')}, "
                     f"{sql_round(f'abs(({analytic}) - ({numeric}))', 'abs_diff')} FROM {_PTS}")
    return " UNION ALL ".join(parts)


def _objective_sql(beta, lam, name) -> str:
    r = f"(y - {_pred(beta)})"
    reg = lam * sum(b * b for b in beta)
    return (f"SELECT count(*) AS n, {sql_round(f'sum({r} * {r}) / count(*) + {_lit(reg)}', name)} "
            f"FROM {_PTS}")


_a, _b, _c = _line_coeffs_parts(BETA, BETA2, LAM)
_res_pred = _pred(BETA)

ORACLE = {
    "residuals": (
        f"SELECT l_orderkey, l_linenumber, {sql_round(_res_pred, 'prediction')}, "
        f"{sql_round(f'y - {_res_pred}', 'residual')}, "
        f"{sql_round(f'(y - {_res_pred}) * (y - {_res_pred})', 'sq_error')} FROM {_PTS}"),
    "linreg_gram": _gram_sql(),
    "linreg_objective": _objective_sql(BETA, LAM, "objective"),
    "linreg_gradient": _gradient_sql(BETA, LAM),
    "linreg_line_coeffs": (f"SELECT {sql_round(_a, 'a')}, {sql_round(_b, 'b')}, {sql_round(_c, 'c')} "
                           f"FROM {_PTS}"),
    "linreg_exact_step": _exact_step_sql(),
    "linreg_fw_step": _fw_step_sql(),
    "linreg_local_gradients": (
        "SELECT l_orderkey, l_linenumber, " + ", ".join(
            sql_round(f"-2.0 * (y - {_pred(BETA)}) * x{k}", f"g{k}") for k in range(D)) + f" FROM {_PTS}"),
    "linreg_mse": _objective_sql(BETA, 0.0, "mse"),
    "linreg_gd": _gd_sql(),
    "linreg_gd_history": _gd_sql(history=True),
    "linreg_gd_poly": _gd_sql(D2, _PTS2),
    "linreg_fw": _fw_sql(),
    "linreg_fw_poly": _fw_sql(D2, _PTS2),
    "gradient_check": _gradient_check_sql(),
}

_EMB = ("e AS (SELECT row_number() OVER () AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label AS DOUBLE) AS y FROM embeddings), "
        "d AS (SELECT max(len(x)) AS d FROM e), "
        "c AS (SELECT id, unnest(x) AS v, generate_subscripts(x, 1) - 1 AS k, y FROM e)")
ORACLE["linreg_gram_embeddings"] = (
    f"WITH {_EMB}, a AS (SELECT id, k, v FROM c UNION ALL SELECT id, d, y FROM e, d) "
    f"SELECT CAST(p.k AS INTEGER) AS i, CAST(q.k AS INTEGER) AS j, {sql_round('sum(p.v * q.v)', 'value')} "
    "FROM a p JOIN a q ON p.id = q.id AND p.k <= q.k GROUP BY p.k, q.k "
    f"UNION ALL SELECT -1, -1, {sql_round('count(*)', 'value')} FROM e")
ORACLE["linreg_gradient_embeddings"] = (
    f"WITH {_EMB}, r AS (SELECT id, any_value(y) - sum(v * sin(k)) AS r FROM c GROUP BY id) "
    f"SELECT CAST(k AS INTEGER) AS idx, {sql_round(f'-2.0 * sum(v * r) / count(*) + {2.0 * LAM} * sin(any_value(k))', 'value')} "
    "FROM c JOIN r ON c.id = r.id GROUP BY k")
