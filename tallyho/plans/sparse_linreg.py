"""Registered sparse least-squares query and its DuckDB oracle.

Data: labelled documents as sparse points, as for the logistic queries.
"""

from __future__ import annotations

from ..operators import sparse_linreg
from ..session import cut_lineage
from ..sources import tables
from .common import rounded, sql_round
from .logreg import _BASE, _d

K = 20.0
MAX_ITER = 20
EPS = 0.02


def q_fw_sparse(spark, sf_dir):
    """To the stop rule or the last step."""
    points, cells = tables.labelled_points(spark, sf_dir)
    fit = sparse_linreg.train_fw(points, cut_lineage(cells), K=K, max_iter=MAX_ITER, eps=EPS)
    return rounded(fit.beta_df(spark))


QUERIES = {"linreg_fw_sparse": q_fw_sparse}


def _fw_sparse_sql() -> str:
    """All steps one after the other; a step after the stop moves nothing."""
    ctes = [*_BASE[:2], "nn AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM pts)", "m0 AS (SELECT id, y, 0.0::DOUBLE AS p FROM pts)",
             "c0 AS (SELECT false AS done)", "w0 AS (SELECT NULL::VARCHAR AS feat, 0.0::DOUBLE AS value WHERE false)"]
    for s in range(1, MAX_ITER + 1):
        q = s - 1
        ctes += [
            f"g{s} AS MATERIALIZED (SELECT c.feat, sum((m.y - m.p) * c.x) * -2.0 / any_value(n) AS g FROM cells c "
            f"JOIN m{q} m ON m.id = c.id, nn GROUP BY c.feat)",
            f"t{s} AS MATERIALIZED (SELECT feat, g, CASE WHEN g < 0 THEN {_d(K)} ELSE {_d(-K)} END AS v FROM g{s} "
            f"ORDER BY round(abs(g), {sparse_linreg.TIE_DIGITS}) DESC, feat LIMIT 1)",
            f"u{s} AS MATERIALIZED (SELECT m.id, m.y, m.p, coalesce(e.q, 0.0) - m.p AS dq FROM m{q} m LEFT JOIN "
            f"(SELECT c.id, c.x * t.v AS q FROM cells c JOIN t{s} t ON c.feat = t.feat) e ON e.id = m.id)",
            f"h{s} AS MATERIALIZED (SELECT -2.0 * sum(p * (y - p)) / count(*) AS bg, sum(dq * dq) / count(*) AS a, "
            f"-2.0 * sum((y - p) * dq) / count(*) AS b FROM u{s})",
            f"c{s} AS MATERIALIZED (SELECT t{s}.feat, t{s}.v, done OR bg - t{s}.v * g <= {_d(EPS)} AS done, CASE WHEN done THEN 0.0 "
            "WHEN a = 0 THEN (CASE WHEN b >= 0 THEN 0.0 ELSE 1.0 END) ELSE least(1.0, greatest(0.0, -b / (2.0 * a))) END AS gamma "
            f"FROM h{s}, t{s}, (SELECT done FROM c{q}))",
            f"m{s} AS MATERIALIZED (SELECT id, y, p + gamma * dq AS p FROM u{s}, c{s})",
            f"w{s} AS MATERIALIZED (SELECT w.feat, (1.0 - gamma) * value AS value FROM w{q} w, c{s} "
            f"UNION ALL SELECT feat, gamma * v FROM c{s})"]
    return (f"WITH {', '.join(ctes)} SELECT feat, {sql_round('sum(value)', 'value')} FROM w{MAX_ITER} "
            "GROUP BY feat HAVING sum(value) <> 0")


ORACLE = {"linreg_fw_sparse": _fw_sparse_sql()}
