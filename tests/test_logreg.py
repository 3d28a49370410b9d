"""Sparse logistic regression: gradient check, Armijo, edge cases, metrics."""

import math

import pytest
from pyspark.sql import functions as F

from tallyho.operators import blocks, gradcheck, logreg, vectors
from tallyho.sources import tables

SMALL = "/root/testdata/sf0.001"


def _toy(spark):
    points = spark.createDataFrame([(1, 1.0), (2, -1.0), (3, 1.0), (4, -1.0), (5, 1.0)], "id BIGINT, y DOUBLE")
    cells = spark.createDataFrame(
        [(1, "a", 1.0), (1, "b", 0.5), (2, "a", -1.0), (2, "c", 2.0), (3, "b", 1.5), (4, "c", 1.0),
         (4, "z", 0.0)], "id BIGINT, feat STRING, x DOUBLE")
    return points, cells                     # point 5 has no features at all


def test_vector_algebra_keeps_union_and_zeros(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 0.0)], "feat STRING, value DOUBLE")
    b = spark.createDataFrame([("y", 2.0), ("w", -1.0)], "feat STRING, value DOUBLE")
    add = {r["feat"]: r["value"] for r in vectors.vec_add(a, b).collect()}
    sub = {r["feat"]: r["value"] for r in vectors.vec_sub(a, b).collect()}
    assert add == {"x": 1.0, "y": 2.0, "w": -1.0}
    assert sub == {"x": 1.0, "y": -2.0, "w": 1.0}
    assert {r["feat"]: r["value"] for r in vectors.vec_scale(a, 3).collect()} == {"x": 3.0, "y": 0.0}
    keys = spark.createDataFrame([("x",), ("q",)], "feat STRING")
    assert {r["feat"]: r["value"] for r in vectors.vec_get(a, keys).collect()} == {"x": 1.0, "q": 0.0}
    assert vectors.vec_dot(a, b).first()["dot"] == 0.0
    other = spark.createDataFrame([("k", 1.0)], "feat STRING, value DOUBLE")
    assert vectors.vec_dot(a, other).first()["dot"] == 0.0
    assert vectors.vec_norm_sq(b).first()["norm_sq"] == 5.0


def test_margins_keep_points_without_features(spark):
    points, cells = _toy(spark)
    beta = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("q", 5.0)], "feat STRING, value DOUBLE")
    m = {r["id"]: r["margin"] for r in logreg.margins(points, cells, beta).collect()}
    assert m == {1: 2.0, 2: -1.0, 3: 3.0, 4: 0.0, 5: 0.0}


def test_confusion_ties(spark):
    points, cells = _toy(spark)
    beta = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "feat STRING, value DOUBLE")
    m = logreg.margins(points, cells, beta)
    c = logreg.confusion(m).first().asDict()
    assert c == {"P": 2, "N": 3, "TP": 2, "FP": 0, "TN": 2, "FN": 1}
    d = logreg.confusion(m, tie="drop").first().asDict()
    assert d == {"P": 2, "N": 1, "TP": 2, "FP": 0, "TN": 1, "FN": 0}
    mt = logreg.metrics(logreg.confusion(m)).first()
    assert mt["acc"] == pytest.approx(4 / 5) and mt["pre"] == 1.0 and mt["rec"] == pytest.approx(2 / 3)


def test_metrics_null_on_empty_denominator(spark):
    conf = spark.createDataFrame([(0, 3, 0, 0, 3, 0)], "P LONG, N LONG, TP LONG, FP LONG, TN LONG, FN LONG")
    r = logreg.metrics(conf).first()
    assert r["acc"] == 1.0 and r["pre"] is None and r["rec"] is None


def test_loss_is_finite_for_extreme_margins(spark):
    points = spark.createDataFrame([(1, 1.0), (2, -1.0)], "id BIGINT, y DOUBLE")
    cells = spark.createDataFrame([(1, "a", 1.0), (2, "a", 1.0)], "id BIGINT, feat STRING, x DOUBLE")
    beta = spark.createDataFrame([("a", 1000.0)], "feat STRING, value DOUBLE")
    r = logreg.loss(points, cells, beta, lam=0.0).first()
    assert math.isfinite(r["loss"]) and r["loss"] == pytest.approx(1000.0)


def test_gradient_check_all_features(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    beta = logreg.zero_beta(cells).select("feat", (F.length("feat") % 5 * 0.01 - 0.02).alias("value"))
    chk = gradcheck.logreg_check(points, cells, beta, lam=0.3, delta=1e-6)
    worst = chk.agg(F.max("abs_diff")).first()[0]
    assert chk.count() == beta.count()
    assert worst < 1e-4


def test_line_search_satisfies_armijo(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    beta = logreg.zero_beta(cells)
    g = logreg.gradient(points, cells, beta, 0.1)
    r = logreg.line_search(points, cells, beta, g, 0.1)
    assert r.accepted
    laid = logreg.line_search(points, cells, beta, g, 0.1, blocks=3)
    assert laid.backtracks == r.backtracks and laid.f_new == pytest.approx(r.f_new, rel=1e-12)
    assert r.f_new <= r.f0 - logreg.ARMIJO_A * r.t * r.grad_sq + 1e-12
    # the step before the accepted one (if any) violated the condition
    if r.backtracks:
        t_prev = r.t / logreg.SHRINK_B
        stepped = vectors.vec_axpy(beta, g, -t_prev)
        f_prev = logreg.loss(points, cells, stepped, 0.1).first()["loss"]
        assert f_prev > r.f0 - logreg.ARMIJO_A * t_prev * r.grad_sq


def test_training_decreases_loss_and_matches_direct_loss(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    fit = logreg.train(points, cells, lam=0.1, max_iter=4, eps=1e-9, refresh_every=2,
                       test=(points, cells), blocks=4)
    objs = [h[1] for h in fit.history]
    assert len(objs) == 4
    assert all(b < a for a, b in zip(objs, objs[1:]))
    direct = logreg.loss(points, cells, fit.beta, 0.1).first()["loss"]
    assert direct == pytest.approx(objs[-1], rel=1e-9)
    assert fit.history[-1][7] is not None          # test accuracy recorded


def test_bucket_operators(spark):
    points, cells = _toy(spark)
    b = {r["id"]: r["bucket"] for r in logreg.bucket_points(points, 3, "mod").collect()}
    assert b == {1: 1, 2: 2, 3: 0, 4: 1, 5: 2}
    fb = {(r["feat"], r["bucket"]) for r in logreg.feature_buckets(cells, 3, "mod").collect()}
    assert fb == {("a", 1), ("b", 1), ("a", 2), ("c", 2), ("b", 0), ("c", 1), ("z", 1)}
    s = logreg.bucket_stats(points, cells, 3, "mod").first()
    assert (s["points_min"], s["points_max"]) == (1, 2)
    assert (s["features_min"], s["features_max"]) == (1, 4)
    h = {r["id"]: r["bucket"] for r in logreg.bucket_points(points, 3, "hash").collect()}
    assert set(h.values()) <= {0, 1, 2}


def test_spark_ml_reaches_a_no_better_optimum(spark):
    """At convergence our loss and Spark ML's (regParam = 2 lam / n, no
    intercept, no standardisation) minimise the same objective."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    pts = [(i, 1.0 if (i * 7) % 5 < 3 else -1.0) for i in range(40)]
    feats = ["f0", "f1", "f2"]
    cells_rows = [(i, feats[k], math.sin(i * (k + 1)) + (0.4 if y > 0 else -0.4) * (k == 0))
                  for i, y in pts for k in range(3)]
    points = spark.createDataFrame(pts, "id BIGINT, y DOUBLE")
    cells = spark.createDataFrame(cells_rows, "id BIGINT, feat STRING, x DOUBLE")
    lam = 0.5
    fit = logreg.train(points, cells, lam=lam, max_iter=200, eps=1e-7)
    ours = logreg.loss(points, cells, fit.beta, lam).first()["loss"]
    dense = {}
    for i, f, x in cells_rows:
        dense.setdefault(i, [0.0] * 3)[feats.index(f)] = x
    df = spark.createDataFrame([(Vectors.dense(dense[i]), (y + 1) / 2) for i, y in pts], ["features", "label"])
    model = LogisticRegression(regParam=2 * lam / len(pts), fitIntercept=False, standardization=False,
                               elasticNetParam=0.0, tol=1e-12, maxIter=500).fit(df)
    coef = spark.createDataFrame([(f, float(model.coefficients[k])) for k, f in enumerate(feats)],
                                 "feat STRING, value DOUBLE")
    theirs = logreg.loss(points, cells, coef, lam).first()["loss"]
    assert ours == pytest.approx(theirs, rel=1e-6)


def test_cell_gradients_sum_to_gradient(spark):
    points, cells = _toy(spark)
    beta = spark.createDataFrame([("a", 0.5), ("c", -1.0)], "feat STRING, value DOUBLE")
    per_cell = logreg.cell_gradients(points, cells, beta).groupBy("feat").agg(F.sum("value").alias("v"))
    got = {r["feat"]: r["v"] for r in per_cell.collect()}
    full = {r["feat"]: r["value"] for r in logreg.gradient(points, cells, beta, 0.0).collect()}
    for f, v in got.items():
        assert v == pytest.approx(full[f], abs=1e-12)


def test_training_is_partition_invariant(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    a = logreg.train(points, cells, lam=0.1, max_iter=2, eps=1e-12)
    b = logreg.train(points.repartition(3), cells.repartition(5), lam=0.1, max_iter=2, eps=1e-12)
    va = {r["feat"]: r["value"] for r in a.beta.collect()}
    vb = {r["feat"]: r["value"] for r in b.beta.collect()}
    assert va.keys() == vb.keys()
    assert max(abs(va[k] - vb[k]) for k in va) < 1e-12


def test_history_table(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    fit = logreg.train(points, cells, lam=0.1, max_iter=2, eps=1e-12)
    h = fit.history_df(spark).orderBy("k").collect()
    assert [r["k"] for r in h] == [0, 1]
    assert all(r["accepted"] and 0 < r["step"] <= 1 for r in h)
    assert h[0]["grad_norm_before_step"] > 0


def test_dealt_documents_give_the_same_model(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    a = logreg.train(points, cells, lam=0.1, max_iter=2, eps=1e-12)
    # every document counts as hot and lies in several blocks
    b = logreg.train(points, cells, lam=0.1, max_iter=2, eps=1e-12, hot_cells=3, blocks=5)
    va = {r["feat"]: r["value"] for r in a.beta.collect()}
    vb = {r["feat"]: r["value"] for r in b.beta.collect()}
    assert va.keys() == vb.keys() and max(abs(va[k] - vb[k]) for k in va) < 1e-12


def exchanged_scans(df, table):
    """How many scans of ``table`` the plan of ``df`` has, and how many of them are exchanged before a join or an aggregate."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(x) - len(x.lstrip(" +-:")) for x in lines]
    scans = exchanged = 0
    for i, line in enumerate(lines):
        if "FileScan" in line and table in line:
            scans += 1
            level = depth[i]
            for j in range(i - 1, -1, -1):
                if depth[j] < level:
                    level = depth[j]
                    if "Exchange" in lines[j]:
                        exchanged += 1
                        break
                    if "Join" in lines[j] or "Aggregate" in lines[j]:
                        break
    return scans, exchanged


def test_an_iteration_exchanges_no_cells(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    laid = blocks.lay_out(cells)
    vec = logreg.zero_beta(laid.feats)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with blocks.co_partitioned(spark):
            for df in (laid.products(vec), laid.weighted(points.select("id", F.col("y").alias("w"))).groupBy("feat").agg(F.sum("g"))):
                assert exchanged_scans(df, laid.names[0]) == (1, 0)
                assert df.count() > 0
        # without it the same join exchanges the cells
        assert exchanged_scans(laid.products(vec), laid.names[0]) == (1, 1)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # sums by document are formed in the block: the only exchange above the cells' join is the slice's
    n = laid.feats.count()
    assert n <= cells.count() and n == laid.cells.select("feat", "block").distinct().count()
    twice = blocks.lay_out(cells.unionAll(cells))
    assert twice.feats.count() == n                 # more cells of the same features and documents move no more rows
    twice.drop()
    laid.drop()


def test_trial_rows_do_not_grow_with_the_points(spark):
    mdm = spark.range(0, 20_000, 1, 4).selectExpr("id", "if(id % 3 = 0, 1D, -1D) as y", "sin(id) as margin", "cos(id) as dm")
    bg = spark.createDataFrame([("a", 0.5, 2.0)], "feat STRING, b DOUBLE, g DOUBLE")
    got = {r["k"]: r for r in logreg.trial_losses(mdm, bg).collect()}
    assert set(got) == {-2, -1, *range(logreg.TRIAL_BLOCK)} and (got[-2]["bb"], got[-2]["bgs"], got[-2]["gg"]) == (0.25, 1.0, 4.0)
    rows = mdm.collect()
    for k, t in ((-1, 0.0), (0, 1.0), (3, logreg.SHRINK_B ** 3)):
        want = sum(math.log1p(math.exp(-r["y"] * (r["margin"] - t * r["dm"]))) for r in rows)
        assert got[k]["loss"] == pytest.approx(want, rel=1e-12)


def test_a_line_search_joins_the_cells_once(spark, monkeypatch):
    """One join for margins and direction, nothing laid out; the same search as in blocks, also without a broadcast."""
    points, cells = tables.labelled_points(spark, SMALL)
    cells = logreg.cut_lineage(cells)
    points = points.unionAll(spark.createDataFrame([(-5, 1.0)], "id LONG, y DOUBLE"))            # a point without cells
    beta = cells.groupBy("feat").agg((F.sum("x") * 0.01).alias("value"))
    g = logreg.gradient(points, cells, beta, 0.1)
    want = logreg.line_search(points, cells, beta, g, 0.1, blocks=3)
    monkeypatch.setattr(logreg, "laid_out", None)
    found = logreg.line_search(points, cells, beta, g, 0.1)
    assert found.backtracks == want.backtracks
    assert (found.f0, found.f_new, found.grad_sq) == pytest.approx((want.f0, want.f_new, want.grad_sq), rel=1e-12)
    bg = logreg.cut_lineage(logreg.paired(beta, g, "b", "g"))
    rows = {r["id"]: r for r in logreg.margins_along(points, cells, bg).collect()}
    assert len(rows) == points.count() and (rows[-5]["margin"], rows[-5]["dm"]) == (0.0, 0.0)
    monkeypatch.setattr(logreg, "bounded_broadcast", lambda df: df)
    again = logreg.line_search(points, cells, beta, g, 0.1)
    assert (again.backtracks, again.f_new) == (want.backtracks, pytest.approx(want.f_new, rel=1e-12))


def odd_cells(spark):
    """Repeated cells, points and weights, nulls, documents without points and words without documents."""
    rows = [(k, f"w{j}", (k * j % 7 - 3) / 4) for k in range(40) for j in range(k % 9)]
    cells = spark.createDataFrame([*rows, *rows[:9], (3, None, 2.0), (None, "w1", 1.0), (5, "rare", None), (77, "alone", 1.0)],
                                  "id LONG, feat STRING, x DOUBLE")
    w = spark.createDataFrame([*((k, math.sin(k)) for k in range(39)), (2, 0.5), (None, 1.0), (4, None)], "id LONG, w DOUBLE")
    vec = spark.createDataFrame([*((f"w{j}", math.cos(j)) for j in range(7)), ("w1", 0.25), (None, 3.0), ("w2", None), ("new", 1.0)],
                                "feat STRING, value DOUBLE")
    return cells, w, vec


def sums(df, key, value):
    out = {r[0]: r[1] or 0.0 for r in df.groupBy(key).agg(F.sum(value)).collect()}
    assert len(out) == df.select(key).distinct().count()
    return out


@pytest.mark.parametrize("hot", [3, 1000])
def test_packed_cells_give_the_joins_sums(spark, hot):
    cells, w, vec = odd_cells(spark)
    plain = blocks.BroadcastCells(cells)
    laid = blocks.pack_cells(cells, 5, hot)
    assert sorted(map(str, (r[0] for r in laid.feats.collect()))) == sorted(map(str, (r[0] for r in cells.select("feat").distinct().collect())))
    got, want = (sums(x.weighted(w), "feat", "g") for x in (laid, plain))
    assert got == pytest.approx(want, abs=1e-12)
    got, want = (sums(x.products(vec), "id", "c") for x in (laid, plain))
    assert got == pytest.approx({k: v for k, v in want.items() if v != 0.0}, abs=1e-12)
    for df in (laid.weighted(w.where("id < 0")), laid.products(vec.where("feat = 'new'"))):
        assert df.count() == 0
    laid.drop()
    empty = blocks.pack_cells(cells.where("id < 0"), 2)
    assert empty.weighted(w).count() == empty.products(vec).count() == empty.feats.count() == 0
    empty.drop()


def test_a_trainer_moves_arrays_and_sorts_no_cells(spark):
    """An iteration over packed cells exchanges a row a block and part, not one a block and word."""
    points, cells = tables.labelled_points(spark, SMALL)
    points, cells = points.select("id", "y"), logreg.cut_lineage(cells)
    laid = logreg.laid_out(points, cells, 4, 100_000)
    for df in (laid.products(logreg.zero_beta(cells)), laid.weighted(points.select("id", F.col("y").alias("w")))):
        lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
        for name in laid.names[:2]:
            at = next(k for k, x in enumerate(lines) if "FileScan" in x and name in x)
            above = [x for x in lines[:at] if "CoGroups" in x or "Exchange" in x and len(x) - len(x.lstrip(" +-:")) < lines[at].index("FileScan")]
            assert "CoGroups" in above[-1]
    assert laid.cells.count() <= 4 * 5 and laid.parts.count() <= 4 * 5
    twice = logreg.laid_out(points, cells.unionAll(cells), 4, 100_000)
    assert twice.cells.count() == laid.cells.count()
    for x in (laid, twice):
        x.drop()
