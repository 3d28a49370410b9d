"""Models that are replaced as one step, trainers that go on from their log,
readers that do not depend on how files are split, and sparse Frank-Wolfe."""

import numpy as np
import pytest

from tallyho.operators import linreg, logreg, mf, progress, sparse_linreg
from tallyho.session import cut_lineage
from tallyho.sources import files, tables, versions

SMALL = "/root/testdata/sf0.001"


def test_a_fault_between_the_factors_leaves_the_old_model(spark, tmp_out, monkeypatch):
    path = f"{tmp_out}/model"
    old = (spark.createDataFrame([(1, [1.0])], "i LONG, u ARRAY<DOUBLE>"), spark.createDataFrame([(2, [2.0])], "j LONG, v ARRAY<DOUBLE>"))
    files.write_factors(*old, path)
    broken = old[1].selectExpr("j", "array(double(raise_error('lost'))) AS v")
    with pytest.raises(Exception, match="lost"):
        files.write_factors(old[0].selectExpr("i", "array(9D) AS u"), broken, path)
    assert [[tuple(r) for r in t.collect()] for t in files.read_factors(spark, path)] == [[(1, [1.0])], [(2, [2.0])]]
    # from what is read, over what is read
    U, V = files.read_factors(spark, path)
    files.write_factors(U.selectExpr("i", "array(u[0] + 1) AS u"), V, path)
    assert files.read_factors(spark, path)[0].first()["u"] == [2.0]
    with pytest.raises(FileNotFoundError):
        files.read_factors(spark, f"{tmp_out}/none")


def test_plain_parquet_models_are_still_read(spark, tmp_out):
    spark.createDataFrame([("a", 1.0)], "feat STRING, value DOUBLE").write.parquet(f"{tmp_out}/p")
    assert [tuple(r) for r in files.read_sparse_vector(spark, f"{tmp_out}/p").collect()] == [("a", 1.0)]


def test_text_models_round_trip_commas_and_special_values(spark, tmp_out):
    rows = [("a,b", 1.5), ("inf", float("inf")), ("-", float("-inf")), ("n", float("nan"))]
    files.write_sparse_vector(spark.createDataFrame(rows, "feat STRING, value DOUBLE"), f"{tmp_out}/t", fmt="text")
    got = {r["feat"]: r["value"] for r in files.read_sparse_vector(spark, f"{tmp_out}/t", fmt="text").collect()}
    assert repr(sorted(got.items())) == repr(sorted(rows))


class Killed(Exception):
    pass


def killed_after(monkeypatch, n):
    """Commits work n times, then the driver is gone."""
    commit, done = versions.commit, []

    def some(path, **tables):
        if len(done) == n:
            raise Killed
        done.append(path)
        commit(path, **tables)

    monkeypatch.setattr(progress.versions, "commit", some)


def without_clock(history):
    return [row[:-1] for row in history]


@pytest.mark.parametrize("train", [linreg.train_gd, linreg.train_fw])
def test_least_squares_goes_on_from_its_log(spark, tmp_out, monkeypatch, train):
    points = tables.lineitem_points(spark, SMALL)
    whole = train(points, max_iter=6, eps=1e-9)
    with monkeypatch.context() as m, pytest.raises(Killed):
        killed_after(m, 3)
        train(points, max_iter=6, eps=1e-9, log=f"{tmp_out}/log")
    fit = train(points, max_iter=6, eps=1e-9, log=f"{tmp_out}/log")
    assert [h[0] for h in fit.history] == list(range(len(whole.history)))
    assert without_clock(fit.history) == without_clock(whole.history) and (fit.beta == whole.beta).all()
    assert without_clock(train(points, max_iter=6, eps=1e-9, log=f"{tmp_out}/log").history) == without_clock(whole.history)


def test_logistic_regression_goes_on_from_its_log(spark, tmp_out, monkeypatch):
    points, cells = tables.labelled_points(spark, SMALL)
    cells = cut_lineage(cells)
    whole = logreg.train(points, cells, lam=0.1, max_iter=3, eps=1e-9, refresh_every=2)
    with monkeypatch.context() as m, pytest.raises(Killed):
        killed_after(m, 2)
        logreg.train(points, cells, lam=0.1, max_iter=3, eps=1e-9, refresh_every=2, log=f"{tmp_out}/log")
    fit = logreg.train(points, cells, lam=0.1, max_iter=3, eps=1e-9, refresh_every=2, log=f"{tmp_out}/log")
    assert [h[0] for h in fit.history] == [0, 1, 2]
    assert [h[1] for h in fit.history] == pytest.approx([h[1] for h in whole.history], rel=1e-12)
    value = lambda f: {r["feat"]: r["value"] for r in f.beta.collect()}
    assert value(fit) == pytest.approx(value(whole), rel=1e-9, abs=1e-12)


def test_folds_go_on_from_their_log(spark, tmp_out, monkeypatch):
    R = cut_lineage(tables.lineitem_ratings(spark, SMALL).where("i < 30"))
    run = lambda **kw: mf.cross_validate(R, folds=2, d=2, maxiter=3, seed=5, **kw)
    whole = run()
    with monkeypatch.context() as m, pytest.raises(Killed):
        killed_after(m, 1)
        run(log=f"{tmp_out}/log")
    again = run(log=f"{tmp_out}/log")
    for (_, a, h), (_, b, g) in zip(whole[1], again[1]):
        assert a == pytest.approx(b, rel=1e-12) and [x[0] for x in g] == [1, 2, 3]
        assert [x[1] for x in h] == pytest.approx([x[1] for x in g], rel=1e-12)


def test_sparse_point_ids_do_not_depend_on_splits(spark, tmp_out):
    for name, first in (("b.txt", 0), ("a.txt", 300)):
        with open(f"{tmp_out}/{name}", "w") as fh:
            fh.write("".join(f"({{'f': {k}}}, 1)\n" + "\n" * (k % 3 == 0) for k in range(first, first + 300)))
    found, sizes = [], (200, 128 << 20)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in sizes:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
            if size == sizes[0]:
                assert files.read_lines(spark, tmp_out).rdd.getNumPartitions() > 4
            found.append({r["id"]: r["x"] for r in files.read_sparse_points(spark, tmp_out)[1].collect()})
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found[0] == found[1] == {k: float((k + 300) % 600) for k in range(600)}


def test_folds_are_one_scan(spark, tmp_out):
    path = f"{tmp_out}/fold9/folds"
    for k in range(3):
        spark.range(k + 1).selectExpr(f"concat(id, ',{k},1.5') AS line").write.text(f"{path}/fold{k}")
    rows = files.read_rating_folds(spark, path, 3)
    assert sorted(tuple(r) for r in rows.collect()) == sorted((i, k, 1.5, k) for k in range(3) for i in range(k + 1))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


@pytest.mark.parametrize("blocks", [None, 3])
def test_sparse_frank_wolfe_equals_the_dense_one(spark, blocks):
    draw = np.random.default_rng(7)
    X = draw.standard_normal((60, 8)) * (draw.random((60, 8)) < 0.6)
    y = X @ np.array([2.0, -1.0, 0, 0, 0.5, 0, 0, 0]) + 0.1 * draw.standard_normal(60)
    points = spark.createDataFrame([(i, float(v)) for i, v in enumerate(y)], "id LONG, y DOUBLE")
    cells = spark.createDataFrame([(i, f"f{k}", float(X[i, k])) for i in range(60) for k in range(8) if X[i, k]],
                                  "id LONG, feat STRING, x DOUBLE")
    dense = spark.createDataFrame([(X[i].tolist(), float(y[i])) for i in range(60)], "x ARRAY<DOUBLE>, y DOUBLE")
    want = linreg.train_fw(dense, K=3.0, max_iter=12, eps=1e-9, d=8)
    fit = sparse_linreg.train_fw(points, cells, K=3.0, max_iter=12, eps=1e-9, blocks=blocks, hot_cells=4)
    assert [fit.atoms.get(f"f{k}", 0.0) for k in range(8)] == pytest.approx(want.beta.tolist(), abs=1e-9)
    assert [h[1] for h in fit.history] == pytest.approx([h[1] for h in want.history], rel=1e-9)
    last = sparse_linreg.objective(points, cells, fit.beta_df(spark)).first()
    assert last["n"] == 60 and last["objective"] < fit.history[-1][1] + 1e-12
    few = sparse_linreg.train_fw(points, cells, K=3.0, max_iter=2, eps=1e-9)
    assert len(few.atoms) <= 3 and few.history_df(spark).count() == 2


def test_sparse_frank_wolfe_on_nothing(spark):
    points, cells = spark.createDataFrame([], "id LONG, y DOUBLE"), spark.createDataFrame([], "id LONG, feat STRING, x DOUBLE")
    assert sparse_linreg.train_fw(points, cells).atoms == {}
    assert sparse_linreg.train_fw(spark.createDataFrame([(1, 1.0)], "id LONG, y DOUBLE"), cells).atoms == {}


def test_null_points_fail_in_the_gradient_check(spark):
    from tallyho.operators.gradcheck import linreg_check
    for row in ([1.0, None], 1.0), ([1.0, 2.0], None), (None, 1.0):
        points = spark.createDataFrame([([1.0, 1.0], 1.0), row], "x ARRAY<DOUBLE>, y DOUBLE")
        with pytest.raises(Exception, match="nulls"):
            linreg_check(points, [1.0, 1.0]).collect()


def test_sparse_frank_wolfe_sends_no_points_through_the_driver(spark, monkeypatch):
    """Over the broadcast bound neither weights nor columns are broadcast, whatever their size; the model is the same."""
    points, cells = tables.labelled_points(spark, SMALL)
    cells = cut_lineage(cells)
    want = sparse_linreg.train_fw(points, cells, K=20.0, max_iter=2, eps=1e-9)
    plans, cut = [], sparse_linreg.cut_lineage
    monkeypatch.setattr(sparse_linreg, "cut_lineage", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or cut(df))
    fit = sparse_linreg.train_fw(points, cells, K=20.0, max_iter=2, eps=1e-9, blocks=3)
    assert fit.atoms == pytest.approx(want.atoms, rel=1e-9)
    assert len(plans) == 3 and not any("BroadcastHashJoin" in p for p in plans)
    assert all("SortMergeJoin" in p for p in plans[1:])
