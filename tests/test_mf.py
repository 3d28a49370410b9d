"""Matrix factorisation: gradient check, descent, RMSE variants, folds."""

import math

import pytest
from pyspark.sql import functions as F

from tallyho.operators import blocks, gradcheck, mf
from tallyho.sources import tables
from tests.test_logreg import exchanged_scans

SMALL = "/root/testdata/sf0.001"


def _ratings(spark, rows):
    return spark.createDataFrame(rows, "i BIGINT, j BIGINT, r DOUBLE")


def test_gradient_check_every_user_coordinate(spark):
    R = tables.lineitem_ratings(spark, SMALL).select("i", "j", "r")
    U = mf.random_profiles(R, "user", 4, 7)
    V = mf.random_profiles(R, "item", 4, 7)
    delta, lam = 1e-6, 0.3
    chk = gradcheck.mf_check(R, U, V, 4, lam=lam, delta=delta)
    assert chk.count() == 4 * U.count()
    # the objective is quadratic in u_i[k], so the forward difference exceeds
    # the derivative by exactly delta * (sum_j v_j[k]^2 + lam)
    J = mf.join_predict(R, U, V, 4)
    curv = J.select("i", F.posexplode("v").alias("k", "vk")).groupBy("i", "k").agg(
        F.sum(F.col("vk") * F.col("vk")).alias("c"))
    worst = chk.join(curv, ["i", "k"]).select(
        F.abs(F.col("numeric") - F.col("analytic") - F.lit(delta) * (F.col("c") + F.lit(lam))).alias("e")
    ).agg(F.max("e")).first()[0]
    assert worst < 1e-6


def test_random_profiles_are_partition_invariant(spark):
    R = tables.lineitem_ratings(spark, SMALL).select("i", "j", "r")
    a = {r["i"]: r["u"] for r in mf.random_profiles(R, "user", 3, 11).collect()}
    b = {r["i"]: r["u"] for r in mf.random_profiles(R.repartition(7), "user", 3, 11).collect()}
    assert a == b
    v = {r["j"]: r["v"] for r in mf.random_profiles(R, "item", 3, 11).collect()}
    common = set(a) & set(v)
    assert any(a[k] != v[k] for k in common) or not common      # sides are salted
    vals = [x for u in a.values() for x in u]
    mean = sum(vals) / len(vals)
    sd = math.sqrt(sum((x - mean) ** 2 for x in vals) / len(vals))
    assert abs(mean) < 0.15 and 0.85 < sd < 1.15


def test_descent_lowers_objective(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    train, test = mf.fold_split(R, 0)
    fit = mf.train(train, test, d=3, gain=0.002, lam=0.1, mu=0.1, maxiter=4, seed=3)
    objs = [h[1] for h in fit.history]
    assert all(b < a for a, b in zip(objs, objs[1:]))
    assert not fit.diverged and fit.last_rmse is not None


def test_unseen_users_and_repeated_pairs(spark):
    train = _ratings(spark, [(0, 0, 1.0), (0, 0, 3.0), (1, 1, 2.0)])      # (0,0) rated twice
    test = _ratings(spark, [(0, 1, 1.0), (9, 0, 5.0)])                   # user 9 unseen
    U = spark.createDataFrame([(0, [1.0]), (1, [0.5])], "i BIGINT, u ARRAY<DOUBLE>")
    V = spark.createDataFrame([(0, [2.0]), (1, [1.0])], "j BIGINT, v ARRAY<DOUBLE>")
    J = mf.join_predict(train, U, V, 1)
    assert sorted(r["delta"] for r in J.collect()) == [-1.5, -1.0, 1.0]
    assert mf.squared_error(J).first()["se"] == pytest.approx(1.0 + 1.0 + 2.25)
    r = mf.rmse(test, U, V, 1).first()
    assert (r["n_test"], r["n_scored"]) == (2, 1)
    assert r["rmse"] == pytest.approx(0.0) and r["rmse_scored"] == pytest.approx(0.0)
    new = {x["i"]: x["u"][0] for x in mf.step_u(J, U, 0.1, 0.5, 1).collect()}
    # u0 = 1 - 0.1 * (2*(1)*2 + 2*(-1)*2) - 0.1*2*0.5*1
    assert new[0] == pytest.approx(1.0 - 0.1 * 0.0 - 0.1)


def test_maxiter_zero_returns_init(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    fit = mf.train(R, None, d=2, maxiter=0, seed=5)
    assert len(fit.history) == 1 and fit.history[0][0] == 0
    init = {r["i"]: r["u"] for r in mf.random_profiles(R, "user", 2, 5).collect()}
    assert {r["i"]: r["u"] for r in fit.U.collect()} == init


def test_divergence_is_reported(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    fit = mf.train(R, None, d=3, gain=50.0, power=0.0, maxiter=30, seed=1)
    assert fit.diverged
    assert not math.isfinite(fit.history[-1][1])


def test_fold_counts_match_brute_force(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    got = {r["fold"]: r.asDict() for r in mf.fold_counts(R).collect()}
    rows = R.collect()
    for k in range(4):
        tr = [x for x in rows if x["fold"] != k]
        assert got[k]["n_train"] == len(tr)
        assert got[k]["n_test"] == len(rows) - len(tr)
        assert got[k]["n_users"] == len({x["i"] for x in tr})
        assert got[k]["n_items"] == len({x["j"] for x in tr})


def test_cross_validate_mean(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    summary, per_fold = mf.cross_validate(R, folds=4, d=2, maxiter=2, seed=9)
    row = summary.first()
    assert row["folds"] == 4
    assert row["cv_rmse"] == pytest.approx(sum(r for _, r, _ in per_fold) / 4)
    # another layout, and all folds at once or one by one, give the same numbers
    tr, te = mf.fold_split(R, 2)
    assert mf.train(tr, te, d=2, maxiter=2, seed=9).last_rmse == pytest.approx(per_fold[2][1], rel=1e-12)
    summary2, per_fold2 = mf.cross_validate(R, folds=4, d=2, maxiter=2, seed=9, blocks=3, hot_ratings=2)
    assert [r for _, r, _ in per_fold2] == pytest.approx([r for _, r, _ in per_fold], rel=1e-12)


def test_fit_all_writes_factors(spark, tmp_out):
    from tallyho.sources.files import read_factors
    R = tables.lineitem_ratings(spark, SMALL)
    fit = mf.fit_all(R, output=f"{tmp_out}/model", d=2, maxiter=1, seed=2)
    U, V = read_factors(spark, f"{tmp_out}/model")
    assert U.count() == fit.U.count() and V.count() == fit.V.count()


def test_history_table(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    train, test = mf.fold_split(R, 1)
    fit = mf.train(train, test, d=2, maxiter=3, seed=4)
    h = fit.history_df(spark).orderBy("iteration").collect()
    assert [r["iteration"] for r in h] == [1, 2, 3]
    assert all(r["test_rmse"] is not None and r["test_rmse_scored"] >= r["test_rmse"] - 1e-12 for r in h)
    assert h[0]["gamma"] == pytest.approx(0.001) and h[1]["gamma"] == pytest.approx(0.001 / 2 ** 0.2)


def test_dealt_users_give_the_same_factors(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    a = mf.train(R, None, d=2, maxiter=2, seed=3)
    b = mf.train(R, None, d=2, maxiter=2, seed=3, blocks=5, hot_ratings=1)
    for x, y, key, vec in ((a.U, b.U, "i", "u"), (a.V, b.V, "j", "v")):
        x, y = ({r[key]: r[vec] for r in t.collect()} for t in (x, y))
        assert x.keys() == y.keys()
        assert max(abs(p - q) for k in x for p, q in zip(x[k], y[k])) < 1e-12
    plan = mf.join_predict(R, a.U, a.V, 2, False, False, salt_buckets=3)._jdf.queryExecution() \
        .executedPlan().toString()
    assert "_salt" in plan


def test_an_iteration_exchanges_no_ratings_and_joins_profiles_four_times(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    U = mf.random_profiles(R, "user", 2, 1).select(F.lit(0).alias("f"), "i", "u")
    V = mf.random_profiles(R, "item", 2, 1).select(F.lit(0).alias("f"), "j", "v")
    U, V = mf.cut_lineage(U), mf.cut_lineage(V)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    profile_joins = 0
    try:
        for side in "ij":
            laid = blocks.lay_out_ratings(R, side)
            with blocks.co_partitioned(spark):
                df = mf._moved(laid, U, V, side, 0.1, 0.0, 2)
                assert exchanged_scans(df, laid.names[0]) == (1, 0)
                profile_joins += sum(line.count("[block") > 0 for line in df._jdf.queryExecution().executedPlan().toString().split("\n")
                                     if "Join" in line)
                assert df.count() > 0
            laid.drop()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert profile_joins == 4


def test_all_folds_are_one_plan(spark, monkeypatch):
    """The layouts and the jobs of an iteration do not grow with the folds."""
    R = tables.lineitem_ratings(spark, SMALL)
    laid, steps = [], []
    lay_out, moved = mf.lay_out_ratings, mf._moved
    monkeypatch.setattr(mf, "lay_out_ratings", lambda *a: laid.append(1) or lay_out(*a))
    monkeypatch.setattr(mf, "_moved", lambda *a: steps.append(1) or moved(*a))
    for folds in (2, 4):
        laid.clear()
        steps.clear()
        mf.cross_validate(R, folds=folds, d=2, maxiter=2, seed=9, blocks=4)
        assert len(laid) == 2 and len(steps) == 4


def test_a_model_that_stops_leaves_the_others(spark):
    """Fold 1 has no ratings, so its model sees all of them and has no RMSE."""
    R = spark.createDataFrame([(i, j, float(i * j % 3), 0 if (i + j) % 2 else 2) for i in range(4) for j in range(4)],
                              "i BIGINT, j BIGINT, r DOUBLE, fold INT")
    summary, per_fold = mf.cross_validate(R, folds=3, d=2, maxiter=3, seed=9)
    assert [len(h) for _, _, h in per_fold] == [3, 3, 3] and per_fold[1][1] is None
    assert summary.first()["cv_rmse"] == pytest.approx((per_fold[0][1] + per_fold[2][1]) / 2)
    _, stopped = mf.cross_validate(R, folds=3, d=2, maxiter=3, seed=9, epsilon=1e9)
    assert [len(h) for _, _, h in stopped] == [2, 2, 2]


@pytest.mark.parametrize("n", [1, 7])
def test_profiles_over_the_bound_meet_ratings_in_a_grid(spark, n):
    """Same rows as a plain join: repeated pairs, nulls, unknown ids, one user of most ratings."""
    rows = [(0, j % 5, float(j)) for j in range(40)] + [(i, 1, 1.5) for i in range(9)] * 2
    R = _ratings(spark, rows + [(None, 1, 1.0), (1, None, 1.0), (None, None, 2.0), (2, 3, None), (77, 1, 1.0), (1, 77, 1.0)])
    U = spark.createDataFrame([(i, [float(i), 0.5]) for i in range(8)] + [(8, None), (None, [1.0, 1.0])], "i BIGINT, u ARRAY<DOUBLE>")
    V = spark.createDataFrame([(j, [1.0, float(j)]) for j in range(5)] + [(4, [2.0, 2.0])], "j BIGINT, v ARRAY<DOUBLE>")
    show = lambda df: sorted(map(repr, df.select("i", "j", "r", "u", "v").collect()))
    want = R.join(U, "i").join(V, "j")
    assert show(blocks.joined_on_grid(R, U, V, n)) == show(want)
    J = mf.join_predict(R, U, V, 2, max_broadcast_rows=1)
    assert show(J) == show(want)
    assert sorted(map(repr, J.collect())) == sorted(map(repr, mf.join_predict(R, U, V, 2, True, True).collect()))
    # no exchange carries a rating and a vector: the joins' own exchanges are gone
    plan = J.select("i", "delta")._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange ") == 1


def test_profiles_over_the_bound_train_in_a_grid(spark, monkeypatch):
    """Same factors and histories as with broadcast profiles: repeated pairs, nulls, unknown ids, held-out ratings, several
    blocks of ratings a task, one user of most ratings; ratings are exchanged once and never meet a join."""
    rows = [(i, j, float((7 * i + j) % 5), (i + j) % 3) for i in range(12) for j in range(9) if (i * j) % 4 != 1]
    rows += [(0, j % 9, 1.5, j % 3) for j in range(200)] + [(3, 3, None, 0), (None, 3, 1.0, 1), (3, None, 1.0, 2), (4, 4, 1.0, None)]
    R = spark.createDataFrame(rows, "i BIGINT, j BIGINT, r DOUBLE, fold INT")
    U = spark.createDataFrame([(i, [0.1 * i, 0.5, -0.2]) for i in range(11)] + [(2, [0.3, 0.1, 0.0]), (40, [1.0, 1.0, 1.0])], "i BIGINT, u ARRAY<DOUBLE>")
    V = spark.createDataFrame([(j, [0.4, 0.1 * j, 0.3]) for j in range(9)], "j BIGINT, v ARRAY<DOUBLE>")
    kw = dict(d=3, gain=0.01, lam=0.1, mu=0.2, maxiter=2)
    train, test = mf.fold_split(R, 1)
    fits = lambda: [mf.train(train, test, U0=U, V0=V, **kw)]
    numbers = lambda history: [-1.0 if v is None else v for h in history for v in h[:-1]]
    folds = lambda: mf.cross_validate(R.where("fold is not null"), init=lambda tr: (U, V), **{**kw, "maxiter": 1})[1]
    want, want_cv = fits(), folds()
    monkeypatch.setattr(mf, "profile_broadcast_rows", lambda d: 1)
    monkeypatch.setattr(blocks, "GRID_STEP", 16)
    monkeypatch.setattr(mf, "lay_out_ratings", None)
    for a, b in zip(want, fits()):
        for x, y, key, vec in ((a.U, b.U, "i", "u"), (a.V, b.V, "j", "v")):
            assert x.schema == y.schema
            x, y = (sorted((r[key], *r[vec]) for r in t.collect()) for t in (x, y))
            assert len(x) == len(y) and [v for r in y for v in r] == pytest.approx([v for r in x for v in r], rel=1e-12, abs=1e-14)
        assert numbers(b.history) == pytest.approx(numbers(a.history), rel=1e-9)
    for (k, a, g), (m, b, h) in zip(want_cv, folds()):
        assert k == m and a == pytest.approx(b, rel=1e-12) and numbers(g) == pytest.approx(numbers(h), rel=1e-9)
    with pytest.raises(Exception, match="entries"):
        mf.train(R, d=2, maxiter=1, U0=U, V0=V)
    grid = blocks.lay_out_grid(R)
    sums = grid.sums(U.withColumn("f", F.lit(-1)), V.withColumn("f", F.lit(-1)), 3)
    assert exchanged_scans(sums, grid.names[0]) == (1, 0)
    assert {(r["kind"], r["f"]) for r in sums.collect()} == {(k, -1) for k in range(3)}
    assert blocks.lay_out_grid(R, block_ratings=10).n == 6
    grid.drop()
