"""Physical-plan regression tests for the scale decisions in README.md."""

from pyspark.sql import functions as F

from tallyho.operators import linreg, logreg, mf
from tallyho.operators import text as T
from tallyho.sources import tables

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_word_counts_tokenise_once_and_aggregate_partially(spark):
    plan = _plan(T.word_counts(tables.documents(spark, SMALL)))
    assert plan.count("regexp_extract_all(lower(") == 1
    assert plan.count("HashAggregate") == 2            # partial + final around one shuffle
    assert "SortAggregate" not in plan


def test_gram_is_one_pruned_scan_and_global_aggregate(spark):
    pts = tables.lineitem_points(spark, SMALL)
    plan = _plan(linreg.gram(pts, 3))
    assert plan.count("FileScan parquet") == 1
    read = pts._jdf.queryExecution().executedPlan().toString()
    assert "l_returnflag" not in read and "l_shipdate" not in read   # pruned columns


def test_mf_steps_use_hash_aggregation(spark):
    R = tables.lineitem_ratings(spark, SMALL)
    U = mf.random_profiles(R, "user", 3, 1)
    V = mf.random_profiles(R, "item", 3, 1)
    J = mf.join_predict(R, U, V, 3, True, True)
    for step in (mf.step_u(J, U, 0.1, 0.1, 3, True), mf.step_v(J, V, 0.1, 0.1, 3, True)):
        plan = _plan(step)
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_logistic_gradient_is_one_feature_aggregate(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    beta = logreg.zero_beta(cells)
    m = logreg.margins(points, cells, beta, broadcast=True)
    plan = _plan(logreg.gradient_pairs(m, cells, beta, 0.1, broadcast_points=True))
    # the final (feat) aggregate appears once as partial + final; no outer joins
    assert "FullOuter" not in plan and "LeftOuter" not in plan
    assert "SortAggregate" not in plan


def test_margins_need_no_join_back_to_points(spark):
    points, cells = tables.labelled_points(spark, SMALL)
    beta = logreg.zero_beta(cells).withColumn("value", F.lit(0.5))
    plan = _plan(logreg.margins(points, cells, beta, broadcast=True))
    assert "SortMergeJoin" not in plan and "LeftOuter" not in plan


def test_no_cartesian_products_anywhere(spark):
    from __spark_entry__ import queries
    qs = queries()
    for key in ("dale_chall_by_lang", "linreg_objective", "margins", "mf_objective", "mf_counts"):
        plan = _plan(qs[key](spark, SMALL))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, key


def test_salted_join_replicates_small_side_only_by_bucket_count(spark):
    from tallyho.session import salted_join
    big = spark.createDataFrame([(1, i) for i in range(30)] + [(2, 0)], "k INT, v INT")
    small = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, s STRING")
    out = salted_join(big, small, ["k"], 4)
    assert out.count() == big.count()
    assert sorted(out.columns) == ["k", "s", "v"]
