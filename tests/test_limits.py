"""Nothing is cut silently: caps, prefixes, bad lines, nulls, wide rows."""

import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyho import session
from tallyho.functions import text as T
from tallyho.functions.vectors import column_dot, literal_dot
from tallyho.operators import gradcheck, linreg, logreg, mf, text
from tallyho.sources import files


def test_line_search_goes_beyond_one_block(spark):
    rows = [(i, 1.0 if i % 3 else -1.0) for i in range(300)]
    points = spark.createDataFrame(rows, "id long, y double")
    cells = points.select("id", F.lit("f").alias("feat"), F.lit(1e6).alias("x"))
    beta = logreg.zero_beta(cells)
    g = logreg.gradient(points, cells, beta)
    found = logreg.line_search(points, cells, beta, g)
    assert found.accepted and found.backtracks >= logreg.TRIAL_BLOCK and found.f_new < found.f0
    small = logreg.line_search(points, cells, beta, g, block=7)
    assert small.backtracks == found.backtracks
    fit = logreg.train(points, cells, max_iter=2, eps=0.0)
    assert fit.iterations == 2 and fit.beta.first()["value"] != 0.0
    assert all(h[-1] >= 0 for h in fit.history)


def test_vectors_of_other_lengths_fail(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 3.0], 1.0)], "x array<double>, y double")
    for value in (literal_dot("x", [1.0]), column_dot("x", "x", 2), column_dot("x", "x", 4)):
        with pytest.raises(Exception, match="entries"):
            rows.select(value).collect()
    none = spark.createDataFrame([(None,)], "x array<double>")
    assert none.select(literal_dot("x", [1.0])).first()[0] is None
    U = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "i long, u array<double>")
    V = spark.createDataFrame([(1, [1.0, 2.0, 3.0])], "j long, v array<double>")
    R = spark.createDataFrame([(1, 1, 1.0)], "i long, j long, r double")
    with pytest.raises(Exception, match="entries"):
        mf.train(R, d=2, maxiter=1, U0=U, V0=V)


def test_text_after_odd_separators_stays(spark):
    for sep in ("\r", "\x85", " ", " "):
        rows = spark.createDataFrame([(f"hello wor{sep}ld foo bar",)], "text string")
        words = {r["word"] for r in text.word_counts(rows, strip="line").collect()}
        assert {"foo", "bar"} <= words
    ends = [spark.createDataFrame([(f"a b.{e}{e}c.{e}",)], "text string") for e in ("\n", "\r\n", "\r")]
    counts = [(text.sentence_count(d).first()[0], text.word_count(d).first()[0]) for d in ends]
    assert counts == [(2, 3)] * 3


def test_long_runs_of_non_letters_are_linear(spark):
    rows = spark.createDataFrame([("-" * 200_000 + " end " + "a" + "-" * 200_000 + "b",)], "text string")
    rows.select(T.normalised_word_array("text")).collect()
    began = time.perf_counter()
    assert len(rows.select(T.normalised_word_array("text")).first()[0]) == 2
    rows.select(T.strip_non_alpha("text")).collect()
    assert time.perf_counter() - began < 5


@pytest.mark.parametrize("parse,line", [
    (files.parse_ratings, "1,x,4.0"), (files.parse_ratings, "2,3"), (files.parse_ratings, "4,5,6.0,7"),
    (files.parse_dense_points, "1.0,two,3"), (files.parse_sparse_vector, "feat,1"), (files.parse_sparse_vector, "('a',b)"),
    (lambda x: files.parse_sparse_points(x)[0], "{'a': 1.0}"), (lambda x: files.parse_sparse_points(x)[1], "({a: 1}, 1)"),
    (lambda x: files.parse_sparse_points(x)[1], "({'a': 1.0, 'b': 'x'}, 1)"),
    (lambda x: files.parse_sparse_points(x)[1], "({'c': 1.0,}, 1)"),
])
def test_bad_lines_fail(spark, parse, line):
    with pytest.raises(Exception, match="unparsable"):
        parse(spark.createDataFrame([(1, line)], "id long, line string")).collect()


def test_sparse_ids_agree(spark, tmp_out):
    spark.createDataFrame([(f"({{'a': {k}.0}}, {k})",) for k in range(50)], "line string").repartition(5).write.text(f"{tmp_out}/p")
    points, cells = files.read_sparse_points(spark, f"{tmp_out}/p")
    assert points.join(cells, "id").where("x <> y").count() == 0 and points.count() == 50


@pytest.mark.parametrize("method", ["columns", "arrow"])
def test_gram_refuses_nulls(spark, method):
    for rows in ([([1.0, 2.0], None)], [([1.0, None], 1.0)]):
        points = spark.createDataFrame(rows, "x array<double>, y double")
        with pytest.raises(Exception, match="nulls"):
            linreg.gram(points, 2, method).collect()


def test_least_squares_of_any_width(spark):
    r = np.random.default_rng(2)
    X, d = r.standard_normal((40, 120)), 120
    y, beta = r.standard_normal(40), r.standard_normal(120)
    points = spark.createDataFrame([(x.tolist(), float(v)) for x, v in zip(X, y)], "x array<double>, y double")
    want = -2 * X.T @ (y - X @ beta) / 40 + 2 * 0.5 * beta
    got = {q["idx"]: q["value"] for q in linreg.gradient(points, beta.tolist(), 0.5).collect()}
    assert np.allclose([got[k] for k in range(d)], want)
    check = gradcheck.linreg_check(points, beta.tolist(), 0.5, 1e-6).collect()
    assert len(check) == d and max(q["abs_diff"] for q in check) < 1e-3
    gram, passes = (linreg.train_gd(points, lam=0.1, max_iter=3, eps=0.0, mode=m) for m in ("gram", "pass"))
    assert np.allclose(gram.beta, passes.beta) and gram.iterations == passes.iterations == 3
    wide = spark.createDataFrame([([0.0] * 1000, 1.0)], "x array<double>, y double")
    began = time.perf_counter()
    linreg.gradient(wide, [0.1] * 1000).explain()
    assert time.perf_counter() - began < 10


def test_wide_rows_are_not_broadcast(spark):
    rows = spark.createDataFrame([("x" * 1000,)] * 20, "word string")
    hinted = lambda d: "broadcast" in d._jdf.queryExecution().logical().toString().lower()
    assert hinted(session.bounded_broadcast(rows)) and not hinted(session.bounded_broadcast(rows, max_bytes=5_000))


def test_salted_joins_keep_one_side(spark):
    rows = spark.range(3)
    with pytest.raises(ValueError):
        session.salted_join(rows, rows, ["id"], 4, "full")
