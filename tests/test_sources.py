"""File sources / sinks: round trips through temp folders."""

import os

import pytest

from tallyho.sources import files


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        fh.write(text)


def test_lines_and_word_list(spark, tmp_out):
    _write(f"{tmp_out}/t.txt", "First line.\nSecond  line\n")
    assert [r["line"] for r in files.read_lines(spark, f"{tmp_out}/t.txt").collect()] == \
        ["First line.", "Second  line"]
    _write(f"{tmp_out}/easy.txt", "The\nthe\nA big\n\n")
    assert {r["word"] for r in files.read_word_list(spark, f"{tmp_out}/easy.txt").collect()} == {"the", "a", "big"}


def test_dense_points_both_readers(spark, tmp_out):
    _write(f"{tmp_out}/p.csv", "1.0e+00,2.5,-3e-01,4.0\n-1,0,0,2.0e+01\n")
    a = sorted((tuple(r["x"]), r["y"]) for r in files.read_dense_points(spark, f"{tmp_out}/p.csv").collect())
    b = sorted((tuple(r["x"]), r["y"]) for r in files.read_dense_points_csv(spark, f"{tmp_out}/p.csv", 3).collect())
    assert a == b == [((-1.0, 0.0, 0.0), 20.0), ((1.0, 2.5, -0.3), 4.0)]


def test_sparse_points(spark, tmp_out):
    _write(f"{tmp_out}/s.txt", "({'a': 1.0, 'b': 2}, 1)\n({\"c\": -0.5}, -1)\n({}, 1)\n")
    points, cells = files.read_sparse_points(spark, f"{tmp_out}/s.txt")
    pts = {r["id"]: r["y"] for r in points.collect()}
    assert sorted(pts.values()) == [-1.0, 1.0, 1.0]
    got = sorted((r["feat"], r["x"]) for r in cells.collect())
    assert got == [("a", 1.0), ("b", 2.0), ("c", -0.5)]


def test_sparse_vector_round_trips(spark, tmp_out):
    beta = spark.createDataFrame([("a", 0.125), ("b", -3.0)], "feat STRING, value DOUBLE")
    files.write_sparse_vector(beta, f"{tmp_out}/bp")
    files.write_sparse_vector(beta, f"{tmp_out}/bp")            # overwrite
    files.write_sparse_vector(beta, f"{tmp_out}/bt", fmt="text")
    for fmt, p in (("parquet", "bp"), ("text", "bt")):
        got = {r["feat"]: r["value"] for r in files.read_sparse_vector(spark, f"{tmp_out}/{p}", fmt).collect()}
        assert got == {"a": 0.125, "b": -3.0}
    _write(f"{tmp_out}/py.txt", "('x', 1.5)\n(y,2.000000)\n")
    got = {r["feat"]: r["value"] for r in files.read_sparse_vector(spark, f"{tmp_out}/py.txt", "text").collect()}
    assert got == {"x": 1.5, "y": 2.0}


def test_dense_vector_round_trips(spark, tmp_out):
    from tallyho.operators.linreg import vector_df, vector_from_df
    files.write_dense_vector(vector_df(spark, [1.5, -2.0, 0.0]), f"{tmp_out}/dv")
    assert list(vector_from_df(files.read_dense_vector(spark, f"{tmp_out}/dv"))) == [1.5, -2.0, 0.0]
    _write(f"{tmp_out}/dv.csv", "1.0,2.0,3.5\n")
    assert list(vector_from_df(files.read_dense_vector_csv(spark, f"{tmp_out}/dv.csv"))) == [1.0, 2.0, 3.5]


def test_rating_folds(spark, tmp_out):
    _write(f"{tmp_out}/folds/fold0", "0,1,2.5\n1,1,-3\n")
    _write(f"{tmp_out}/folds/fold1", "0,1,1.0\n")
    R = files.read_rating_folds(spark, f"{tmp_out}/folds", 2)
    got = sorted(tuple(r) for r in R.collect())
    assert got == [(0, 1, 1.0, 1), (0, 1, 2.5, 0), (1, 1, -3.0, 0)]


def test_unparsable_sparse_point_fails_loudly(spark, tmp_out):
    _write(f"{tmp_out}/bad.txt", "({'a': 1.0}, 1)\nnot a point\n")
    points, cells = files.read_sparse_points(spark, f"{tmp_out}/bad.txt")
    with pytest.raises(Exception):
        cells.collect()


def test_document_lines_match_whole_documents(spark):
    from tallyho.operators import text as T
    from tallyho.sources import tables
    docs = tables.documents(spark, "/root/testdata/sf0.001")
    lines = tables.document_lines(docs).withColumnRenamed("line", "text")
    for op in (T.sentence_count, T.word_count):
        a = {r[0]: r[1] for r in op(docs, "text", by=["doc_id"]).collect()}
        b = {r[0]: r[1] for r in op(lines, "text", by=["doc_id"]).collect()}
        assert a == b
    wa = {r["word"]: r["n"] for r in T.word_counts(docs).collect()}
    wb = {r["word"]: r["n"] for r in T.word_counts(lines).collect()}
    assert wa == wb
