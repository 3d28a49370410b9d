"""Text statistics: semantics on hand-made lines (edge cases) and options."""

import pytest
from pyspark.sql import functions as F

from tallyho.operators import text as T


def _df(spark, lines, col="line"):
    return spark.createDataFrame([(i, l) for i, l in enumerate(lines)], f"id INT, {col} STRING")


def _counts(df):
    return {r["word"]: r["n"] for r in df.collect()}


def test_sentences_and_words_edge_cases(spark):
    lines = ["", "  ", "Hello world. ", "a..b", "tab\tseparated words", "...", "x"]
    df = _df(spark, lines)
    n_sent = T.sentence_count(df, "line").first()["n_sentences"]
    n_words = T.word_count(df, "line").first()["n_words"]
    # python definition: split on '.' / ' ', keep non-empty pieces
    exp_s = sum(len([p for p in l.split(".") if len(p) > 0]) for l in lines)
    exp_w = sum(len([p for p in l.split(" ") if len(p) > 0]) for l in lines)
    assert n_sent == exp_s
    assert n_words == exp_w


def test_document_equals_sum_of_lines(spark):
    text = "One. Two three.\n\nFour five six\n. seven"
    doc = _df(spark, [text], "text")
    lines = _df(spark, text.split("\n"), "text")
    assert T.sentence_count(doc).first()[0] == T.sentence_count(lines).first()[0]
    assert T.word_count(doc).first()[0] == T.word_count(lines).first()[0]


def test_strip_token_mode(spark):
    df = _df(spark, [",1what?!\" haven't 123 ... Hello", "HELLO x2y"])
    c = _counts(T.word_counts(df, "line"))
    assert c == {"what": 1, "haven't": 1, "hello": 2, "x2y": 1}


def test_strip_line_mode(spark):
    lines = ["1 2 hello, world 3", "!!", "? ?", "", "a", "x. y z9"]
    df = _df(spark, lines)
    got = _counts(T.word_counts(df, "line", strip="line"))

    def ref(line):
        toks = line.lower().split(" ")
        alpha = [t.isalpha() for t in toks]
        if True not in alpha:
            return toks if len(toks) == 1 else []
        first = alpha.index(True)
        last = len(alpha) - 1 - alpha[::-1].index(True)
        return toks[first:last + 1]

    exp = {}
    for l in lines:
        for t in ref(l):
            if t:
                exp[t] = exp.get(t, 0) + 1
    assert got == exp


def test_top_words_ties_by_word(spark):
    df = _df(spark, ["b a c b a c d"])
    top = [(r["word"], r["n"]) for r in T.top_words(T.word_counts(df, "line"), 2).collect()]
    assert top == [("a", 2), ("b", 2)]


def test_top_words_per_group(spark):
    df = spark.createDataFrame([("x", "a a b"), ("y", "c d d d")], "g STRING, line STRING")
    got = {(r["g"], r["word"]): r["rank"]
           for r in T.top_words(T.word_counts(df, "line", by=["g"]), 1, by=["g"]).collect()}
    assert got == {("x", "a"): 1, ("y", "d"): 1}


def test_difficult_and_dale_chall(spark):
    df = _df(spark, ["The cat sat. The dog ran far away."])
    easy = spark.createDataFrame([("the",), ("cat",), ("dog",)], "word STRING")
    counts = T.word_counts(df, "line")
    diff = {r["word"] for r in T.difficult_words(counts, easy).collect()}
    assert diff == {"sat", "ran", "far", "away"}
    assert T.difficult_word_count(counts, easy).first()["n_difficult"] == 4
    assert T.difficult_word_count(counts, easy, count="tokens").first()["n_difficult"] == 4
    r = T.dale_chall(df, easy, "line").first()
    words, sents, hard = 8, 2, 4
    assert (r["n_words"], r["n_sentences"], r["n_difficult"]) == (words, sents, hard)
    assert r["score"] == pytest.approx(0.1579 * (hard / words) * 100 + 0.0496 * words / sents)
    adj = T.dale_chall(df, easy, "line", adjusted=True).first()["score"]
    assert adj == pytest.approx(r["score"] + 3.6365)


def test_dale_chall_by_group_matches_separate_ops(spark):
    from tallyho.sources import tables
    docs = tables.documents(spark, "/root/testdata/sf0.001")
    easy = tables.easy_words(spark, "/root/testdata/sf0.001")
    dc = {r["lang"]: r for r in T.dale_chall(docs, easy, by=["lang"]).collect()}
    sents = {r["lang"]: r["n_sentences"] for r in T.sentence_count(docs, by=["lang"]).collect()}
    words = {r["lang"]: r["n_words"] for r in T.word_count(docs, by=["lang"]).collect()}
    hard = {r["lang"]: r["n_difficult"] for r in T.difficult_word_count(
        T.word_counts(docs, by=["lang"]), easy, by=["lang"]).collect()}
    for lang, r in dc.items():
        assert r["n_sentences"] == sents[lang]
        assert r["n_words"] == words[lang]
        assert r["n_difficult"] == hard.get(lang, 0)


def test_zero_denominators_are_null(spark):
    df = _df(spark, ["", "..."])
    easy = spark.createDataFrame([("a",)], "word STRING")
    r = T.dale_chall(df, easy, "line").first()
    assert r["n_words"] == 1 and r["n_sentences"] == 0
    assert r["words_per_sentence"] is None and r["score"] is None


def test_plan_is_single_scan_with_partial_aggregate(spark):
    from tallyho.sources import tables
    docs = tables.documents(spark, "/root/testdata/sf0.001")
    easy = tables.easy_words(spark, "/root/testdata/sf0.001")
    plan = T.dale_chall(docs, easy, by=["lang"])._jdf.queryExecution().executedPlan().toString()
    # documents scanned once; the easy words come from their checkpoint
    assert plan.count("FileScan parquet") == 1 and "documents.parquet" in plan
    assert "benchmark.parquet" not in plan
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan
    assert plan.count("regexp_extract_all(lower(") == 1  # text tokenised once


def test_strip_non_alpha_column_function(spark):
    from tallyho.functions.text import strip_non_alpha
    toks = [",1what?!\"", "haven't", "123", "é-x-é!", "a", "--", ""]
    df = spark.createDataFrame([(t,) for t in toks], "t STRING")
    got = [r[0] for r in df.select(strip_non_alpha("t")).collect()]
    # docstring rule: leading / trailing non-letters removed, inner ones kept
    assert got == ["what", "haven't", "", "é-x-é", "a", "", ""]
