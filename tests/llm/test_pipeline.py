"""The pipeline stage by stage against brute force, callers' columns, and the
bounded samples."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tallyho.llm import common, curriculum, decontaminate, jaccard_join, language_id, line_rules, mil_quality, secrets
from tests.llm import brute
from tests.llm.conftest import odd_rows, prose

SMALL = "/root/testdata/sf0.001"
# names of results and of operators' own columns, in one case or another
NAMES = ["Score", "N_WORDS", "spans", "Items", "n_hit", "_row", "_blob", "_Salt", "_spans", "_text", "Kept", "clean_text", "_H", "_d",
         "_before", "_bucket", "row", "comp", "t", "CLS", "f", "component_id", "lang_pred", "Terms", "_words", "_tie", "skey", "_key"]


def wide(spark, rows):
    schema = ", ".join(["doc_id long, text string, lang string, source string", *[f"`{n}` string" for n in NAMES]])
    return spark.createDataFrame([(*r, *[f"{n}:{k}" for n in NAMES]) for k, r in enumerate(rows)], schema)


def good_rows():
    return [(d, prose(d, 90) + f" token={'ab12' * 3}{d} .", "en", "ab"[d % 2]) for d in range(1, 9)]


@pytest.mark.parametrize("name", ["decontaminate", "redact", "clean", "keep_one", "quality", "mix"])
def test_other_columns_come_back_untouched(spark, tmp_out, name):
    docs = wide(spark, good_rows())
    run = {"decontaminate": lambda d: decontaminate.decontaminate(d, spark.createDataFrame([(1, "no such words here")], "item_id long, text string")),
           "redact": secrets.redact, "clean": line_rules.clean, "keep_one": jaccard_join.keep_one, "mix": curriculum.mix,
           "quality": lambda d: corpus_pipeline.quality(spark, d, SMALL)}[name]
    if name == "quality":
        spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_out}/labels.parquet")
        run = lambda d: corpus_pipeline.quality(spark, d, tmp_out)
    got = run(docs)
    assert got.columns == docs.columns + (["size", "source_size", "target", "taken", "position"] if name == "mix" else [])
    was = {r[0]: r[2:] for r in docs.collect()}
    rows = got.collect()
    assert len(rows) > 3 and all(r[2:2 + len(NAMES) + 2] == was[r[0]] for r in rows)
    if name == "redact":
        assert all("[SECRET]" in r["text"] for r in rows)


def forward(model, x):
    """The score of one document, passage by passage."""
    p = model.weights
    hidden = [np.tanh(v @ p["W"] + p["b"]) for v in ((x - model.mean) / model.scale).clip(-8, 8)]
    raw = [float((np.tanh(h @ p["V"]) * (1 / (1 + np.exp(-(h @ p["U"]))))) @ p["w"]) for h in hidden]
    share = np.exp(np.array(raw) - max(raw))
    z = sum(a * h for a, h in zip(share / share.sum(), hidden))
    return float(1 / (1 + np.exp(-(z @ p["o"] + p["c"]))))


def test_stages_against_brute_force(spark, tmp_out):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text", "lang", "source").withColumn("Score", F.lit("mine"))
    more = [(None if d is None else d + 100_000, t, a, s, "mine") for d, t, a, s in odd_rows()]
    docs = common.written(docs.unionAll(spark.createDataFrame(more, docs.schema)), "test-docs")
    marks = common.training_marks(spark.read.parquet(f"{SMALL}/labels.parquet"), "quality")
    model = mil_quality.fit(docs.drop("Score"), marks)
    assert model.weights is not None
    scored = mil_quality.score(docs.select("doc_id", "text"), model).collect()
    for r in scored:
        raw = (r["text"] or "").encode()
        x, first = mil_quality.passages(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
        assert r["score"] == pytest.approx(forward(model, x[:first[1]]), abs=1e-4)
    rows = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [tuple(r) for r in rows.collect()]
        out = common.written(stage(spark, rows, SMALL), "test-stage")
        after = [tuple(r) for r in out.collect()]
        ids = sorted((r[0] for r in after), key=str)
        unique = {r[0]: r[1] for r in before}
        if name == "quality":
            clear = {r["doc_id"] for r in scored if abs(r["score"] - 0.3) > 1e-3}
            keep = {r["doc_id"] for r in scored if r["score"] >= 0.3}
            assert set(ids) & clear == keep & clear
        elif name == "near_duplicates":
            found = brute.components([(d, t) for d, t in unique.items() if d is not None], 5, 80)
            assert ids == sorted([d for d, (_, c) in found.items() if c == d] + [r[0] for r in before if r[0] is None], key=str)
        elif name == "decontamination":
            bench = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
            bad = brute.contamination(unique.items(), bench)
            assert ids == sorted((r[0] for r in before if not bad[r[0]][4]), key=str)
        elif name == "secret_scan":
            assert ids == sorted((r[0] for r in before), key=str)
            assert all(r[1] == unique[r[0]] or "[SECRET]" in r[1] for r in after)
        else:
            size = {d: len(brute.WORD.findall(t or "")) for d, t in unique.items()}
            assert all(r[-5] == size[r[0]] and r[-2] <= 3 * r[-5] for r in after)
            for s in {r[3] for r in after}:
                own = [r for r in after if r[3] == s]
                assert abs(sum(r[-2] for r in own) - own[0][-3]) <= 1
        if name != "mixture":
            assert out.columns == docs.columns and all(r[4] == "mine" for r in after)
        rows = out


def test_pipeline_on_no_documents(spark, tmp_out):
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").write.parquet(f"{tmp_out}/{name}.parquet")
    spark.read.parquet(f"{SMALL}/documents.parquet").limit(0).write.parquet(f"{tmp_out}/documents.parquet")
    assert corpus_pipeline.run(spark, tmp_out).count() == 0


def test_sample_of_many_values(spark):
    rows = spark.range(100_000).selectExpr("id AS doc_id", "concat('text ', id) AS text", "concat('lang ', id) AS lang")
    got = common.bounded_sample(rows, "lang", 0.04)
    n = got.count()
    assert 3_500 < n < 4_500 and got.select("doc_id").distinct().count() == n
    assert {r[0] for r in got.collect()} == {r[0] for r in common.bounded_sample(rows.repartition(7), "lang", 0.04).collect()}


def test_sample_of_a_huge_group(spark):
    """Out of ten billion a share of 800 is 8e-8: no such draw may round to none."""
    share = 800 / 1e10
    draw = spark.range(50_000_000).select(common.chance(F.xxhash64("id")).alias("c"))
    assert 0 < draw.where(F.col("c") < share).count() + draw.where(F.col("c") < 20 * share).count() < 250


def test_an_id_that_repeats_does_not_flood_the_sample(spark):
    same = spark.range(10_000).selectExpr("7L AS doc_id", "concat('text ', id) AS text")
    docs = same.unionAll(spark.range(100).selectExpr("id + 10 AS doc_id", "concat('other ', id) AS text"))
    marks = docs.select("doc_id").distinct().selectExpr("doc_id", "int(doc_id = 7) AS label")
    sample, counts = common.training_texts(docs, marks, {1: 50, 0: 50})
    got = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    assert counts == {0: 100, 1: 1} and got[0] == 50 and 20 < got[1] <= 165


def test_language_prediction_equals_the_machines(spark):
    """Family by the largest softmax weight, then the pairs inside it."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language_id.fit(docs)
    texts = [(r["doc_id"], r["text"]) for r in docs.where("text is not null").limit(60).collect()]
    got = {r["doc_id"]: r["lang_pred"] for r in language_id.predict(docs.select("doc_id", "text"), model).collect()}
    for d, t in texts:
        raw = t.encode()
        x = language_id.trigram_rows(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0]
        x = np.append(x, np.float32(1))
        family = int(np.argmax(x @ model.family)) if model.family is not None else 0
        group = model.members[family]
        votes = {a: 0.0 for a in group}
        for a, b, w in model.pairs:
            if a in votes and b in votes:
                p = 1 / (1 + np.exp(-np.clip(4 * float(x @ w), -50, 50)))
                votes[a] += p
                votes[b] += 1 - p
        want = model.langs[max(group, key=lambda a: (votes[a], -a))]
        assert got[d] == want or len(set(t)) < 3
