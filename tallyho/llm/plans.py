"""Registered queries of the training-data operators and their SQL oracles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.llm import (bwt_dedup, curriculum, decontaminate, fill_in_middle, jaccard_join, language_id, line_rules, mil_quality,
                         periodic_runs, secrets, superminhash, toxicity, warc)
from tallyho.llm.common import crc_mod, read_table, training_marks


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def _held_out(folds: int, remainder: int):
    return F.coalesce(crc_mod(F.col("doc_id"), folds) == remainder, F.lit(False)).alias("held_out")


def op1_language_id(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    model = language_id.fit(docs.where(crc_mod(F.col("doc_id"), 3) != 1))
    return language_id.predict(docs.select("doc_id", "text"), model).select("doc_id", _held_out(3, 1), "lang_pred", "score")


def op2_decontaminate(spark, sf_dir):
    docs = _docs(spark, sf_dir).select("doc_id", "text")
    return decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op3_quality(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    model = mil_quality.fit(docs, training_marks(read_table(spark, sf_dir, "labels"), "quality"))
    return mil_quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", _held_out(5, 0), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_toxicity(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    model = toxicity.fit(docs, training_marks(read_table(spark, sf_dir, "labels"), "toxic"))
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", _held_out(5, 0), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_secret_scan(spark, sf_dir):
    return secrets.scan_documents(_docs(spark, sf_dir))


def op6_jaccard_join(spark, sf_dir):
    return jaccard_join.join(_docs(spark, sf_dir), words=3, percent=90)


def op7_quality_rules(spark, sf_dir):
    return line_rules.judge(_docs(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_bwt_dedup(spark, sf_dir):
    return bwt_dedup.dedup(_docs(spark, sf_dir))


def op9_curriculum(spark, sf_dir):
    return curriculum.assign(_docs(spark, sf_dir)).select(
        "doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken",
        F.round("position", 9).alias("position")).orderBy("position", "doc_id")


def op10_warc(spark, sf_dir):
    return warc.round_trip(read_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_periodic_runs(spark, sf_dir):
    return periodic_runs.run_digests(periodic_runs.runs(periodic_runs.planted(_docs(spark, sf_dir))))


def op12_fill_in_middle(spark, sf_dir):
    rows = fill_in_middle.restore(fill_in_middle.transform(_docs(spark, sf_dir).select("doc_id", "text")))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha("output").alias("output_sha256"),
                       sha("restored").alias("restored_sha256"))


def op13_near_dedup(spark, sf_dir):
    return superminhash.near_duplicates(_docs(spark, sf_dir), words=4, percent=80)


QUERIES = {f.__name__: f for f in (
    op1_language_id, op2_decontaminate, op3_quality, op4_toxicity, op5_secret_scan, op6_jaccard_join, op7_quality_rules,
    op8_bwt_dedup, op9_curriculum, op10_warc, op11_periodic_runs, op12_fill_in_middle,
    op13_near_dedup)}

_W = r"[^\x20\x09-\x0D]+"


def _finds(rule: secrets.Rule) -> str:
    """(doc_id, kind, start, end) of one rule: the gaps between matches and
    the matches, added up."""
    keep = (f"length(regexp_extract(m, '{rule.value.replace(chr(39), chr(39) * 2)}', 1)) >= {rule.min_chars}"
            if rule.min_chars else "true")
    p = rule.pattern.replace("'", "''")
    return f"""SELECT doc_id, '{rule.kind}' AS kind, e - length(m) AS start, e AS "end" FROM (
      SELECT doc_id, m, sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
        SELECT doc_id, unnest(found) AS m, unnest(gaps[:len(found)]) AS gap, generate_subscripts(found, 1) AS i FROM (
          SELECT doc_id, regexp_extract_all(t, '{p}') AS found, string_split_regex(t, '{p}') AS gaps FROM d)))
    WHERE {keep}"""


def _op5_sql() -> str:
    kinds = [r.kind for r in secrets.RULES]
    base = [r.kind for r in secrets.RULES if r.base]
    order = f"list_position({kinds!r}, kind)".replace("[", "[").replace('"', "'")
    span = "kind || ':' || start || ':' || \"end\""
    only = ", ".join(f"'{k}'" for k in base)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    f AS ({' UNION ALL '.join(_finds(r) for r in secrets.RULES)}),
    g AS (SELECT doc_id, {', '.join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in base)},
      string_agg({span}, ',' ORDER BY start, {order}) FILTER (kind IN ({only})) AS b,
      string_agg({span}, ',' ORDER BY start, {order}) AS s FROM f GROUP BY doc_id)
    SELECT d.doc_id, {', '.join(f'coalesce(n_{k}, 0) AS n_{k}' for k in base)},
      sha256(coalesce(b, '')) AS base_sha256, coalesce(s, '') AS spans FROM d LEFT JOIN g USING (doc_id)"""


def _op7_sql() -> str:
    n = lambda c, p: f"len(regexp_extract_all({c}, '{p}'))"
    r = line_rules
    passes = f"""({n('l', _W)} = 0 OR NOT (
        {n('l', r.SYMBOL)} * 10 > length(l) OR {n('l', r.SHOUT)} * 2 > {n('l', _W)}
        OR {n('l', r.SEPARATORS)} >= 3 OR regexp_matches(l, '{r.NAVIGATION}') OR regexp_matches(l, '{r.BOILERPLATE}')
        OR ({n('l', _W)} >= {r.LINE_WORDS} AND NOT regexp_matches(l, '{r.PUNCTUATION}'))))"""
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS l FROM d),
    ls AS (SELECT doc_id, sum(length(l)) AS chars, coalesce(sum(length(l)) FILTER ({passes}), 0) AS good,
        count(*) FILTER (regexp_matches(l, '{_W}')) - count(DISTINCT l) FILTER (regexp_matches(l, '{_W}')) AS n_dup_lines
      FROM l GROUP BY doc_id),
    w AS (SELECT doc_id, w, i, lead(w) OVER p AS w2, lead(w, 2) OVER p AS w3 FROM (
        SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM (
          SELECT doc_id, regexp_extract_all(t, '{_W}') AS ws FROM d)) WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
    r AS (SELECT doc_id, i, w3 IS NOT NULL AND count(*) OVER (PARTITION BY doc_id, w, w2, w3) > 1 AS again, w FROM w),
    c AS (SELECT doc_id, w, again OR coalesce(lag(again) OVER p, false) OR coalesce(lag(again, 2) OVER p, false) AS hit
      FROM r WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
    ws AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars, count(*) FILTER (hit) AS n_repeat_words
      FROM c GROUP BY doc_id),
    a AS (SELECT d.doc_id, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
        {n('t', r.SYMBOL)} AS n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, chars, good
      FROM d LEFT JOIN ws USING (doc_id) LEFT JOIN ls USING (doc_id))
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
      n_words < {r.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed,
      NOT (n_words < {r.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words) AND NOT good < {1 - r.MAX_LOST} * chars AS kept
    FROM a"""


def _op9_sql() -> str:
    slope = " ".join(f"WHEN {w} THEN {s}" for w, s in curriculum.SLOPES.items())
    cap = f"CAST(ss * {curriculum.MAX_EPOCHS} AS DOUBLE)"
    return f"""WITH s AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{_W}')), 0) AS size FROM documents),
    p AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
      FROM s GROUP BY source),
    q AS (SELECT *, row_number() OVER o AS rk, (sum(ss) OVER () - coalesce(sum({cap}) OVER (o ROWS BETWEEN UNBOUNDED
        PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lv
      FROM p WINDOW o AS (ORDER BY {cap} / w, source NULLS FIRST)),
    z AS (SELECT min(rk) AS rk FROM q WHERE lv * w <= {cap}),
    t AS (SELECT source, ss, w, CASE WHEN q.rk < z.rk THEN {cap}
        ELSE least((SELECT lv FROM q, z WHERE q.rk = z.rk) * w, {cap}) END AS target FROM q, z),
    r AS (SELECT s.doc_id, size, ss, w, target, CAST(round(target) AS BIGINT) AS want,
        CASE WHEN ss > 0 THEN CAST(round(target) AS BIGINT) // ss ELSE 0 END AS ep,
        coalesce(sum(size) OVER (PARTITION BY s.source ORDER BY md5(CAST(s.doc_id AS VARCHAR)), s.doc_id, size
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b
      FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source),
    u AS (SELECT *, CAST(ep * size + least(greatest(want - ep * ss - b, 0), size) AS BIGINT) AS taken,
        CASE w {slope} END AS k FROM r)
    SELECT doc_id, size, ss AS source_size, round(target, 6) AS target, taken, round(CASE WHEN taken > 0 THEN least(1.0,
        2 * (b / target) / ((1 - k) + sqrt((1 - k) * (1 - k) + 4 * k * (b / target)))) END, 9) AS position FROM u"""


_OP10_SQL = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
  q AS (SELECT page_id, octet_length(encode(h)) AS n, sha256(h) AS d FROM p),
  r AS (SELECT *, min(page_id) OVER (PARTITION BY d) AS m FROM q)
  SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, d AS payload_digest,
    CASE WHEN n >= {warc.MIN_REVISIT_BYTES} AND page_id > m THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN n >= {warc.MIN_REVISIT_BYTES} AND page_id > m THEN m END AS refers_to FROM r"""



def _op12_sql() -> str:
    m = fill_in_middle
    p, s, mid = (f"'{x}'" for x in (m.PREFIX, m.SUFFIX, m.MIDDLE))
    h = [f"CAST('0x' || substr(g, {1 + 8 * k}, 8) AS BIGINT)" for k in range(4)]
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{m.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS g
      FROM documents),
    e AS (SELECT doc_id, t, CAST(length(t) AS BIGINT) AS n, {h[0]} % (length(t) + 1) AS x, {h[1]} % (length(t) + 1) AS y,
      CASE WHEN t = '' OR contains(t, {p}) OR contains(t, {s}) OR contains(t, {mid}) OR {h[2]} % 100 >= {m.FIM_PERCENT} THEN 'plain'
        WHEN {h[3]} % 100 < {m.SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM d),
    c AS (SELECT doc_id, t, n, form, least(x, y) AS a, greatest(x, y) - least(x, y) AS b, substr(t, 1, least(x, y)) AS tp,
      substr(t, least(x, y) + 1, greatest(x, y) - least(x, y)) AS tm, substr(t, greatest(x, y) + 1) AS ts FROM e)
    SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b END AS middle_chars,
      sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN {p} || tp || {s} || ts || {mid} || tm
        ELSE {s} || ts || {p} || tp || {mid} || tm END) AS output_sha256, sha256(t) AS restored_sha256 FROM c"""


ORACLE = {"op5_secret_scan": _op5_sql(), "op7_quality_rules": _op7_sql(), "op9_curriculum": _op9_sql(), "op10_warc": _OP10_SQL,
          "op12_fill_in_middle": _op12_sql()}
