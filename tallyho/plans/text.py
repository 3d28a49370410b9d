"""Registered text queries (capability A) and their DuckDB oracles.

The oracles are written independently of the Spark operators: they split
each text into lines, lines into sentences / words with plain list
functions, and strip with list positions, instead of the run-counting and
span regexes the operators use.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import text as ops
from ..sources import tables
from .common import rounded, sql_round

TOP_K = 20


def _docs(spark: SparkSession, sf_dir: str):
    return tables.documents(spark, sf_dir)


def q_sentence_count(spark, sf_dir):
    return ops.sentence_count(_docs(spark, sf_dir), "text", by=["doc_id"])


def q_sentence_count_crlf(spark, sf_dir):
    """Line ends of another system: the counts must not change."""
    docs = _docs(spark, sf_dir).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\r\n")))
    return ops.sentence_count(docs, "text", by=["doc_id"])


def q_word_count(spark, sf_dir):
    return ops.word_count(_docs(spark, sf_dir), "text", by=["doc_id"])


def q_word_counts(spark, sf_dir):
    return ops.word_counts(_docs(spark, sf_dir), "text")


def q_word_counts_line(spark, sf_dir):
    return ops.word_counts(_docs(spark, sf_dir), "text", strip="line")


def q_top_words(spark, sf_dir):
    return ops.top_words(ops.word_counts(_docs(spark, sf_dir), "text"), TOP_K)


def q_top_words_by_lang(spark, sf_dir):
    counts = ops.word_counts(_docs(spark, sf_dir), "text", by=["lang"])
    return ops.top_words(counts, TOP_K, by=["lang"])


def q_difficult_words(spark, sf_dir):
    counts = ops.word_counts(_docs(spark, sf_dir), "text")
    return ops.difficult_words(counts, tables.easy_words(spark, sf_dir))


def q_difficult_word_count(spark, sf_dir):
    counts = ops.word_counts(_docs(spark, sf_dir), "text")
    return ops.difficult_word_count(counts, tables.easy_words(spark, sf_dir))


def q_dale_chall(spark, sf_dir):
    return rounded(ops.dale_chall(_docs(spark, sf_dir), tables.easy_words(spark, sf_dir)))


def q_difficult_word_tokens(spark, sf_dir):
    counts = ops.word_counts(_docs(spark, sf_dir), "text", by=["lang"])
    return ops.difficult_word_count(counts, tables.easy_words(spark, sf_dir), by=["lang"], count="tokens")


def q_dale_chall_adjusted(spark, sf_dir):
    return rounded(ops.dale_chall(_docs(spark, sf_dir), tables.easy_words(spark, sf_dir), by=["source"],
                                  count="tokens", adjusted=True))


def q_dale_chall_by_lang(spark, sf_dir):
    return rounded(ops.dale_chall(_docs(spark, sf_dir), tables.easy_words(spark, sf_dir),
                                  by=["lang"]))


QUERIES = {
    "sentence_count": q_sentence_count,
    "sentence_count_crlf": q_sentence_count_crlf,
    "word_count": q_word_count,
    "word_counts": q_word_counts,
    "word_counts_line": q_word_counts_line,
    "top_words": q_top_words,
    "top_words_by_lang": q_top_words_by_lang,
    "difficult_words": q_difficult_words,
    "difficult_word_count": q_difficult_word_count,
    "dale_chall": q_dale_chall,
    "dale_chall_by_lang": q_dale_chall_by_lang,
    "difficult_word_tokens": q_difficult_word_tokens,
    "dale_chall_adjusted": q_dale_chall_adjusted,
}


# ---------------------------------------------------------------- oracles --

def _lines(table: str, keys: str) -> str:
    sep = ", " if keys else ""
    return f"(SELECT {keys}{sep}unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM {table})"


def _words_token(table: str, keys: str = "") -> str:
    """keys + word (normalised, possibly empty), one row per space token."""
    sep = ", " if keys else ""
    toks = f"(SELECT {keys}{sep}unnest(string_split(lower(line), ' ')) AS tok FROM {_lines(table, keys)})"
    return (f"(SELECT {keys}{sep}regexp_replace(tok, '^\\P{{L}}+|\\P{{L}}+$', '', 'g') AS word "
            f"FROM {toks})")


def _words_line(table: str, keys: str = "") -> str:
    sep = ", " if keys else ""
    split = f"(SELECT {keys}{sep}string_split(lower(line), ' ') AS t FROM {_lines(table, keys)})"
    flags = (f"(SELECT {keys}{sep}t, list_transform(t, lambda x: regexp_full_match(x, '\\p{{L}}+')) AS a "
             f"FROM {split})")
    kept = ("CASE WHEN list_position(a, true) IS NULL "
            "THEN (CASE WHEN len(t) = 1 THEN t ELSE []::VARCHAR[] END) "
            "ELSE t[list_position(a, true) : len(t) - list_position(list_reverse(a), true) + 1] END")
    return f"(SELECT {keys}{sep}unnest({kept}) AS word FROM {flags})"


def _easy() -> str:
    return f"(SELECT DISTINCT word FROM {_words_token('benchmark')} WHERE length(word) > 0)"


def _counts(words_sql: str, keys: str = "") -> str:
    sep = ", " if keys else ""
    return (f"(SELECT {keys}{sep}word, count(*) AS n FROM {words_sql} "
            f"WHERE length(word) > 0 GROUP BY {keys}{sep}word)")


def _dale_chall_sql(keys: str | None, value: str = "count(*)", adjusted: bool = False) -> str:
    kk = keys or "g"
    src = f"(SELECT {keys or '1 AS g'}, text FROM documents)"
    words = _counts(_words_token(src, kk), kk)
    difficult = (f"SELECT {kk}, {value} AS n_difficult FROM {words} w "
                 f"WHERE NOT EXISTS (SELECT 1 FROM {_easy()} e WHERE e.word = w.word) GROUP BY {kk}")
    totals = (
        f"SELECT {kk}, "
        "CAST(sum(len(list_filter(string_split(line, '.'), lambda x: length(x) > 0))) AS BIGINT) AS n_sentences, "
        "CAST(sum(len(list_filter(string_split(line, ' '), lambda x: length(x) > 0))) AS BIGINT) AS n_words "
        f"FROM {_lines(src, kk)} GROUP BY {kk}")
    select_keys = f"t.{keys}, " if keys else ""
    wps = "CAST(t.n_words AS DOUBLE) / nullif(t.n_sentences, 0)"
    pct = "CAST(coalesce(d.n_difficult, 0) AS DOUBLE) / nullif(t.n_words, 0) * 100.0"
    extra = f" + CASE WHEN {pct} > 5.0 THEN 3.6365 ELSE 0.0 END" if adjusted else ""
    return (
        f"WITH t AS ({totals}), d AS ({difficult}) "
        f"SELECT {select_keys}t.n_sentences, t.n_words, "
        "CAST(coalesce(d.n_difficult, 0) AS BIGINT) AS n_difficult, "
        f"{sql_round(wps, 'words_per_sentence')}, {sql_round(pct, 'pct_difficult')}, "
        f"{sql_round(f'0.1579 * ({pct}) + 0.0496 * ({wps}){extra}', 'score')} "
        f"FROM t LEFT JOIN d ON t.{kk} = d.{kk}")


ORACLE = {
    "sentence_count": (
        "SELECT doc_id, CAST(sum(len(list_filter(string_split(line, '.'), lambda x: length(x) > 0))) AS BIGINT) "
        f"AS n_sentences FROM {_lines('documents', 'doc_id')} GROUP BY doc_id"),
    "word_count": (
        "SELECT doc_id, CAST(sum(len(list_filter(string_split(line, ' '), lambda x: length(x) > 0))) AS BIGINT) "
        f"AS n_words FROM {_lines('documents', 'doc_id')} GROUP BY doc_id"),
    "word_counts": f"SELECT word, n FROM {_counts(_words_token('documents'))}",
    "word_counts_line": f"SELECT word, n FROM {_counts(_words_line('documents'))}",
    "top_words": f"SELECT word, n FROM {_counts(_words_token('documents'))} ORDER BY n DESC, word LIMIT {TOP_K}",
    "top_words_by_lang": (
        "SELECT lang, word, n, CAST(rank AS INTEGER) AS rank FROM ("
        "SELECT lang, word, n, row_number() OVER (PARTITION BY lang ORDER BY n DESC, word) AS rank "
        f"FROM {_counts(_words_token('(SELECT lang, text FROM documents)', 'lang'), 'lang')}) "
        f"WHERE rank <= {TOP_K}"),
    "difficult_words": (
        f"SELECT word, n FROM {_counts(_words_token('documents'))} w "
        f"WHERE NOT EXISTS (SELECT 1 FROM {_easy()} e WHERE e.word = w.word)"),
    "difficult_word_count": (
        f"SELECT count(*) AS n_difficult FROM {_counts(_words_token('documents'))} w "
        f"WHERE NOT EXISTS (SELECT 1 FROM {_easy()} e WHERE e.word = w.word)"),
    "dale_chall": _dale_chall_sql(None),
    "dale_chall_by_lang": _dale_chall_sql("lang"),
    "difficult_word_tokens": (
        "SELECT lang, CAST(sum(n) AS BIGINT) AS n_difficult FROM "
        f"{_counts(_words_token('(SELECT lang, text FROM documents)', 'lang'), 'lang')} w "
        f"WHERE NOT EXISTS (SELECT 1 FROM {_easy()} e WHERE e.word = w.word) GROUP BY lang"),
    "dale_chall_adjusted": _dale_chall_sql("source", "sum(n)", True),
}

ORACLE["sentence_count_crlf"] = ORACLE["sentence_count"]
