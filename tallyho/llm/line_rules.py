"""Quality rules, line first: lines are judged one by one, failing lines are
removed, and a document that loses too much of its text is rejected.

Line rules (a line without a word always passes):

* ``symbols``     – more than a tenth of the line's characters are symbols, or
  runs of ``!!``/``??`` stand after most words;
* ``navigation``  – three or more menu separators, or the line is nothing but
  a menu label;
* ``boilerplate`` – licence, copyright and cookie notices;
* ``punctuation`` – twelve or more words without any sentence punctuation.

Base counts on the whole text: n_words, word_chars, n_symbols, n_dup_lines,
n_repeat_words (words inside 3-word windows that occur twice or more).
A document fails the base rules with fewer than 50 words or with more than
half of its words in repeated windows; it is kept if it passes them and at
least half of the characters of its lines survive the line rules.

Everything is a DataFrame expression on the document's own row: no shuffle and
no Python.  Windows are compared by 64-bit hashes, and a document's windows
are only sorted when their distinct count shows a repetition.

Edge cases: null text counts as empty (no words, base failed, cleaned text
empty); other columns pass through; a column that clashes with a result is
replaced; repeated rows are judged one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyho.llm.common import WORD, apart

MIN_WORDS = 50
MAX_LOST = 0.5
SYMBOL = r"[#*$%&|<>]"
# Patterns of the line rules (RE2 and Java read them alike).
NAVIGATION = r"(?i)^\s*(home|menu|login|log in|sign in|sign up|register|search|contact|about us|next|previous|back to top|skip to content|share this|read more)\s*$"
SEPARATORS = r"\s[|»›·]\s"
BOILERPLATE = (r"(?i)(all rights reserved|licensed under|released under the|terms of (use|service)|privacy policy"
               r"|accept (all )?cookies|we use cookies|copyright ©|©\s*[0-9]{4}|javascript is (disabled|required))")
SHOUT = r"[!?]{2,}"
PUNCTUATION = r"[.!?,;:。！？、،؟।]"
LINE_WORDS = 12


def _n(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern))


def line_passes(line: Column) -> Column:
    words = _n(line, WORD)
    bad_symbols = (_n(line, SYMBOL) * 10 > F.length(line)) | (_n(line, SHOUT) * 2 > words)
    navigation = (_n(line, SEPARATORS) >= 3) | line.rlike(NAVIGATION)
    unpunctuated = (words >= LINE_WORDS) & ~line.rlike(PUNCTUATION)
    return (words == 0) | ~(bad_symbols | navigation | line.rlike(BOILERPLATE) | unpunctuated)


def with_counts(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    rows = docs.withColumn("_text", F.coalesce(F.col("text"), F.lit("")))
    rows = rows.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    rows = rows.withColumn("_lines", lines)
    n = F.size("_words")
    grams = F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1), F.get("_words", i + 2)))
    rows = rows.withColumn("_grams", F.when(n >= 3, F.slice(grams, F.lit(1), n - 2)))
    placed = F.transform("_grams", lambda g, i: F.struct(g.alias("g"), i.alias("i")))
    rows = rows.withColumn("_sorted", F.when(F.size(F.array_distinct("_grams")) < n - 2, F.sort_array(placed)))
    again = F.filter("_sorted", lambda e, j: (e["g"] == F.get("_sorted", j - 1)["g"])
                     | (e["g"] == F.get("_sorted", j + 1)["g"]))
    covered = F.array_distinct(F.flatten(F.transform(
        again, lambda e: F.array(e["i"], e["i"] + 1, e["i"] + 2))))
    rows = (rows.withColumn("n_words", n.cast("long"))
            .withColumn("word_chars", F.aggregate("_words", F.lit(0).cast("long"), lambda a, w: a + F.length(w)))
            .withColumn("n_symbols", _n(F.col("_text"), SYMBOL).cast("long"))
            .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
            .withColumn("n_repeat_words", F.when(F.col("_sorted").isNull(), F.lit(0)).otherwise(F.size(covered)).cast("long")))
    return rows.drop("_words", "_lines", "_grams", "_sorted")


def judge(docs: DataFrame, min_words: int = MIN_WORDS, max_lost: float = MAX_LOST) -> DataFrame:
    """``docs`` with the base counts, ``clean_text`` (surviving lines),
    ``base_failed`` and ``kept``."""
    rows = with_counts(docs)
    rows = rows.withColumn("clean_text", F.array_join(F.filter(F.split("_text", "\n", -1), line_passes), "\n"))
    chars = lambda c: F.length(F.regexp_replace(c, "\n", ""))
    base_failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost = chars(F.col("clean_text")) < (1 - max_lost) * chars(F.col("_text"))
    return (rows.withColumn("base_failed", base_failed)
            .withColumn("kept", ~F.col("base_failed") & ~lost).drop("_text"))


def clean(docs: DataFrame) -> DataFrame:
    """The kept documents with their cleaned text, in the columns of ``docs``."""
    rows, back = apart(docs)
    return back(judge(rows).where("kept").withColumn("text", F.col("clean_text")))
