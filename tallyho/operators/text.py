"""Text statistics and readability (sentence / word counts, word frequencies,
top words, difficult words, Dale-Chall).

Every operator takes a DataFrame with a text column (a line or a whole
document) plus optional grouping columns ``by`` and returns a DataFrame.

Plan shape at scale: one parquet scan, a ``Generate`` (explode of the token
array) fused with the projection in whole-stage codegen, then a partial
hash aggregate before the single shuffle on ``(by..., word)``.  A hot word
(``the``) therefore reaches the final aggregate as one row per map task, not
as a third of the data.  Word lists are joined with a size-checked broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import DEFAULT_BROADCAST_ROWS, bounded_broadcast

# The Dale-Chall readability formula.
DALE_CHALL_PCT_WEIGHT = 0.1579
DALE_CHALL_LENGTH_WEIGHT = 0.0496
DALE_CHALL_ADJUSTMENT = 3.6365
DALE_CHALL_ADJUST_ABOVE_PCT = 5.0


def sentence_count(df: DataFrame, text_col: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """``by..., n_sentences``: sentences per group (one global row when ``by`` is empty)."""
    return df.groupBy(*by).agg(F.sum(T.sentence_total(text_col)).alias("n_sentences"))


def word_count(df: DataFrame, text_col: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """``by..., n_words``: raw (un-normalised) words per group."""
    return df.groupBy(*by).agg(F.sum(T.word_total(text_col)).alias("n_words"))


def _exploded_words(df: DataFrame, text_col: str, by: Sequence[str], strip: str,
                    with_totals: bool = False) -> DataFrame:
    """Rows ``by..., word`` (normalised, may be empty), one per token.

    With ``with_totals`` the first token row of every input row also carries
    that row's sentence and raw-word totals (``_s``, ``_t``; 0 elsewhere), so
    a single aggregate over the exploded rows yields the word frequencies and
    the text totals from one scan.
    """
    by = list(by)
    base = [*by, T.token_array(text_col, strip).alias("_toks")]
    if with_totals:
        base += [T.sentence_total(text_col).alias("_s0"), T.word_total(text_col).alias("_t0")]
    rows = df.select(*base)
    keep = by + (["_s0", "_t0"] if with_totals else [])
    # Outer generator: a text without words still yields one row (word NULL)
    # that carries its totals, and Catalyst infers no ``size(tokens) > 0``
    # filter, which would evaluate the tokenising regex a second time.
    rows = rows.select(*keep, F.posexplode_outer("_toks").alias("_pos", "_tok"))
    out = [*by, F.col("_tok").alias("word")]
    if with_totals:
        first = F.coalesce(F.col("_pos"), F.lit(0)) == 0
        out += [F.when(first, F.col("_s0")).otherwise(F.lit(0)).alias("_s"),
                F.when(first, F.col("_t0")).otherwise(F.lit(0)).alias("_t")]
    return rows.select(*out)


def word_counts(df: DataFrame, text_col: str = "text", by: Sequence[str] = (),
                strip: str = "token") -> DataFrame:
    """``by..., word, n``: occurrences of every normalised word.

    Empty words (line mode) are removed *after* the aggregate, so the
    tokenising expressions are not re-evaluated by a pushed-down filter.
    """
    words = _exploded_words(df, text_col, by, strip)
    counts = words.groupBy(*by, "word").agg(F.count(F.lit(1)).alias("n"))
    return counts.filter(F.length("word") > 0)


def top_words(counts: DataFrame, k: int = 20, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` most frequent words (per group), ties broken by the word.

    Global: ``TakeOrderedAndProject`` (each task keeps its own top k).  Per
    group: ``row_number`` over a window, which Spark plans with a partial
    group limit before the shuffle.
    """
    by = list(by)
    if not by:
        return counts.orderBy(F.desc("n"), F.asc("word")).limit(k)
    w = Window.partitionBy(*by).orderBy(F.desc("n"), F.asc("word"))
    ranked = counts.withColumn("rank", F.row_number().over(w))
    return ranked.filter(F.col("rank") <= k)


def easy_word_set(words: DataFrame, word_col: str = "word",
                  max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Distinct easy words as a join side, broadcast only when provably small.
    Building it runs a job: the distinct words are written and measured."""
    easy = words.select(F.col(word_col).alias("word")).distinct()
    return bounded_broadcast(easy, max_broadcast_rows, materialize=True)


def difficult_words(counts: DataFrame, easy: DataFrame,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Rows of ``counts`` whose word is not in the easy list (anti-join)."""
    side = easy_word_set(easy, max_broadcast_rows=max_broadcast_rows)
    return counts.join(side, "word", "left_anti")


def difficult_word_count(counts: DataFrame, easy: DataFrame, by: Sequence[str] = (),
                         count: str = "types",
                         max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """``by..., n_difficult``: distinct difficult words (``types``) or their
    occurrences (``tokens``)."""
    diff = difficult_words(counts, easy, max_broadcast_rows)
    if count == "types":
        value = F.count(F.lit(1))
    elif count == "tokens":
        value = F.sum("n")
    else:
        raise ValueError("count must be 'types' or 'tokens'")
    return diff.groupBy(*by).agg(value.cast("long").alias("n_difficult"))


def dale_chall(df: DataFrame, easy: DataFrame, text_col: str = "text",
               by: Sequence[str] = (), count: str = "types", adjusted: bool = False,
               strip: str = "token",
               max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Dale-Chall raw score per group from a single scan of the text.

    ``score = 0.1579 * 100 * difficult / words + 0.0496 * words / sentences``
    (+3.6365 when ``adjusted`` and more than 5 % of the words are difficult).

    Output: ``by..., n_sentences, n_words, n_difficult, words_per_sentence,
    pct_difficult, score``.  Ratios are NULL when a denominator is 0.
    """
    by = list(by)
    rows = _exploded_words(df, text_col, by, strip, with_totals=True)
    per_word = rows.groupBy(*by, "word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_s").alias("_s"), F.sum("_t").alias("_t"))
    flagged = per_word.join(
        easy_word_set(easy, max_broadcast_rows=max_broadcast_rows)
        .withColumn("_easy", F.lit(True)), "word", "left")
    hard = (F.length("word") > 0) & F.col("_easy").isNull()
    hard_value = F.when(hard, F.lit(1) if count == "types" else F.col("n")).otherwise(0)
    if count not in ("types", "tokens"):
        raise ValueError("count must be 'types' or 'tokens'")
    totals = flagged.groupBy(*by).agg(
        F.sum("_s").cast("long").alias("n_sentences"),
        F.sum("_t").cast("long").alias("n_words"),
        F.sum(hard_value).cast("long").alias("n_difficult"))
    return _score(totals, by, adjusted)


def _score(totals: DataFrame, by: Sequence[str], adjusted: bool) -> DataFrame:
    wps = F.try_divide(F.col("n_words").cast("double"), F.col("n_sentences"))
    pct = F.try_divide(F.col("n_difficult").cast("double"), F.col("n_words")) * 100.0
    score = F.lit(DALE_CHALL_PCT_WEIGHT) * pct + F.lit(DALE_CHALL_LENGTH_WEIGHT) * wps
    if adjusted:
        score = score + F.when(pct > DALE_CHALL_ADJUST_ABOVE_PCT,
                               F.lit(DALE_CHALL_ADJUSTMENT)).otherwise(0.0)
    return totals.select(*by, "n_sentences", "n_words", "n_difficult",
                         wps.alias("words_per_sentence"), pct.alias("pct_difficult"),
                         score.alias("score"))

