"""Mixing sources to target weights: a time-varying curriculum.

Training time runs from 0 to 1.  Source s has the weight schedule
``w_s * (1 + slope_s * (2 t - 1))``; its integral over the run is ``w_s``, so
the slopes move a source's tokens within the run and the integrals fix how
many there are.  Integrated weights share all tokens; a source's target stops
at ``max_epochs`` times its size and the excess is shared again by weight.
Within a source the documents stand in a fixed hash order; the cumulative
token demand ``target * (t + slope * (t^2 - t))`` is inverted at each
document's place in that order, which is its training position, and documents
are range-sorted by position.

Prefix sums never need a whole source in one task: documents stand in the
order of their id's MD5, whose first digits cut a source into buckets of at
most about ``BUCKET_ROWS`` documents; bucket sums are added up first, and a
window runs inside each bucket only.

Edge cases: null text and empty text have size 0; null source is a source of
its own, last in order; sources of size 0 have target 0; rows with equal
doc_id are separate rows (equal rows may swap places, with the same result);
an empty table gives no rows; columns whose names clash with the results are
replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyho.llm.common import WORD, apart, key_of, written
from tallyho.session import bounded_broadcast

BUCKET_ROWS = 5_000
MAX_EPOCHS = 3
# Slope of the schedule by weight: light sources early, heavy ones late.
SLOPES = {1: -0.5, 2: 0.0, 3: 0.5}
# Sources whose statistics may be broadcast (about 100 bytes a row).
BROADCAST_SOURCES = 100_000


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weight(rank: Column) -> Column:
    """1, 2, 3, 1, ... for ranks 0, 1, 2, 3, ..."""
    return (F.pmod(rank, F.lit(3)) + 1).cast("int")


def source_targets(sized: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(skey, source_size, n_docs, weight, target) per source.

    Water filling in closed form.  With sources ordered by cap / weight, the
    level is (total - caps before) / (weights from here on) at the first
    source it doesn't overfill; all sources before that one are at their cap.
    The windows run over one row per source.
    """
    per = sized.groupBy("skey").agg(F.min("source").alias("source"), F.sum("size").alias("source_size"),
                                    F.count(F.lit(1)).alias("n_docs"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    per = per.withColumn("weight", cyclic_weight(F.row_number().over(by_name) - 1))
    cap = (F.col("source_size") * max_epochs).cast("double")
    fill = Window.orderBy((cap / F.col("weight")).asc(), F.col("skey").asc())
    everything = fill.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = fill.rowsBetween(Window.unboundedPreceding, -1)
    rest = fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(everything) - F.coalesce(F.sum(cap).over(before), F.lit(0.0)))
             / F.sum("weight").over(rest))
    per = (per.withColumn("_rank", F.row_number().over(fill))
           .withColumn("_level", level)
           .withColumn("_fits", F.when(F.col("_level") * F.col("weight") <= cap, F.col("_rank"))))
    first = Window.partitionBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = per.withColumn("_first", F.min("_fits").over(first))
    per = per.withColumn("_final", F.min(F.when(F.col("_rank") == F.col("_first"), F.col("_level"))).over(first))
    target = F.when(F.col("_rank") < F.col("_first"), cap).otherwise(F.col("_final") * F.col("weight"))
    return per.select("skey", "source_size", "n_docs", "weight",
                      F.coalesce(F.least(target, cap), cap).alias("target"))


def invert_demand(fraction: Column, slope: Column) -> Column:
    """The time t with t + slope * (t^2 - t) = fraction, for |slope| < 1."""
    b = 1 - slope
    return F.least(F.lit(1.0), 2 * fraction / (b + F.sqrt(b * b + 4 * slope * fraction)))


def cut_buckets(rows: DataFrame, bucket_rows: int) -> DataFrame:
    """``rows`` (doc_id, size, skey, n_docs, _tie, ...) with ``_h``, and with
    ``_bucket`` and ``_sub``, whose order within a source agrees with that of
    ``_h``, size.  ``_sub`` is empty but for buckets of several times
    ``bucket_rows``; there it cuts by ``_h``, size and as many digits of the
    tie as leave about ``bucket_rows`` rows."""
    digits = lambda n: F.greatest(F.lit(0), F.ceil(F.log(16.0, n / bucket_rows))).cast("int")
    rows = (rows.withColumn("_h", F.coalesce(F.md5(F.col("doc_id").cast("string").cast("binary")), F.lit("~")))
            .withColumn("_bucket", F.substr(F.col("_h"), F.lit(1), digits(F.col("n_docs")))))
    full = rows.groupBy("skey", "_bucket").count().where(F.col("count") > 4 * bucket_rows)
    full = written(full.select("skey", "_bucket", F.lit(True).alias("_full")), "mix-full")
    if full.isEmpty():
        return rows.withColumn("_sub", F.lit(""))
    rows = rows.join(bounded_broadcast(full, BROADCAST_SOURCES), ["skey", "_bucket"], "left")
    alike = rows.where("_full").groupBy("skey", "_h", "size").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > bucket_rows)
    alike = written(alike.select("skey", "_h", "size", digits(F.col("_n")).alias("_digits")), "mix-alike")
    rows = rows.join(bounded_broadcast(alike, BROADCAST_SOURCES), ["skey", "_h", "size"], "left")
    sub = F.concat("_h", F.lit(":"), F.lpad(F.col("size").cast("string"), 19, "0"), F.lit(":"),
                   F.substr(F.col("_tie"), F.lit(1), F.coalesce("_digits", F.lit(0))))
    return rows.withColumn("_sub", F.when(F.col("_full"), sub).otherwise(F.lit(""))).drop("_full", "_digits")


def assign(docs: DataFrame, max_epochs: int = MAX_EPOCHS, bucket_rows: int = BUCKET_ROWS,
           carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken and
    ``position`` (of its first copy; null if nothing of it is taken)."""
    sized = written(docs.select("doc_id", "source", *carry, word_count(F.col("text")).alias("size"))
                    .withColumn("skey", key_of(F.col("source"))).withColumn("_tie", F.substring(F.md5(
                        F.monotonically_increasing_id().cast("string").cast("binary")), 1, 12)), "mix-sizes")
    targets = written(source_targets(sized, max_epochs), "mix-targets")
    rows = cut_buckets(sized.drop("source").join(bounded_broadcast(targets, BROADCAST_SOURCES), "skey"), bucket_rows)
    sums = written(rows.groupBy("skey", "_bucket", "_sub").agg(F.sum("size").alias("_sub_size")), "mix-buckets")
    before_it = lambda *by: Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    buckets = sums.groupBy("skey", "_bucket").agg(F.sum("_sub_size").alias("_bucket_size")).select(
        "skey", "_bucket", F.coalesce(F.sum("_bucket_size").over(before_it("skey", "_bucket")), F.lit(0)).alias("_offset"))
    inner = sums.select("skey", "_bucket", "_sub", F.coalesce(
        F.sum("_sub_size").over(before_it("skey", "_bucket", "_sub")), F.lit(0)).alias("_inner"))
    offsets = inner.join(buckets, ["skey", "_bucket"]).select(
        "skey", "_bucket", "_sub", (F.col("_offset") + F.col("_inner")).alias("_offset"))
    inside = Window.partitionBy("skey", "_bucket", "_sub").orderBy("_h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    rows = rows.join(offsets, ["skey", "_bucket", "_sub"])
    before = F.col("_offset") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    want = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(want / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    rows = rows.withColumn("_before", before).withColumn("_epochs", epochs).withColumn("_want", want)
    part = F.least(F.greatest(F.col("_want") - F.col("_epochs") * F.col("source_size") - F.col("_before"),
                              F.lit(0)), F.col("size"))
    rows = rows.withColumn("taken", (F.col("_epochs") * F.col("size") + part).cast("long"))
    slope = F.lit(0.0)
    for w, s in SLOPES.items():
        slope = F.when(F.col("weight") == w, F.lit(s)).otherwise(slope)
    at = F.when(F.col("taken") > 0, invert_demand(F.col("_before") / F.col("target"), slope))
    return rows.select("doc_id", *carry, "size", "source_size", "target", "taken", at.alias("position"))


def mix(docs: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The training order: every column of the taken documents with ``size``,
    ``taken`` and ``position``, range-sorted by position.  ``taken`` above
    ``size`` says how often the document is repeated.  Columns of ``docs`` under
    one of the five new names, in any case, are replaced."""
    extra = ["size", "source_size", "target", "taken", "position"]
    names = [c for c in docs.columns if c.lower() not in extra]
    rows, _ = apart(docs.select(*names))
    keep = rows.columns
    rows = rows.withColumn("_row", F.xxhash64(*keep))
    mixed = assign(rows, max_epochs, carry=("_row",)).where("position is not null")
    mixed = mixed.groupBy("doc_id", "_row").agg(
        *[F.min(c).alias(c) for c in ("size", "source_size", "target", "position")],
        F.sum("taken").alias("_all"), F.count(F.lit(1)).alias("_n"))
    mixed = mixed.withColumn("taken", F.expr("_all div _n")).drop("_all", "_n")
    joined = rows.withColumn("_id", F.coalesce(F.col("doc_id"), F.lit(-1))).join(
        mixed.withColumn("_id", F.coalesce(F.col("doc_id"), F.lit(-1))).drop("doc_id"), ["_id", "_row"])
    return joined.select(*keep, *extra).toDF(*names, *extra).orderBy("position", "doc_id")
