"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyho.session import bounded_broadcast, checkpoint_dir, read_table

# Runs of anything but ASCII white space: the word of sizes and shingles.
WORD = r"[^\x20\x09-\x0D]+"

__all__ = ["WORD", "apart", "bounded_sample", "chance", "crc_mod", "key_of", "read_table", "scratch", "split_buffers", "training_marks",
           "training_texts", "written"]


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder name below the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written once as a Parquet table in the shared folder and read
    back: later stages neither recompute it nor depend on any executor."""
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def crc_mod(doc_id: Column, m: int) -> Column:
    """crc32(doc_id as text) mod m; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(m))


def chance(key: Column) -> Column:
    """A hash as a number from 0 up to 1, in 63 bits."""
    return key.bitwiseAND(F.lit((1 << 63) - 1)).cast("double") / float(1 << 63)


def bounded_sample(rows: DataFrame, group: str, per_group: float, seed: int = 5) -> DataFrame:
    """(doc_id, text, group) of about ``per_group`` different rows of each value
    of ``group``, all of a smaller one, and never more than 1.3 times as many in
    all.  Rows are taken by a hash of what is in them against a share from the
    (estimated) number of different rows, so reruns agree, no group is gathered
    or sorted, and a row that is repeated counts once; only the hashes of the
    sample are ordered and broadcast."""
    key = F.xxhash64("doc_id", "text", group, F.lit(seed)).alias("_key")
    rows = rows.select("doc_id", "text", group)
    keys = written(rows.select(group, key), "sample-keys")
    counts = written(keys.groupBy(group).agg(F.approx_count_distinct("_key").alias("_n")), "sample-counts")
    draw = chance(F.col("_key"))
    some = keys.join(bounded_broadcast(counts), group).where(draw < F.lit(float(per_group)) / F.col("_n"))
    most = int(1.3 * per_group * counts.count()) + 100
    some = written(some.select("_key").distinct().orderBy(draw, "_key").limit(most), "sample-chosen")
    found = rows.withColumn("_key", key).join(F.broadcast(some), "_key")
    return found.dropDuplicates(["_key"]).select("doc_id", "text", group)


def apart(docs: DataFrame):
    """``docs`` under names that no operator uses (doc_id, text and source keep
    theirs), and a function that gives the columns of a result their own names
    back: whatever else a caller's columns are called, they come back untouched."""
    names = [c if c in ("doc_id", "text", "source") else f"_in_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), lambda rows: rows.select(*names).toDF(*docs.columns)


def training_marks(labels: DataFrame, label: str, folds: int = 5) -> DataFrame:
    """(doc_id, label 0/1) that may be learned from: rows whose crc32(doc_id)
    is not a multiple of ``folds``.  A doc_id that is labelled twice has the
    larger label."""
    rows = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (crc_mod(F.col("doc_id"), folds) != 0))
    return rows.groupBy("doc_id").agg((F.max(label) > 0).cast("int").alias("label"))


def training_texts(docs: DataFrame, marks: DataFrame, most: dict[int, int]) -> tuple[DataFrame, dict]:
    """(doc_id, text, label) of a bounded sample of the marked documents,
    ``most[label]`` each (about as many texts), written once; and all marks by label.
    Marks are drawn first, then, for ids with several texts, the texts.  Only
    the drawn marks, bounded by ``most``, are broadcast."""
    counts = {r["label"]: r["count"] for r in marks.where(F.col("label").isin(*most)).groupBy("label").count().collect()}
    texts, parts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), []
    draw = chance(F.xxhash64("doc_id", F.lit(5)))
    for value, n in most.items():
        # a few more than n by their hashes, of which the first n
        share = (n + 6 * n ** 0.5 + 10) / counts.get(value, 1)
        drawn = marks.where((F.col("label") == value) & (draw < share)).select("doc_id", "label")
        drawn = written(drawn.orderBy(draw, "doc_id").limit(n), "sample-marks")
        parts.append(bounded_sample(texts.join(F.broadcast(drawn), "doc_id"), "label", 1.3 * n))
    sample = parts[0]
    for p in parts[1:]:
        sample = sample.unionAll(p)
    return written(sample, "sample"), counts


def key_of(c: Column) -> Column:
    """A join key that is never null and keeps null apart from any value."""
    return F.when(c.isNull(), F.lit("n")).otherwise(F.concat(F.lit("v"), c.cast("string")))


def split_buffers(batch, column: str, limit: int = 4 << 20, rows: int = 1 << 20):
    """Slices of an Arrow batch of about ``limit`` bytes of text and ``rows``
    rows at most.

    Yields ``(slice, data, offsets, valid)``: ``data`` the slice's UTF-8 bytes
    as one uint8 array, ``offsets`` its row limits (int64, rows + 1, from 0),
    ``valid`` which rows are not null (null rows have no bytes).  One text that
    is longer than ``limit`` is a slice of its own.
    """
    import numpy as np
    import pyarrow as pa

    text = batch.column(batch.schema.get_field_index(column))
    n = len(text)
    if not n:
        return
    text = text.cast(pa.large_string())
    if text.null_count:
        valid = ~np.asarray(text.is_null())
        text = text.fill_null("")
    else:
        valid = np.ones(n, bool)
    _, offs, raw = text.buffers()
    offsets = np.frombuffer(offs, np.int64)[text.offset: text.offset + n + 1]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), lo + rows, n)
        yield (batch.slice(lo, hi - lo), data[offsets[lo]: offsets[hi]],
               offsets[lo: hi + 1] - offsets[lo], valid[lo:hi])
        lo = hi
