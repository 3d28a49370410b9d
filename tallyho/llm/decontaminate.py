"""Benchmark decontamination with training suffix arrays.

The training side is cut into shards (a megabyte of documents each).  A
shard's words become ranks in the benchmark's vocabulary, 0 for all others, and
its suffix array is built over the suffixes that can hold a match: those that
begin with as many benchmark words in a row as the shortest window has.  Every
test suffix is binary-searched in every shard's array, which gives the range of
its verbatim occurrences; their longest extensions and locations follow, and
documents with enough hit words are removed.

A window is ``window`` consecutive words of an item; a shorter item is one
window.  Words are compared by 64-bit hashes of their bytes.

Each document is wholly in one shard, so no training row is shuffled.  The
benchmark is read in blocks of ``block_bytes``; each block goes to the tasks
with the function (its size is bounded by the block).  With more than one block
each block's hits are written to the shared folder before the next block is
read, so the driver holds one block at a time, and the documents' hits are
united per document afterwards.  Every block reads the documents once more.

Edge cases: null text has no words; items without words or with a null id are
left out; repeated documents give repeated rows; other columns, clashing names
included, pass through unless a result has the same name; an empty benchmark
hits nothing.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyho.llm.bytes_words import ALNUM, LOWER, find_words, prefix_hash, range_hash
from tallyho.llm.common import apart, scratch, split_buffers

WINDOW = 13
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 1 << 20          # a shard's arrays take about 40 bytes a byte of text
MATCH = "item_id string, item_word long, doc_word long, words long"
_NEW = T.StructType([T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(T.LongType())),
                     T.StructField("items", T.ArrayType(T.StringType()))])


def tokenize(data: np.ndarray, offsets: np.ndarray):
    """(hash, row) of every word."""
    low = LOWER[data]
    start, end, row = find_words(low, offsets, ALNUM)
    return range_hash(prefix_hash(low), start, end), row


class TestSet:
    """A block of benchmark items: vocabulary, items as ranks, distinct windows."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        texts = [t.encode("utf-8") for _, t in items]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        hashes, row = tokenize(np.frombuffer(b"".join(texts), np.uint8), offsets)
        self.window = window
        self.vocab, ranks = np.unique(hashes, return_inverse=True)
        self.names = sorted({i for i, _ in items})
        place = {n: k for k, n in enumerate(self.names)}
        first = np.searchsorted(row, np.arange(len(items) + 1))
        self.words = (ranks + 1).astype(np.uint32)
        keys, at, item = [], [], []
        for k, (name, _) in enumerate(items):
            a, b = int(first[k]), int(first[k + 1])
            if a == b:
                continue
            size = min(window, b - a)
            for p in range(a, b - size + 1):
                key = np.zeros(window, np.uint32)
                key[:size] = self.words[p:p + size]
                keys.append(key)
                at.append((p, a, b))
                item.append(place[name])
        keys = np.array(keys, np.uint32).reshape(-1, window)
        self.keys, which = np.unique(keys, axis=0, return_inverse=True)
        which = which.reshape(-1)
        self.size = (self.keys > 0).sum(axis=1)
        order = np.argsort(which, kind="stable")
        self.first = np.searchsorted(which[order], np.arange(len(self.keys) + 1))
        self.item = np.array(item, np.int64)[order]
        self.at = np.array(at, np.int64).reshape(-1, 3)[order]
        self.shortest = int(self.size.min()) if len(self.keys) else 0

    def packed(self, words: np.ndarray) -> list[np.ndarray]:
        """Columns of two words each, compared from first to last."""
        if words.shape[1] % 2:
            words = np.concatenate([words, np.zeros((len(words), 1), np.uint32)], axis=1)
        wide = words.astype(np.uint64)
        return [(wide[:, c] << np.uint64(32)) | wide[:, c + 1] for c in range(0, words.shape[1], 2)]


def suffix_array(seq: np.ndarray, test: TestSet):
    """Start positions of the matchable suffixes in the order of their first
    ``window`` words, and those words as packed columns."""
    zeros = np.flatnonzero(seq == 0)
    run = zeros[np.searchsorted(zeros, np.arange(len(seq)))] - np.arange(len(seq))
    starts = np.flatnonzero(run >= max(test.shortest, 1))
    columns = []
    for c in range(0, test.window, 2):
        pair = []
        for k in (c, c + 1):
            w = np.zeros(len(starts), np.uint64)
            if k < test.window:
                reach = run[starts] > k
                w[reach] = seq[starts[reach] + k]
            pair.append(w)
        columns.append((pair[0] << np.uint64(32)) | pair[1])
    order = np.lexsort(columns[::-1])
    return starts[order], [c[order] for c in columns]


def bisect(columns: list[np.ndarray], query: list[np.ndarray], right: bool) -> np.ndarray:
    """Where the queries' places in the sorted columns are, all in step."""
    lo = np.zeros(len(query[0]), np.int64)
    hi = np.full(len(query[0]), len(columns[0]), np.int64)
    while True:
        open_ = lo < hi
        if not open_.any():
            return lo
        mid = (lo + hi) >> 1
        at = np.minimum(mid, len(columns[0]) - 1)
        less, equal = np.zeros(len(lo), bool), np.ones(len(lo), bool)
        for c, q in zip(columns, query):
            have = c[at]
            less |= equal & (have < q)
            equal &= have == q
        up = open_ & (less | (equal if right else False))
        lo, hi = np.where(up, mid + 1, lo), np.where(open_ & ~up, mid, hi)


def locate(seq: np.ndarray, test: TestSet):
    """(position, window) of every occurrence of a test window in the shard."""
    none = np.zeros(0, np.int64)
    if not len(test.keys):
        return none, none
    starts, columns = suffix_array(seq, test)
    if not len(starts):
        return none, none
    low = test.packed(test.keys)
    top = test.keys.copy()
    top[np.arange(test.window)[None, :] >= test.size[:, None]] = np.uint32(0xFFFFFFFF)
    lo, hi = bisect(columns, low, False), bisect(columns, test.packed(top), True)
    n = np.maximum(hi - lo, 0)
    window = np.repeat(np.arange(len(n)), n)
    at = np.arange(len(window)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
    return starts[at], window


def expand(position: np.ndarray, window: np.ndarray, test: TestSet):
    """(position, entry) with one row for each item place that has the window."""
    n = test.first[window + 1] - test.first[window]
    entry = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(test.first[window], n)
    return np.repeat(position, n), entry


def longest(seq: np.ndarray, position: np.ndarray, window: np.ndarray, test: TestSet):
    """(position, entry, words) of the matches that reach as far as they can to
    either side."""
    at, entry = expand(position, window, test)
    p, a, b = test.at[entry].T
    earlier = (p > a) & (at > 0) & (test.words[np.maximum(p - 1, 0)] == seq[np.maximum(at - 1, 0)])
    at, entry, p, b = at[~earlier], entry[~earlier], p[~earlier], b[~earlier]
    words = test.size[window].repeat(test.first[window + 1] - test.first[window])[~earlier].astype(np.int64)
    grow = np.arange(len(at))
    while len(grow):
        more = p[grow] + words[grow] < b[grow]
        grow = grow[more]
        grow = grow[seq[at[grow] + words[grow]] == test.words[p[grow] + words[grow]]]
        words[grow] += 1
    return at, entry, words


def shard_sequence(data: np.ndarray, offsets: np.ndarray, test: TestSet):
    """The shard's words as ranks with a 0 after each document; (seq, row and
    word number of every place, words of each document)."""
    hashes, row = tokenize(data, offsets)
    rows = len(offsets) - 1
    n_words = np.bincount(row, minlength=rows)
    seq = np.zeros(len(hashes) + rows + 1, np.uint32)
    if len(test.vocab):
        rank = np.minimum(np.searchsorted(test.vocab, hashes), len(test.vocab) - 1)
        seq[np.arange(len(hashes)) + row] = np.where(test.vocab[rank] == hashes, rank + 1, 0)
    begin = np.cumsum(n_words + 1) - (n_words + 1)
    return seq, begin, n_words


def search_shard(data, offsets, test: TestSet):
    """Per document: words, hit spans [start, end, start, end, ...), items, by
    the longest matches: they cover the words of all window hits and no other."""
    seq, begin, n_words = shard_sequence(data, offsets, test)
    position, window = locate(seq, test)
    spans, items = [[]] * len(n_words), [[]] * len(n_words)
    if len(position):
        at, entry, words = longest(seq, position, window, test)
        change = np.zeros(len(seq) + 1, np.int64)
        np.add.at(change, at, 1)
        np.add.at(change, at + words, -1)
        hit = np.concatenate([[0], (np.cumsum(change) > 0).astype(np.int8)])
        turns = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
        row = np.searchsorted(begin, turns[:, 0], side="right") - 1
        for r in np.unique(row):
            spans[r] = (turns[row == r] - begin[r]).reshape(-1).tolist()
        row = np.searchsorted(begin, at, side="right") - 1
        pairs = np.unique(np.stack([row, test.item[entry]]), axis=1)
        cut = np.flatnonzero(np.diff(pairs[0])) + 1
        for part, own in zip(np.split(pairs[0], cut), np.split(pairs[1], cut)):
            items[part[0]] = [test.names[i] for i in own]
    return n_words, spans, items


def blocks(benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """The benchmark's items, and how many blocks of bounded size they make."""
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.where("item_id is not null")
    total = rows.agg(F.sum(F.octet_length("text") + 16).alias("b")).first()["b"] or 0
    return rows, max(1, -(-total // block_bytes))


def block_items(rows: DataFrame, n: int, k: int) -> list[tuple[str, str]]:
    """The items of block ``k`` of ``n``."""
    part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("item_id"), F.lit(n)) == k)
    return [(r["item_id"], r["text"]) for r in part.collect()]


def written_by_block(rows: DataFrame, n: int, hits) -> DataFrame:
    """``hits(items)`` of all blocks, each written before the next is read."""
    folder = scratch(rows.sparkSession, "benchmark-hits")
    for k in range(n):
        part = hits(block_items(rows, n, k))
        part.write.mode("append").parquet(folder)
        schema = part.schema
        del part
    return rows.sparkSession.read.schema(schema).parquet(folder)


def _pass(docs: DataFrame, items: list[tuple[str, str]], window: int) -> DataFrame:
    keep = [c for c in docs.columns if c not in _NEW.names]
    docs = docs.select(*keep)
    schema = T.StructType(docs.schema.fields + _NEW.fields)

    def run(batches):
        import pyarrow as pa

        test = TestSet(items, window)
        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
                n, spans, found = search_shard(data, offsets, test)
                yield pa.RecordBatch.from_arrays(
                    part.columns + [pa.array(n, pa.int64()), pa.array(spans, pa.list_(pa.int64())),
                                    pa.array(found, pa.list_(pa.string()))], keep + _NEW.names)

    return docs.mapInArrow(run, schema)


def _finish(rows: DataFrame) -> DataFrame:
    """n_hit, n_items, items_sha256 and contaminated from spans and items."""
    hit = F.aggregate(F.transform("spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x)), F.lit(0).cast("long"),
                      lambda a, x: a + x)
    return (rows.withColumn("n_hit", hit).withColumn("n_items", F.size("items").cast("long"))
            .withColumn("items_sha256", F.sha2(F.concat_ws(",", "items").cast("binary"), 256))
            .withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                  block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, spans (hit words, as start, end, ...), items,
    n_hit, n_items, items_sha256 and contaminated."""
    rows, n = blocks(benchmark, block_bytes)
    if n == 1:
        return _finish(_pass(docs, block_items(rows, n, 0), window))
    keep = [c for c in docs.columns if c not in _NEW.names]
    keyed = lambda items: _pass(docs, items, window).withColumn("_h", F.xxhash64(*keep))
    every = written_by_block(rows, n, lambda items: keyed(items).where(F.size("items") > 0).select(
        "_h", F.col("doc_id").alias("_d"), *_NEW.names))
    some = every.groupBy("_h", "_d").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.transform(
            F.sequence(F.lit(0), F.floor(F.size("spans") / 2).cast("int") - 1),
            lambda i: F.struct(F.get("spans", i * 2).alias("a"), F.get("spans", i * 2 + 1).alias("b"))))))).alias("s"))
    none = F.array().cast("array<bigint>")
    join = F.aggregate("s", none, lambda a, x: F.when(
        (F.size(a) > 0) & (F.element_at(a, -1) >= x["a"]),
        F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.greatest(F.element_at(a, -1), x["b"])))
    ).otherwise(F.concat(a, F.array(x["a"], x["b"]))))
    some = some.select("_h", F.coalesce("_d", F.lit(-1)).alias("_d"), "items", join.alias("spans"))
    base = keyed([]).drop("spans", "items").withColumn("_d", F.coalesce("doc_id", F.lit(-1)))
    rows = base.join(some, ["_h", "_d"], "left").drop("_h", "_d")
    return _finish(rows.withColumn("spans", F.coalesce("spans", none)).withColumn(
        "items", F.coalesce("items", F.array().cast("array<string>"))))


def longest_matches(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                    block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, item_word, doc_word, words) of every longest verbatim
    match of at least a window, with its places in item and document."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType)]
                          + T.StructType.fromDDL(MATCH).fields)

    def one(items):
        def run(batches):
            import pyarrow as pa

            test = TestSet(items, window)
            for batch in batches:
                for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
                    seq, begin, _ = shard_sequence(data, offsets, test)
                    at, entry, words = longest(seq, *locate(seq, test), test)
                    row = np.searchsorted(begin, at, side="right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(row)), pa.array([test.names[i] for i in test.item[entry]], pa.string()),
                         pa.array(test.at[entry, 0] - test.at[entry, 1]), pa.array(at - begin[row]), pa.array(words)],
                        schema.names)

        return docs.select("doc_id", "text").mapInArrow(run, schema)

    rows, n = blocks(benchmark, block_bytes)
    return one(block_items(rows, n, 0)) if n == 1 else written_by_block(rows, n, one)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` without the contaminated documents, their columns untouched."""
    rows, back = apart(docs)
    return back(contamination(rows, benchmark, window).where("not contaminated"))
