"""Exact n-gram Jaccard join with token-combination prefixes.

A document's set holds the hashes of its distinct ``words``-word shingles; two
sets link when 100 * |x & y| >= percent * |x | y|.

*Prefixes.*  In any fixed order of all shingles, sets that link share at least
``k`` shingles within their first ``n - ceil(t n) + k`` ones.  The first order
is the hash order with ``k`` a tenth of the set: only those prefixes are
counted over the corpus.  Within the shared prefix the same rule holds again
with the corpus order (rarest first), so the shingles a set is looked up by
are about its ``(1 - t) n`` rarest, and most sets have none that occurs twice.

*Token combinations.*  Rare shingles (up to ``RARE`` documents) are indexed alone.
Frequent ones are indexed by pairs in a prefix that is one longer: sets that link
share two shingles there, so either a single or a pair meets.  Pairs tell sets
apart that share some boilerplate; for sets that share most of their prefix they
are only many rows.  So a frequent shingle whose sets hold more than ``CROWD``
frequent ones in their prefixes, on the average, is indexed alone as well.  This is
a class of the shingle, the same in all sets, so no link is lost; and as the sum
of all sets' squared numbers of paired shingles is at most ``CROWD`` times the
sum of the numbers, pairs are at most ``CROWD / 2`` rows a shingle, whatever the
sizes of sets and groups.  Sets too small to share two are indexed by singles.
Keys also carry a size band.

*Verification* compares whole sets, rebuilt from the texts: a key's members with
one leader, not with each other, and what that leaves in more than one component
by the differences from a leader (:mod:`star_links`).  So no link between
different texts is lost, and a group of m copies costs about m comparisons.

Equal sets are one class; links, components and prefixes live in tables, never on
the driver.

Edge cases: null, empty and blank texts have no shingles, link to nothing and
are their own component; with fewer than ``words`` words the whole sequence is
one shingle; a null doc_id links to nothing and its component is null; rows
that share a doc_id are judged one by one, by their own texts; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.bytes_words import LOWER, NOT_SPACE, find_words, mix, prefix_hash, range_hash
from tallyho.llm.common import split_buffers, written
from tallyho.llm.star_links import BROADCAST_IDS, link_classes, needed_keys
from tallyho.session import bounded_broadcast

WORDS, PERCENT = 5, 80
RARE = 64
CROWD = 4
SHARD_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)


def row_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    low = LOWER[data]
    start, end, row = find_words(low, offsets, NOT_SPACE)
    h = range_hash(prefix_hash(low), start, end)
    grams = np.zeros(len(h), np.uint64)
    for k in range(words):
        shifted = np.zeros(len(h), np.uint64)
        shifted[:max(len(h) - k, 0)] = h[k:]
        grams = mix(grams * _ODD + shifted + np.uint64(k + 1))
    first = np.searchsorted(row, np.arange(len(offsets)))
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= words:
            out.append(np.unique(grams[a: b - words + 1]))
        elif b > a:
            short = np.zeros(1, np.uint64)
            for k in range(a, b):
                short = mix(short * _ODD + h[k] + np.uint64(101 + b - a))
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def first_prefix(n: int, percent: int) -> int:
    """n - ceil(t n) + k, with k a tenth of n."""
    return min(n, n - -(-percent * n // 100) + max(1, -(-n // 10)))


def text_hash():
    return F.xxhash64(F.coalesce("text", F.lit("")))


def prefixes(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, t, n, cls, f, tokens): hash of the text, set size, both halves
    of the set's fingerprint and its first prefix; of equal sets in a batch only
    the smallest doc_id has tokens."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
                ids = part.column(0).to_pylist()
                sets = row_sets(data, offsets, words)
                prints = [fingerprint(s) for s in sets]
                head: dict[bytes, int] = {}
                for i, (d, p, s) in enumerate(zip(ids, prints, sets)):
                    if len(s) and d is not None and (p not in head or d < ids[head[p]]):
                        head[p] = i
                tokens = [s[:first_prefix(len(s), percent)].view(np.int64) if head.get(p) == i else np.zeros(0, np.int64)
                          for i, (p, s) in enumerate(zip(prints, sets))]
                f = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
                limits = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int32)
                flat = np.concatenate(tokens) if tokens else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array([len(s) for s in sets], pa.int64()), pa.array(f[:, 0].copy()),
                     pa.array(f[:, 1].copy()), pa.ListArray.from_arrays(pa.array(limits), pa.array(flat))],
                    ["doc_id", "t", "n", "cls", "f", "tokens"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("t"), "text")
    return rows.mapInArrow(run, "doc_id long, t long, n long, cls long, f long, tokens array<long>")


def keys(grouped: DataFrame, percent: int, rare: int, crowd: float) -> DataFrame:
    """(key, cls, n) from (cls, n, tokens: array<struct<df, token>> rarest
    first): single shingles and pairs, with their size band."""
    spared = lambda n: f"greatest(1, ({n} + 9) div 10)"
    rows = grouped.withColumn("share", F.expr(f"({percent} * n + 99) div 100"))
    rows = rows.withColumn("prefix", F.expr(f"least(n, n - share + {spared('n')})")).withColumn("both", F.expr(spared("share")))
    # of the first prefix, rarest first, the shingles of this set alone go before all others
    rows = rows.withColumn("short", F.expr("greatest(0, prefix - both + 1) - (prefix - size(tokens))"))
    start = lambda c, n: F.slice(c, F.lit(1), F.greatest(F.least(n, F.size(c)), F.lit(0)).cast("int"))
    rows = rows.select("cls", "n", "both", "short", start("tokens", F.col("short") + 1).alias("longer")).where("size(longer) > 0")
    rows = written(rows, "join-prefixes")
    single = F.xxhash64(F.lit(1), "t.token").alias("k")
    # partners of the larger ones may be too small for pairs
    small = f"n <= {100 * 100 // percent // 5}"
    few = rows.where("both < 2").select("cls", "n", F.explode(start("longer", F.col("short"))).alias("t")).select("cls", "n", single)
    rows = rows.where("both >= 2").withColumn("often", F.filter("longer", lambda t: t["df"] > rare))
    rows = rows.withColumn("m", F.size("often")).withColumn("at", F.size("longer") - F.col("m"))
    seldom = rows.select("cls", "n", F.explode(F.slice("longer", F.lit(1), F.col("at"))).alias("t")).select("cls", "n", single)
    often = rows.select("cls", "n", "m", "at", "short", F.posexplode("often").alias("i", "t"))
    often = written(often.select("cls", "n", "m", "t", F.expr(f"{small} and at + i < short").alias("early")), "join-frequent")
    crowded = written(often.groupBy("t.token").agg(F.avg("m").alias("m")).where(F.col("m") > crowd).select("token"), "join-crowded")
    alone = bounded_broadcast(crowded, BROADCAST_IDS).withColumn("alone", F.lit(True))
    often = often.join(alone, F.col("t.token") == F.col("token"), "left").select("cls", "n", "t", "alone", "early")
    paired = often.where("alone is null").groupBy("cls", "n").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    paired = paired.select("cls", "n", "ts", F.posexplode("ts").alias("i", "a")).select(
        "cls", "n", "a", F.explode(F.slice("ts", F.col("i") + 2, F.size("ts"))).alias("b"))
    out = few.unionAll(seldom).unionAll(often.where("alone or early").select("cls", "n", single)).unionAll(
        paired.select("cls", "n", F.xxhash64(F.lit(2), "a.token", "b.token").alias("k")))
    band = F.floor(F.log(F.col("n").cast("double")) / -math.log((percent - 1) / 100))
    return out.select(F.explode(F.array(band, band + 1)).alias("band"), "k", "cls", "n").select(F.xxhash64("k", "band").alias("key"), "cls", "n")


def rarest_first(rows: DataFrame) -> DataFrame:
    """(cls, tokens) from (cls, token): each class's tokens that another row
    has too, with their counts, rarest first."""
    often = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    return rows.join(often, "token").groupBy("cls").agg(F.sort_array(F.collect_set(F.struct("df", "token"))).alias("tokens"))


def fingerprint(tokens: np.ndarray) -> bytes:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()


def class_sets(docs: DataFrame, heads: DataFrame, words: int) -> DataFrame:
    """(cls, n, tokens) of the classes ``heads`` (cls, doc_id), one row each,
    from the texts of their documents; ``cls`` is the first half of a set's
    fingerprint."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for _, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
                sets = row_sets(data, offsets, words)
                cls = [int(np.frombuffer(fingerprint(s), np.int64)[0]) for s in sets]
                limits = np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int32)
                # as signed numbers, in order
                tokens = np.concatenate([np.sort(s.view(np.int64)) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(np.diff(limits), pa.int64()),
                                                  pa.ListArray.from_arrays(pa.array(limits), pa.array(tokens))], ["cls", "n", "tokens"])

    ids = bounded_broadcast(heads.select("doc_id").distinct(), BROADCAST_IDS)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).join(
        ids, "doc_id", "left_semi")
    sets = texts.select("text").mapInArrow(run, "cls long, n long, tokens array<long>")
    sets = written(sets.join(bounded_broadcast(heads.select("cls"), BROADCAST_IDS), "cls", "left_semi"), "join-sets")
    # a row that is repeated whole has its set twice
    several = sets.groupBy("cls").count().where("count > 1").limit(1).count()
    return written(sets.dropDuplicates(["cls"]), "join-sets") if several else sets


def _linked(docs: DataFrame, words: int, percent: int, rare: int, crowd: float) -> DataFrame:
    """(doc_id, t: hash of the text, n, comp, component_id) of every document;
    ``comp`` is null where nothing can link."""
    sets = written(prefixes(docs, words, percent), "join-sets")
    real = F.expr("n > 0 and doc_id is not null")
    classes = written(sets.where(real).groupBy("cls", "f", "n").agg(F.min("doc_id").alias("doc_id")), "join-classes")
    shared = rarest_first(sets.select("cls", F.explode("tokens").alias("token")))
    grouped = classes.select("cls", "n").join(shared, "cls").select("cls", "n", "tokens")
    posted = written(keys(grouped, percent, rare, crowd), "join-keys")
    members = written(needed_keys(posted), "join-members")
    involved = bounded_broadcast(members.select("cls").distinct(), BROADCAST_IDS, materialize=True)
    heads = written(classes.join(involved, "cls", "left_semi").select("cls", "doc_id"), "join-heads")
    comps = link_classes(members, class_sets(docs, heads, words), percent)
    named = classes.join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = named.where("comp <> cls").select("comp").distinct()
    groups = named.join(first, "comp", "left_semi").groupBy("comp").agg(F.min("doc_id").alias("least"))
    named = written(named.join(groups, "comp", "left").select("cls", "f", "n", "comp", F.coalesce("least", "doc_id").alias("component_id")),
                    "join-named")
    rows = sets.select("doc_id", "t", "n", "cls", "f")
    linked = rows.where(real).join(named, ["cls", "f", "n"]).select("doc_id", "t", "n", "comp", "component_id")
    alone = rows.where(~real).select("doc_id", "t", "n", F.lit(None).cast("long").alias("comp"), F.col("doc_id").alias("component_id"))
    return linked.unionAll(alone)


def join(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, rare: int = RARE, crowd: float = CROWD) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    return _linked(docs, words, percent, rare, crowd).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group: the smallest doc_id, and of
    several texts with it one.  Documents that can link to nothing (no id, no
    words) stay."""
    found = written(_linked(docs, words, percent, RARE, CROWD), "join-found")
    kept = found.where("comp is not null").groupBy("comp").agg(F.min(F.struct("doc_id", "t")).alias("k")).select("k.doc_id", "k.t")
    kept = kept.unionAll(found.where("comp is null and doc_id is not null").select("doc_id", "t").distinct())
    mine = docs.select(F.struct(*docs.columns).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("t"))
    same = written(mine.where("doc_id is not null").join(bounded_broadcast(written(kept, "join-kept"), BROADCAST_IDS), ["doc_id", "t"], "left_semi"),
                   "join-rows")
    several = same.groupBy("doc_id", "t").count().where("count > 1").limit(1).count()
    same = same.dropDuplicates(["doc_id", "t"]) if several else same
    return same.select("row.*").unionAll(docs.where("doc_id is null"))
