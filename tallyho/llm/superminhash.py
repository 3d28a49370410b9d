"""Near duplicates by SuperMinHash signatures, banding and verification.

A document's set holds the hashes of its distinct ``words``-word shingles; two
documents link when 100 * |x & y| >= percent * |x | y|.

*Signature.*  Every element deals its own random permutation of the ``SLOTS``
slots, one slot a step, with a random fraction: in step j a slot gets j + that
fraction if that is the least so far.  An element's values are one of each
integer part, so they are negatively correlated and the share of equal slots
estimates the similarity with less variance than independent minima.  A slot
that is filled in step j cannot be lowered later, so a set stops as soon as all
slots are filled: after one step for long texts.  The permutations are dealt
for all elements of a batch at once.

*Banding.*  Sets that agree in all ``ROWS`` slots of one of the
``SLOTS / ROWS`` bands are candidates.  With 128 slots and 4 rows a pair of
similarity 0.8 is missed with odds of about 5e-8.

*Verification and groups.*  Candidates of a band value are compared on whole
sets: with one leader, then by their differences from it (:mod:`star_links`).
Links go into components by contraction (written tables of links, fewer each round).

Equal sets are one class from the start, so thousands of copies cost one row
each.  Links, components and signatures live in tables, never on the driver.
Shingles, classes and bands are compared by 64-bit hashes (classes by 128 bits
where copies are found).

Edge cases: null, empty and blank texts have no shingles, link to nothing and
are their own component; with fewer than ``words`` words the whole sequence is
one shingle; a null doc_id links to nothing, its component is null and it is
kept; rows that share a doc_id are judged one by one, by their own texts; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.bytes_words import mix
from tallyho.llm.common import split_buffers, written
from tallyho.llm.jaccard_join import class_sets, fingerprint, row_sets
from tallyho.llm.star_links import BROADCAST_IDS, link_classes, needed_keys
from tallyho.session import bounded_broadcast

WORDS, PERCENT = 5, 80
SLOTS, ROWS = 128, 4
SHARD_BYTES = 1 << 19
_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)


def signatures(sets: list[np.ndarray], slots: int = SLOTS) -> np.ndarray:
    """One row of ``slots`` values a set: the step in the highest byte, the
    random fraction below; all ones for an empty set."""
    out = np.full((len(sets), slots), _EMPTY)
    size = np.array([len(s) for s in sets], np.int64)
    element = np.concatenate(sets) if len(sets) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(sets)), size)
    order = None                                # each element's permutation, as dealt so far
    for j in range(slots):
        if not len(element):
            break
        draw = mix(element * _ODD + np.uint64(2 * j + 1))
        swap = j + (mix(draw + _ODD) % np.uint64(slots - j)).astype(np.int64)
        each = np.arange(len(element))
        if j == 0:
            slot = swap
        else:
            slot = order[each, swap]
            order[each, swap] = order[:, j]
        value = np.uint64(j << 56) | draw >> np.uint64(8)
        np.minimum.at(out.reshape(-1), row * slots + slot, value)
        left = (out == _EMPTY).any(axis=1)[row]
        element, row = element[left], row[left]
        if j == 0:
            order = np.tile(np.arange(slots, dtype=np.uint16), (len(element), 1))
            order[np.arange(len(element)), swap[left]] = 0
        else:
            order = order[left]
    return out


def bands(signed: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash a band, with the band's number, of every signature."""
    parts = signed.reshape(len(signed), signed.shape[1] // rows, rows)
    out = np.zeros(parts.shape[:2], np.uint64) + np.arange(parts.shape[1], dtype=np.uint64)
    for k in range(rows):
        out = mix(out * _ODD + parts[:, :, k])
    return out


def _shingles(batch, words: int):
    for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
        yield part, row_sets(data, offsets, words)


def signed(docs: DataFrame, words: int, slots: int, rows: int) -> DataFrame:
    """(doc_id, n, cls, f, bands): set size, both halves of the set's
    fingerprint and its band hashes; of equal sets in a batch the
    smallest doc_id has them."""
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, sets in _shingles(batch, words):
                prints = [fingerprint(s) for s in sets]
                valid = ~np.asarray(part.column(0).is_null())
                ids = part.column(0).to_pylist()
                head: dict[bytes, int] = {}
                for i, (p, s) in enumerate(zip(prints, sets)):
                    if len(s) and valid[i] and (p not in head or ids[i] < ids[head[p]]):
                        head[p] = i
                at = np.array(sorted(head.values()), np.int64)
                keys = bands(signatures([sets[i] for i in at.tolist()], slots), rows)
                counts = np.zeros(len(sets), np.int64)
                counts[at] = keys.shape[1]
                f = np.frombuffer(b"".join(prints), np.int64).reshape(-1, 2)
                limits = np.append(0, np.cumsum(counts)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(s) for s in sets], pa.int64()), pa.array(f[:, 0].copy()), pa.array(f[:, 1].copy()),
                     pa.ListArray.from_arrays(pa.array(limits), pa.array(keys.reshape(-1).view(np.int64)))], ["doc_id", "n", "cls", "f", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, cls long, f long, bands array<long>")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, slots: int = SLOTS, rows: int = ROWS) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document: the smallest
    doc_id that links reach, and whether it is its own."""
    sets = written(signed(docs, words, slots, rows), "dedup-signed")
    real = F.expr("n > 0 and doc_id is not null")
    classes = written(sets.where(real).groupBy("cls", "f", "n").agg(F.min("doc_id").alias("doc_id")), "dedup-classes")
    # copies in several batches post their keys once, by the smallest doc_id
    heads = sets.where("size(bands) > 0").join(classes.select("cls", "doc_id"), ["cls", "doc_id"])
    posted = heads.select("cls", "n", F.explode("bands").alias("key"))
    members = written(needed_keys(posted), "dedup-members")
    heads = classes.join(bounded_broadcast(members.select("cls").distinct(), BROADCAST_IDS, materialize=True), "cls", "left_semi")
    whole = class_sets(docs, written(heads.select("cls", "doc_id"), "dedup-heads"), words)
    comps = link_classes(members, whole, percent)
    named = classes.join(comps, "cls", "left").withColumn("comp", F.coalesce("comp", "cls"))
    first = named.where("comp <> cls").select("comp").distinct()
    groups = named.join(first, "comp", "left_semi").groupBy("comp").agg(F.min("doc_id").alias("least"))
    named = written(named.join(groups, "comp", "left").select("cls", "f", "n", F.coalesce("least", "doc_id").alias("component_id")),
                    "dedup-named")
    linked = sets.where(real).select("doc_id", "n", "cls", "f").join(named, ["cls", "f", "n"])
    alone = sets.where(~real).withColumn("component_id", F.col("doc_id"))
    found = linked.select("doc_id", "n", "component_id").unionAll(alone.select("doc_id", "n", "component_id"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))
