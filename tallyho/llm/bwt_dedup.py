"""Suffix-array dedup: repeated 100-byte strings by merging shard BWTs.

Texts are UTF-8 bytes.  A byte is removed if a string of ``MATCH`` bytes that
covers it also starts earlier (in a smaller doc_id, or earlier in the same
document).

1. *Anchors.*  Every ``MATCH``-byte window has an anchor: the smallest hash of
   its ``GRAM``-byte strings.  Equal windows have equal anchors, so a window
   whose anchor has one occurrence is not repeated, and the text is cut into
   stretches of windows with one anchor.  Of equal stretches (one content
   under one anchor) all but the earliest are repeated as a whole; the strings
   that go on are the distinct ones whose anchor has another content, too.
2. *Shard transforms.*  The stretches of candidate windows are dealt out by
   anchor, so equal windows meet in one task.  There they are cut into shards.
   A window is a string over the alphabet of ``STEP``-byte strings, and a
   shard's Burrows-Wheeler transform is kept by layers: layer l holds the
   symbol before each suffix of l symbols, in the shard's suffix order.
3. *Merge.*  The transforms are merged by refining their interleave: from any
   interleave, symbols are pulled from the shards' layers in turn and dealt
   into one bucket per symbol, which sorts the merged suffixes by one more
   symbol; no suffix is sorted again.  Borders between buckets are carried
   along: neighbours without a border after layer l share l symbols, and after
   the last layer the runs without a border share ``MATCH`` bytes.  These are
   the repeated intervals; all but their earliest window are marked.

Marks are united per document, and the remaining bytes are hashed.

Nothing hot is gathered: equal stretches are reduced to the earliest within a
task's slice before they are shuffled, and the rest of them are spread by
document.  What meets in one task are the distinct contents around one anchor,
about 160 bytes each; they are compared in passes of ``CHUNK_WINDOWS`` windows.
Texts are shuffled once, by doc_id; both joins read that exchange.

Edge cases: null text is empty; texts under ``MATCH`` bytes keep everything;
rows that share a doc_id are the same place in the order, so copies under one
id do not remove each other, and marks apply to all rows of the id; a null
doc_id comes first; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyho.llm.bytes_words import mix, powers, prefix_hash, range_hash
from tallyho.llm import bytes_words
from tallyho.llm.common import split_buffers

MATCH = 100
GRAM = 24
STEP = 20
LEVELS = MATCH // STEP
SHARD_BYTES = 2 << 20
RUN = 96                        # windows in one stretch (an anchor inside one window covers 77 at most)
CHUNK_WINDOWS = 300_000
SHARDS = 8
NULL_ID = -(1 << 63)
_SEAT = np.uint64((1 << 22) - 1)


def gram_hashes(prefix: np.ndarray, size: int) -> np.ndarray:
    """Hash of data[i:i + size] for every i, from the prefix hashes."""
    n = max(len(prefix) - size, 0)
    return mix((prefix[size:] - prefix[:n]) * powers(len(prefix), bytes_words._INVERSE)[:n])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    size = 1
    while size * 2 <= width:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def stretches(data: np.ndarray, offsets: np.ndarray):
    """(start, length, anchor, content hash, self) of every run of windows with
    one anchor; ``self``: windows of the run may equal each other."""
    none = np.zeros(0, np.int64)
    n = len(data) - MATCH + 1
    if n <= 0:
        return none, none, none, none, none.astype(bool)
    prefix = prefix_hash(data)
    h = gram_hashes(prefix, GRAM)
    seated = (h & ~_SEAT) | np.arange(len(h), dtype=np.uint64)
    seat = (sliding_min(seated, MATCH - GRAM + 1) & _SEAT).astype(np.int64)
    anchor = h[seat]
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, np.maximum(offsets[1:-1] - MATCH + 1, 0), 1)
    np.add.at(change, offsets[1:-1], -1)
    valid = np.cumsum(change[:n]) == 0
    cut = np.ones(n, bool)
    cut[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1])
    cut[offsets[1:-1][offsets[1:-1] < n]] = True
    start = np.flatnonzero(cut)
    length = np.diff(np.append(start, n))
    parts = -(-length // RUN)
    step = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * RUN
    whole = np.repeat(length, parts)
    start, length = np.repeat(start, parts) + step, np.minimum(whole - step, RUN)
    keep = valid[start]
    start, length = start[keep], length[keep]
    content = range_hash(prefix, start, start + length + MATCH - 1)
    return start, length, anchor[start].view(np.int64), content.view(np.int64), seat[start] != seat[start + length - 1]


def _pieces(batch):
    """(doc_id of each row, bytes, row limits, base) in bounded pieces; a long
    text comes in overlapping pieces, ``base`` being where one begins."""
    for part, data, offsets, _ in split_buffers(batch, "text", SHARD_BYTES):
        ids = np.asarray(part.column(0).fill_null(NULL_ID))
        if len(data) <= 2 * SHARD_BYTES:
            yield ids, data, offsets, 0
            continue
        for lo in range(0, len(data), SHARD_BYTES):
            piece = data[lo: lo + SHARD_BYTES + MATCH - 1]
            yield ids, piece, np.array([0, len(piece)]), lo


def _classes(v, content, doc, place):
    """Order by anchor, content and place, with what is new in that order:
    (order, new anchor, new content, same place as the row before)."""
    order = np.lexsort((place, doc, content, v))
    differs = lambda x: np.append(True, x[order][1:] != x[order][:-1])[:len(order)]
    anchor = differs(v)
    return order, anchor, anchor | differs(content), ~(differs(doc) | differs(place))


def _merge_runs(doc, first, end):
    """Runs [first, end) of each document, those that touch made one."""
    order = np.lexsort((first, doc))
    doc, first, end = doc[order], first[order], end[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (first[1:] > end[:-1]))[:len(doc)]
    return doc[new], first[new], np.maximum.reduceat(end, np.flatnonzero(new)) if len(doc) else end


def anchor_rows(docs: DataFrame) -> DataFrame:
    """(v, content, doc_id, first, end, own): stretches of windows [first, end)
    under their anchor; without v: runs known to be repeated."""
    names = ["v", "content", "doc_id", "first", "end", "own"]

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for ids, data, offsets, base in _pieces(batch):
                start, length, v, content, own = stretches(data, offsets)
                row = np.searchsorted(offsets, start, side="right") - 1
                doc, first = ids[row], start - offsets[row] + base
                order, _, new, same = _classes(v, content, doc, first)
                head, later = order[new], order[~new & ~same]
                yield pa.RecordBatch.from_arrays([pa.array(x[head]) for x in (v, content, doc, first, first + length, own)], names)
                d, a, b = _merge_runs(doc[later], first[later], first[later] + length[later])
                none = pa.nulls(len(d), pa.int64())
                yield pa.RecordBatch.from_arrays([none, none, pa.array(d), pa.array(a), pa.array(b), pa.nulls(len(d), pa.bool_())], names)

    return docs.select("doc_id", "text").mapInArrow(run, "v long, content long, doc_id long, first long, end long, own boolean")


def settle(rows: DataFrame) -> DataFrame:
    """(doc_id, first, end, v): runs that are repeated (v null), and the
    distinct stretches that must be compared under their anchor."""
    def run(batches):
        import pyarrow as pa

        names = ["doc_id", "first", "end", "v"]

        def out(doc, first, end, v=None):
            for lo in range(0, len(doc), 100_000):
                k = slice(lo, lo + 100_000)
                third = pa.nulls(len(doc[k]), pa.int64()) if v is None else pa.array(v[k])
                yield pa.RecordBatch.from_arrays([pa.array(doc[k]), pa.array(first[k]), pa.array(end[k]), third], names)

        held = []
        for batch in batches:
            known = batch.filter(batch.column(0).is_null())
            if known.num_rows:
                yield pa.RecordBatch.from_arrays([known.column(i) for i in (2, 3, 4, 0)], names)
            if known.num_rows < batch.num_rows:
                open_ = batch.filter(batch.column(0).is_valid())
                held.append([np.asarray(open_.column(i)) if i < 5 else np.asarray(open_.column(i).cast(pa.int8())) for i in range(6)])
        if not held:
            return
        v, content, doc, first, end, own = (np.concatenate([h[i] for h in held]) for i in range(6))
        order, anchor, new, same = _classes(v, content, doc, first)
        group = np.cumsum(anchor) - 1
        compare = (np.bincount(group, weights=new) > 1) | (np.bincount(group, weights=own[order]) > 0)
        later, need = order[~new & ~same], order[new & compare[group]]
        yield from out(doc[later], first[later], end[later])
        yield from out(doc[need], first[need], end[need], v[need])

    # runs that are settled already have no need to meet
    place = F.when(F.col("v").isNull(), F.xxhash64("doc_id", "first")).otherwise(F.col("v"))
    return rows.repartition(place).mapInArrow(run, "doc_id long, first long, end long, v long")


def cut_stretches(held: DataFrame) -> DataFrame:
    """(v, doc_id, place, length, bytes) of the stretches to compare."""
    def run(batches):
        import pyarrow as pa

        names = ["v", "doc_id", "place", "length", "bytes"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        batch_of = lambda rows: pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)
        for batch in batches:
            rows = []
            for doc, text, first, end, v in zip(*(batch.column(i).to_pylist() for i in range(5))):
                raw = text.encode("utf-8")
                for a, b, x in zip(first, end, v):
                    b = min(b, len(raw) - MATCH + 1)
                    if a < b:           # else the stretch is of another text under this id
                        rows.append((x, doc, a, b - a, raw[a: b + MATCH - 1]))
                if len(rows) > 20_000:
                    yield batch_of(rows)
                    rows = []
            if rows:
                yield batch_of(rows)

    rows = held.select("doc_id", "text", *[F.col(f"needs.{c}").alias(c) for c in ("first", "end", "v")])
    return rows.mapInArrow(run, "v long, doc_id long, place long, length long, bytes binary")


class Shard:
    """Layers of one shard's transform, and its windows in final suffix order.

    ``symbols[l]`` is the symbol column l of its windows, first to last."""

    def __init__(self, symbols: list[np.ndarray]):
        order = np.arange(len(symbols[0]))
        self.layers = []
        for column in reversed(symbols):
            before = column[order]
            self.layers.append(before)
            order = order[np.argsort(before, kind="stable")]
        self.order = order


def merge(shards: list[Shard]):
    """Interleave of the shards' suffixes by repeated refinement.

    Returns (shard of each merged suffix, whether it differs from the one before).
    Shard order breaks ties, and each shard's own order is kept throughout."""
    z = np.repeat(np.arange(len(shards), dtype=np.int16), [len(s.order) for s in shards])
    border = np.zeros(len(z), bool)
    border[:1] = True
    for level in range(len(shards[0].layers)):
        symbol = np.empty(len(z), shards[0].layers[0].dtype)
        symbol[np.argsort(z, kind="stable")] = np.concatenate([s.layers[level] for s in shards])
        block = np.cumsum(border, dtype=np.int32)
        deal = np.argsort(symbol, kind="stable")
        symbol, block, z = symbol[deal], block[deal], z[deal]
        border = np.ones(len(z), bool)
        border[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
    return z, border


def repeated(symbols: list[np.ndarray], shards: int = SHARDS) -> tuple[np.ndarray, np.ndarray]:
    """(window, first) of the windows that equal an earlier one, ``first``
    being the earliest; windows are given in their order of place."""
    n = len(symbols[0])
    cuts = np.linspace(0, n, max(1, min(shards, n)) + 1).astype(int)
    parts = [Shard([c[a:b] for c in symbols]) for a, b in zip(cuts[:-1], cuts[1:])]
    z, border = merge(parts)
    window = np.empty(n, np.int64)
    window[np.argsort(z, kind="stable")] = np.concatenate([s.order + a for s, a in zip(parts, cuts)])
    head = np.maximum.accumulate(np.where(border, np.arange(n), 0))
    later = ~border
    return window[later], window[head[later]]


def _window_symbols(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    h = gram_hashes(prefix_hash(data), STEP)
    return [h[at + STEP * k] for k in range(LEVELS)]


def _windows(doc, place, length, raw):
    """(bytes, place of every window in them, doc and place of every window)."""
    limits = np.concatenate([[0], np.cumsum([len(b) for b in raw])])
    data = np.frombuffer(b"".join(raw), np.uint8)
    step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
    return data, np.repeat(limits[:-1], length) + step, np.repeat(doc, length), np.repeat(place, length) + step


def _symbols_of(parts, passes: int, turn: int):
    """Symbols, doc and place of the parts' windows, in order of place; with
    several passes those whose first symbol falls to this turn (equal windows
    fall to the same one)."""
    doc, place, length = (np.concatenate([p[i] for p in parts]) for i in (0, 1, 2))
    raw = [b for p in parts for b in p[3]]
    order = np.lexsort((place, doc))
    out = []
    for lo in range(0, len(order), 20_000):
        some = order[lo: lo + 20_000]
        data, at, d, w = _windows(doc[some], place[some], length[some], [raw[i] for i in some])
        s = _window_symbols(data, at)
        mine = slice(None) if passes == 1 else s[0] % np.uint64(passes) == turn
        out.append([x[mine] for x in (*s, d, w)])
    cols = [np.concatenate(c) for c in zip(*out)]
    return cols[:LEVELS], cols[LEVELS], cols[LEVELS + 1]


def compared(segments: DataFrame) -> DataFrame:
    """(doc_id, first, end): runs of windows that are repeated among the
    stretches of one anchor."""
    def run(batches):
        import pyarrow as pa

        def compare(parts):
            passes = -(-sum(int(p[2].sum()) for p in parts) // (2 * CHUNK_WINDOWS))
            for turn in range(passes):
                symbols, d, w = _symbols_of(parts, passes, turn)
                again, first = repeated(symbols) if len(d) else (np.zeros(0, int),) * 2
                other = again[(d[again] != d[first]) | (w[again] != w[first])]
                cols = _merge_runs(d[other], w[other], w[other] + 1)
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], ["doc_id", "first", "end"])

        def parts():
            """The stretches of one anchor after the other; a large anchor
            comes in several parts."""
            for batch in batches:
                v, doc, place, length = (np.asarray(batch.column(i)) for i in range(4))
                raw = batch.column(4).to_pylist()
                cut = np.flatnonzero(np.diff(v)) + 1
                for a, b in zip(np.append(0, cut), np.append(cut, len(v))):
                    if a < b:
                        yield v[a], (doc[a:b], place[a:b], length[a:b], raw[a:b])

        held, size, last = [], 0, None
        for v, part in parts():
            if v != last and size >= CHUNK_WINDOWS:
                yield from compare(held)
                held, size = [], 0
            held.append(part)
            size += int(part[2].sum())
            last = v
        if held:
            yield from compare(held)

    return segments.repartition("v").sortWithinPartitions("v").mapInArrow(run, "doc_id long, first long, end long")


def _cut(rows: DataFrame, with_kept: bool) -> DataFrame:
    kept = ", kept binary" if with_kept else ""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            out = []
            for doc, text, runs in zip(*(batch.column(i).to_pylist() for i in range(3))):
                raw = text.encode("utf-8")
                at, removed, spans, pieces = 0, 0, 0, []
                for a, b in sorted((r["first"], r["end"] + MATCH - 1) for r in runs or ()):
                    b = min(b, len(raw))
                    if a > at or not spans:
                        pieces.append(raw[at:a])
                        spans += 1
                        removed += b - a
                    elif b > at:
                        removed += b - at
                    at = max(at, b)
                pieces.append(raw[at:])
                left = b"".join(pieces)
                out.append((doc, len(raw), removed, spans, hashlib.sha256(left).hexdigest(), left))
            cols = list(zip(*out)) or [()] * 6
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
            k = 6 if with_kept else 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols[:k], kinds)], names[:k])

    return rows.mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + kept)


def dedup(docs: DataFrame, with_kept: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document, and
    its remaining bytes if asked."""
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                       F.coalesce("text", F.lit("")).alias("text"))
    texts = docs.repartition("doc_id")
    settled = settle(anchor_rows(docs)).repartition("doc_id")
    needs = settled.where("v is not null").groupBy("doc_id").agg(F.collect_list(F.struct("first", "end", "v")).alias("needs"))
    found = compared(cut_stretches(texts.join(needs, "doc_id")))
    marks = settled.where("v is null").select("doc_id", "first", "end").unionAll(found)
    runs = marks.groupBy("doc_id").agg(F.collect_list(F.struct("first", "end")).alias("runs"))
    out = _cut(texts.join(runs, "doc_id", "left").select("doc_id", "text", "runs"), with_kept)
    return out.withColumn("doc_id", F.when(F.col("doc_id") != NULL_ID, F.col("doc_id")))
