"""Fill-in-middle transformation by an indexable skip list.

A text is cut into units (code points, words with the space after them, or
lines) and an indexable skip list is laid over them: every lane's nodes carry
how many units and how many code points (and bytes) they span, and a node is in
the next lane with odds of one in four, by a hash of its number.  A cut rank is
found by descending the lanes and adding up widths, so the units are counted
once a text, however many cuts are asked for, and a cut never falls inside a
code point.

A document's ranks and form come from the SHA-256 of ``seed:doc_id``: its first
four groups of eight hex digits h1 to h4.  The prefix ends after the smaller of
h1 % (n + 1) and h2 % (n + 1) units, the middle after the larger.  A text that
is empty or holds a marker stays plain, and so does one with
h3 % 100 >= ``fim_percent``; else h4 % 100 < ``spm_percent`` puts the suffix
first (``<S>suffix<P>prefix<M>middle``), otherwise ``<P>prefix<S>suffix<M>middle``.

Edge cases: a null text is an empty one; a null doc_id hashes as ``seed:``; rows
are treated alone, so repeated ids and texts change nothing; an empty table
gives no rows; texts of any length are cut whole; results replace columns of
their names and all other columns are passed through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tallyho.llm.bytes_words import NOT_SPACE, mix
from tallyho.llm.common import split_buffers

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, FIM_PERCENT, SPM_PERCENT = 1, 90, 20
UNITS = ("char", "word", "line")
SHARD_BYTES = 4 << 20
MADE = ["n", "form", "prefix_chars", "middle_chars", "output"]

_nodes: list[np.ndarray] = [np.zeros(0, np.int64)]     # numbers of the nodes of lane 1, 2, ... among the first _nodes_for units
_nodes_for = 0


def lane_nodes(n: int) -> list[np.ndarray]:
    """The numbers of the nodes of each express lane over ``n`` units, lowest
    lane first.  Node 0 is in every lane; a node's height depends on its number
    only, so lanes are kept from text to text."""
    global _nodes, _nodes_for
    if n > _nodes_for:
        size = max(1 << 16, 1 << n.bit_length())
        draw, at, lanes = mix(np.arange(1, size + 1, dtype=np.uint64)), np.arange(size), []
        while len(at) > 4:
            draw >>= np.uint64(2)
            up = (draw & np.uint64(3)) == 0
            up[0] = True
            at, draw = at[up], draw[up]
            lanes.append(at)
        _nodes, _nodes_for = lanes, size
    out = [x[:np.searchsorted(x, n)] for x in _nodes]
    return [x for x in out if len(x) > 1]


class SkipList:
    """Lanes over the units that start at the given bytes and code points."""

    def __init__(self, byte_at: np.ndarray, char_at: np.ndarray):
        """``byte_at``, ``char_at``: where each unit starts, and the ends."""
        self.n = len(byte_at) - 1
        self.lanes = []                                 # top first: (unit widths, code point widths, byte widths, nodes below)
        below = None
        for at in [np.arange(self.n), *lane_nodes(self.n)]:
            ends = np.append(at, self.n)
            down = np.zeros(0, np.int64) if below is None else np.searchsorted(below, at)
            self.lanes.append((np.diff(ends), np.diff(char_at[ends]), np.diff(byte_at[ends]), down))
            below = at
        self.lanes.reverse()

    def find(self, rank: int) -> tuple[int, int]:
        """(code points, bytes) before the unit number ``rank``."""
        units = chars = size = node = 0
        for lane, (unit_width, char_width, byte_width, down) in enumerate(self.lanes):
            while node < len(unit_width) and units + unit_width[node] <= rank:
                units += int(unit_width[node])
                chars += int(char_width[node])
                size += int(byte_width[node])
                node += 1
            if lane + 1 == len(self.lanes) or units == rank:
                break
            node = int(down[node]) if node < len(down) else len(self.lanes[lane + 1][0])
        return chars, size


def unit_starts(data: np.ndarray, unit: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, code points) at which the units of a UTF-8 text start, and the
    ends.  A word has the white space after it, a text's first one that before
    it too; a line has its line end."""
    first = (data & 0xC0) != 0x80
    if unit == "char":
        at = np.flatnonzero(first)
        return np.append(at, len(data)), np.arange(len(at) + 1)
    if unit == "word":
        word = NOT_SPACE[data]
        new = word.copy()
        new[1:] &= ~word[:-1]
    else:
        new = np.zeros(len(data), bool)
        new[1:] = data[:-1] == 10
    at = np.flatnonzero(new)
    if len(data):
        at = np.union1d([0], at[1:] if unit == "word" else at)
    at = np.append(at, len(data))
    return at, np.append(0, np.cumsum(first))[at]


def draws(seed: int) -> list[Column]:
    """h1 to h4 of each row's doc_id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, unit: str = "char", seed: int = SEED, fim_percent: int = FIM_PERCENT,
              spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` with ``n`` (units), ``form`` (plain, psm or spm),
    ``prefix_chars`` and ``middle_chars`` (code points; null if plain) and
    ``output``."""
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    rows = docs.drop(*MADE)
    kept = rows.columns
    source = kept.index("text")
    h = draws(seed)
    text = F.coalesce("text", F.lit(""))
    marked = text.contains(PREFIX) | text.contains(SUFFIX) | text.contains(MIDDLE)
    form = F.when((text == "") | marked | (h[2] % 100 >= fim_percent), "plain").when(h[3] % 100 < spm_percent, "spm").otherwise("psm")
    width = len(kept)

    def one(raw: bytes, form: str, h1: int, h2: int):
        skip = SkipList(*unit_starts(np.frombuffer(raw, np.uint8), unit))
        if form == "plain":
            return skip.n, None, None, raw
        ranks = sorted((h1 % (skip.n + 1), h2 % (skip.n + 1)))
        (c1, b1), (c2, b2) = skip.find(ranks[0]), skip.find(ranks[1])
        p, m, s = raw[:b1], raw[b1:b2], raw[b2:]
        out = b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m
        return skip.n, c1, c2 - c1, out

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            drawn = batch.column(width).to_pylist(), batch.column(width + 1).to_pylist(), batch.column(width + 2).to_pylist()
            done = 0
            for part, data, offsets, _ in split_buffers(pa.RecordBatch.from_arrays([batch.column(source)], ["t"]), "t", SHARD_BYTES):
                raw, m = data.tobytes(), len(part)
                forms, h1, h2 = (x[done:done + m] for x in drawn)
                found = [one(raw[offsets[k]: offsets[k + 1]], forms[k], h1[k], h2[k]) for k in range(m)]
                n, prefix, middle, out = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(done, m).columns[:width], pa.array(n, pa.int64()), pa.array(forms, pa.string()),
                     pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(out, pa.binary()).cast(pa.string())], [*kept, *MADE])
                done += m

    kinds = (LongType(), StringType(), LongType(), LongType(), StringType())
    schema = StructType([*rows.schema.fields, *[StructField(c, t) for c, t in zip(MADE, kinds)]])
    return rows.select(*kept, form.alias("_fim_form"), h[0].alias("_fim_h1"), h[1].alias("_fim_h2")).mapInArrow(run, schema)


def restore(rows: DataFrame) -> DataFrame:
    """``rows`` with ``restored``: the exact text, rebuilt from ``output`` and
    ``form`` alone."""
    part = F.split("output", "<[PSM]>", -1)
    psm, spm = F.concat(part[1], part[3], part[2]), F.concat(part[2], part[3], part[1])
    return rows.withColumn("restored", F.when(F.col("form") == "plain", F.col("output")).when(F.col("form") == "psm", psm).otherwise(spm))
