"""Periodic runs of words, detected on a Re-Pair grammar.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are
equal), of ``max(MIN_RUN, 2 q)`` words at least, that neither neighbour extends.

*Grammar.*  The words of every document in a task's slice are replaced pair by
pair.  A round counts all adjacent pairs of a document (overlapping ones once)
and replaces those that no more frequent pair overlaps, at all their places at
once; a pair that occurs once can never be replaced later, so only boundaries
with a repeated pair go into the next round.  Every replaced boundary is one
derivation of its nonterminal, so all derivation positions together are fewer
than the words.

*Runs.*  The smallest derivation that holds a run is split by the run.  So for
each nonterminal the runs across its one boundary are computed once, at its
first place and within its own words, and for what is left of the start rule
across each remaining boundary.  Such a run repeats three words at (or before)
the boundary at the distance of its period, so the periods to try come from
equal three-word stretches; how far a period reaches comes from hashes of
stretches of 1, 2, 4, ... words.

*Positions.*  The runs of a nonterminal are carried to all its derivations;
intervals of one period that overlap by a period or more are one run, and of
several periods for one interval the smallest is right.

Edge cases: null, empty and blank texts have no words and no runs; texts of any
length are handled whole (memory grows with the longest text of a task); every
row is treated alone, so repeated rows and null or equal ids change nothing; an
empty table gives no rows; the results replace columns of those names, and all
other columns are passed through.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from tallyho.llm.bytes_words import NOT_SPACE, find_words, mix, prefix_hash, range_hash
from tallyho.llm.common import WORD, split_buffers

MIN_RUN = 12
SHARD_BYTES = 2 << 20
CANDIDATES = 1 << 20            # compared at once
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TOP = 10                       # the longest hashed stretch has 2^10 words


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return mix(mix(a + _ODD) * _ODD + b)


def grammar(words: np.ndarray, limits: np.ndarray):
    """(rule, boundary, first, end) of every derivation of a nonterminal, and
    which adjacent words form a pair that their document repeats.

    ``words``: hashes; document ``d`` has words[limits[d]:limits[d + 1]]."""
    n = len(words)
    doc = np.repeat(np.arange(len(limits) - 1, dtype=np.uint64), np.diff(limits))
    symbol = mix(words + doc * _ODD)
    start = np.arange(n)
    end = start + 1
    joined = np.zeros(n, bool)              # symbol i and i + 1 may become one
    joined[:-1] = doc[:-1] == doc[1:]
    often, found = None, []
    while True:
        at = np.flatnonzero(joined)
        pair = _pair(symbol[at], symbol[at + 1])
        same = np.zeros(len(at), bool)      # overlaps the boundary before with the same pair
        same[1:] = (np.diff(at) == 1) & (pair[1:] == pair[:-1])
        order = np.arange(len(at))
        odd = (order - np.maximum.accumulate(np.where(same, 0, order))) % 2 == 1
        _, which = np.unique(pair, return_inverse=True)
        counts = np.bincount(which[~odd], minlength=1) if len(at) else np.zeros(1, int)
        count = counts[which]
        repeated = count >= 2
        joined[at[~repeated]] = False
        if often is None:
            often = joined.copy()
        at, pair, same, odd, which = (x[repeated] for x in (at, pair, same, odd, which))
        if not len(at):
            break
        rank = np.minimum(count[repeated], (1 << 24) - 1).astype(np.uint64) << np.uint64(40) | pair >> np.uint64(24)
        beside = np.diff(at) == 1
        take = ~odd
        take[1:] &= same[1:] | ~beside | (rank[1:] > rank[:-1])
        take[:-1] &= same[1:] | ~beside | (rank[:-1] >= rank[1:])
        # a rule needs two derivations
        take &= (np.bincount(which[take], minlength=len(counts)) >= 2)[which]
        left = at[take]
        if not len(left):
            break
        found.append((pair[take], start[left + 1], start[left], end[left + 1]))
        symbol[left] = mix(pair[take])
        end[left] = end[left + 1]
        joined[left] = joined[left + 1]
        keep = np.ones(len(symbol), bool)
        keep[left + 1] = False
        symbol, start, end, joined = symbol[keep], start[keep], end[keep], joined[keep]
        near = joined.copy()
        near[1:] |= joined[:-1]
        symbol, start, end, joined = symbol[near], start[near], end[near], joined[near]
    rules = [np.concatenate(x) for x in zip(*found)] if found else [np.zeros(0, np.uint64)] + [np.zeros(0, np.int64)] * 3
    return rules, often


def _stretches(words: np.ndarray, longest: int) -> list[np.ndarray]:
    """Hashes of the stretches of 1, 2, 4, ... words from every place."""
    out = [words]
    for k in range(min(_TOP, max(0, longest.bit_length() - 1))):
        half, last = 1 << k, out[-1]
        if len(last) <= half:
            break
        out.append(_pair(last[:-half], last[half:]))
    return out


def _reach(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray, room: np.ndarray, back: bool) -> np.ndarray:
    """How many words are equal from i and from j on (or before them), within
    ``room``."""
    got = np.zeros(len(i), np.int64)

    def step(rows, k):
        size = 1 << k
        rows = rows[room[rows] - got[rows] >= size]
        a, b = (i[rows] - got[rows] - size, j[rows] - got[rows] - size) if back else (i[rows] + got[rows], j[rows] + got[rows])
        rows = rows[levels[k][a] == levels[k][b]]
        got[rows] += size
        return rows

    rows = np.arange(len(i))
    while len(rows):
        rows = step(rows, len(levels) - 1)
    rows = np.arange(len(i))
    for k in range(len(levels) - 2, -1, -1):
        step(rows, k)
    return got


def _across(words, often, b, low, high, min_run):
    """(boundary number, start, end, period) of the runs across boundary
    ``b[k]`` within ``low[k]:high[k]``; for one interval the smallest period."""
    n, none = len(words), (np.zeros(0, np.int64),) * 4
    at = np.flatnonzero(often[:-1] & often[1:]) if n > 2 else np.zeros(0, np.int64)
    triple = _pair(_pair(words[at], words[at + 1]), words[at + 2]) if len(at) else np.zeros(0, np.uint64)
    # the document is part of the hash: equal triples elsewhere are apart anyway
    _, group, count = np.unique(triple, return_inverse=True, return_counts=True)
    at, group = at[count[group] > 1], group[count[group] > 1]
    if not len(at):
        return none
    group_at = np.full(n + 3, -1, np.int64)
    group_at[at] = group
    place = np.sort(group * (n + 1) + at)
    half = (high - low) // 2
    asked = []
    for shift in (0, 3):
        a = b - shift
        rows = np.flatnonzero((a >= low) & (a + 3 <= high))
        rows = rows[group_at[a[rows]] >= 0]
        g = group_at[a[rows]] * (n + 1)
        first = np.searchsorted(place, g + np.maximum(low[rows], a[rows] - half[rows]))
        last = np.searchsorted(place, g + np.minimum(high[rows] - 2, a[rows] + half[rows] + 1))
        asked.append((rows, a[rows], first, last - first))
    levels, out = None, []
    for rows, a, first, many in asked:
        ends = np.cumsum(many)
        lo = 0
        while lo < len(rows):
            hi = max(int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + CANDIDATES, side="right")), lo + 1)
            m = many[lo:hi]
            if m.sum() > (hi - lo):                 # a triple is always in its own list
                if levels is None:
                    levels = _stretches(words, int((high - low).max()))
                row = np.repeat(np.arange(lo, hi), m)
                which = np.arange(len(row)) - np.repeat(np.cumsum(m) - m, m) + first[row]
                away = place[which] % (n + 1) - a[row]
                row, away = row[away != 0], away[away != 0]
                k = rows[row]
                i = b[k] + np.minimum(away, 0)
                q = np.abs(away)
                forth = _reach(levels, i, i + q, high[k] - i - q, False)
                back = _reach(levels, i, i + q, i - low[k], True)
                run = (forth + back >= np.maximum(q, min_run - q)) & np.where(away < 0, forth > 0, back > 0)
                out.append((k[run], (i - back)[run], (i + q + forth)[run], q[run]))
            lo = hi
    if not out:
        return none
    k, s, e, q = (np.concatenate(x) for x in zip(*out))
    order = np.lexsort((q, e, s, k))
    k, s, e, q = (x[order] for x in (k, s, e, q))
    first = np.ones(len(k), bool)
    first[1:] = (k[1:] != k[:-1]) | (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    return k[first], s[first], e[first], q[first]


def find_runs(words: np.ndarray, limits: np.ndarray, min_run: int = MIN_RUN):
    """(document, start, end, period) of all runs, places counted over all
    documents, by document, start and period."""
    n = len(words)
    if not n:
        return (np.zeros(0, np.int64),) * 4
    (rule, boundary, first, end), often = grammar(words, limits)
    doc = np.repeat(np.arange(len(limits) - 1), np.diff(limits))
    top = np.ones(n, bool)                          # boundaries of the start rules, before a word
    top[limits[:-1][limits[:-1] < n]] = False
    top[boundary] = False
    top = np.flatnonzero(top)
    _, once, which = np.unique(rule, return_index=True, return_inverse=True)
    b = np.concatenate([boundary[once], top])
    low = np.concatenate([first[once], limits[doc[top]]])
    high = np.concatenate([end[once], limits[doc[top] + 1]])
    k, s, e, q = _across(words + doc.astype(np.uint64) * _ODD, often, b, low, high, min_run)
    # a nonterminal's runs at all its derivations
    own = k < len(once)
    order = np.argsort(which, kind="stable")
    many = np.bincount(which, minlength=len(once))
    begin = np.cumsum(many) - many
    times = many[k[own]]
    row = np.repeat(np.flatnonzero(own), times)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
    moved = boundary[order[begin[k[row]] + nth]] - b[k[row]]
    s, e, q = (np.concatenate([s[~own], s[row] + moved]), np.concatenate([e[~own], e[row] + moved]),
               np.concatenate([q[~own], q[row]]))
    if not len(s):
        return (np.zeros(0, np.int64),) * 4
    order = np.lexsort((s, q, doc[s]))
    s, e, q = s[order], e[order], q[order]
    # intervals of one document and period, merged
    new = np.ones(len(s), bool)
    new[1:] = (doc[s[1:]] != doc[s[:-1]]) | (q[1:] != q[:-1])
    base = np.cumsum(new) * (2 * n + 2)
    furthest = np.maximum.accumulate(e + base) - base
    new[1:] |= s[1:] > furthest[:-1] - q[1:]
    heads = np.flatnonzero(new)
    s, q, e = s[heads], q[heads], furthest[np.append(heads[1:], len(e)) - 1]
    order = np.lexsort((q, e, s))
    s, e, q = s[order], e[order], q[order]
    first = np.ones(len(s), bool)
    first[1:] = (s[1:] != s[:-1]) | (e[1:] != e[:-1])
    s, e, q = s[first], e[first], q[first]
    order = np.lexsort((q, s))
    return doc[s[order]], s[order], e[order], q[order]


def runs(docs: DataFrame, column: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (array of start, length, period, by
    start and period) and ``collapsed``: the words joined by one space, without
    those that a run has after its first period.  ``min_run`` is 12 or more: the
    search for periods relies on three equal words beside a boundary."""
    if min_run < 12:
        raise ValueError("min_run must be 12 or more")
    made = ["n_words", "runs", "collapsed"]
    rows = docs.drop(*made)
    kept = rows.columns
    at = kept.index(column)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for part, data, offsets, _ in split_buffers(pa.RecordBatch.from_arrays(
                    [batch.column(at), pa.array(np.arange(len(batch)))], ["t", "i"]), "t", SHARD_BYTES):
                start, end, row = find_words(data, offsets, NOT_SPACE)
                words = range_hash(prefix_hash(data), start, end)
                limits = np.searchsorted(row, np.arange(len(offsets)))
                doc, s, e, q = find_runs(words, limits, min_run)
                again = np.zeros(len(words) + 1, np.int64)
                np.add.at(again, s + q, 1)
                np.add.at(again, e, -1)
                keep = np.cumsum(again[:-1]) == 0
                raw, texts = data.tobytes(), []
                changed = np.zeros(len(offsets), bool)
                changed[doc] = True
                for d in range(len(part)):
                    found = raw[offsets[d]: offsets[d + 1]].split()
                    if changed[d]:
                        found = [found[i] for i in np.flatnonzero(keep[limits[d]: limits[d + 1]]).tolist()]
                    texts.append(b" ".join(found))
                from_doc = limits[doc]
                struct = pa.StructArray.from_arrays([pa.array(s - from_doc), pa.array(e - s), pa.array(q)], ["start", "length", "period"])
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(offsets))).astype(np.int32)), struct)
                own = batch.slice(int(part.column(1)[0].as_py()), len(part))
                yield pa.RecordBatch.from_arrays(
                    [*own.columns, pa.array(np.diff(limits)), lists, pa.array(texts, pa.binary()).cast(pa.string())], [*kept, *made])

    run_type = StructType([StructField(c, LongType()) for c in ("start", "length", "period")])
    schema = StructType([*rows.schema.fields, StructField("n_words", LongType()), StructField("runs", ArrayType(run_type)),
                         StructField("collapsed", StringType())])
    return rows.mapInArrow(run, schema)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id, text of every document; in those whose h = crc32(doc_id as
    text) is a multiple of 10, with g = h / 10, the words from a = g mod n on
    repeat with period 1 + (n - a) / (3 + g mod 8).  A null id plants nothing."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(F.col("h") / 10)
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), 1)).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, g % F.col("n")))
    rows = rows.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + g % 8)))
    again = F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda i: F.get(
        "w", F.when(i < F.col("a"), i).otherwise((F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")).cast("int")))
    return rows.select("doc_id", F.when(F.col("a").isNotNull(), F.array_join(again, " ")).otherwise(F.col("text")).alias("text"))


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run (the smallest start, then period, of
    several) with its exponent in thousandths, and digests of all runs and of
    the collapsed text."""
    longest = F.reduce("runs", F.expr("cast(null as struct<start:long,length:long,period:long>)"), lambda best, r: F.when(
        best.isNull() | (r["length"] > best["length"]), r).otherwise(best))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    rows = found.withColumn("l", longest)
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("l.start").alias("start"), F.col("l.length").alias("length"),
        F.col("l.period").alias("period"), F.expr("1000 * l.length div l.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
