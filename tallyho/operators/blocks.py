"""Cells and ratings laid out in blocks, so that only models and per-document
values move.

``lay_out`` writes three tables once, each bucketed by its key:

* ``cells(block, id, feat, x)`` by block – a block holds whole documents, except
  that a document of over ``hot_cells`` cells is dealt over all blocks;
* ``feats(feat, block)`` by feature – which blocks need a feature;
* ``ids(id, block)`` by document – which blocks need a document.

A product with a vector over features joins the vector to ``feats``, sends each
block its slice of the vector (features x blocks rows at most) and multiplies
inside the blocks: the sums by document need no exchange of cells.  A product
with per-document weights goes the same way through ``ids``; its sums by feature
leave a block as one row a feature.  No iteration exchanges ``cells``.

``pack_cells`` writes the cells for trainers, which meet them in every iteration:
in a grid of blocks of documents and parts of the features, each packed into
arrays of places.  The words of a block are kept once; what moves between blocks
and parts are arrays of numbers, one row a block and part, and cells are neither
sorted nor looked up by a word again.

``lay_out_ratings`` does the same for ratings, twice: in blocks of users and in
blocks of items, each with the lists of the users and items that a block needs.

``joined_on_grid`` joins ratings with both profiles once, in a grid of blocks: no
rating moves with a vector.  ``lay_out_grid`` writes the ratings once in such a
grid, for trainers: an iteration sends each profile, packed with others, to the
blocks of its row or column and gets its sums back from each.  A task keeps the
items of its block; users, ratings and sums pass through it in packed rows, so
its memory does not depend on the number of users or ratings of a block.

A model (and, for cells, the points) within the size bound of a broadcast needs
no layout: it is broadcast, the same sums are formed where the rows lie, and
nothing is written.  The results do not depend on the choice.
"""

from __future__ import annotations

import math
import sys
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from ..session import DISK_BACKED, bounded_broadcast, checkpoint_dir, cut_lineage, held_setting

# functions of this module travel to the executors, which need not have the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HOT_CELLS = 100_000
PACKED_CELLS = 4_000_000        # of a packed block, on the average
PACKED_BLOCKS = 32              # at least
GRID_RATINGS = 10_000_000       # of a block of a trainer's grid, on the average
GRID_ITEMS = 1_000_000          # of a column of a trainer's grid, on the average: their vectors and sums stay in a task's memory
GRID_PART = 1 << 16             # profiles of a part, on the average
GRID_ROW = 1 << 14              # profiles of a packed row, at most
GRID_STEP = 1 << 16             # ratings that a task joins with vectors at once
GRID_GROUP = 16 << 20           # bytes of a Parquet row group of packed ratings
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
READER_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def bucketed(df: DataFrame, by: str, buckets: int) -> tuple[DataFrame, str]:
    """``df`` written once as a table of ``buckets`` files by hash of ``by``, in
    the shared folder; and the table's name, for dropping it."""
    spark = df.sparkSession
    name = f"tallyho_{uuid.uuid4().hex}"
    (df.repartition(buckets, by).write.bucketBy(buckets, by).sortBy(by)
     .option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return spark.table(name), name


def co_partitioned(spark: SparkSession):
    """Inside, a join on (block, ...) may rely on its sides being partitioned by
    block alone.  Plans are made when an action starts, so actions belong
    inside."""
    return held_setting(spark, CO_PARTITION, "false")


@contextmanager
def short_batches(spark: SparkSession):
    """Inside, packed rows are read and go to Python in batches of a few MB: a
    Parquet batch of the usual number of rows would be a whole block of ratings."""
    with held_setting(spark, BATCH_BYTES, "4m"), held_setting(spark, READER_ROWS, "16"):
        yield


@dataclass
class CellBlocks:
    cells: DataFrame
    feats: DataFrame
    ids: DataFrame
    names: list[str]

    def drop(self) -> None:
        for name in self.names:
            self.cells.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    def products(self, vec: DataFrame) -> DataFrame:
        """``id, c``: <vec, x_id>, one row a document and block; documents
        without a common feature have none."""
        sent = self.feats.join(vec.select("feat", F.col("value").alias("_v")), "feat").select("block", "feat", "_v")
        near = self.cells.join(sent, ["block", "feat"])
        return near.groupBy("block", "id").agg(F.sum(F.col("x") * F.col("_v")).alias("c")).select("id", "c")

    def weighted(self, w: DataFrame) -> DataFrame:
        """``feat, g`` = x * w[id] of every cell; ``w``: (id, w)."""
        sent = self.ids.join(w.select("id", F.col("w").alias("_w")), "id").select("block", "id", "_w")
        return self.cells.join(sent, ["block", "id"]).select("feat", (F.col("_w") * F.col("x")).alias("g"))


@dataclass
class BroadcastCells:
    """Cells as they lie; vectors over features and documents are broadcast."""
    cells: DataFrame

    def __post_init__(self):
        self.cells = self.feats = self.cells.select("id", "feat", "x").persist(DISK_BACKED)

    def drop(self) -> None:
        self.cells.unpersist()

    def products(self, vec: DataFrame) -> DataFrame:
        side = F.broadcast(vec.select("feat", F.col("value").alias("_v")))
        return self.cells.join(side, "feat").select("id", (F.col("x") * F.col("_v")).alias("c"))

    def weighted(self, w: DataFrame) -> DataFrame:
        return self.cells.join(F.broadcast(w.select("id", F.col("w").alias("_w"))), "id").select("feat", (F.col("_w") * F.col("x")).alias("g"))


def _dealt(rows: DataFrame, key: str, other: str, blocks: int, hot_rows: int) -> DataFrame:
    """``rows`` with their block: by ``key``, and by ``other`` too for a key of
    over ``hot_rows`` rows."""
    hot = cut_lineage(rows.groupBy(key).count().where(F.col("count") > hot_rows).select(key, F.lit(True).alias("_hot")))
    block = F.pmod(F.when(F.col("_hot"), F.xxhash64(key, other)).otherwise(F.xxhash64(key)), F.lit(blocks)).cast("int")
    return rows.join(bounded_broadcast(hot), key, "left").withColumn("block", block).drop("_hot")


def _block_count(spark: SparkSession, blocks: int | None) -> int:
    return blocks or int(spark.conf.get("spark.sql.shuffle.partitions"))


def lay_out(cells: DataFrame, blocks: int | None = None, hot_cells: int = HOT_CELLS) -> CellBlocks:
    """``cells(id, feat, x)`` in ``blocks`` blocks (default: as many as the
    session's shuffle partitions)."""
    blocks = _block_count(cells.sparkSession, blocks)
    rows = _dealt(cells.select("id", "feat", "x"), "id", "feat", blocks, hot_cells)
    laid, first = bucketed(rows.select("block", "id", "feat", "x"), "block", blocks)
    feats, second = bucketed(laid.select("feat", "block").distinct(), "feat", blocks)
    ids, third = bucketed(laid.select("id", "block").distinct(), "id", blocks)
    return CellBlocks(laid, feats, ids, [first, second, third])


def _labels(spark: SparkSession, n: int) -> list[int]:
    """``n`` numbers that a hash partitioning into as many partitions keeps apart."""
    apart = spark.range(64 * n).select(F.col("id").cast("int").alias("label")).groupBy(F.pmod(F.hash("label"), F.lit(n)).alias("at")).agg(
        F.min("label").alias("label"))
    labels = [r["label"] for r in apart.orderBy("at").collect()]
    return labels + list(range(64 * n, 64 * n + n - len(labels)))


def _flat(c: pa.ChunkedArray) -> pa.Array:
    c = c.combine_chunks()
    return pa.concat_arrays(c.chunks) if isinstance(c, pa.ChunkedArray) else c


def _numbers(c: pa.ChunkedArray) -> np.ndarray:
    return _flat(c).fill_null(0.0).to_numpy(zero_copy_only=False)


def _places(values: pa.ChunkedArray, known: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Which of ``values`` are where in ``known``."""
    at = pc.index_in(_flat(values), value_set=known)
    found = np.flatnonzero(np.asarray(at.is_valid()))
    return found, at.take(pa.array(found)).to_numpy(zero_copy_only=False).astype(np.int64)


def _packed_block(labels: list[int]):
    """The cells of a block by part of the features: one row for each part with
    its words and the places of the cells' documents and words; and one with the
    block's documents."""
    def run(table):
        block = table.column("block")[0].as_py()
        feat, doc = (_flat(table.column(c)).dictionary_encode(null_encoding="encode") for c in ("feat", "id"))
        code, part = feat.indices.to_numpy(), table.column("part").to_numpy()
        part_of = np.empty(len(feat.dictionary), np.int64)
        part_of[code] = part
        order = np.argsort(part_of, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        first = np.searchsorted(part_of[order], np.arange(len(labels) + 1))
        cell = place[code]
        by = np.argsort(cell, kind="stable")
        cell, docs, x = cell[by], doc.indices.to_numpy()[by].astype(np.int32), _numbers(table.column("x"))[by]
        cut = np.searchsorted(cell, first)
        none_w, none_i = feat.dictionary.slice(0, 0), doc.dictionary.slice(0, 0)
        rows = [(-1, none_w, doc.dictionary, b"", b"", b"")]
        for p in np.flatnonzero(np.diff(first)).tolist():
            mine = slice(cut[p], cut[p + 1])
            rows.append((labels[p], feat.dictionary.take(pa.array(order[first[p]: first[p + 1]])), none_i, docs[mine].tobytes(),
                         (cell[mine] - first[p]).astype(np.int32).tobytes(), x[mine].tobytes()))
        lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(r[k]) for r in rows])).astype(np.int32)),
                                          pa.concat_arrays([r[k] for r in rows])) for k in (1, 2)]
        return pa.Table.from_arrays([pa.array([block] * len(rows), pa.int32()), pa.array([r[0] for r in rows], pa.int32()), *lists,
                                     *(pa.array([r[k] for r in rows], pa.binary()) for k in (3, 4, 5))],
                                    ["block", "part", "words", "ids", "doc", "feat", "x"])

    return run


def _packed_part(table):
    """The words of a part, and where those of each block are among them."""
    part, blocks, words = table.column("part")[0].as_py(), table.column("block").to_pylist(), _flat(table.column("words"))
    coded = words.flatten().dictionary_encode(null_encoding="encode")
    at, ends = coded.indices.to_numpy(), np.append(0, np.cumsum(words.value_lengths().to_numpy()))
    limits = pa.array([0, len(coded.dictionary), *[len(coded.dictionary)] * len(blocks)], pa.int32())
    places = [b"", *(at[lo:hi].astype(np.int32).tobytes() for lo, hi in zip(ends, ends[1:]))]
    return pa.Table.from_arrays(
        [pa.array([part] * len(places), pa.int32()), pa.array([-1, *blocks], pa.int32()),
         pa.ListArray.from_arrays(limits, coded.dictionary), pa.array(places, pa.binary())], ["part", "block", "words", "at"])


def _ints(c) -> np.ndarray:
    return np.frombuffer(c.as_py(), np.int32)


def _part_rows(parts) -> tuple[pa.Array, list]:
    """A part's words, and (block, places) of each block in order."""
    blocks = parts.column("block").to_pylist()
    own = blocks.index(-1)
    order = sorted((b, k) for k, b in enumerate(blocks) if k != own)
    return _flat(parts.column("words").slice(own, 1)).flatten(), [(b, _ints(parts.column("at")[k])) for b, k in order]


def _sent_slices(parts, vec):
    """The slices of a vector that the blocks of a part need, those without a value left out."""
    found = []
    if parts.num_rows and vec.num_rows:
        words, rows = _part_rows(parts)
        hit, at = _places(vec.column("feat"), words)
        value = np.bincount(at, _numbers(vec.column("value"))[hit], len(words))
        part = parts.column("part")[0].as_py()
        found = [(b, part, value[places].tobytes()) for b, places in rows if value[places].any()]
    return pa.Table.from_pylist([dict(zip(("block", "part", "v"), r)) for r in found],
                                pa.schema([("block", pa.int32()), ("part", pa.int32()), ("v", pa.binary())]))


def _block_cells(cells):
    """A block's documents, and (part, doc, feat, x) of its cells in order."""
    parts = cells.column("part").to_pylist()
    own = parts.index(-1)
    order = sorted((p, k) for k, p in enumerate(parts) if k != own)
    docs = _flat(cells.column("ids").slice(own, 1)).flatten()
    return docs, [(p, _ints(cells.column("doc")[k]), _ints(cells.column("feat")[k]), np.frombuffer(cells.column("x")[k].as_py()))
                  for p, k in order]


def _block_products(cells, sent):
    """Sums by document of a block from the slices sent to it."""
    if not cells.num_rows or not sent.num_rows:
        return pa.Table.from_arrays([_flat(cells.column("ids")).flatten().slice(0, 0), pa.array([], pa.float64())], ["id", "c"])
    docs, rows = _block_cells(cells)
    slices = dict(zip(sent.column("part").to_pylist(), sent.column("v").to_pylist()))
    total = np.zeros(len(docs))
    for part, doc, feat, x in rows:
        if part in slices:
            total += np.bincount(doc, x * np.frombuffer(slices[part])[feat], len(docs))
    some = np.flatnonzero(total)
    return pa.Table.from_arrays([docs.take(pa.array(some)), pa.array(total[some])], ["id", "c"])


def _block_weighted(cells, sent):
    """Sums by feature of a block, one row a part; ``seen``: which features
    have a document with a weight, empty if all have."""
    found = []
    if cells.num_rows and sent.num_rows:
        docs, rows = _block_cells(cells)
        hit, at = _places(sent.column("id"), docs)
        w, n = np.bincount(at, _numbers(sent.column("w"))[hit], len(docs)), np.bincount(at, minlength=len(docs))
        block = cells.column("block")[0].as_py()
        for part, doc, feat, x in rows:
            g = np.bincount(feat, x * w[doc])
            seen = np.bincount(feat, n[doc]) > 0
            if seen.any():
                found.append((part, block, g.tobytes(), b"" if seen.all() else seen.tobytes()))
    return pa.Table.from_pylist([dict(zip(("part", "block", "g", "seen"), r)) for r in found],
                                pa.schema([("part", pa.int32()), ("block", pa.int32()), ("g", pa.binary()), ("seen", pa.binary())]))


def _part_sums(parts, sent):
    """Sums by feature of a part from those of the blocks, in their order."""
    if not parts.num_rows or not sent.num_rows:
        return pa.Table.from_arrays([_flat(parts.column("words")).flatten().slice(0, 0), pa.array([], pa.float64())], ["feat", "g"])
    words, rows = _part_rows(parts)
    got = {b: (g, s) for b, g, s in zip(*(sent.column(c).to_pylist() for c in ("block", "g", "seen")))}
    total, seen = np.zeros(len(words)), np.zeros(len(words), bool)
    for block, at in rows:
        if block in got:
            g, s = got[block]
            total[at] += np.frombuffer(g)
            seen[at] |= np.frombuffer(s, bool) if s else True
    some = np.flatnonzero(seen)
    return pa.Table.from_arrays([words.take(pa.array(some)), pa.array(total[some])], ["feat", "g"])


@dataclass
class PackedCells:
    """Cells in blocks of documents and parts of features, packed."""
    cells: DataFrame            # block, part, words, ids, doc, feat, x
    parts: DataFrame            # part, block, words, at
    ids: DataFrame              # id, block
    labels: list[int]
    names: list[str]

    @property
    def feats(self) -> DataFrame:
        return self.parts.where("block = -1").select(F.explode("words").alias("feat"))

    def drop(self) -> None:
        for name in self.names:
            self.cells.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    def products(self, vec: DataFrame) -> DataFrame:
        """``id, c``: <vec, x_id>, one row a document and block; documents
        without a common feature have none."""
        part = F.element_at(F.array(*map(F.lit, self.labels)), _part_of(len(self.labels)) + 1)
        vec = vec.where("feat is not null").select(part.alias("part"), "feat", F.col("value").cast("double").alias("value"))
        sent = self.parts.groupBy("part").cogroup(vec.groupBy("part")).applyInArrow(_sent_slices, "block int, part int, v binary")
        near = self.cells.select("block", "part", "ids", "doc", "feat", "x")
        kind = StructType([StructField("id", self.ids.schema["id"].dataType), StructField("c", DoubleType())])
        return near.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_block_products, kind)

    def weighted(self, w: DataFrame) -> DataFrame:
        """``feat, g``: sums of x * w[id] over the cells, one row a feature; ``w``: (id, w)."""
        # merged, so that no weight passes through the driver
        sent = self.ids.hint("shuffle_merge").join(w.select("id", F.col("w").cast("double").alias("w")), "id").select("block", "id", "w")
        near = self.cells.select("block", "part", "ids", "doc", "feat", "x")
        found = near.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(_block_weighted, "part int, block int, g binary, seen binary")
        kind = StructType([StructField("feat", self.feats.schema["feat"].dataType), StructField("g", DoubleType())])
        return self.parts.groupBy("part").cogroup(found.groupBy("part")).applyInArrow(_part_sums, kind)


def _part_of(n: int):
    return F.pmod(F.xxhash64("feat"), F.lit(n)).cast("int")


def pack_cells(cells: DataFrame, blocks: int | None = None, hot_cells: int = HOT_CELLS) -> PackedCells:
    """``cells(id, feat, x)`` written once, packed, in ``blocks`` blocks (default:
    of about ``PACKED_CELLS`` cells, ``PACKED_BLOCKS`` at least) and as many
    parts.  A document of over ``hot_cells`` cells is dealt over all blocks."""
    spark = cells.sparkSession
    n = blocks or max(PACKED_BLOCKS, -(-cells.count() // PACKED_CELLS))
    labels = _labels(spark, n)
    rows = _dealt(cells.select("id", "feat", F.coalesce(F.col("x").cast("double"), F.lit(0.0)).alias("x")), "id", "feat", n, hot_cells)
    rows = rows.select(F.element_at(F.array(*map(F.lit, labels)), F.col("block") + 1).alias("block"), _part_of(n).alias("part"), "id", "feat", "x")
    types = {c: cells.schema[c].dataType for c in ("id", "feat")}
    kind = StructType([StructField("block", IntegerType()), StructField("part", IntegerType()), StructField("words", ArrayType(types["feat"])),
                       StructField("ids", ArrayType(types["id"])), *(StructField(c, BinaryType()) for c in ("doc", "feat", "x"))])
    laid, first = _kept(rows.groupBy("block").applyInArrow(_packed_block(labels), kind), "block", n)
    parts = laid.where("part >= 0").select("part", "block", "words").groupBy("part").applyInArrow(
        _packed_part, StructType([kind["part"], kind["block"], kind["words"], StructField("at", BinaryType())]))
    parts, second = _kept(parts, "part", n)
    ids, third = bucketed(laid.where("part = -1").select(F.explode("ids").alias("id"), "block"), "id", n)
    return PackedCells(laid, parts, ids, labels, [first, second, third])


def _kept(rows: DataFrame, by: str, n: int) -> tuple[DataFrame, str]:
    """Packed rows in a table of ``n`` buckets, and its name."""
    name = f"tallyho_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(rows.sparkSession).rstrip('/')}/{name}"
    rows.repartition(n, by).write.bucketBy(n, by).option("path", path).saveAsTable(name)
    return rows.sparkSession.table(name), name


@dataclass
class RatingBlocks:
    """Ratings (block, i, j, r, fold) in blocks of one side, and which blocks
    need a user or an item."""
    ratings: DataFrame
    users: DataFrame            # i, block
    items: DataFrame            # j, block
    names: list[str]

    def drop(self) -> None:
        for name in self.names:
            self.ratings.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    def summed(self, parts: DataFrame, by: list[str]) -> DataFrame:
        """Sums of ``parts`` inside the blocks."""
        return parts.groupBy("block", *by).agg(*[F.sum(c).alias(c) for c in parts.columns if c not in ("block", *by)]).drop("block")

    def joined(self, U: DataFrame, V: DataFrame) -> DataFrame:
        """``block, f, i, j, r, fold, u, v``: every rating once for each model
        ``f`` that has both profiles; U (f, i, u) and V (f, j, v) move, ratings
        do not."""
        us = self.users.join(U.select("f", "i", "u"), "i").select("block", "f", "i", "u")
        vs = self.items.join(V.select("f", "j", "v"), "j").select("block", "f", "j", "v")
        return self.ratings.join(us, ["block", "i"]).join(vs, ["block", "f", "j"])


@dataclass
class BroadcastRatings:
    """Ratings (i, j, r, fold) as they lie; profiles are broadcast."""
    ratings: DataFrame

    def drop(self) -> None:
        self.ratings.unpersist()

    def summed(self, parts: DataFrame, by: list[str]) -> DataFrame:
        return parts.drop("block")              # the caller's aggregate sums them in part where they lie

    def joined(self, U: DataFrame, V: DataFrame) -> DataFrame:
        us, vs = F.broadcast(U.select("f", "i", "u")), F.broadcast(V.select("f", "j", "v"))
        return self.ratings.withColumn("block", F.lit(0)).join(us, "i").join(vs, ["f", "j"])


def lay_out_ratings(ratings: DataFrame, side: str, blocks: int | None = None, hot_ratings: int = HOT_CELLS) -> RatingBlocks:
    """``ratings(i, j, r, fold)`` in blocks of users (``side='i'``) or items
    (``'j'``); one with over ``hot_ratings`` ratings is dealt over all blocks."""
    blocks = _block_count(ratings.sparkSession, blocks)
    rows = _dealt(ratings.select("i", "j", "r", "fold"), side, "j" if side == "i" else "i", blocks, hot_ratings)
    laid, first = bucketed(rows.select("block", "i", "j", "r", "fold"), "block", blocks)
    users, second = bucketed(laid.select("i", "block").distinct(), "i", blocks)
    items, third = bucketed(laid.select("j", "block").distinct(), "j", blocks)
    return RatingBlocks(laid, users, items, [first, second, third])


def grid_side(spark: SparkSession, blocks: int | None = None) -> int:
    """Side of the grid of blocks: a quarter as many blocks as the session has
    shuffle partitions (16 at least), or ``blocks``."""
    return max(1, math.isqrt(blocks - 1) + 1) if blocks else max(4, math.isqrt(_block_count(spark, None) // 4))


def fits_grid(ratings: DataFrame, U: DataFrame, V: DataFrame) -> bool:
    """Whether ids are whole numbers and both sides have vectors of one type."""
    kinds = [t.schema[c].dataType for t, c in ((ratings, "i"), (U, "i"), (ratings, "j"), (V, "j"))]
    return (kinds[0] == kinds[1] and kinds[2] == kinds[3] and all(isinstance(k, (IntegerType, LongType)) for k in kinds)
            and U.schema["u"].dataType == V.schema["v"].dataType)


class _Profiles:
    """Profiles of a block by id."""

    def __init__(self, parts: list, key: str):
        ids = np.concatenate([p.column(key).to_numpy(zero_copy_only=False) for p in parts]) if parts else np.zeros(0, "int64")
        order = np.argsort(ids, kind="stable")
        self.ids = ids[order]
        self.vectors = pa.concat_arrays([p.column("p") for p in parts]).take(pa.array(order)) if parts else None

    def matched(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of ``keys`` have which vectors."""
        first, last = (np.searchsorted(self.ids, keys, s) for s in ("left", "right"))
        n = last - first
        rows = np.repeat(np.arange(len(keys)), n)
        return rows, first[rows] + np.arange(len(rows)) - (np.cumsum(n) - n)[rows]


def _met(batches):
    """Rows of a block in the order users, items, ratings: ``i, j, r, u, v``."""
    block = users = items = None
    for batch in batches:
        code = batch.column("block").to_numpy() * 3 + batch.column("kind").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(code)) + 1), len(code)]
        for lo, hi in zip(cuts, cuts[1:]):
            if lo == hi:
                continue
            part, (at, kind) = batch.slice(lo, hi - lo), divmod(int(code[lo]), 3)
            if at != block:
                block, sides, users, items = at, ([], []), None, None
            if kind < 2:
                sides[kind].append(part)
                continue
            if users is None:
                users, items = _Profiles(sides[0], "i"), _Profiles(sides[1], "j")
            rows, u = users.matched(part.column("i").to_numpy(zero_copy_only=False))
            more, v = items.matched(part.column("j").to_numpy(zero_copy_only=False)[rows])
            if len(more):
                rows = pa.array(rows[more])
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(rows) for c in "ijr"), users.vectors.take(pa.array(u[more])),
                     items.vectors.take(pa.array(v))], names=list("ijruv"))


def joined_on_grid(ratings: DataFrame, U: DataFrame, V: DataFrame, blocks: int | None = None) -> DataFrame:
    """``i, j, r, u, v``: ratings (i, j, r) with the profiles U (i, u) and V (j, v),
    inner joins, met in a grid of blocks (hash of i, hash of j).

    A rating goes to one block and without a vector; a profile goes to the blocks
    of its row or column.  A task keeps the profiles of its block and streams the
    ratings; one of a user or item of any number of ratings lies in a whole row
    or column of blocks."""
    n = grid_side(ratings.sparkSession, blocks)
    row, column = (F.pmod(F.xxhash64(c), F.lit(n)).cast("int") for c in "ij")
    every = F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    at = lambda r, c: (r * n + c).cast("int").alias("block")
    none = lambda df, c: F.lit(None).cast(df.schema[c].dataType).alias(c)
    kind = lambda k: F.lit(k).alias("kind")
    vector = U.schema["u"].dataType
    # an empty vector and not null: millions of null arrays take long to become Arrow
    R = ratings.where("i is not null and j is not null").select(
        at(row, column), kind(2), "i", "j", "r", F.array().cast(vector).alias("p"))
    us = U.where("i is not null").select("i", "u", every.alias("_k")).select(
        at(row, F.col("_k")), kind(0), "i", none(ratings, "j"), none(ratings, "r"), F.col("u").alias("p"))
    vs = V.where("j is not null").select("j", "v", every.alias("_k")).select(
        at(F.col("_k"), column), kind(1), none(ratings, "i"), "j", none(ratings, "r"), F.col("v").alias("p"))
    rows = us.unionByName(vs).unionByName(R).repartitionById(n * n, "block").sortWithinPartitions("block", "kind")
    schema = StructType([*(StructField(c, ratings.schema[c].dataType) for c in "ijr"),
                         StructField("u", vector), StructField("v", vector)])
    return rows.mapInArrow(_met, schema)


def _packed(batches):
    """Rows of packed ratings, at most one a batch, block and group of users."""
    for batch in batches:
        block, sub = (batch.column(c).to_numpy() for c in ("block", "sub"))
        order = np.lexsort((sub, block))
        cut = np.flatnonzero(np.diff(block[order]) | np.diff(sub[order])) + 1
        for rows in np.split(order, cut):
            if len(rows):
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array([c[rows[0]]], pa.int32()) for c in (block, sub)),
                     *(pa.array([batch.column(c).to_numpy()[rows].tobytes()], pa.binary()) for c in ("i", "j", "r", "fold"))],
                    ["block", "sub", "i", "j", "r", "fold"])


PROFILE_KEYS = "kind int, f int, line int, sub int, "
PACKED_PROFILES = PROFILE_KEYS + "ids binary, p binary"
PACKED_SUMS = PACKED_PROFILES + ", se double, n long, se_held double, n_held long"
PACKED_STEP = PACKED_SUMS + ", norm double"
PACKED_COLUMNS = [x.split()[0] for x in PACKED_PROFILES.split(",")]


def _packed_rows(keys: tuple, ids: np.ndarray, vectors: np.ndarray, *rest) -> list[tuple]:
    """Packed rows of ids and their vectors, ``GRID_ROW`` at most in each."""
    return [(*keys, ids[lo: lo + GRID_ROW].tobytes(), np.ascontiguousarray(vectors[lo: lo + GRID_ROW]).tobytes(), *rest)
            for lo in range(0, len(ids), GRID_ROW)]


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "double": pa.float64(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(",")]
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)],
                                      [name for name, _ in fields])


def _bytes(c: pa.Array, k: int, kind=np.float64) -> np.ndarray:
    """The numbers of a packed value, which keep the batch as long as they are used."""
    _, ends, data = c.buffers()
    lo, hi = np.frombuffer(ends, np.int32)[c.offset + k: c.offset + k + 2]
    return np.frombuffer(data, np.uint8)[lo:hi].view(kind) if hi > lo else np.zeros(0, kind)


def _packed_profiles(d: int):
    """Profiles of one part as they come, packed."""
    def run(batches):
        for batch in batches:
            at = _batch_keys(batch)
            f, ids = batch.column("f").to_numpy(), batch.column("id").to_numpy()
            vectors = batch.column("p").flatten().to_numpy().reshape(-1, d)
            order = np.lexsort((ids, f))
            for rows in np.split(order, np.flatnonzero(np.diff(f[order])) + 1):
                if len(rows):
                    yield _batch(_packed_rows((at[0], int(f[rows[0]]), *at[1:]), ids[rows], vectors[rows]), PACKED_PROFILES)

    return run


def _batch_keys(batch) -> tuple[int, int, int]:
    return tuple(batch.column(c)[0].as_py() for c in ("kind", "line", "sub"))


def _unpacked(d: int):
    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                ids, p = _bytes(batch.column("ids"), k, np.int64), _bytes(batch.column("p"), k)
                ends = pa.array(np.arange(len(ids) + 1, dtype=np.int32) * d)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(ids), batch.column("f")[k].as_py()), pa.int32()), pa.array(ids),
                     pa.ListArray.from_arrays(ends, pa.array(p))], ["f", "id", "p"])

    return run


class _Side:
    """Vectors of one model's users or items by id, from packed rows, which are
    given up one by one; an id may have several."""

    def __init__(self, rows: list[tuple], d: int):
        ids = np.concatenate([r[1] for r in rows])
        order = np.argsort(ids, kind="stable")
        rank = np.empty(len(ids), np.int64)
        rank[order] = np.arange(len(ids))
        part = np.empty(len(ids), np.int32)
        self.ids, self.vectors, self.parts, lo = ids[order], np.empty((len(ids), d)), [], 0
        while rows:
            at, own, vectors = rows.pop()
            hi = len(ids) - lo
            mine = rank[hi - len(own): hi]
            self.vectors[mine] = vectors.reshape(-1, d)
            if at not in self.parts:
                self.parts.append(at)
            part[mine] = self.parts.index(at)
            lo += len(own)
        self.keys, first, self.place = np.unique(self.ids, return_index=True, return_inverse=True)
        self.part = part[first]
        self.sums, self.seen = np.zeros((len(self.keys), d)), np.zeros(len(self.keys), bool)

    matched = _Profiles.matched

    def add(self, rows: np.ndarray, e: np.ndarray, other: np.ndarray) -> None:
        """``2 e * other`` to the sums of the ids of ``rows``."""
        if len(rows):
            at = self.place[rows]
            order = np.argsort(at, kind="stable")
            at = at[order]
            first = np.append(0, np.flatnonzero(np.diff(at)) + 1)
            self.sums[at[first]] += np.add.reduceat((2.0 * e[order])[:, None] * other[order], first)
            self.seen[at[first]] = True

    def packed(self, kind: int, f: int):
        """Sums of the ids with ratings, in packed rows by part."""
        for p, (line, sub) in enumerate(self.parts):
            mine = np.flatnonzero(self.seen & (self.part == p))
            for lo in range(0, len(mine), GRID_ROW):
                at = mine[lo: lo + GRID_ROW]
                yield _batch(_packed_rows((kind, f, line, sub), self.keys[at], self.sums[at], None, None, None, None), PACKED_SUMS)


def _block_sums(d: int):
    """Sums of a block from its rows in the order: items; then of each group of
    users, users and ratings.  The items stay, users and ratings pass."""
    def run(batches):
        sides, waiting, totals, group = ({}, {}), [], {}, None

        def ready(kind: int) -> dict:
            for f, side in sides[kind].items():
                if isinstance(side, list):
                    sides[kind][f] = _Side(side, d)
            return sides[kind]

        def meet() -> None:
            """The waiting ratings, ``GRID_STEP`` at once."""
            if not waiting:
                return
            ratings = [np.concatenate(c) for c in zip(*waiting)]
            waiting.clear()
            items = ready(1)
            for f, users in ready(0).items():
                if f not in items:
                    continue
                total = totals[f]
                for lo in range(0, len(ratings[0]), GRID_STEP):
                    i, j, r, fold = (c[lo: lo + GRID_STEP] for c in ratings)
                    rows, a = users.matched(i)
                    more, b = items[f].matched(j[rows])
                    rows, a = rows[more], a[more]
                    u, v = users.vectors[a], items[f].vectors[b]
                    e = np.einsum("nk,nk->n", u, v) - r[rows]
                    trained = fold[rows] != f
                    total[2] += float(np.square(e[~trained]).sum())
                    total[3] += int((~trained).sum())
                    if not trained.all():
                        a, b, u, v, e = (x[trained] for x in (a, b, u, v, e))
                    total[0] += float(np.square(e).sum())
                    total[1] += len(e)
                    users.add(a, e, v)
                    items[f].add(b, e, u)

        def sums(kind: int):
            for f, side in sides[kind].items():
                if isinstance(side, _Side):
                    yield from side.packed(kind, f)
            sides[kind].clear()

        for batch in batches:
            kinds, groups, models, lines, subs = (batch.column(c).to_pylist() for c in ("kind", "at", "f", "line", "sub"))
            a, b, c, e = (batch.column(x) for x in ("a", "b", "c", "e"))
            for k, kind in enumerate(kinds):
                if groups[k] != group:
                    meet()
                    yield from sums(0)
                    group = groups[k]
                if kind < 2:
                    totals.setdefault(models[k], [0.0, 0, 0.0, 0])
                    sides[kind].setdefault(models[k], []).append(((lines[k], subs[k]), _bytes(a, k, np.int64), _bytes(b, k)))
                elif sides[0] and sides[1]:
                    waiting.append((_bytes(a, k, np.int64), _bytes(c, k, np.int64), _bytes(b, k), _bytes(e, k, np.int32)))
                    if sum(len(w[0]) for w in waiting) >= GRID_STEP:
                        meet()
        meet()
        yield from sums(0)
        yield from sums(1)
        yield _batch([(2, f, 0, 0, None, None, *total) for f, total in totals.items()], PACKED_SUMS)

    return run


def _stepped(d: int, gamma: float, shrinks: tuple[float, float]):
    """Profiles of one part after a step from the old ones, which come first, and
    their sums; those without a rating are left out."""
    def run(batches):
        old, sides, at = {}, {}, None
        for batch in batches:
            at = _batch_keys(batch)
            for k, (f, tag) in enumerate(zip(batch.column("f").to_pylist(), batch.column("tag").to_pylist())):
                if at[0] == 2:
                    yield _batch([(2, f, 0, 0, None, None, *(batch.column(c)[k].as_py() for c in ("se", "n", "se_held", "n_held")), None)],
                                 PACKED_STEP)
                    continue
                ids, p = _bytes(batch.column("ids"), k, np.int64), _bytes(batch.column("p"), k).reshape(-1, d)
                if not tag:
                    old.setdefault(f, []).append((ids, p))
                    continue
                if f not in sides:
                    keys, place = np.unique(np.concatenate([x for x, _ in old[f]]), return_inverse=True)
                    before = np.zeros((len(keys), d))
                    np.add.at(before, place, np.concatenate([x for _, x in old.pop(f)]))
                    sides[f] = keys, before, np.zeros((len(keys), d)), np.zeros(len(keys), bool)
                keys, _, g, seen = sides[f]
                mine = np.searchsorted(keys, ids)
                g[mine] += p
                seen[mine] = True
        for f, (keys, before, g, seen) in sides.items():
            keys, before, g = keys[seen], before[seen], g[seen]
            after = before - gamma * g - shrinks[at[0]] * before
            for lo in range(0, len(keys), GRID_ROW):
                part = slice(lo, lo + GRID_ROW)
                yield _batch(_packed_rows((at[0], f, *at[1:]), keys[part], after[part], None, None, None, None,
                                          float(np.square(before[part]).sum())), PACKED_STEP)

    return run


@dataclass
class RatingGrid:
    """Ratings in ``n * columns`` blocks by hash of user and item, packed;
    ``labels`` name the blocks.  The users of a row are in ``user_parts`` parts
    by another hash, those of a block's ratings too; the items of a column are in
    ``item_parts``.

    A trainer keeps the profiles packed as well, by part (``PACKED_PROFILES``;
    kind 0: users, 1: items; line: row or column)."""
    ratings: DataFrame          # block, sub, i, j, r, fold
    labels: list[int]
    n: int
    columns: int
    user_parts: int
    item_parts: int
    names: list[str]

    def drop(self) -> None:
        for name in self.names:
            self.ratings.sparkSession.sql(f"DROP TABLE IF EXISTS {name}")

    def packed(self, U: DataFrame, V: DataFrame, d: int) -> DataFrame:
        """The profiles U (f, i, u) and V (f, j, v), packed by part."""
        def side(rows, kind, key, own, lines, parts):
            wrong = F.raise_error(F.lit(f"vectors must have {d} entries")).cast("array<double>")
            # the error of a profile without a vector or with a null in it is null
            whole = rows.where(F.col(key).isNotNull() & F.col(own).isNotNull() & ~F.exists(own, lambda x: x.isNull()))
            return whole.select(F.lit(kind).alias("kind"), F.col("f").cast("int").alias("f"), _line(key, lines).alias("line"),
                                _line(key, parts, 1).alias("sub"), F.col(key).cast("long").alias("id"),
                                F.when(F.size(own) == d, F.col(own).cast("array<double>")).otherwise(wrong).alias("p"))

        rows = side(U, 0, "i", "u", self.n, self.user_parts).unionAll(side(V, 1, "j", "v", self.columns, self.item_parts))
        return rows.groupBy("kind", "line", "sub").applyInArrow(_streamed(_packed_profiles(d)), PACKED_PROFILES)

    def unpacked(self, state: DataFrame, d: int) -> tuple[DataFrame, DataFrame]:
        """(f, i, u) and (f, j, v) of packed profiles."""
        schema = StructType([StructField("f", IntegerType()), StructField("id", LongType()), StructField("p", ArrayType(DoubleType()), False)])
        both = (state.where(F.col("kind") == k).select("f", "ids", "p").mapInArrow(_unpacked(d), schema) for k in (0, 1))
        return tuple(rows.toDF("f", *names) for rows, names in zip(both, (("i", "u"), ("j", "v"))))

    def sums(self, U: DataFrame, V: DataFrame, d: int) -> DataFrame:
        return self.summed(self.packed(U, V, d), d)

    def summed(self, state: DataFrame, d: int) -> DataFrame:
        """``PACKED_SUMS`` from packed profiles: for each block and model the sums
        of ``2 delta`` times the other side's vector over the training ratings of
        each user (kind 0) and item (1) that has any; and one row (kind 2) with
        squared errors and numbers of training and of held-out ratings.
        Profiles move, to the blocks of their row or column; ratings do not."""
        user = F.col("kind") == 0
        every = F.explode(F.sequence(F.lit(0), F.when(user, F.lit(self.columns)).otherwise(F.lit(self.n)) - 1)).alias("_k")
        at = F.when(user, F.col("line") * self.columns + F.col("_k")).otherwise(F.col("_k") * self.columns + F.col("line"))
        none = lambda kind, *names: [F.lit(None).cast(kind).alias(c) for c in names]
        sent = state.select(*PACKED_COLUMNS, every).select(
            F.element_at(F.array(*map(F.lit, self.labels)), at + 1).alias("block"), F.when(user, F.col("sub")).otherwise(F.lit(-1)).alias("at"),
            "kind", "f", "line", "sub", F.col("ids").alias("a"), F.col("p").alias("b"), *none("binary", "c", "e"))
        ratings = self.ratings.select("block", F.col("sub").alias("at"), F.lit(2).alias("kind"), *none("int", "f", "line", "sub"),
                                      F.col("i").alias("a"), F.col("r").alias("b"), F.col("j").alias("c"), F.col("fold").alias("e"))
        # both sides lie by block, and so does their union: only the profiles are exchanged
        rows = sent.repartition(len(self.labels), "block").unionAll(ratings).sortWithinPartitions("block", "at", "kind")
        return rows.groupBy("block").applyInArrow(_streamed(_block_sums(d)), PACKED_SUMS)

    def stepped(self, state: DataFrame, gamma: float, lam: float, mu: float, d: int) -> DataFrame:
        """``PACKED_STEP``: the packed profiles with training ratings after a step,
        ``norm`` that of the profiles of a row before it; and the rows of kind 2 of
        :meth:`summed`."""
        sums, old = self.summed(state, d), state.select(*PACKED_COLUMNS)
        old = old.select(*PACKED_COLUMNS, *[F.lit(None).cast(sums.schema[c].dataType).alias(c) for c in sums.columns[len(PACKED_COLUMNS):]])
        rows = old.withColumn("tag", F.lit(0)).unionAll(sums.withColumn("tag", F.lit(1)))
        rows = rows.repartition("kind", "line", "sub").sortWithinPartitions("kind", "line", "sub", "tag")
        return rows.groupBy("kind", "line", "sub").applyInArrow(_streamed(_stepped(d, gamma, (gamma * 2 * lam, gamma * 2 * mu))), PACKED_STEP)


def _streamed(run):
    """``run`` for applyInArrow, which takes a group batch by batch if hints say so."""
    def streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return run(batches)

    streamed.__annotations__ = {"batches": Iterator[pa.RecordBatch], "return": Iterator[pa.RecordBatch]}
    return streamed


def _line(key: str, n: int, seed: int = 0):
    return F.pmod(F.xxhash64(F.col(key).cast("long"), *[F.lit(seed)] * (seed > 0)), F.lit(n)).cast("int")


def lay_out_grid(ratings: DataFrame, block_ratings: int = GRID_RATINGS, users: int = 0, items: int = 0) -> RatingGrid:
    """``ratings(i, j, r, fold)`` written once, in a grid of blocks of about
    ``block_ratings`` (16 blocks at least), with a column for every
    ``GRID_ITEMS`` of ``items`` profiles at least.  A user or item of any number of
    ratings lies in a whole row or column of blocks.  Ratings with a null have
    no error and are left out."""
    spark = ratings.sparkSession
    n = max(4, math.isqrt(max(ratings.count() // block_ratings, 1) - 1) + 1)
    columns = max(n, -(-items // GRID_ITEMS))
    user_parts, item_parts = (max(1, -(-size // (lines * GRID_PART))) for size, lines in ((users, n), (items, columns)))
    labels = _labels(spark, n * columns)
    at = _line("i", n) * columns + _line("j", columns)
    rows = ratings.where("i is not null and j is not null and r is not null and fold is not null").select(
        F.element_at(F.array(*map(F.lit, labels)), at + 1).alias("block"), _line("i", user_parts, 1).alias("sub"),
        F.col("i").cast("long").alias("i"), F.col("j").cast("long").alias("j"), F.col("r").cast("double").alias("r"),
        F.col("fold").cast("int").alias("fold"))
    packed = rows.repartition(len(labels), "block").sortWithinPartitions("block", "sub").mapInArrow(
        _packed, "block int, sub int, i binary, j binary, r binary, fold binary")
    name = f"tallyho_{uuid.uuid4().hex}"
    (packed.write.bucketBy(len(labels), "block").option("parquet.block.size", GRID_GROUP).option("path", f"{checkpoint_dir(spark).rstrip('/')}/{name}").saveAsTable(name))
    return RatingGrid(spark.table(name), labels, n, columns, user_parts, item_parts, [name])
