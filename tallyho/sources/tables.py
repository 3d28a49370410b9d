"""Adapters from the driver's parquet tables to the shapes the operators use.

All adapters are lazy projections / aggregates over the given tables, so the
work of every query grows with the tables it reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import LINE_END
from ..operators import text as text_ops
from ..session import read_table, spread

# Scaling of the lineitem features and label (keeps the
# least-squares problem well conditioned) and of the bag-of-words counts.
LINEITEM_QUANTITY_SCALE = 50.0
LINEITEM_RATE_SCALE = 10.0
LINEITEM_PRICE_SCALE = 100000.0
BAG_OF_WORDS_SCALE = 100.0
RATING_QUANTITY_SCALE = 50.0
DEFAULT_FOLDS = 4


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id, lang, source, text``, spread over the cluster for tokenising."""
    return spread(read_table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))


def document_lines(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, line_no, line``: one row per line of each text."""
    return docs.select("doc_id", "lang", "source",
                       F.posexplode(F.split("text", LINE_END, -1)).alias("line_no", "line"))


def easy_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``word``: the easy-word list, here the distinct normalised words of
    ``benchmark.text`` (the published list is not part of the data)."""
    bench = read_table(spark, sf_dir, "benchmark").select("text")
    return text_ops.word_counts(bench, "text").select("word")


def lineitem_points(spark: SparkSession, sf_dir: str, degree: int = 1,
                    keys: bool = False) -> DataFrame:
    """``x ARRAY<DOUBLE>, y DOUBLE`` from lineitem.

    Base features: quantity/50, discount*10, tax*10; label price/100000.  With
    ``degree=2`` the base features are followed by all products x_i*x_j,
    i <= j, in row order (the layout of the polynomial fixtures).  ``keys``
    keeps ``l_orderkey, l_linenumber`` in front.
    """
    li = read_table(spark, sf_dir, "lineitem")
    base = [F.col("l_quantity") / LINEITEM_QUANTITY_SCALE,
            F.col("l_discount") * LINEITEM_RATE_SCALE,
            F.col("l_tax") * LINEITEM_RATE_SCALE]
    feats = list(base)
    if degree == 2:
        feats += [base[i] * base[j] for i in range(len(base)) for j in range(i, len(base))]
    elif degree != 1:
        raise ValueError("degree must be 1 or 2")
    key_cols = ["l_orderkey", "l_linenumber"] if keys else []
    return spread(li.select(*key_cols, F.array(*feats).alias("x"),
                            (F.col("l_extendedprice") / LINEITEM_PRICE_SCALE).alias("y")))


def embedding_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``x ARRAY<DOUBLE>, y DOUBLE`` from the embeddings (label as y)."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select(F.col("embedding").cast("array<double>").alias("x"),
                      F.col("label").cast("double").alias("y"))


def labelled_points(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Sparse labelled points as two long tables.

    ``points(id BIGINT, y DOUBLE)``: labelled documents, quality 1 -> +1,
    0 -> -1.  ``cells(id BIGINT, feat STRING, x DOUBLE)``: bag of normalised
    words of each labelled document, x = count / 100.
    """
    labels = read_table(spark, sf_dir, "labels")
    points = labels.select(F.col("doc_id").alias("id"),
                           F.when(F.col("quality") == 1, 1.0).otherwise(-1.0).alias("y"))
    docs = spread(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    counts = text_ops.word_counts(labelled, "text", by=["doc_id"])
    cells = counts.select(F.col("doc_id").alias("id"), F.col("word").alias("feat"),
                          (F.col("n") / BAG_OF_WORDS_SCALE).alias("x"))
    return points, cells


def lineitem_ratings(spark: SparkSession, sf_dir: str, folds: int = DEFAULT_FOLDS) -> DataFrame:
    """``i BIGINT, j BIGINT, r DOUBLE, fold INT``: customer x part ratings.

    i = customer, j = part, r = quantity / 50; fold = (orderkey + linenumber) % folds.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = li.join(orders, li.l_orderkey == orders.o_orderkey)
    return joined.select(
        F.col("o_custkey").alias("i"), F.col("l_partkey").alias("j"),
        (F.col("l_quantity") / RATING_QUANTITY_SCALE).alias("r"),
        F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(folds)).cast("int").alias("fold"))
