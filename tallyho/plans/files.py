"""Registered parsers and formatters of the text formats, on lines that are
made from the tables, round trips through files, and their DuckDB oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import cut_lineage, read_table
from ..sources import files, tables
from .common import rounded, scratch, sql_round
from .mf import FOLDS, ORACLE as MF_ORACLE, _both, random_init


def q_parse_dense_points(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select(F.concat_ws(
        ",", "l_quantity", "l_discount", "l_tax", "l_extendedprice").alias("line"))
    points = files.parse_dense_points(lines, 3)
    return rounded(points.select(*[F.col("x")[k].alias(f"x{k}") for k in range(3)], "y"))


def q_parse_ratings(spark, sf_dir):
    lines = read_table(spark, sf_dir, "lineitem").select(F.concat_ws(",", "l_orderkey", "l_partkey", "l_quantity").alias("line"))
    return rounded(files.parse_ratings(lines))


def q_parse_sparse_points(spark, sf_dir):
    lines = read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.format_string(
        "({'total': %s, \"cust\": %s}, %s)", F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string"),
        F.when(F.col("o_custkey") % 2 == 0, F.lit("1")).otherwise(F.lit("-1.0"))).alias("line"))
    points, cells = files.parse_sparse_points(lines)
    return rounded(cells.join(points, "id").select("id", "feat", "x", "y"))


def q_parse_sparse_vector(spark, sf_dir):
    lines = read_table(spark, sf_dir, "part").select(F.format_string("('%s',%s)", F.col("p_partkey").cast("string"),
                                                                     F.col("p_retailprice").cast("string")).alias("line"))
    return rounded(files.parse_sparse_vector(lines))


def q_format_sparse_vector(spark, sf_dir):
    beta = read_table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("feat"),
                                                    F.col("p_size").cast("double").alias("value"))
    return files.format_sparse_vector(beta)


def q_parse_word_list(spark, sf_dir):
    return files.parse_word_list(tables.document_lines(tables.documents(spark, sf_dir)).select("line"))


def q_read_sparse_points(spark, sf_dir):
    """Lines written to files and read back; points and cells meet by the ids
    that the reader gives."""
    path = scratch(spark, "sparse-points")
    read_table(spark, sf_dir, "orders").select(F.format_string(
        "({'total': %s, 'cust': %s}, %s)", F.col("o_totalprice").cast("string"), F.col("o_custkey").cast("string"),
        F.col("o_orderkey").cast("string")).alias("line")).write.text(path)
    points, cells = files.read_sparse_points(spark, path)
    return rounded(cells.join(points, "id").select("feat", "x", "y"))


def q_read_rating_folds(spark, sf_dir):
    """Every fold written as text files, all of them read in one scan."""
    path, ratings = scratch(spark, "folds"), cut_lineage(tables.lineitem_ratings(spark, sf_dir, FOLDS))
    for k in range(FOLDS):
        ratings.where(F.col("fold") == k).select(F.concat_ws(",", "i", "j", "r").alias("line")).write.text(f"{path}/fold{k}")
    return rounded(files.read_rating_folds(spark, path, FOLDS))


def q_write_dense_vector(spark, sf_dir):
    """Written, doubled from what is read, written over it, read again."""
    path = scratch(spark, "dense-vector")
    files.write_dense_vector(read_table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("idx"), F.col("p_retailprice").cast("double").alias("value")), path)
    files.write_dense_vector(files.read_dense_vector(spark, path).withColumn("value", F.col("value") * 2), path)
    return rounded(files.read_dense_vector(spark, path))


def q_write_sparse_vector(spark, sf_dir):
    """The same for a sparse model, Parquet and then text; features hold commas."""
    path, text = scratch(spark, "sparse-vector"), scratch(spark, "sparse-vector-text")
    files.write_sparse_vector(read_table(spark, sf_dir, "part").select(
        F.concat(F.lit("part,"), F.col("p_partkey").cast("string")).alias("feat"), F.col("p_size").cast("double").alias("value")), path)
    files.write_sparse_vector(files.read_sparse_vector(spark, path).withColumn("value", F.col("value") * 2), path)
    files.write_sparse_vector(files.read_sparse_vector(spark, path), text, fmt="text")
    return rounded(files.read_sparse_vector(spark, text, fmt="text"))


def q_write_factors(spark, sf_dir):
    """Profiles written, replaced by others, read back."""
    path, (U, V) = scratch(spark, "factors"), random_init(spark, sf_dir)
    files.write_factors(U.limit(1), V.limit(1), path)
    files.write_factors(U, V, path)
    return rounded(_both(*files.read_factors(spark, path)))


QUERIES = {
    "read_sparse_points": q_read_sparse_points,
    "read_rating_folds": q_read_rating_folds,
    "write_dense_vector": q_write_dense_vector,
    "write_sparse_vector": q_write_sparse_vector,
    "write_factors": q_write_factors,
    "parse_dense_points": q_parse_dense_points,
    "parse_ratings": q_parse_ratings,
    "parse_sparse_points": q_parse_sparse_points,
    "parse_sparse_vector": q_parse_sparse_vector,
    "format_sparse_vector": q_format_sparse_vector,
    "parse_word_list": q_parse_word_list,
}

ORACLE = {
    "read_sparse_points": " UNION ALL ".join(
        f"SELECT '{n}' AS feat, {sql_round(c, 'x')}, o_orderkey::DOUBLE AS y FROM orders"
        for c, n in (("o_totalprice", "total"), ("o_custkey", "cust"))),
    "read_rating_folds": (f"SELECT o_custkey AS i, l_partkey AS j, {sql_round('l_quantity / 50.0', 'r')}, "
                          f"CAST((l_orderkey + l_linenumber) % {FOLDS} AS INTEGER) AS fold "
                          "FROM lineitem JOIN orders ON l_orderkey = o_orderkey"),
    "write_dense_vector": f"SELECT CAST(p_partkey AS INTEGER) AS idx, {sql_round('p_retailprice * 2', 'value')} FROM part",
    "write_sparse_vector": f"SELECT 'part,' || p_partkey AS feat, {sql_round('p_size * 2', 'value')} FROM part",
    "write_factors": MF_ORACLE["mf_init"],
    "parse_dense_points": "SELECT " + ", ".join(sql_round(c, n) for c, n in (
        ("l_quantity", "x0"), ("l_discount", "x1"), ("l_tax", "x2"), ("l_extendedprice", "y"))) + " FROM lineitem",
    "parse_ratings": f"SELECT l_orderkey AS i, l_partkey AS j, {sql_round('l_quantity', 'r')} FROM lineitem",
    "parse_sparse_points": " UNION ALL ".join(
        f"SELECT o_orderkey AS id, '{n}' AS feat, {sql_round(c, 'x')}, CASE WHEN o_custkey % 2 = 0 THEN 1.0::DOUBLE "
        "ELSE -1.0::DOUBLE END AS y FROM orders" for c, n in (("o_totalprice", "total"), ("o_custkey", "cust"))),
    "parse_sparse_vector": f"SELECT CAST(p_partkey AS VARCHAR) AS feat, {sql_round('p_retailprice', 'value')} FROM part",
    "format_sparse_vector": "SELECT '(' || p_partkey || ',' || CAST(CAST(p_size AS DOUBLE) AS VARCHAR) || ')' AS line FROM part",
    "parse_word_list": ("SELECT DISTINCT word FROM (SELECT unnest(string_split(lower(line), ' ')) AS word FROM ("
                        "SELECT unnest(string_split_regex(text, '\\r\\n|\\r|\\n')) AS line FROM documents)) WHERE length(word) > 0"),
}
