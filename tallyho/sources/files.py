"""File sources and sinks.

Text inputs keep the formats of the reference data (lines of text, one word
per line, CSV points / ratings, ``({feat: value, ...}, y)`` sparse points,
``(feat,value)`` sparse models).  Every reader is a lazy ``parse_*``
over the lines of its files, in column expressions – never by evaluating file
content – and a line that does not parse fails the query.  Models
and factors are written as Parquet (full doubles, schema kept) and replaced as
one step (:mod:`.versions`); their readers also take plain Parquet folders.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import bounded_broadcast, cut_lineage
from . import versions

_NUMBER = r"[-+]?(?:\d+\.?\d*(?:[eE][-+]?\d+)?|\.\d+(?:[eE][-+]?\d+)?|(?i:inf(?:inity)?|nan))"


# ---------------------------------------------------------------- text --

def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line``: one row per line of the text file(s) at ``path``."""
    return spark.read.text(path).select(F.col("value").alias("line"))


def _text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line``: the non-blank lines of the text file(s)."""
    return read_lines(spark, path).filter(F.length(F.trim("line")) > 0)


def _bad(what: str, kind: str) -> F.Column:
    """Fails the query, naming the line."""
    return F.raise_error(F.concat(F.lit(f"unparsable {what}: "), F.col("line"))).cast(kind)


def _number(text: F.Column, what: str, kind: str = "double") -> F.Column:
    value = F.trim(text).try_cast(kind)
    return F.when(value.isNotNull(), value).otherwise(_bad(what, kind))


def parse_word_list(lines: DataFrame) -> DataFrame:
    """``word``: lower-cased space-separated tokens of ``line``, empties
    dropped, de-duplicated."""
    words = lines.select(F.explode(F.split(F.lower("line"), " ", -1)).alias("word"))
    return words.filter(F.length("word") > 0).distinct()


def read_word_list(spark: SparkSession, path: str) -> DataFrame:
    """:func:`parse_word_list` of the text file(s) at ``path``."""
    return parse_word_list(read_lines(spark, path))


def _model(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Table ``name`` of the last version at ``path``, or the plain Parquet
    folder there."""
    return versions.table(spark, path, name) if versions.exists(spark, path) else spark.read.parquet(path)


# ---------------------------------------------------------- dense points --

def parse_dense_points(lines: DataFrame, d: int | None = None) -> DataFrame:
    """``x ARRAY<DOUBLE>, y DOUBLE`` from lines ``v,...,v,y``.  A field that is
    no number, or a line of another length than ``d`` + 1 if given, fails."""
    fields = F.split("line", ",", -1)
    vals = F.transform(fields, lambda v: _number(v, "dense point"))
    if d is not None:
        vals = F.when(F.size(fields) == d + 1, vals).otherwise(_bad("dense point", "array<double>"))
    arr = lines.select(vals.alias("a"))
    return arr.select(F.slice("a", 1, F.size("a") - 1).alias("x"), F.element_at("a", -1).alias("y"))


def read_dense_points(spark: SparkSession, path: str) -> DataFrame:
    """:func:`parse_dense_points` of the text file(s) at ``path``."""
    return parse_dense_points(_text_lines(spark, path))


def read_dense_points_csv(spark: SparkSession, path: str, d: int) -> DataFrame:
    """Same with a known dimension, which every line must have."""
    return parse_dense_points(_text_lines(spark, path), d)


def read_dense_vector(spark: SparkSession, path: str) -> DataFrame:
    """``idx, value`` from Parquet written by :func:`write_dense_vector`."""
    return _model(spark, path, "vector").select("idx", "value").orderBy("idx")


def read_dense_vector_csv(spark: SparkSession, path: str) -> DataFrame:
    """``idx, value`` from a one-line CSV vector."""
    line = spark.read.text(path).filter(F.length(F.trim("value")) > 0)
    return line.select(F.posexplode(F.split(F.trim("value"), ",")).alias("idx", "v")).select(
        F.col("idx").cast("int").alias("idx"), F.trim("v").cast("double").alias("value"))


def write_dense_vector(beta: DataFrame, path: str) -> None:
    """Replace the vector at ``path``."""
    versions.commit(path, vector=beta.select("idx", "value"))


# --------------------------------------------------------- sparse points --

def parse_sparse_points(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(points(id, y), cells(id, feat, x))`` from ``id, line`` with lines
    ``({"f": v, ...}, y)``; the dictionary is read as JSON with single or
    double quotes.  A line of another form, or a value that is no number,
    fails."""
    pattern = r"^\s*\(\s*(\{.*\})\s*,\s*(" + _NUMBER + r")\s*\)\s*$"
    text, y = F.regexp_extract("line", pattern, 1), F.regexp_extract("line", pattern, 2)
    parsed = lines.select("id", "line", F.from_json(text, "map<string,string>", {
        "allowSingleQuotes": "true", "allowNonNumericNumbers": "true"}).alias("m"), _number(y, "sparse point").alias("y"))
    whole = F.when(F.col("m").isNotNull(), F.col("m")).otherwise(_bad("sparse point", "map<string,string>"))
    cells = parsed.select("id", "line", F.explode(whole).alias("feat", "v"))
    return (parsed.select("id", F.when(F.col("m").isNotNull(), F.col("y")).otherwise(_bad("sparse point", "double")).alias("y")),
            cells.select("id", "feat", _number(F.col("v"), "sparse point").alias("x")))


def read_sparse_points(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """:func:`parse_sparse_points` of the text file(s) at ``path``.  A line's id
    is its number among the non-blank lines, files in the order of their paths,
    however the files are split.  Lines are read once, into a written copy that
    both tables read."""
    lines = spark.read.text(path).select(
        F.col("value").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start")).where(F.length(F.trim("line")) > 0)
    lines = cut_lineage(lines.withColumn("at", F.monotonically_increasing_id()))
    # a split's lines are numbered in order; one row a split says where they begin
    splits = lines.groupBy("file", "start").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "start", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("move"))
    rows = lines.join(bounded_broadcast(splits, materialize=True), ["file", "start"])
    return parse_sparse_points(rows.select((F.col("at") + F.col("move")).alias("id"), "line"))


# --------------------------------------------------------- sparse models --

def parse_sparse_vector(lines: DataFrame) -> DataFrame:
    """``feat, value`` from lines ``(feat,value)``, with or without quotes
    around the feature, which may hold commas; other lines fail."""
    pattern = r"^\s*\(\s*(?:'([^']*)'|\"([^\"]*)\"|(.*?))\s*,\s*(" + _NUMBER + r")\s*\)\s*$"
    feat = F.coalesce(*[F.nullif(F.regexp_extract("line", pattern, g), F.lit("")) for g in (1, 2, 3)])
    return lines.select(feat.alias("feat"), _number(F.regexp_extract("line", pattern, 4), "sparse entry").alias("value"))


def format_sparse_vector(beta: DataFrame) -> DataFrame:
    """``line``: ``(feat,value)`` of every entry."""
    return beta.select(F.format_string("(%s,%s)", F.col("feat"), F.col("value").cast("string")).alias("line"))


def read_sparse_vector(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """``feat, value``.  ``fmt='text'`` reads ``(feat,value)`` lines."""
    if fmt == "parquet":
        return _model(spark, path, "vector").select("feat", "value")
    if fmt != "text":
        raise ValueError("fmt must be parquet or text")
    return parse_sparse_vector(_text_lines(spark, path))


def write_sparse_vector(beta: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace ``path`` with ``beta``; ``fmt='text'`` writes ``(feat,value)`` lines."""
    if fmt == "parquet":
        versions.commit(path, vector=beta.select("feat", "value"))
    elif fmt == "text":
        format_sparse_vector(beta).write.mode("overwrite").text(path)
    else:
        raise ValueError("fmt must be parquet or text")


# --------------------------------------------------------------- ratings --

def parse_ratings(lines: DataFrame) -> DataFrame:
    """``i, j, r`` and the other columns from lines ``i,j,r``; other lines fail."""
    f = F.split("line", ",", -1)
    three = F.when(F.size(f) == 3, f).otherwise(_bad("rating", "array<string>"))
    return lines.select("*", three.alias("_f")).select(
        _number(F.col("_f")[0], "rating", "bigint").alias("i"), _number(F.col("_f")[1], "rating", "bigint").alias("j"),
        _number(F.col("_f")[2], "rating").alias("r"), *[c for c in lines.columns if c != "line"])


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """:func:`parse_ratings` of the text file(s) at ``path``."""
    return parse_ratings(_text_lines(spark, path))


def read_rating_folds(spark: SparkSession, directory: str, folds: int) -> DataFrame:
    """``i, j, r, fold`` from ``directory/fold0 .. fold{folds-1}``, files or
    folders, in one scan: a line's fold is that of its path."""
    paths = [f"{directory.rstrip('/')}/fold{k}" for k in range(folds)]
    fold = F.regexp_extract("_metadata.file_path", r"^.*/fold(\d+)(?:/[^/]*)?$", 1).cast("int")
    lines = spark.read.text(paths).select(F.col("value").alias("line"), fold.alias("fold")).where(F.length(F.trim("line")) > 0)
    return parse_ratings(lines)


def write_factors(U: DataFrame, V: DataFrame, output: str) -> None:
    """Replace the profiles at ``output``, both in one step."""
    versions.commit(output, U=U.select("i", "u"), V=V.select("j", "v"))


def read_factors(spark: SparkSession, output: str) -> tuple[DataFrame, DataFrame]:
    """``(U, V)`` of the last :func:`write_factors`."""
    return versions.table(spark, output, "U"), versions.table(spark, output, "V")

