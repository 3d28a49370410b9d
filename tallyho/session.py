"""Session plumbing shared by every operator.

Nothing here computes results; it holds the three cluster-facing policies the
operators rely on:

* ``build_session`` – the configuration we run tests and the benchmark with
  (AQE on, skew-join splitting on, Arrow on, UI off).
* ``cut_lineage`` – reliable ``checkpoint()`` into the directory the cluster
  names in ``spark.checkpoint.dir`` (never ``localCheckpoint``: a lost executor
  would take the only copy with it).
* ``bounded_broadcast`` – broadcast a join side only after a bounded scan has
  proved it is small; otherwise leave the shuffle join (plus AQE skew
  splitting) to Spark.
"""

from __future__ import annotations

import gc
import os
import tempfile
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows above which a dimension side is never broadcast.  Beta vectors and word
# lists are (string, double) rows of roughly 50 bytes, so this keeps a
# broadcast below ~25 MB per executor.
DEFAULT_BROADCAST_ROWS = 500_000
# Byte budget for a broadcast side whose row width depends on a parameter
# (e.g. factor profiles with d doubles): rows allowed = budget / row width.
DEFAULT_BROADCAST_BYTES = 25 * 1024 * 1024

DISK_BACKED = StorageLevel.MEMORY_AND_DISK


def build_session(master: str | None = None, app_name: str = "tallyho",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None) -> SparkSession:
    """Return (or create) a session configured the way the operators expect.

    On a local master the driver JVM is the only executor, so its heap is
    sized explicitly (``driver_memory``, default ``$TALLYHO_DRIVER_MEMORY`` or
    16g); on a cluster the cluster's own settings are left alone."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if (master or "").startswith("local"):
        memory = driver_memory or os.environ.get("TALLYHO_DRIVER_MEMORY", "16g")
        builder = builder.config("spark.driver.memory", memory)
    if shuffle_partitions is None and (master or "").startswith("local"):
        shuffle_partitions = os.cpu_count() or 8
    if shuffle_partitions is not None:
        # on a cluster leave the cluster's setting: AQE coalesces from there
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    builder = (
        builder
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # per-iteration checkpoints are deleted once nothing references them
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint directory of the cluster.

    Read from the SparkContext or from ``spark.checkpoint.dir``.  Only a local
    master (tests, the benchmark) may fall back to a private temp folder; on a
    cluster a machine-local folder would not survive the loss of that machine,
    so we refuse instead.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; iterative operators need a shared "
            "checkpoint folder on a cluster")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tallyho-ckpt-"))
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` as a reliable checkpoint and return the truncated plan."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def held_setting(spark: SparkSession, key: str, value: str):
    """Inside, the session has this setting.  Plans are made when an action
    starts, so actions belong inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shuffles_freed(spark: SparkSession):
    """Queries that are made and run inside leave no shuffle files.  For those
    whose result is written; run again, they would have to write them again."""
    return held_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")


def release(spark: SparkSession) -> None:
    """Shuffle files and checkpoints that no DataFrame refers to any more are
    deleted now.  Spark does so when the driver happens to collect its garbage,
    which may be after many iterations."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS,
                      materialize: bool = False,
                      max_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Hint ``df`` for broadcast iff it holds at most ``max_rows`` rows and
    about ``max_bytes`` bytes (strings and arrays at their own length).

    The check reads at most ``max_rows + 1`` rows, so it is cheap even when the
    answer is "no"; beyond the bound the caller's join stays a shuffle join.
    It runs when the join is built.
    ``materialize`` first writes a *derived* side (an aggregate that must be
    computed in full anyway) as a checkpoint, so the check and the join read
    the same written rows instead of computing them twice.
    """
    if materialize:
        df = cut_lineage(df)
    return F.broadcast(df) if fits_broadcast(df, max_rows, max_bytes) else df


def fits_broadcast(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    """Whether ``df`` holds at most ``max_rows`` rows and about ``max_bytes``
    bytes; at most ``max_rows + 1`` rows are read."""
    width = F.lit(8 * len(df.columns) + 16)
    for f in df.schema.fields:
        if f.dataType.typeName() in ("string", "binary"):
            width = width + F.coalesce(F.octet_length(f.name), F.lit(0))
        elif f.dataType.typeName() == "array":
            width = width + 8 * F.coalesce(F.size(f.name), F.lit(0))
    size = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return size["n"] <= max_rows and (size["b"] or 0) <= max_bytes


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver-provided parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin ``df`` over the cluster only when its scan is narrower than
    the default parallelism (e.g. one unsplittable file).  With many input
    splits, as on a cluster, this adds no shuffle."""
    sc = df.sparkSession.sparkContext
    target = min_partitions or sc.defaultParallelism
    if df.rdd.getNumPartitions() < target:
        return df.repartition(target)
    return df


def salted_join(big: DataFrame, small: DataFrame, keys: list[str], buckets: int,
                how: str = "inner") -> DataFrame:
    """Equi-join that splits hot keys explicitly (for clusters without AQE
    skew-join splitting, or keys too hot for it).

    Every row of ``big`` gets a salt in [0, buckets) from a hash of its own
    content (deterministic, so a retried task salts identically); ``small`` is
    replicated once per salt.  A key holding a third of ``big`` is then spread
    over ``buckets`` tasks; ``small`` grows by exactly ``buckets`` times, never
    by pairs.  ``buckets <= 1`` is a plain join.  Only joins that keep the
    rows of ``big`` alone can be salted: unmatched rows of ``small`` would come
    once per salt.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError("a salted join must be inner, left, left_semi or left_anti")
    if buckets <= 1:
        return big.join(small, keys, how)
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in big.columns]), F.lit(buckets)).cast("int")
    b = big.withColumn("_salt", salt)
    s = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return b.join(s, keys + ["_salt"], how).drop("_salt")
