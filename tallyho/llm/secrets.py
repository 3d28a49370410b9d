"""Secret scans with an incremental blob ledger.

Every historical version of a path is content-addressed (SHA-256 of its
bytes).  The ledger holds which (blob, rule version) pairs have been scanned;
only unseen pairs are scanned, each once however many paths or versions hold
the blob, and findings are joined back to all paths.  ``update_ledger`` adds
one batch as new Parquet files, so a run that dies leaves no pair marked as
scanned without its findings.  ``scan_documents`` and ``redact`` go through the
ledger in the folder that they are given or that the session names as
``spark.tallyho.secretLedger``, and otherwise through a new one of their own,
below the shared checkpoint folder.

A rule is a pattern and a test of its matches; matches are leftmost and
non-overlapping.  Offsets are code points: the pieces between matches and the
matches themselves are summed up by a window over a blob's own matches.

Edge cases: null content is an empty text; empty texts have no findings;
repeated rows share one blob; columns other than the named ones pass by; an
empty table gives no findings and no paths.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyho.llm.common import apart, scratch

RULE_VERSION = "2024-1"


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str        # leftmost, non-overlapping
    gate: str           # cheap test: texts without a match of it have no findings
    value: str = ""     # pattern whose group 1 must have min_chars characters
    min_chars: int = 0
    base: bool = False


# The rules, in the order in which spans of one start are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
RULES = (
    Rule("assign", ASSIGN + r"[A-Za-z0-9+/_.=-]+", ASSIGN + r"[A-Za-z0-9+/_.=-]{6}",
         r"""^[A-Za-z_]+["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", 6, base=True),
    Rule("access", r"AKIA[A-Z0-9]{16,}", r"AKIA[A-Z0-9]{16}", base=True),
    Rule("hex", r"[0-9a-f]{24,}", r"[0-9a-f]{24}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
FINDING = "blob string, rule_version string, kind string, start long, end long"


def address(content: Column) -> Column:
    return F.sha2(F.coalesce(content, F.lit("")).cast("binary"), 256)


def blobs_of(versions: DataFrame, content: str = "text") -> DataFrame:
    """(blob, content), one row per distinct content; equal contents meet in
    the map side of the aggregate first, so hot copies do not pile up."""
    text = F.coalesce(F.col(content), F.lit(""))
    return versions.select(address(F.col(content)).alias("blob"), text.alias("content")).dropDuplicates(["blob"])


def scan(blobs: DataFrame, rules: tuple[Rule, ...] = RULES, rule_version: str = RULE_VERSION) -> DataFrame:
    """Findings (blob, rule_version, kind, start, end) of every rule."""
    parts = [F.when(F.col("content").rlike(r.gate), F.struct(
        F.lit(r.kind).alias("kind"),
        F.split("content", r.pattern, -1).alias("pieces"),
        F.regexp_extract_all("content", F.lit(r.pattern), F.lit(0)).alias("found"))) for r in rules]
    hits = blobs.select("blob", F.filter(F.array(*parts), lambda x: x.isNotNull()).alias("hits")).where(F.size("hits") > 0)
    hits = hits.select("blob", F.explode("hits").alias("h")).select(
        "blob", "h.kind", F.posexplode(F.arrays_zip(
            F.transform("h.pieces", F.length).alias("gap"), F.col("h.found").alias("match"))).alias("at", "m"))
    hits = hits.select("blob", "kind", "at", "m.gap", "m.match").where("match is not null")
    sofar = Window.partitionBy("blob", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("match").cast("long")
    hits = hits.withColumn("end", F.sum(F.col("gap").cast("long") + size).over(sofar)).withColumn("start", F.col("end") - size)
    keep = F.lit(True)
    for r in rules:
        if r.min_chars:
            keep = keep & ((F.col("kind") != r.kind) | (F.length(F.regexp_extract("match", r.value, 1)) >= r.min_chars))
    return hits.where(keep).select("blob", F.lit(rule_version).alias("rule_version"), "kind", "start", "end")


def unseen(blobs: DataFrame, ledger: DataFrame | None, rule_version: str = RULE_VERSION) -> DataFrame:
    """The blobs that the ledger (blob, rule_version) lacks under this version."""
    if ledger is None:
        return blobs
    seen = ledger.where(F.col("rule_version") == rule_version).select("blob").distinct()
    return blobs.join(seen, "blob", "left_anti")


def update_ledger(versions: DataFrame, folder: str, content: str = "text", rules: tuple[Rule, ...] = RULES,
                  rule_version: str = RULE_VERSION) -> int:
    """Scan what ``folder`` has not seen of ``versions`` and append it: one row
    per scanned pair with all its findings, so both become visible together.
    Returns how many pairs were scanned."""
    spark = versions.sparkSession
    old = read_ledger(spark, folder)
    fresh = unseen(blobs_of(versions, content), old, rule_version)
    found = scan(fresh, rules, rule_version).groupBy("blob").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "kind"))).alias("findings"))
    pairs = fresh.select("blob", F.lit(rule_version).alias("rule_version")).join(found, "blob", "left")
    staged = scratch(spark, "ledger")
    pairs.write.parquet(staged)
    pairs = spark.read.parquet(staged)
    pairs.write.mode("append").parquet(folder)
    return pairs.count()


LEDGER = "blob string, rule_version string, findings array<struct<start: bigint, end: bigint, kind: string>>"


def read_ledger(spark, folder: str) -> DataFrame | None:
    """The ledger in ``folder``; None before the first batch."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return None
    return spark.read.schema(LEDGER).parquet(folder)


def version_of(rules: tuple[Rule, ...]) -> str:
    """``RULE_VERSION``, with a digest of the rules if they are others."""
    return RULE_VERSION if rules == RULES else f"{RULE_VERSION}-{hashlib.sha256(repr(rules).encode()).hexdigest()[:16]}"


def ledger_findings(docs: DataFrame, rules: tuple[Rule, ...], folder: str | None) -> DataFrame:
    """(blob, findings) of the blobs with findings, after the ledger has been
    brought up to date with ``docs``; a pair that two runs wrote counts once."""
    spark = docs.sparkSession
    folder = folder or spark.conf.get("spark.tallyho.secretLedger", None) or scratch(spark, "secret-ledger")
    update_ledger(docs, folder, rules=rules, rule_version=version_of(rules))
    ledger = read_ledger(spark, folder).where((F.col("rule_version") == version_of(rules)) & (F.size("findings") > 0))
    return ledger.select("blob", "findings").dropDuplicates(["blob"])


def span_text(kinds: tuple[str, ...], only: tuple[str, ...] | None = None) -> Column:
    """kind:start:end of the ``spans`` array, by start, then kind as listed."""
    order = F.lit(0)
    for i, k in enumerate(kinds):
        order = F.when(F.col("kind") == k, F.lit(i)).otherwise(order)
    item = F.struct("start", order.alias("o"), F.concat_ws(":", "kind", "start", "end").alias("s"))
    items = F.collect_list(F.when(F.col("kind").isin(*only), item) if only else item)
    return F.concat_ws(",", F.transform(F.sort_array(items), lambda x: x["s"]))


def scan_documents(docs: DataFrame, rules: tuple[Rule, ...] = RULES, folder: str | None = None) -> DataFrame:
    """doc_id with counts and spans of every document; only blobs that the
    ledger in ``folder`` lacks are scanned.

    Findings are one row per distinct text, so the join back to the paths
    multiplies nothing; the paths' side of a hot text is salted."""
    kinds, base = tuple(r.kind for r in rules), tuple(r.kind for r in rules if r.base)
    count = [F.count_if(F.col("kind") == k).alias(f"n_{k}") for k in base]
    found = ledger_findings(docs, rules, folder).select("blob", F.inline("findings")).groupBy("blob").agg(
        *count, span_text(kinds, base).alias("base_spans"), span_text(kinds).alias("spans"))
    salts = 16
    found = found.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    paths = docs.select("doc_id", address(F.col("text")).alias("blob")).withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
    rows = paths.join(found, ["blob", "salt"], "left")
    return rows.select("doc_id", *[F.coalesce(f"n_{k}", F.lit(0)).alias(f"n_{k}") for k in base],
                       F.sha2(F.coalesce("base_spans", F.lit("")).cast("binary"), 256).alias("base_sha256"),
                       F.coalesce("spans", F.lit("")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, mark: str = "[SECRET]", folder: str | None = None) -> DataFrame:
    """``docs`` with every found span replaced by ``mark``; no document goes.
    Overlapping spans become one mark; other columns stay as they are.  Only
    blobs that the ledger in ``folder`` lacks are scanned."""
    docs, back = apart(docs)
    found = ledger_findings(docs, rules, folder).select("blob", F.sort_array(F.transform(
        "findings", lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end")))).alias("_spans"))
    salts = 16
    found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).withColumnRenamed("blob", "_blob")
    rows = docs.withColumn("_blob", address(F.col("text"))).withColumn(
        "_salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int")).join(found, ["_blob", "_salt"], "left")
    text = F.col("text")
    piece = lambda a, to: F.substr(text, (a["pos"] + 1).cast("int"), (to - a["pos"]).cast("int"))
    step = lambda a, x: F.when(x["end"] <= a["pos"], a).otherwise(F.struct(
        F.when(x["start"] >= a["pos"], F.concat(a["out"], piece(a, x["start"]), F.lit(mark)))
        .otherwise(a["out"]).alias("out"), x["end"].alias("pos")))
    done = F.aggregate("_spans", F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("pos")), step,
                       lambda a: F.concat(a["out"], piece(a, F.length(text) + a["pos"])))
    return back(rows.withColumn("text", F.when(F.col("_spans").isNull(), text).otherwise(done)))
