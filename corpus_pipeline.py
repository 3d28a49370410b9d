"""The corpus pipeline: documents in, a curated training order out.

Each stage reads what its predecessor kept, as a Parquet table:

1. ``quality``          – documents that the quality classifier scores under
   ``MIN_QUALITY`` go;
2. ``near_duplicates``  – one document of each group of near duplicates stays
   (five-word shingles, similarity 0.8);
3. ``decontamination``  – documents that hold benchmark passages go;
4. ``secret_scan``      – secrets are masked, every document stays;
5. ``mixture``          – sources are mixed to their target weights; documents
   that the mix takes, in training order, with how many of their words.

Stages 1 to 4 return the columns of ``documents`` untouched, whatever they are
called; the last one adds size, source_size, target, taken and position.  A null,
empty or blank text is scored like any other by stage 1 and then passes; rows
with a null doc_id pass stage 2; of rows that repeat a doc_id and text one
stays, and of several texts that link one; no documents give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyho.llm import curriculum, decontaminate, jaccard_join, mil_quality, secrets
from tallyho.llm.common import apart, read_table, training_marks, written

MIN_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows, back = apart(docs)
    model = mil_quality.fit(rows, training_marks(read_table(spark, sf_dir, "labels"), "quality"))
    return back(mil_quality.score(rows, model).where(f"score >= {MIN_QUALITY}"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secrets.redact(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return curriculum.mix(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secret_scan", secret_scan), ("mixture", mixture)]
# The classifier is trained and the join compares sets: no SQL for run()'s rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows are not written."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
