"""The corpus pipeline: stages over documents, each written as Parquet and read again.

Quality rules, near-duplicates, benchmark decontamination and pseudonyms return
documents with their columns; packing returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import decontaminate, packing, pii, quality, simhash
from harborline.llm.common import materialise, table


#: Rows of an Arrow batch: workers that serve all stages one after the other hold a few MB of texts at a time.
BATCH_ROWS = 1000


def small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the quality rules go."""
    small_batches(spark)
    return quality.filter_documents(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: five-word shingles, similarity 0.8 or more."""
    small_batches(spark)
    return simhash.drop_near_duplicates(docs, size=5, similarity=0.8)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    small_batches(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(found.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Private values give way to pseudonyms; n_chars follows."""
    small_batches(spark)
    return pii.pseudonymise(docs, pii.DEMO_KEY).withColumn("n_chars", F.length("text").cast("long"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    small_batches(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("quality rules", quality_stage),
    ("near duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("pseudonyms", pii_stage),
    ("packing", packing_stage),
]

#: Near-duplicate search, tokenizing and hashing have no SQL form; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs)
    return docs
