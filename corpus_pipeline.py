"""The corpus pipeline: quality rules, near duplicates, secrets, mixing, packing.

Each stage takes the rows that the one before kept and returns the columns of ``documents``,
the last one the packing. ``run`` writes each stage as Parquet in the shared folder and reads
it again, so a lost executor costs one stage at most; what a stage kept on disk for itself goes when
its rows are written, and its rows go when those of the next stage are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from countyrisk.llm import jaccard_join, mixing, packing, quality_rules, secrets
from countyrisk.session import drop_scratch, scratch_dir, scratch_scope


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at a similarity of 0.8 or more, one stays."""
    return jaccard_join.keep_one(docs, size=5, percent=80)


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; no document goes."""
    return secrets.redact_secrets(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture of sources takes it."""
    return mixing.mix_sources(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every row is packed."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("jaccard_join", near_duplicate_stage),
    ("secret_scan", secret_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

# The model of the first stage and the greedy packing of the last have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, f"stage-{name}")
        with scratch_scope(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.mode("overwrite").parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before:
            drop_scratch(spark, before)
        before = path
    return docs
