"""A corpus from raw documents to packed sequences: each stage's rows are written as Parquet
and read back as the next stage's documents. All but the last keep the columns of documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.llm import cost_packing, line_winnow, quality_ledger, simhash_index, winnow_contamination
from gondola.sources.shared import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ledger's policy keeps; null and empty texts have too few words."""
    return quality_ledger.kept_rows(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeats of runs of lines, short lines too. `n_chars` follows the text. One
    that repeats earlier lines throughout stays with an empty text."""
    cleaned = line_winnow.dedup_lines(docs, whole_runs=True)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed = F.when(F.col("n_removed") > 0, F.length("text").cast(kind))
        cleaned = cleaned.withColumn("n_chars", F.coalesce(changed, F.col("n_chars")))
    return cleaned.select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near copies."""
    return simhash_index.first_of_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share no window of words with the benchmark."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    judged = winnow_contamination.annotate(docs, benchmark, into="_contamination")
    return judged.where(F.col("_contamination.n_hit") == 0).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 2048 tokens, as `op4_packing` gives them."""
    return cost_packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]
ORACLE_SQL = None  # tokens and fingerprints are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
