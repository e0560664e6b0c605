"""The numbered operators applied to their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from gondola.llm import (
    chunk_dedup, cost_packing, covertree_codes, entropy_mixing, host_reputation, html_subsequence, line_winnow,
    quality_ledger, rans_store, simhash_index, token_alignment, weak_pii, winnow_contamination,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_ledger.apply_policy(quality_ledger.ledger(table(spark, sf_dir, "documents")))
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        quality_ledger.rejected_by(quality_ledger.BASE).alias("base_failed"),
        "kept", "n_capitals", "n_exclaims", "failed_bits",
    )


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    judged = host_reputation.judge(pages, labels, host_reputation.RULES)
    return judged.select(
        "page_id", "host", "path", "rule", "verdict", "n_labels", "n_bad", "bad_mean", "bad_bound"
    )


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return chunk_dedup.dedup_substrings(docs).select("doc_id", "n_removed", "text")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cost_packing.pack(table(spark, sf_dir, "documents"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_index.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = rans_store.store_path(spark)
    rans_store.write(table(spark, sf_dir, "documents"), path)
    return rans_store.read(spark, path)


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = weak_pii.detect(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: int):
        of_kind = F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))
        return F.size(of_kind).cast("long").alias(f"n_{weak_pii.KINDS[kind]}")

    counts = map(count, range(len(weak_pii.KINDS)))
    return found.select(
        "doc_id", *counts, F.sha2(weak_pii.joined(base), 256).alias("base_sha256"),
        weak_pii.joined(F.col("spans")).alias("spans"),
    )


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = winnow_contamination.annotate(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "contamination.n_words", "contamination.n_hit", "contamination.n_items",
        F.sha2(F.array_join("contamination.item_ids", ","), 256).alias("items_sha256"),
        (F.col("contamination.n_hit") > 0).alias("contaminated"),
    )


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_winnow.dedup_lines(docs).select("doc_id", "n_removed", "text")


def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_subsequence.extract_pages(table(spark, sf_dir, "pages"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = entropy_mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies")


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, codebooks = covertree_codes.compress(table(spark, sf_dir, "embeddings"))
    return codes.select(
        "vec_id", "code", "error", "label_error", F.lit(covertree_codes.digest(codebooks)).alias("codebooks_sha256")
    )


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = token_alignment.align(table(spark, sf_dir, "documents"))
    return documents


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = {k: v for k, v in globals().items() if k.startswith("op") and k[2:3].isdigit()}
    return dict(sorted(found.items(), key=lambda x: int(x[0][2:].split("_")[0])))
