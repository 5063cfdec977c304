"""The query of each operator: it reads whole tables, calls the operator with
production parameters and derives the digest columns. ``QUERIES`` maps a name to the
query and its DuckDB SQL (None where SQL can't express the method)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsmart.llm import (
    decontamination,
    hard_negatives,
    html_text,
    interaction,
    language,
    learned_partitions,
    lines,
    oracles,
    packing,
    quality,
    secrets,
    sharding,
    simhash,
    token_counts,
)
from newsmart.llm.common import table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.maintain(table(spark, sf_dir, "documents")).totals()


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), capacity=packing.CAPACITY)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.statistics_and_verdicts(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(table(spark, sf_dir, "documents"), max_edits=lines.MAX_EDITS, min_chars=lines.MIN_CHARS)


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(table(spark, sf_dir, "documents"), sample_docs=secrets.SAMPLE_DOCS)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op10_byte_balanced_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(table(spark, sf_dir, "documents"), n=sharding.SHARDS)


def op11_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interaction.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.search(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.mine(table(spark, sf_dir, "embeddings"), every=100, n_positives=5, n_negatives=5)


QUERIES = {
    "op1_token_counts": (op1_token_counts, None),
    "op2_simhash_near_dedup": (op2_simhash_near_dedup, None),
    "op3_best_fit_packing": (op3_best_fit_packing, None),
    "op4_quality_rules": (op4_quality_rules, None),
    "op5_line_dedup": (op5_line_dedup, None),
    "op6_benchmark_decontamination": (op6_benchmark_decontamination, oracles.OP6),
    "op7_secret_scan": (op7_secret_scan, None),
    "op8_language_id": (op8_language_id, None),
    "op9_html_extraction": (op9_html_extraction, None),
    "op10_byte_balanced_sharding": (op10_byte_balanced_sharding, None),
    "op11_filter_interaction": (op11_filter_interaction, oracles.OP11),
    "op12_learned_partitions": (op12_learned_partitions, None),
    "op13_hard_negatives": (op13_hard_negatives, oracles.OP13),
}
