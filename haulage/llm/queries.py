"""Registered queries of this subpackage, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulage.llm import (
    chat, collocations, line_dedup, mixing, negatives, packing, quality, secrets, simhash, substring, token_files, topk, toxicity,
)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.packed_documents(load(spark, sf_dir, "documents"), capacity=1024, keep_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(load(spark, sf_dir, "documents"))


def token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = token_files.round_trip(load(spark, sf_dir, "documents"))
    return read.select("doc_id", "start", "n_tokens", "ids_crc32")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_flags(load(spark, sf_dir, "documents"))


def simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(load(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(load(spark, sf_dir, "documents"), labels=load(spark, sf_dir, "labels"))


def page_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.clean_pages(load(spark, sf_dir, "pages"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


def chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(load(spark, sf_dir, "conversations"))


def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(load(spark, sf_dir, "documents"), least=100, most_words=5, per_language=2_000)


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.without_repeats(load(spark, sf_dir, "documents"), length=20, keep_text=False)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(load(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label, positives=5, negatives=5)


QUERIES = {
    "op1_best_fit_packing": best_fit_packing,
    "op2_secret_scan": secret_scan,
    "op3_token_output": token_output,
    "op4_quality_rules": quality_rules,
    "op5_simhash_near_dedup": simhash_near_dedup,
    "op6_exact_top_k": exact_top_k,
    "op7_source_mixing": source_mixing,
    "op8_line_dedup": page_line_dedup,
    "op9_toxicity": toxicity_scores,
    "op10_chat_perspectives": chat_perspectives,
    "op11_phrase_collocations": phrase_collocations,
    "op12_substring_dedup": substring_dedup,
    "op13_hard_negatives": hard_negatives,
}
