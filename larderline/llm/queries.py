"""The registered queries: each operator over the whole of its table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from larderline.llm import (
    decontaminate,
    dialogue_repair,
    interval_dedup,
    language,
    licenses,
    line_chunks,
    packing,
    periodic_runs,
    quality,
    simhash,
    sql,
    surrogates,
    toxicity,
    url_rules,
)
from larderline.llm.common import stored
from larderline.llm.registry import QUERIES, SQL, registered, table

__all__ = ["QUERIES", "SQL"]

# A key for the test tables. A real one is kept where only the job reads it.
SURROGATE_KEY = b"key of the test tables"
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


@registered
def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_copies(docs).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


@registered
def op7_host_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    judged = quality.judge(docs, carry=["doc_id"])
    return judged.select(
        "document.doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
    )


SQL["op7_host_quality"] = sql.HOST_QUALITY


@registered
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return line_chunks.remove_repeats(docs).select(
        "document.doc_id", F.col("cleaned").alias("text"), "n_chunks", "n_removed"
    )


SQL["op10_line_dedup"] = sql.LINE_DEDUP


@registered
def op1_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = decontaminate.contained_items(
        table(spark, folder, "documents").select("doc_id", "text"),
        table(spark, folder, "benchmark").select("item_id", "text"),
    )
    return found.select(F.col("id").alias("doc_id"), "item_id", "n_shingles", "n_shared")


SQL["op1_benchmark_decontamination"] = sql.DECONTAMINATION


@registered
def op8_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    pieces = packing.tokenized(docs, VOCABULARY)
    # The ids are needed for their checksum only, so they are not stored.
    slim = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.placed(stored(slim, "pieces")).withColumnRenamed("id", "doc_id")


@registered
def op6_url_rules(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    judged = url_rules.judge_urls(pages).withColumnRenamed("id", "page_id")
    return judged.select("page_id", "host", "path", "rule", "verdict")


@registered
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return licenses.scan_licenses(docs).select(
        F.col("id").alias("doc_id"),
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base_labels", ",").alias("base_labels"),
        F.array_join("labels", ",").alias("labels"),
        "score",
    )


@registered
def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(language.fold(F.col("doc_id"), 4) == 2, F.lit(False))
    network = language.fit(docs.filter(~held_out))
    return language.predict(docs, network).select(
        F.col("id").alias("doc_id"),
        F.coalesce(language.fold(F.col("id"), 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        "score",
    )


@registered
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic")
    scored = toxicity.score_documents(docs, labels, ~toxicity.held_out(F.col("doc_id")))
    return scored.select(
        F.col("id").alias("doc_id"),
        toxicity.held_out(F.col("id")).alias("held_out"),
        "score",
        "predicted",
        F.size("passages").cast("long").alias("n_passages"),
    )


@registered
def op4_surrogates(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return surrogates.replace_entities(docs, SURROGATE_KEY).select(
        "document.doc_id",
        "text",
        F.coalesce(F.size("mentions"), F.lit(0)).cast("long").alias("n_mentions"),
    )


@registered
def op11_dialogue_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns, copies = dialogue_repair.damaged(table(spark, folder, "conversations"))
    return dialogue_repair.plan_repairs(turns, copies)


@registered
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    docs = periodic_runs.planted(table(spark, folder, "documents").select("doc_id", "text"))
    found = periodic_runs.find_runs(docs, with_text=False)
    return periodic_runs.summary(found).withColumnRenamed("id", "doc_id")


@registered
def op13_interval_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return interval_dedup.remove_repeated_bytes(docs).select(
        F.col("id").alias("doc_id"),
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
