"""The contract queries: each applies its operator to a whole table and keeps the columns asked for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from plantmetrics.llm.byte_bpe import encode_documents
from plantmetrics.llm.decontamination import mark_leaks
from plantmetrics.llm.jaccard_join import JoinSettings, jaccard_components
from plantmetrics.llm.labelled import fold
from plantmetrics.llm.licenses import resolve_licenses
from plantmetrics.llm.line_rules import apply_line_rules
from plantmetrics.llm.quality import fit_quality, score_quality
from plantmetrics.llm.sentence_spans import remove_repeated_spans
from plantmetrics.llm.toxicity import fit_toxicity, score_toxicity
from plantmetrics.llm.url_cascade import BLOCKED_HOSTS, judge_urls, listed_hosts
from plantmetrics.llm.warc import archive_pages
from plantmetrics.llm.whitening import whiten_embeddings
from plantmetrics.llm.wrappers import extract_main_text
from plantmetrics.llm.zone_clusters import cluster_embeddings


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _held_out():
    return F.coalesce(fold("doc_id") == 0, F.lit(False)).alias("held_out")


def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = archive_pages(_table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files in folders by source and language."""
    docs = _table(spark, sf_dir, "documents")
    path = F.concat_ws("/", F.coalesce("source", F.lit("-")), F.coalesce("lang", F.lit("-")), F.col("doc_id").cast("string"))
    found = resolve_licenses(docs.select(path.alias("path"), "text"))
    return found.withColumn("doc_id", F.regexp_extract("path", r"(\d+)$", 1).cast("long"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        _held_out(),
        F.col("_score").alias("score"),
        (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        F.col("_toxic").alias("over_threshold"),
    )


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), JoinSettings(words=3, percent=90))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return marked.select(
        "doc_id", F.col("_leaked_items").alias("leaked_items"), (F.size("_leaked_items") > 0).alias("contaminated")
    )


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_table(spark, sf_dir, "pages"))


def sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeated_spans(_table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "text", F.col("_n_removed").alias("n_removed"))


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(_table(spark, sf_dir, "documents"))
    return encoded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return apply_line_rules(_table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = score_quality(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", _held_out(), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(_table(spark, sf_dir, "pages"), listed_hosts(spark, BLOCKED_HOSTS))


def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten_embeddings(_table(spark, sf_dir, "embeddings"))


def zone_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_embeddings(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": warc,
    "op2_license_scan": license_scan,
    "op3_toxicity": toxicity,
    "op4_jaccard_join": jaccard_join,
    "op5_decontamination": decontamination,
    "op6_html_text": html_text,
    "op7_sentence_spans": sentence_spans,
    "op8_byte_bpe": byte_bpe,
    "op9_line_rules": line_rules,
    "op10_quality": quality,
    "op11_url_cascade": url_cascade,
    "op12_whitening": whitening,
    "op13_zone_clusters": zone_clusters,
    "pipeline": corpus_pipeline.run,
}
