"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chosen_path, conversation_repair, exact_dedup, html_density, language_id, license_scan, merkle, packing, personal_data, source_mixing, suffix_repeats, topk_search, url_filter
from .common import table


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_density.extract(table(spark, sf_dir, "pages"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_id.identify(table(spark, sf_dir, "documents"), declared_col="lang", host_col="source")
    return found.select("doc_id", F.col("_lang").alias("language"), F.col("_posterior").alias("posterior"),
                        F.col("_accepted").alias("accepted"), F.col("_text_lang").alias("text_language"))


def language_id_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fusion on web pages: declared markup language, address and host."""
    pages = table(spark, sf_dir, "pages")
    declared = F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z-]+)", 1)
    body = F.regexp_replace(F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1>", " "), r"<[^>]*>", " ")
    rows = pages.select("page_id", "url", declared.alias("declared"), body.alias("text"))
    found = language_id.identify(rows, declared_col="declared", url_col="url")
    return found.select("page_id", F.col("_lang").alias("language"), F.col("_posterior").alias("posterior"),
                        F.col("_accepted").alias("accepted"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = source_mixing.mix(table(spark, sf_dir, "documents"), repeat_limit=source_mixing.REPEAT_LIMIT)
    return mixed.select("doc_id", "source", F.col("_tokens").alias("tokens"), F.col("_weight").alias("weight"),
                        F.col("_epoch").alias("epoch"), F.col("_order").alias("block_order"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_copies(table(spark, sf_dir, "documents"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(table(spark, sf_dir, "pages"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search.top_k(table(spark, sf_dir, "embeddings"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.find_personal_data(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return merkle.verify(docs, changed={"text": merkle.lowered(docs)})


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.repair(table(spark, sf_dir, "conversations"))


QUERIES = {f.__name__: f for f in (
    op1_html_extraction, op2_suffix_dedup, op3_language_id, op4_license_scan, op5_ngram_jaccard_join, op6_source_mixing, op7_packing, op8_exact_dedup, op9_url_filter, op10_topk_search, op11_personal_data, op12_merkle_manifest, op13_conversation_repair, language_id_pages)}
ORACLE = {"op8_exact_dedup": exact_dedup.ORACLE, "op9_url_filter": url_filter.oracle(), "op10_topk_search": topk_search.ORACLE,
          "op12_merkle_manifest": merkle.ORACLE, "op13_conversation_repair": conversation_repair.ORACLE}
