"""Registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shopgrain.llm import (
    bpe, imatch, lines, merkle, minhash, outliers, packing, quality, simhash, substrings, toxicity, urls, whiten,
)
from shopgrain.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def _sha(col: str):
    return F.sha2(F.col(col).cast("binary"), 256)


def _held_out(col: str):
    return F.coalesce(F.crc32(F.col(col).cast("string")) % 5 == 0, F.lit(False))


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack_documents(
        table(spark, sf_dir, "documents"), vocabulary, limit=4096, with_ids=False
    )
    return packed.withColumnRenamed("id", "doc_id")


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.select_quality(docs, labels).select(
        "row.doc_id", "expected_grade", "tail_probability", "kept"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    known = labels.where(~_held_out("doc_id"))
    model = toxicity.train(
        docs, known.select(F.col("doc_id").alias("id"), F.col("toxic").alias("label"))
    )
    return toxicity.score(docs, model).select(
        "row.doc_id", _held_out("row.doc_id").alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences",
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    coded = encoded.select("row.doc_id", F.col("n_tokens"), "ids")
    return bpe.decode(coded, ranks).select(
        "row.doc_id", "row.n_tokens", F.sha2("row.ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return outliers.judge(docs).select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "distance",
    )


def op6_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return imatch.compare_edited(docs).withColumnRenamed("id", "doc_id")


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.drop_common_lines(table(spark, sf_dir, "documents"))
    return out.select(
        "row.doc_id", "n_lines", "n_dropped", _sha("kept").alias("kept_sha256")
    )


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.drop_repeated_passages(docs).select(
        "row.doc_id", "n_words", "n_removed", _sha("kept").alias("kept_sha256")
    )


# Fixed values of the query: its rules, and the sites whose pages make up the list.
URL_RULES = [
    urls.Rule("net", "/", "block"), urls.Rule("example.net", "/en/", "allow"),
    urls.Rule("example.com", "/de/", "block"), urls.Rule("org", "/fr/", "allow"),
]
LISTED_SITES = ["cheap-pills", "casino-win", "spam-farm", "adult-x", "free-bets", "ads-track"]


def op9_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    site = F.array_contains(F.split(urls.url_host(F.col("url")), "\\."), F.lit(LISTED_SITES[0]))
    for name in LISTED_SITES[1:]:
        site = site | F.array_contains(F.split(urls.url_host(F.col("url")), "\\."), F.lit(name))
    block_list = pages.where(site).select(urls.canonical_url(F.col("url")).alias("canonical"))
    return urls.judge(pages, block_list, URL_RULES).select(
        "row.page_id", "host", "path", "rule", "verdict"
    )


def op10_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = simhash.fingerprints(table(spark, sf_dir, "documents"), size=3, seed=42)
    return simhash.near_duplicates(prints).select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op11_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), size=4).withColumnRenamed("id", "doc_id")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    return merkle.manifest(table(spark, sf_dir, "documents"), tampered)


QUERIES: dict[str, Query] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_toxicity": op3_toxicity,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_quality_rules": op5_quality_rules,
    "op6_document_fingerprints": op6_document_fingerprints,
    "op7_line_dedup": op7_line_dedup,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_url_filters": op9_url_filters,
    "op10_simhash_near_dedup": op10_simhash_near_dedup,
    "op11_minhash_near_dedup": op11_minhash_near_dedup,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_merkle_manifest": op13_merkle_manifest,
}
