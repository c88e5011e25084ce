"""Raw documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shopgrain.llm import lines, packing, quality, simhash, substrings
from shopgrain.llm.common import store, table

# Entries that the last stage's tokenizers remember: its executors still hold what four stages left.
REMEMBERED = 1 << 16


def _with_text(out: DataFrame, kept: Column) -> DataFrame:
    """The columns of ``row`` with the text, and its length where there is one, replaced."""
    new = {"text": kept, "n_chars": F.char_length(kept).cast("long")}
    names = out.schema["row"].dataType.fieldNames()
    return out.select(*[new.get(n, F.col("row").getField(n)).alias(n) for n in names])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the poorest grade go."""
    scored = quality.select_quality(docs, table(spark, sf_dir, "labels"))
    return scored.where("kept").select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents share go."""
    return _with_text(lines.drop_common_lines(docs), F.col("kept"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return simhash.keep_one(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 35 words and more that start in two places go."""
    return _with_text(substrings.drop_repeated_passages(docs, tidy=False), F.col("kept"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their sequence and place there."""
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    packed = packing.pack_documents(
        docs, vocabulary, limit=4096, with_ids=False, remembered=REMEMBERED
    )
    return packed.withColumnRenamed("id", "doc_id")


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("substring_dedup", substring_dedup),
    ("best_fit_packing", best_fit_packing),
]

# Token ids and 64-bit text hashes have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
