"""What each landing feed becomes. Every function takes a streaming or a batch DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.operators.quality import required, split_valid, tag_rows
from shopgrain.sources.files import CORRUPT, with_ingest_meta

VERSION = ["customer_id", "_last_updated"]


def ingest_orders(raw: DataFrame, *, watermark: str = "24 hours") -> DataFrame:
    """Orders with ingestion time and source file; late by at most ``watermark`` downstream."""
    return _watermarked(
        with_ingest_meta(raw, source_file=True), "order_purchase_timestamp", watermark
    )


def ingest_customers(
    raw: DataFrame, *, watermark: str | None = None, one_per_customer: bool = False
) -> DataFrame:
    """Customer versions. A batch keeps each version (customer, last update) once.

    A stream appends every row without state by default, however late it is; ``distinct_versions``
    over what it wrote drops re-sent copies, and ``latest_per_key`` takes the latest. With a
    ``watermark`` the stream drops copies itself, and loses rows that come later than that; with
    ``one_per_customer`` (48 hours unless given) it keeps the first row of a customer only.
    """
    keys = ["customer_id"] if one_per_customer else VERSION
    rows = with_ingest_meta(raw)
    if not raw.isStreaming:
        return rows.dropDuplicates(keys)
    if watermark is None and not one_per_customer:
        return rows
    late = watermark or "48 hours"
    return rows.withWatermark("_last_updated", late).dropDuplicatesWithinWatermark(keys)


def distinct_versions(customers: DataFrame) -> DataFrame:
    """Each stored customer version once."""
    return customers.dropDuplicates(VERSION)


def latest_customers(customers: DataFrame) -> DataFrame:
    """The latest version per customer as a running aggregate.

    On a stream, write it in update mode: a customer is sent again when a later version arrives.
    State is one row per customer, and map tasks reduce their rows before the shuffle.
    """
    rest = [c for c in customers.columns if c != "customer_id"]
    return (
        customers.groupBy("customer_id")
        .agg(F.max_by(F.struct(*rest), F.struct("_last_updated", F.xxhash64(*rest))).alias("v"))
        .select("customer_id", *[F.col(f"v.{c}").alias(c) for c in rest])
    )


def _product_rules(raw: DataFrame) -> dict[str, Column]:
    rules = required(["product_id", "product_category_name"])
    if CORRUPT in raw.columns:
        rules["line is unreadable"] = F.col(CORRUPT).isNull()
    return rules


def ingest_products(
    raw: DataFrame, *, source_file: bool = True
) -> tuple[DataFrame, DataFrame]:
    """(products with id and category, quarantined rows and why). Two streams of these read every file
    twice; ``tag_products`` reads it once."""
    valid, bad = split_valid(with_ingest_meta(raw, source_file=source_file), _product_rules(raw))
    return valid.drop(CORRUPT), bad


def tag_products(raw: DataFrame, *, source_file: bool = True) -> DataFrame:
    """All rows with ``_validation_status`` and the rules they break. Appended with
    ``partition_by=["_validation_status"]`` one stream fills both outputs: one read, one ingestion time, and
    one commit, so a replayed batch is in neither of them twice."""
    return tag_rows(with_ingest_meta(raw, source_file=source_file), _product_rules(raw))


def product_categories(products: DataFrame) -> DataFrame:
    """One category per product, so that no item is doubled; store it where it is large, or each
    micro-batch reduces the catalogue again."""
    return products.groupBy("product_id").agg(
        F.min("product_category_name").alias("product_category_name")
    )


def ingest_order_items(
    raw: DataFrame, categories: DataFrame, *, row_id: bool = True
) -> DataFrame:
    """Items with their product's category; an item of an unknown product keeps NULL.

    ``categories`` has one row per product and no broadcast hint: Spark broadcasts it only below
    its size threshold. ``row_id`` needs ``raw`` to be a parquet source.
    """
    items = with_ingest_meta(raw, row_id=row_id)
    return items.join(categories, "product_id", "left").withColumn(
        "_enriched_category", F.col("product_category_name")
    )


def ingest_payments(raw: DataFrame) -> DataFrame:
    """Payments of known orders, with missing or negative values at 0 and clean types."""
    return with_ingest_meta(clean_payments(raw))


def clean_payments(raw: DataFrame) -> DataFrame:
    value, kind = F.col("payment_value"), F.col("payment_type")
    return raw.filter(F.col("order_id").isNotNull()).withColumns(
        {
            "payment_value": F.when(value.isNull() | (value < 0), 0.0).otherwise(value),
            "payment_type": F.coalesce(F.lower(F.trim(kind)), F.lit("not_defined")),
            "_payment_date": F.to_date("order_purchase_timestamp"),
        }
    )


def _watermarked(df: DataFrame, column: str, delay: str) -> DataFrame:
    return df.withWatermark(column, delay) if df.isStreaming else df
