"""Cleaned (silver) tables: orders, customers, products, order items, payments."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.functions import exact_sum, money_mean, ratio, run_time
from shopgrain.operators.heavy import apart, heavy_keys
from shopgrain.operators.history import latest_per_key, scd2_apply, scd2_current, scd2_splice
from shopgrain.operators.incremental import (
    are_few, dealt_rows_of, incremental, rows_of, touched_keys, touched_rows,
)
from shopgrain.operators.merge import differs, upsert
from shopgrain.operators.ordered import ordered
from shopgrain.session import stored

AsOf = datetime | date | str | None

# Fixed values.
SOURCE_SYSTEM = "BRONZE_CDC"
TRACKED = (
    "customer_unique_id",
    "customer_zip_code_prefix",
    "customer_city",
    "customer_state",
    "customer_phone",
    "customer_email",
)
STANDARD_TYPES = {
    "credit_card": "CREDIT_CARD",
    "debit_card": "DEBIT_CARD",
    "boleto": "BOLETO",
    "voucher": "VOUCHER",
}
OTHER_TYPE = "OTHER"
METHOD_CATEGORIES = {"CARD": ("credit_card", "debit_card"), "BANK_SLIP": ("boleto",)}


@dataclass(frozen=True)
class PaymentLimits:
    valid_types: tuple[str, ...] = ("credit_card", "debit_card", "voucher", "boleto", "pix")
    suspicious_above: float = 50_000
    high_value_above: float = 10_000


def order_updates(bronze: DataFrame, *, as_of: AsOf = None) -> DataFrame:
    """Orders with delivery measures, one row per order (the last one ingested)."""
    delivered, estimated = "order_delivered_customer_date", "order_estimated_delivery_date"
    if "_ingestion_timestamp" in bronze.columns:
        bronze = latest_per_key(bronze, "order_id", "_ingestion_timestamp")
    return bronze.withColumns(
        {
            "processing_time_days": F.datediff(delivered, "order_purchase_timestamp"),
            "delivery_delay_days": F.datediff(delivered, estimated),
            "is_delayed": F.coalesce(F.datediff(delivered, estimated) > 0, F.lit(False)),
            "order_year_month": F.date_format("order_purchase_timestamp", "yyyy-MM"),
            "_processed_timestamp": run_time(as_of),
            "_source_system": F.lit(SOURCE_SYSTEM),
            "_operation": F.lit("INSERT"),
        }
    )


def merge_orders(target: DataFrame, updates: DataFrame) -> DataFrame:
    """Target with new orders inserted and changed ones updated (only the columns that move)."""
    watched = ("order_status", "order_delivered_customer_date", "payment_value")
    measures = ("processing_time_days", "delivery_delay_days", "is_delayed")
    return upsert(
        target,
        updates,
        ["order_id"],
        when=lambda t, s: differs(t, s, *watched),
        update=[*watched, *measures, "_ingestion_timestamp", "_processed_timestamp"],
        set_={"_operation": F.lit("UPDATE")},
    )


def orders_silver(
    bronze: DataFrame,
    target: DataFrame | None = None,
    *,
    since: Column | str | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """New state of the orders table: rows ingested after ``since`` merged into ``target``."""
    updates = order_updates(incremental(bronze, "_ingestion_timestamp", since), as_of=as_of)
    return updates if target is None else merge_orders(target, updates)


def customers_scd2(
    dim: DataFrame,
    updates: DataFrame,
    *,
    newest: str = "updated_at",
    as_of: AsOf = None,
    current_only: bool = False,
) -> DataFrame:
    """Type-2 customer history after a feed that may hold several versions of a customer.

    ``current_only`` leaves out the versions closed earlier, for ``tables.write_scd2``."""
    apply = scd2_current if current_only else scd2_apply
    latest = latest_per_key(updates, "customer_id", newest)
    return apply(dim, latest, "customer_id", TRACKED, as_of)


def customers_history(
    dim: DataFrame,
    updates: DataFrame,
    log: DataFrame,
    *,
    time: str = "updated_at",
    as_of: AsOf = None,
    ranges: int | None = None,
) -> DataFrame:
    """Type-2 customer history by the versions' own times: every version of ``updates`` enters it, late
    ones too. ``log`` holds all versions so far, those of ``updates`` as well."""
    return scd2_splice(dim, updates, log, "customer_id", TRACKED, time, as_of, ranges=ranges)


def products_silver(
    bronze: DataFrame,
    translations: DataFrame,
    *,
    since: Column | str | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """Products with the English category and text lengths. ``translations`` is the fixed list of
    20 categories, the only side broadcast by hint."""
    new = incremental(bronze, "_ingestion_timestamp", since)
    english = F.col("product_category_name_english")
    return new.join(F.broadcast(translations), "product_category_name", "left").select(
        "product_id",
        "product_category_name",
        "product_category_name_english",
        F.length("product_name").alias("product_name_length"),
        F.length("product_description").alias("product_description_length"),
        F.size(F.split("product_photos", ",")).alias("product_photos_qty"),
        "product_weight_g",
        "product_length_cm",
        "product_height_cm",
        "product_width_cm",
        F.when(english.isNull(), "UNKNOWN").otherwise("KNOWN").alias("category_level"),
        run_time(as_of).alias("_processed_timestamp"),
    )


def with_freight_ratio(items: DataFrame) -> DataFrame:
    return items.withColumn("freight_ratio", F.round(ratio("freight_value", "price"), 2))


def order_items_silver(
    bronze: DataFrame,
    *,
    touched: DataFrame | None = None,
    as_of: AsOf = None,
    **splitting: int | None,
) -> DataFrame:
    """Items with their place in the order (by price) and their seller's average price.

    ``touched`` (a batch of items) limits the result to the rows the batch changes: its orders, and
    the orders of its sellers, whose average moves in all of them. ``splitting`` is passed to ``ordered``; without
    it only heavy orders go by ranges, and the others are dealt out by order_id in the result.
    """
    sellers = stored(
        bronze.groupBy("seller_id").agg(
            money_mean(exact_sum("price"), F.count("price")).alias("avg_seller_price")
        ),
        "seller_prices",
    )
    keys = None
    if touched is not None:
        of_sellers = touched_rows(bronze, touched, "seller_id").select("order_id")
        keys = touched_keys(of_sellers.union(touched.select("order_id")), "order_id")

    def priced(items: DataFrame) -> DataFrame:
        return items.join(sellers, "seller_id", "left")

    def placed(items: DataFrame, **how) -> DataFrame:
        return ordered(
            with_freight_ratio(items),
            "order_id",
            [("price", "asc"), ("order_item_id", "asc")],
            row_number="item_rank",
            running={"running_total": "price"},
            totals={"order_total": "price"},
            ties=[*bronze.columns, "freight_ratio"],
            **how,
        )

    def in_place(items: DataFrame) -> DataFrame:
        """Items get their seller's price while they are narrow, then move by order once for all the rest."""
        if keys is None or are_few(keys):
            items = items if keys is None else rows_of(items, keys, "order_id")
            return placed(priced(items).repartition("order_id"), whole=True)
        return placed(dealt_rows_of(priced(items), keys, "order_id"), whole=True)

    def by_ranges(items: DataFrame) -> DataFrame:
        if keys is not None:
            items = stored(rows_of(items, keys, "order_id"), "touched_items")
        return priced(placed(items, **splitting))

    if any(splitting.values()):
        items = by_ranges(bronze)
    else:
        items = apart(bronze, "order_id", heavy_keys(bronze, "order_id"), in_place, by_ranges)
    variance = F.col("price") - F.col("avg_seller_price")
    return items.select(
        "order_id",
        "order_item_id",
        "product_id",
        "seller_id",
        "shipping_limit_date",
        "price",
        "freight_value",
        "item_rank",
        "running_total",
        "order_total",
        F.round(ratio("price", "order_total") * 100, 2).alias("revenue_contribution_pct"),
        "avg_seller_price",
        variance.alias("seller_price_variance"),
        F.coalesce(variance > 0, F.lit(False)).alias("is_above_avg"),
        "freight_ratio",
        run_time(as_of).alias("_processed_timestamp"),
    )


def payments_silver(
    bronze: DataFrame,
    *,
    limits: PaymentLimits = PaymentLimits(),
    since: Column | str | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """Payments with standard type, validation status and installment value."""
    kind, value = F.col("payment_type"), F.col("payment_value")
    status = (
        F.when(~F.coalesce(kind.isin(*limits.valid_types), F.lit(False)), "INVALID")
        .when(value.isNull() | (value <= 0), "ZERO_VALUE")
        .when(value > limits.suspicious_above, "SUSPICIOUS")
        .otherwise("VALID")
    )
    return incremental(bronze, "_ingestion_timestamp", since).select(
        "order_id",
        "payment_sequential",
        _label(kind, {v: (k,) for k, v in STANDARD_TYPES.items()}, OTHER_TYPE).alias(
            "payment_type_standardized"
        ),
        "payment_installments",
        "payment_value",
        F.round(ratio("payment_value", "payment_installments"), 2).alias("installment_value"),
        status.alias("validation_status"),
        F.coalesce(F.col("payment_installments") > 0, F.lit(False)).alias("is_installment_valid"),
        F.coalesce(value > limits.high_value_above, F.lit(False)).alias("is_high_value"),
        _label(kind, METHOD_CATEGORIES, "OTHER").alias("payment_method_category"),
        run_time(as_of).alias("_processed_timestamp"),
    )


def _label(col: Column, groups: Mapping[str, tuple[str, ...]], default: str) -> Column:
    out = F.lit(default)
    for label, values in groups.items():
        out = F.when(col.isin(*values), label).otherwise(out)
    return out
