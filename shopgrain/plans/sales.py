"""Daily sales and customer segments."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.functions import (
    band, exact_sum, money, money_mean, percent, ratio, run_date, run_time,
)
from shopgrain.operators.incremental import incremental, touched_rows
from shopgrain.plans.cleaned import OTHER_TYPE, STANDARD_TYPES
from shopgrain.session import stored

AsOf = datetime | date | str | None
_TYPES = (*STANDARD_TYPES.values(), OTHER_TYPE)


def daily_sales(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    *,
    grain: str = "joined",
    since: Column | str | None = None,
    lookback_days: int | None = 0,
    touched: DataFrame | None = None,
    as_of: AsOf = None,
) -> DataFrame:
    """Sales per purchase date over orders that have both items and payments.

    ``grain="joined"`` counts every item once per payment of its order (the three-table join);
    ``grain="order"`` counts each item and each payment once. Neither builds the item x payment
    rows: both sides are summed per order first, and the joined grain multiplies the sums by the
    other side's row count. ``since`` is the last report date already stored; it is recomputed
    together with ``lookback_days`` days before it (None: strictly later days only). ``touched`` (the
    order ids of changed orders, late items and late payments) gives the whole days these orders are
    in, however long ago.
    """
    if grain not in ("joined", "order"):
        raise ValueError(f"unknown grain: {grain}")
    if touched is not None:
        day = F.to_date("order_purchase_timestamp").alias("_day")
        days = touched_rows(orders, touched, "order_id").select(day)
        orders = touched_rows(orders.select("*", day), days, "_day").drop("_day")
        orders = stored(orders, "touched_orders")
    if since is not None:
        orders = _after(orders, since, lookback_days)
    if since is not None or touched is not None:
        # A short list of new orders is broadcast and the history is only scanned, not shuffled.
        # Rebalancing the few rows kept frees the sums from the join's partitions, so that a long
        # list (a shuffled join) still lets adaptive execution split a hot order.
        items = touched_rows(items, orders, "order_id").hint("rebalance")
        payments = touched_rows(payments, orders, "order_id").hint("rebalance")
    per_order = items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_items"),
        F.count("price").alias("n_prices"),
        exact_sum("price").alias("item_price"),
        exact_sum("freight_value").alias("item_freight"),
    )
    paid = payments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("n_payments"),
        exact_sum("payment_value").alias("paid"),
        F.bit_or(_type_bit("payment_type_standardized")).alias("types"),
    )
    joined = grain == "joined"
    times_payments = _wide(F.col("n_payments") if joined else F.lit(1))
    times_items = _wide(F.col("n_items") if joined else F.lit(1))
    rows = times_payments * times_items
    prices = _wide(F.col("n_prices")) * times_payments if joined else F.lit(1)
    per_customer = (
        orders.select(
            "order_id",
            "customer_id",
            F.to_date("order_purchase_timestamp").alias("report_date"),
            "is_delayed",
            "processing_time_days",
        )
        .join(per_order, "order_id")
        .join(paid, "order_id")
        .groupBy("report_date", "customer_id")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(rows).alias("rows"),
            F.sum(prices).alias("prices"),
            _weighted("item_price", times_payments).alias("revenue"),
            _weighted("item_freight", times_payments).alias("freight"),
            _weighted("paid", times_items).alias("paid"),
            F.sum(F.when(F.col("is_delayed"), rows).otherwise(0)).alias("delayed"),
            F.sum(F.col("processing_time_days") * rows).alias("days"),
            F.sum(F.when(F.col("processing_time_days").isNotNull(), rows)).alias("timed"),
            F.bit_or("types").alias("types"),
        )
    )
    per_day = per_customer.groupBy("report_date").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_customers"),
        *[
            F.sum(c).alias(c)
            for c in ("rows", "prices", "revenue", "freight", "paid", "delayed", "days", "timed")
        ],
        F.bit_or("types").alias("types"),
    )
    return per_day.select(
        "report_date",
        "total_orders",
        "unique_customers",
        money("revenue").alias("total_revenue"),
        money_mean("revenue", "prices").alias("avg_order_value"),
        F.col("delayed").cast("bigint").alias("delayed_orders"),
        percent("delayed", "rows").alias("delay_rate"),
        money("paid").alias("total_payments"),
        F.bit_count(F.coalesce(F.col("types"), F.lit(0))).cast("bigint").alias(
            "payment_methods_used"
        ),
        F.round(ratio("days", "timed"), 1).alias("avg_processing_time_days"),
        money("freight").alias("total_freight"),
        percent(money("freight"), money("revenue")).alias("freight_percentage"),
        run_time(as_of).alias("_processed_timestamp"),
        F.lit("INCREMENTAL").alias("_load_type"),
        F.date_format("report_date", "yyyy-MM").alias("_report_year_month"),
    )


def _after(orders: DataFrame, since: Column | str, lookback_days: int | None) -> DataFrame:
    if lookback_days is None:  # strictly later days, as a range on the bare timestamp
        day = F.lit(since).cast("date") if isinstance(since, str) else since.cast("date")
        return orders.filter(
            F.col("order_purchase_timestamp") >= F.date_add(day, 1).cast("timestamp")
        )
    return incremental(
        orders, "order_purchase_timestamp", since, lookback_days=lookback_days
    )


def _weighted(value: str, weight: Column) -> Column:
    return F.sum((F.col(value).cast("decimal(38,0)") * weight).cast("decimal(38,0)"))


def _wide(count: Column) -> Column:
    """A number of rows that may be multiplied by another one: one order may hold any share."""
    return count.cast("decimal(19,0)")


def _type_bit(col: str) -> Column:
    """One bit per standard payment type, so distinct types merge as a bitwise OR."""
    out = F.when(F.col(col).isNull(), F.lit(0))
    for i, name in enumerate(_TYPES):
        out = out.when(F.col(col) == name, F.lit(1 << i))
    return out.otherwise(
        F.raise_error(F.concat(F.lit("not a standard payment type: "), F.col(col))).cast("int")
    )


@dataclass(frozen=True)
class RfmCuts:
    recency_days: tuple = ((30, 5), (60, 4), (90, 3), (180, 2))
    orders: tuple = ((10, 5), (7, 4), (5, 3), (3, 2))
    spent: tuple = ((50_000, 5), (30_000, 4), (10_000, 3), (5_000, 2))
    segments: tuple = (
        (13, "CHAMPIONS"),
        (10, "LOYAL_CUSTOMERS"),
        (7, "POTENTIAL_LOYALISTS"),
        (5, "AT_RISK"),
    )
    last_segment: str = "LOST"


def customer_segmentation(
    orders: DataFrame,
    items: DataFrame,
    *,
    touched: DataFrame | None = None,
    as_of: AsOf = None,
    cuts: RfmCuts = RfmCuts(),
) -> DataFrame:
    """Recency, frequency and money scores (5 best) and the segment of every buying customer, or of
    the customers of the ``touched`` orders (order ids of changed orders and late items)."""
    if touched is not None:
        buyers = touched_rows(orders, touched, "order_id").select("customer_id")
        orders = stored(touched_rows(orders, buyers, "customer_id"), "touched_orders")
        items = touched_rows(items, orders, "order_id").hint("rebalance")
    per_order = items.groupBy("order_id").agg(
        F.count("price").alias("n_prices"), exact_sum("price").alias("spent")
    )
    purchases = (
        orders.select("order_id", "customer_id", "order_purchase_timestamp")
        .join(per_order, "order_id")
        .groupBy("customer_id")
        .agg(
            F.to_date(F.max("order_purchase_timestamp")).alias("last_purchase_date"),
            F.count(F.lit(1)).alias("total_orders"),
            F.sum("spent").alias("spent"),
            F.sum("n_prices").alias("n_prices"),
        )
    )
    scored = purchases.select(
        "customer_id",
        "last_purchase_date",
        "total_orders",
        money("spent").alias("total_spent"),
        money_mean("spent", "n_prices").alias("avg_order_value"),
        F.datediff(run_date(as_of), "last_purchase_date").alias("days_since_last_purchase"),
    ).withColumns(
        {
            "recency_score": band("days_since_last_purchase", "<=", cuts.recency_days, 1),
            "frequency_score": band("total_orders", ">=", cuts.orders, 1),
            "monetary_score": band("total_spent", ">=", cuts.spent, 1),
        }
    )
    rfm = F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score")
    return scored.withColumn("rfm_score", rfm).withColumns(
        {
            "customer_segment": band("rfm_score", ">=", cuts.segments, cuts.last_segment),
            "segment_date": run_date(as_of),
            "_processed_timestamp": run_time(as_of),
        }
    )
