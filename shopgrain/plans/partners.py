"""Sellers, customer locations and the life of each order."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F

from shopgrain.functions import (
    band, exact_halves, exact_sum, join_halves, money, money_mean, percent, ratio, rounded_ratio,
    run_date, run_time, sum_halves,
)
from shopgrain.operators.distinct import beside, distinct_counts
from shopgrain.operators.incremental import rows_of, touched_keys, touched_rows
from shopgrain.operators.ordered import ordered
from shopgrain.session import stored

AsOf = datetime | date | str | None


@dataclass(frozen=True)
class SellerCuts:
    rank: tuple = ((10, "ELITE"), (50, "TOP_PERFORMER"), (200, "GROWING"), (500, "ESTABLISHED"))
    last_tier: str = "NEW"
    delayed_rate: tuple = ((5, 5), (10, 4), (20, 3), (30, 2))


@dataclass(frozen=True)
class MarketCuts:
    revenue_per_customer: tuple = (
        (10_000, "PREMIUM_MARKET"),
        (5_000, "HIGH_VALUE_MARKET"),
        (2_000, "STANDARD_MARKET"),
    )
    last_market: str = "DEVELOPING_MARKET"


@dataclass(frozen=True)
class LifecycleCuts:
    approval_hours: tuple = ((24, "WITHIN_SLA"), (48, "SLIGHT_DELAY"))
    breach: str = "SLA_BREACH"
    slow_approval_hours: int = 48
    slow_processing_days: int = 5
    slow_shipping_days: int = 7
    items: tuple = ((5, "COMPLEX"), (2, "MODERATE"))
    few_items: str = "SIMPLE"
    installments: tuple = ((5, "HIGH_INSTALLMENT"), (1, "MODERATE_INSTALLMENT"))
    one_payment: str = "SINGLE_PAYMENT"


def seller_analytics(
    orders: DataFrame,
    items: DataFrame,
    *,
    touched: DataFrame | None = None,
    as_of: AsOf = None,
    cuts: SellerCuts = SellerCuts(),
    **splitting: int | None,
) -> DataFrame:
    """Sales, delivery and reliability per seller, ranked by revenue (ties by seller id).

    ``delayed_rate`` is delayed items per order, as its inputs are counted, and may pass 100. With
    ``touched`` only the sellers in that batch are computed, so ranks are among them; rank again
    over the merged table with ``rank_sellers``.
    """
    items = items if touched is None else touched_rows(items, touched, "seller_id")
    reduced = items.groupBy("order_id", "seller_id", "product_id").agg(
        F.count(F.lit(1)).alias("items"),
        exact_sum("price").alias("revenue"),
        F.count("price").alias("prices"),
        exact_sum("freight_value").alias("freight"),
        exact_sum("freight_ratio").alias("ratios"),
        F.count("freight_ratio").alias("n_ratios"),
    )
    # Both facts are read and joined once, for the sums and the distinct counts.
    sold = stored(
        reduced.join(
            orders.select(
                "order_id",
                "customer_id",
                "order_purchase_timestamp",
                "is_delayed",
                F.datediff("order_delivered_customer_date", "order_purchase_timestamp").alias("days"),
            ),
            "order_id",
        ),
        "sold",
    )
    first, last = "first_sale_date", "last_sale_date"
    per_seller = sold.groupBy("seller_id").agg(
        *[F.sum(c).alias(c) for c in ("revenue", "prices", "freight", "ratios", "n_ratios")],
        F.sum(F.col("days") * F.col("items")).alias("days"),
        F.sum(F.when(F.col("days").isNotNull(), F.col("items")).otherwise(0)).alias("n_days"),
        F.sum(F.when(F.col("is_delayed"), F.col("items")).otherwise(0)).alias("delayed_deliveries"),
        F.min("order_purchase_timestamp").alias(first),
        F.max("order_purchase_timestamp").alias(last),
    )
    counted = distinct_counts(
        sold,
        "seller_id",
        {
            "total_orders": "order_id",
            "unique_products_sold": "product_id",
            "unique_customers": "customer_id",
        },
    )
    measured = beside(per_seller, counted, ["seller_id"]).select(
        "seller_id",
        "total_orders",
        "unique_products_sold",
        "unique_customers",
        money("revenue").alias("total_revenue"),
        money_mean("revenue", "prices").alias("avg_order_value"),
        money("freight").alias("total_freight_collected"),
        money_mean("ratios", "n_ratios").alias("avg_freight_ratio"),
        ratio("days", "n_days").alias("avg_delivery_days"),
        "delayed_deliveries",
        percent("delayed_deliveries", "total_orders").alias("delayed_rate"),
        F.datediff(last, first).alias("active_days"),
        first,
        last,
    ).withColumn("daily_revenue", rounded_ratio("total_revenue", "active_days", 2))
    ranked = rank_sellers(measured, cuts=cuts, **splitting)
    return ranked.withColumns(
        {
            "reliability_score": band("delayed_rate", "<=", cuts.delayed_rate, 1),
            "_processed_timestamp": run_time(as_of),
        }
    )


def rank_sellers(
    sellers: DataFrame, *, cuts: SellerCuts = SellerCuts(), **splitting: int | float
) -> DataFrame:
    """(Re)compute ``seller_rank`` and ``seller_tier`` over all rows of a stored seller table."""
    ranked = ordered(
        sellers.drop("seller_rank", "seller_tier"),
        None,
        [("total_revenue", "desc"), ("seller_id", "asc")],
        row_number="seller_rank",
        **splitting,
    )
    return ranked.withColumn("seller_tier", band("seller_rank", "<=", cuts.rank, cuts.last_tier))


PLACE = ("customer_state", "customer_city", "customer_zip_code_prefix")
_PLACE_SUMS = ("orders", "revenue", "prices", "delay_days", "timed", "delayed")


def geographical_analytics(
    customers: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    *,
    as_of: AsOf = None,
    cuts: MarketCuts = MarketCuts(),
    **splitting: int | None,
) -> DataFrame:
    """Buying customers, orders, revenue, delays and active sellers per state, city and zip."""
    state = stored(place_state(customers, orders, items), "place_state")
    return place_table(state, as_of=as_of, cuts=cuts, **splitting)


def place_state(
    customers: DataFrame, orders: DataFrame, items: DataFrame, *, touched: DataFrame | None = None
) -> DataFrame:
    """What the place table is made from, in a form that can be added to and taken from: a row for
    each place and buying customer with sums over that customer's orders, and a row for each place and
    seller with the number of orders behind it.

    The items are read once and reduced to (order, seller), so the customer x order x item join is
    never built. ``touched`` (with order_id) limits the state to those orders' part.
    """
    if touched is not None:
        return _state_of(touched_keys(touched, "order_id"), customers, orders, items)
    located = customers.filter("is_current").select("customer_id", *PLACE)
    reduced = items.groupBy("order_id", "seller_id").agg(
        F.count(F.lit(1)).alias("items"),
        F.count("price").alias("prices"),
        *exact_halves("price", "revenue"),
    )
    # The place joins the orders, of which there are fewer than of their items.
    sold = stored(
        orders.select("order_id", "customer_id", "is_delayed", "delivery_delay_days")
        .join(located, "customer_id")
        .join(reduced, "order_id"),
        "sold",
    )
    delayed = F.coalesce(F.col("is_delayed"), F.lit(False))
    per_order = sold.groupBy(*PLACE, "customer_id", "order_id", "is_delayed", "delivery_delay_days").agg(
        *[F.sum(c).alias(c) for c in ("items", "prices")], *sum_halves("revenue")
    )
    per_customer = per_order.groupBy(*PLACE, "customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        join_halves("revenue").alias("revenue"),
        F.sum("prices").alias("prices"),
        F.sum(F.coalesce(F.col("delivery_delay_days"), F.lit(0)) * F.col("items")).alias("delay_days"),
        F.sum(F.when(F.col("delivery_delay_days").isNotNull(), F.col("items")).otherwise(0)).alias("timed"),
        F.sum(F.when(delayed, F.col("items")).otherwise(0)).alias("delayed"),
    )
    per_seller = sold.groupBy(*PLACE, "seller_id").agg(F.count(F.lit(1)).alias("orders"))
    return (
        per_customer.withColumn("seller_id", F.lit(None).cast(items.schema["seller_id"].dataType))
        .withColumn("is_customer", F.lit(True))
        .unionByName(per_seller.withColumn("is_customer", F.lit(False)), allowMissingColumns=True)
    )


def _state_of(keys: DataFrame, customers: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """The part of a ``place_state`` of the orders in ``keys``, as ``touched_keys`` gives them."""
    return place_state(customers, *[rows_of(side, keys, "order_id") for side in (orders, items)])


def place_changes(
    before: tuple[DataFrame, DataFrame, DataFrame],
    after: tuple[DataFrame, DataFrame, DataFrame],
    touched: DataFrame,
) -> DataFrame:
    """What a batch adds to a stored ``place_state``, with a minus sign what it takes away.

    ``before`` and ``after`` are (customers, orders, items) without and with the batch; ``touched`` names
    the orders whose part may differ: new, changed and cancelled ones, those of its items, and all
    orders of customers who moved. Only these orders are read on either side.
    """
    sums = [c for c in _PLACE_SUMS]
    keys = touched_keys(touched, "order_id")
    old, new = _state_of(keys, *before), _state_of(keys, *after)
    return new.unionByName(old.withColumns({c: -F.col(c) for c in sums}))


def add_places(state: DataFrame, changes: DataFrame) -> DataFrame:
    """The state after ``changes``: sums added up, and rows left out behind which no order is any more."""
    members = [*PLACE, "customer_id", "seller_id", "is_customer"]
    return (
        state.unionByName(changes)
        .groupBy(*members)
        .agg(*[F.sum(c).alias(c) for c in _PLACE_SUMS])
        .filter("orders <> 0")
    )


def place_table(
    state: DataFrame, *, as_of: AsOf = None, cuts: MarketCuts = MarketCuts(), **splitting: int | None
) -> DataFrame:
    """The place table from a stored ``place_state``, ranked within each state."""
    totals = state.groupBy(*PLACE).agg(
        F.count_if("is_customer").alias("customers"),
        F.count_if(~F.col("is_customer") & F.col("seller_id").isNotNull()).alias("active_sellers"),
        *[F.sum(F.when(F.col("is_customer"), F.col(c))).alias(c) for c in _PLACE_SUMS],
    )
    measured = totals.select(
        *PLACE,
        F.col("customers").alias("total_customers"),
        F.col("orders").alias("total_orders"),
        money("revenue").alias("total_revenue"),
        money_mean("revenue", "prices").alias("avg_order_value"),
        ratio("delay_days", "timed").alias("avg_delay"),
        F.col("delayed").alias("delayed_orders"),
        "active_sellers",
        percent("delayed", "orders").alias("delay_rate"),
        F.round(money_mean("revenue", "customers"), 2).alias("revenue_per_customer"),
    )
    ranked = ordered(
        measured, "customer_state", [("total_revenue", "desc")], rank="city_rank_in_state", **splitting
    )
    return ranked.withColumns(
        {
            "market_segment": band(
                "revenue_per_customer", ">", cuts.revenue_per_customer, cuts.last_market
            ),
            "_processed_timestamp": run_time(as_of),
            "_analysis_date": run_date(as_of),
        }
    )


def order_lifecycle(
    orders: DataFrame,
    payments: DataFrame,
    customers: DataFrame,
    items: DataFrame,
    *,
    touched: DataFrame | None = None,
    as_of: AsOf = None,
    cuts: LifecycleCuts = LifecycleCuts(),
) -> DataFrame:
    """Stage durations, SLA, bottleneck and complexity per order and distinct payment, of all orders
    or of ``touched`` ones (order ids of changed orders, late items and late payments).

    Payments of an order that agree in type, installments and value share one row whose
    ``order_value`` counts the items once per such payment. Items and payments are reduced to
    their own grain first, so the item x payment rows are never built.
    """
    if touched is not None:
        orders, payments, items = (
            touched_rows(side, touched, "order_id").hint("rebalance")
            for side in (orders, payments, items)
        )
    basket = (
        items.groupBy("order_id", "product_id")
        .agg(exact_sum("price").alias("price"))
        .groupBy("order_id")
        .agg(F.sum("price").alias("price"), F.count("product_id").alias("items_count"))
    )
    paid = ["payment_type_standardized", "payment_installments", "payment_value"]
    payments = payments.groupBy("order_id", *paid).agg(F.count(F.lit(1)).alias("payments"))
    located = customers.filter("is_current").select(
        "customer_id", "customer_state", "customer_city"
    )
    bought, approved = "order_purchase_timestamp", "order_approved_at"
    shipped, delivered = "order_delivered_carrier_date", "order_delivered_customer_date"
    rows = (
        orders.select(
            "order_id", "customer_id", "order_status", bought, approved, shipped, delivered,
            "order_estimated_delivery_date",
        )
        .join(basket, "order_id")
        .join(payments, "order_id")
        .join(located, "customer_id")
        .select(
            "order_id",
            "order_status",
            bought,
            approved,
            shipped,
            delivered,
            "order_estimated_delivery_date",
            _elapsed("HOUR", bought, approved).alias("approval_time_hours"),
            _elapsed("DAY", approved, shipped).cast("int").alias("processing_time_days"),
            _elapsed("DAY", shipped, delivered).cast("int").alias("shipping_time_days"),
            _elapsed("DAY", bought, delivered).cast("int").alias("total_cycle_time_days"),
            *paid,
            "customer_state",
            "customer_city",
            money((F.col("price").cast("decimal(38,0)") * F.col("payments").cast("decimal(19,0)")).cast("decimal(38,0)")).alias("order_value"),
            "items_count",
        )
    )
    stage = (
        F.when(F.col("approval_time_hours") > cuts.slow_approval_hours, "APPROVAL")
        .when(F.col("processing_time_days") > cuts.slow_processing_days, "PROCESSING")
        .when(F.col("shipping_time_days") > cuts.slow_shipping_days, "SHIPPING")
        .otherwise("NONE")
    )
    return rows.withColumns(
        {
            "approval_sla": band("approval_time_hours", "<=", cuts.approval_hours, cuts.breach),
            "is_completed": F.coalesce(F.col("order_status") == "delivered", F.lit(False)),
            "bottleneck_stage": stage,
            "order_complexity": band("items_count", ">", cuts.items, cuts.few_items),
            "payment_complexity": band(
                "payment_installments", ">", cuts.installments, cuts.one_payment
            ),
            "_processed_timestamp": run_time(as_of),
        }
    )


def _elapsed(unit: str, start: str, end: str) -> Column:
    """Whole units elapsed, which for days differs from the calendar ``datediff``."""
    return F.timestamp_diff(unit, F.col(start), F.col(end))
