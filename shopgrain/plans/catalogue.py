"""Product performance, inventory and cross-selling.

No aggregate here counts several distinct columns beside its sums, which would copy every row with
all its aggregate buffers per counted column: sums and distinct keys are reduced apart. Rows of light
keys move once by order and once by product. Those of heavy ones are partially aggregated before each
shuffle, so a hot product sends one row per map task; and no aggregate right after their join on order_id
groups by order_id, as it would keep that join's partitions and so keep adaptive execution from splitting
a hot order. The category is joined on at product grain, after the facts are reduced.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, functions as F

from shopgrain.functions import (
    band, exact_halves, join_halves, money, money_mean, percent, ratio, rounded_ratio, run_date,
    run_time, sum_halves,
)
from shopgrain.operators.basket import BIG_BASKET, co_occurrence
from shopgrain.operators.heavy import apart, heavy_keys, is_heavy
from shopgrain.operators.incremental import touched_keys, touched_rows
from shopgrain.session import stored

AsOf = datetime | date | str | None
CATEGORY = "product_category_name_english"


@dataclass(frozen=True)
class ProductCuts:
    revenue: tuple = ((100_000, "PREMIUM"), (50_000, "HIGH_PERFORMER"), (10_000, "STANDARD"))
    low_revenue: str = "LOW_PERFORMER"
    risk: tuple = ((20, "HIGH_RISK"), (10, "MEDIUM_RISK"))
    low_risk: str = "LOW_RISK"


@dataclass(frozen=True)
class InventoryCuts:
    turnover: tuple = ((100, "FAST_MOVING"), (50, "REGULAR"), (10, "SLOW_MOVING"))
    slowest: str = "DEAD_STOCK"


@dataclass(frozen=True)
class LiftCuts:
    strength: tuple = ((5, "STRONG"), (3, "MODERATE"), (1.5, "WEAK"))
    weakest: str = "NEGLIGIBLE"


def product_performance(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    *,
    touched: DataFrame | None = None,
    as_of: AsOf = None,
    cuts: ProductCuts = ProductCuts(),
) -> DataFrame:
    """Sales, returns (items of canceled orders), velocity and tiers per product.

    ``touched`` (a batch of items) recomputes only its products, over their full history."""
    bought_at = "order_purchase_timestamp"
    facts = orders.select(
        "order_id", "customer_id", bought_at, (F.col("order_status") == "canceled").alias("canceled")
    )
    # A product's rows move once, unless it is heavy: then they are added up per buyer before they meet.
    per_product = apart(
        _bought(items, facts),
        "product_id",
        heavy_keys(items, "product_id"),
        lambda rows: _sold(rows.repartition("product_id"), bought_at),
        lambda rows: _sold(rows, bought_at),
    )
    if touched is not None:
        # Spark looks few keys up before the items move, and many here, where nothing moves but they. Products
        # without a key are left out below.
        keys = touched_keys(touched, "product_id")
        per_product = per_product.join(keys, F.col("product_id") == F.col("_touched_0"), "left_semi")
    measured = (
        per_product
        .join(products.select("product_id", F.col(CATEGORY).alias("category")), "product_id")
        .select(
            "product_id",
            "category",
            "total_orders",
            "unique_buyers",
            money("revenue").alias("total_revenue"),
            money_mean("revenue", "prices").alias("avg_selling_price"),
            ratio(money("freight"), "items").alias("avg_freight_cost"),
            "product_lifetime_days",
            "return_count",
            F.coalesce(money("returned"), F.lit(0.0)).alias("return_value"),
        )
    )
    return measured.withColumns(
        {
            "return_rate": percent("return_count", "total_orders"),
            "daily_revenue_velocity": rounded_ratio("total_revenue", "product_lifetime_days", 2),
        }
    ).withColumns(
        {
            "revenue_tier": band("total_revenue", ">=", cuts.revenue, cuts.low_revenue),
            "risk_level": band("return_rate", ">", cuts.risk, cuts.low_risk),
            "_processed_timestamp": run_time(as_of),
        }
    )


def _sold(bought: DataFrame, bought_at: str) -> DataFrame:
    """The sums and distinct buyers of each product."""
    canceled, sums = F.col("canceled"), ("items", "prices")
    per_buyer = bought.groupBy("product_id", "customer_id").agg(
        F.count(F.lit(1)).alias("orders"),
        *[F.sum(c).alias(c) for c in sums],
        *sum_halves("revenue"),
        *sum_halves("freight"),
        F.sum(F.when(canceled, F.col("items")).otherwise(0)).alias("return_count"),
        *sum_halves("revenue", when=canceled, to="returned"),
        F.max(bought_at).alias("last"),
        F.min(bought_at).alias("first"),
    )
    return per_buyer.groupBy("product_id").agg(
        F.sum("orders").alias("total_orders"),
        F.count("customer_id").alias("unique_buyers"),
        *[F.sum(c).alias(c) for c in (*sums, "return_count")],
        *[join_halves(c).alias(c) for c in ("revenue", "freight", "returned")],
        F.datediff(F.max("last"), F.min("first")).alias("product_lifetime_days"),
    )


def _bought(items: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per order and product with the sums of its items, beside the order's columns.

    Its rows count a product's distinct orders, and those per customer its distinct buyers, so each
    fact is scanned and joined once. Items move by order once, as they are, for both steps; those of heavy
    orders are reduced first, in the map tasks too, so that the join can be split. Runs jobs.
    """
    key = "order_id"
    heavy = sorted({*heavy_keys(items, key), *heavy_keys(orders, key)})

    def reduced(rows: DataFrame) -> DataFrame:
        return rows.groupBy(key, "product_id").agg(
            F.count(F.lit(1)).alias("items"),
            F.count("price").alias("prices"),
            *exact_halves("price", "revenue"),
            *exact_halves("freight_value", "freight"),
        )

    light = orders.filter(~is_heavy(key, heavy)) if heavy else orders
    return apart(
        items,
        key,
        heavy,
        lambda rows: reduced(rows.repartition(key)).join(light, key),
        lambda rows: reduced(rows).join(orders.filter(is_heavy(key, heavy)), key),
    )


def inventory_analytics(
    orders: DataFrame,
    items: DataFrame,
    products: DataFrame,
    *,
    touched: DataFrame | None = None,
    as_of: AsOf = None,
    cuts: InventoryCuts = InventoryCuts(),
) -> DataFrame:
    """Monthly movement of each product, its turnover, reorder level and stock class."""
    items = items if touched is None else touched_rows(items, touched, "product_id")
    sale_month = F.date_trunc("month", "order_purchase_timestamp").alias("sale_month")
    month = ["product_id", "sale_month"]
    per_month = (
        _bought(items, orders.select("order_id", "customer_id", sale_month))
        .groupBy(*month, "customer_id")
        .agg(F.count(F.lit(1)).alias("orders"), *sum_halves("revenue"))
        .groupBy(*month)
        .agg(
            F.sum("orders").alias("orders"),
            *sum_halves("revenue"),
            F.count("customer_id").alias("buyers"),
        )
    )
    per_product = per_month.groupBy("product_id").agg(
        F.count("sale_month").alias("months_active"),
        F.sum("orders").alias("total_orders"),
        F.avg("orders").alias("avg_monthly_orders"),
        F.stddev_samp("orders").alias("stddev_monthly_orders"),
        F.max("orders").alias("peak_monthly_orders"),
        F.min("orders").alias("low_monthly_orders"),
        join_halves("revenue").alias("revenue"),
        F.count("revenue_high").alias("revenue_months"),
        F.sum("buyers").alias("total_buyers"),
    )
    spread = F.coalesce(F.col("stddev_monthly_orders"), F.lit(0.0))
    return (
        per_product.join(
            products.select("product_id", F.col(CATEGORY).alias("category")), "product_id"
        )
        .select(
            "product_id",
            "category",
            "months_active",
            "total_orders",
            "avg_monthly_orders",
            "stddev_monthly_orders",
            "peak_monthly_orders",
            "low_monthly_orders",
            money("revenue").alias("total_revenue"),
            money_mean("revenue", "revenue_months").alias("avg_monthly_revenue"),
            "total_buyers",
            rounded_ratio("total_orders", "months_active", 2).alias("inventory_turnover_rate"),
            F.round(F.col("avg_monthly_orders") + spread * 2, 0)
            .cast("bigint")
            .alias("recommended_reorder_level"),
        )
        .withColumns(
            {
                "inventory_category": band(
                    "inventory_turnover_rate", ">", cuts.turnover, cuts.slowest
                ),
                "_processed_timestamp": run_time(as_of),
                "_analysis_date": run_date(as_of),
            }
        )
    )


def cross_selling(
    items: DataFrame,
    products: DataFrame,
    *,
    item_col: str = "product_id",
    category_col: str = "product_category_name",
    min_co: int = 11,
    top: int = 1000,
    scale: float = 100,
    big_basket: int = BIG_BASKET,
    as_of: AsOf = None,
    cuts: LiftCuts = LiftCuts(),
) -> DataFrame:
    """The ``top`` item pairs by lift among pairs bought together in at least ``min_co`` orders.

    Pairs are order-free, and an item counts once per order. ``items`` holds order_id and ``item_col``; ``products`` one row per ``item_col`` with its
    category. ``lift_score`` is ``scale`` times the lift; equal scores are ordered by the pair.
    """
    known = items.select("order_id", item_col).join(
        products.select(item_col), item_col, "left_semi"
    )
    members = stored(known.distinct(), "baskets")
    popular = stored(
        members.groupBy(item_col)
        .agg(F.count(F.lit(1)).alias("orders"))
        .filter(F.col("orders") >= min_co)
        .join(products.select(item_col, category_col), item_col),
        "popular",
    )
    pairs = co_occurrence(
        members.join(popular.select(item_col), item_col, "left_semi"),
        "order_id",
        item_col,
        min_count=min_co,
        big_basket=big_basket,
    )
    n_orders = members.agg(F.count_distinct("order_id").cast("double")).scalar()

    def facts(side: str, short: str) -> DataFrame:
        return popular.select(
            F.col(item_col).alias(f"item_{side}"),
            F.col(category_col).alias(f"category_{side}"),
            F.col("orders").alias(f"{short}_orders"),
        )

    co, a, b = F.col("co_occurrence_count"), F.col("product_a_orders"), F.col("product_b_orders")
    expected = F.try_divide(a.cast("double") * b.cast("double"), n_orders)
    return (
        pairs.join(facts("a", "product_a"), "item_a")
        .join(facts("b", "product_b"), "item_b")
        .select(
            F.col("item_a").alias(f"{item_col}_a"),
            "category_a",
            "product_a_orders",
            F.col("item_b").alias(f"{item_col}_b"),
            "category_b",
            "product_b_orders",
            "co_occurrence_count",
            percent(co, a).alias("probability_a_to_b"),
            percent(co, b).alias("probability_b_to_a"),
            F.round(F.try_divide(co.cast("double") * F.lit(float(scale)), expected), 2).alias(
                "lift_score"
            ),
        )
        .orderBy(F.col("lift_score").desc(), f"{item_col}_a", f"{item_col}_b")
        .limit(top)
        .withColumns(
            {
                "recommendation_strength": band("lift_score", ">", cuts.strength, cuts.weakest),
                "cross_category_flag": F.coalesce(
                    F.col("category_a") != F.col("category_b"), F.lit(False)
                ),
                "_processed_timestamp": run_time(as_of),
                "_analysis_date": run_date(as_of),
            }
        )
    )
