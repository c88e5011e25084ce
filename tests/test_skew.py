"""One key with a third of all rows: results stay right and the plan spreads the key."""

import contextlib
import random

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from shopgrain.operators.incremental import touched_rows
from shopgrain.plans import catalogue, cleaned, partners, sales

N = 6000


@contextlib.contextmanager
def conf(spark, **settings):
    settings = {k.replace("__", "."): v for k, v in settings.items()}
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """A third of the items in order 0, of product 0, of seller 0; a third of the orders by one
    customer."""
    rnd = random.Random(4)
    root = tmp_path_factory.mktemp("skew")

    def hot(n):
        return 0 if rnd.random() < 1 / 3 else rnd.randrange(1, n)

    items = [(hot(1500), i, hot(300), hot(40), rnd.randrange(1, 9000) / 100, 1.0) for i in range(N)]
    orders = [
        (o, hot(200), rnd.choice(["delivered", "canceled"]), f"2020-0{rnd.randrange(1, 7)}-11")
        for o in range(1500)
    ]
    spark.createDataFrame(
        items, "order_id BIGINT, order_item_id BIGINT, product_id BIGINT, seller_id BIGINT, "
        "price DOUBLE, freight_value DOUBLE",
    ).withColumn("shipping_limit_date", F.lit("2020-01-01").cast("timestamp")).repartition(
        12
    ).write.parquet(str(root / "items"))
    spark.createDataFrame(
        orders, "order_id BIGINT, customer_id BIGINT, order_status STRING, p STRING"
    ).select(
        "order_id", "customer_id", "order_status",
        F.col("p").cast("timestamp").alias("order_purchase_timestamp"),
        F.col("p").cast("timestamp").alias("order_approved_at"),
        F.col("p").cast("timestamp").alias("order_delivered_carrier_date"),
        F.col("p").cast("timestamp").alias("order_delivered_customer_date"),
        F.col("p").cast("timestamp").alias("order_estimated_delivery_date"),
    ).repartition(6).write.parquet(str(root / "orders"))
    products = spark.range(300).select(
        F.col("id").alias("product_id"), F.lit("c").alias("product_category_name_english"),
        F.lit("c").alias("product_category_name"),
    )
    read = spark.read.parquet
    return cleaned.order_updates(read(str(root / "orders"))), read(str(root / "items")), products, items, orders


def test_item_windows_of_a_hot_order(spark, shop):
    _, items, _, data, _ = shop
    got = cleaned.order_items_silver(items, ranges=16)
    by_order = {}
    for o, i, _, _, price, _ in data:
        by_order.setdefault(o, []).append((price, i))
    want = []
    for o, members in by_order.items():
        total = 0
        for n, (price, i) in enumerate(sorted(members), 1):
            total += round(price * 100)
            want.append((o, i, n, total / 100))
    assert rows(got, "order_id", "order_item_id", "item_rank", "running_total") == sorted(want, key=repr)


def test_product_sums_and_distinct_counts(shop):
    orders, items, products, data, order_rows = shop
    buyer = {o: c for o, c, *_ in order_rows}
    want = {}
    for o, _, p, _, price, _ in data:
        row = want.setdefault(p, [set(), set(), 0])
        row[0].add(o), row[1].add(buyer[o])
        row[2] += round(price * 100)
    got = catalogue.product_performance(orders, items, products)
    assert rows(got, "product_id", "total_orders", "unique_buyers", "total_revenue") == sorted(
        ((p, len(a), len(b), c / 100) for p, (a, b, c) in want.items()), key=repr
    )


def test_pairs_with_a_hot_order_and_product(shop):
    _, items, products, data, _ = shop
    baskets = {}
    for o, _, p, *_ in data:
        baskets.setdefault(o, set()).add(p)
    pairs = {}
    for members in baskets.values():
        for a in members:
            for b in members:
                if a < b:
                    pairs[a, b] = pairs.get((a, b), 0) + 1
    got = catalogue.cross_selling(items, products, min_co=3, top=10**6, big_basket=20)
    assert rows(got, "product_id_a", "product_id_b", "co_occurrence_count") == sorted(
        ((a, b, n) for (a, b), n in pairs.items() if n >= 3), key=repr
    )


def test_adaptive_execution_splits_the_hot_order_of_a_join(spark, shop):
    orders, items, products, *_ = shop
    with conf(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="1.2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="4KB",
        spark__sql__adaptive__coalescePartitions__enabled="false",
        # The plans do not lean on this setting.
        spark__sql__adaptive__forceOptimizeSkewedJoin="false",
    ):
        payments = orders.select(
            "order_id", F.lit("VOUCHER").alias("payment_type_standardized"),
            F.lit(1.0).alias("payment_value"),
        )
        for df in (
            catalogue.product_performance(orders, items, products),
            catalogue.inventory_analytics(orders, items, products),
            sales.daily_sales(orders, items, payments, since="2020-01-01"),
            cleaned.order_items_silver(items),
            touched_rows(items, items.filter("order_item_id > 10"), "order_id"),
        ):
            assert "skew=true" in plan(df)


def test_joins_of_reduced_sides_have_one_row_per_key(spark, shop):
    """Daily sales never joins item rows to payment rows."""
    orders, items, *_ = shop
    payments = orders.select("order_id", F.lit("VOUCHER").alias("payment_type_standardized"),
                             F.lit(1.0).alias("payment_value"))
    per_day = sales.daily_sales(orders, items, payments.unionByName(payments))
    text = per_day._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join Inner") == 2 and text.count("Aggregate [order_id") == 2
    assert per_day.agg(F.sum("total_orders")).first()[0] == len({o for o, *_ in shop[3]})


def test_sellers_of_a_hot_seller(shop):
    orders, items, *_ = shop
    got = partners.seller_analytics(
        orders, cleaned.with_freight_ratio(items), ranges=4
    )
    ranks = rows(got, "seller_rank", "total_revenue")
    ranks.sort()
    assert [r for r, _ in ranks] == list(range(1, len(ranks) + 1))
    assert [v for _, v in ranks] == sorted((v for _, v in ranks), reverse=True)


def test_no_python_in_any_plan(spark):
    from checks.queries import queries

    eager = ("stream_", "customers_surrogate", "orders_table_merge")
    for name, query in queries().items():
        if not name.startswith(eager):
            df = query(spark, "/root/testdata/sf0.001")
            text = df._jdf.queryExecution().optimizedPlan().toString()
            assert "Python" not in text and "Cartesian" not in text, name
