"""Items move once by order and once by product on the way to a product's figures."""

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from shopgrain.plans import catalogue


@pytest.fixture(scope="module")
def shop(spark, tmp_path_factory):
    """4000 orders, some twice, some without a key; 1500 products, some twice in an order."""
    root = str(tmp_path_factory.mktemp("products"))
    items = spark.range(9000).selectExpr(
        "IF(id % 1500 = 7, NULL, id % 4000) AS order_id", "IF(id % 1400 = 9, NULL, id * 7 % 4000 % 1500) AS product_id",
        "IF(id % 31 = 0, NULL, id % 97 / 4D) AS price", "id % 5 / 2D AS freight_value", "id > 8800 AS new",
    )
    items.union(items.filter("product_id % 3 = 0")).repartition(6).write.parquet(root + "/items")
    orders = spark.range(4100).selectExpr(
        "IF(id > 4090, NULL, id) AS order_id", "IF(id % 50 = 0, NULL, id % 333) AS customer_id",
        "element_at(array('canceled', 'delivered', NULL), int(id % 3) + 1) AS order_status",
        "timestamp_seconds(id * 100000) AS order_purchase_timestamp",
    )
    orders.union(orders.filter("order_id < 20")).repartition(3).write.parquet(root + "/orders")
    products = spark.range(1600).selectExpr("id AS product_id", "'c' AS product_category_name_english")
    products.write.parquet(root + "/products")
    return [spark.read.parquet(f"{root}/{t}") for t in ("orders", "items", "products")]


@pytest.fixture
def threshold(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    yield lambda value: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def light(monkeypatch, hashes=lambda df, key: []):
    monkeypatch.setattr(catalogue, "heavy_keys", hashes)


def test_shuffles(spark, shop, threshold, monkeypatch):
    light(monkeypatch)
    threshold("-1")
    orders, items, products = shop
    assert plan(catalogue.product_performance(*shop)).count("Exchange hashpartitioning") == 4
    refreshed = catalogue.product_performance(*shop, touched=items.filter("new"))
    assert plan(refreshed).count("Exchange hashpartitioning") == 5  # and the touched products


def test_few_products_are_picked_before_anything_moves(spark, shop, threshold, monkeypatch):
    light(monkeypatch)
    threshold("10MB")
    orders, items, products = shop
    df = catalogue.product_performance(*shop, touched=items.filter("product_id < 3"))
    text = plan(df)
    assert text.index("Exchange hashpartitioning(order_id") < text.index("LeftSemi")
    assert {p for p, in rows(df, "product_id")} == {0, 1, 2}


@pytest.mark.parametrize("by", ["order_id", "product_id", "both"])
def test_heavy_and_light_keys_give_the_same(shop, monkeypatch, by):
    def every_other(df, key):
        some = df.filter(F.coalesce(F.col(key) % 2 == 0, F.lit(True))) if by in (key, "both") else df.limit(0)
        return [r[0] for r in some.select(F.xxhash64(key)).distinct().collect()]

    new = shop[1].filter("new")
    light(monkeypatch)
    want = [rows(catalogue.product_performance(*shop, touched=t, as_of="2020-01-01")) for t in (None, new)]
    light(monkeypatch, every_other)
    got = [rows(catalogue.product_performance(*shop, touched=t, as_of="2020-01-01")) for t in (None, new)]
    assert got == want


def test_figures_by_hand(shop):
    orders, items, products = ([tuple(r) for r in df.collect()] for df in shop)
    by_order = {}
    for o, c, status, at in orders:
        by_order.setdefault(o, []).append((c, status))
    pairs = {}
    for o, p, price, *_ in items:
        if o is not None and p is not None and o in by_order:
            pairs.setdefault((o, p), []).append(price or 0)
    want = {}
    for (o, p), prices in pairs.items():
        row = want.setdefault(p, [0, set(), 0, 0])
        for c, status in by_order[o]:
            row[0] += 1
            row[1].add(c)
            row[2] += sum(prices)
            row[3] += len(prices) * (status == "canceled")
    got = catalogue.product_performance(*shop)
    assert rows(got, "product_id", "total_orders", "unique_buyers", "total_revenue", "return_count") == sorted(
        ((p, n, len(buyers - {None}), total, back) for p, (n, buyers, total, back) in want.items()), key=repr
    )
