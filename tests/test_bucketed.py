"""Tables stored by the key of their joins: no exchange below the join, layout kept by every write."""

import uuid

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from shopgrain.operators.merge import upsert_all
from shopgrain.plans import sales
from shopgrain.sources import tables

BY_ORDER = (4, ["order_id"])


@pytest.fixture
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def facts(spark, n=300):
    orders = spark.range(n).select(
        F.col("id").alias("order_id"), (F.col("id") % 7).alias("customer_id"),
        F.timestamp_seconds(F.col("id") * 20_000).alias("order_purchase_timestamp"),
        (F.col("id") % 3 == 0).alias("is_delayed"), (F.col("id") % 5).cast("int").alias("processing_time_days"),
        F.concat(F.lit("m"), F.col("id") % 4).alias("month"),
    )
    items = spark.range(3 * n).select(
        (F.col("id") % n).alias("order_id"), (F.col("id") % 50 + 0.5).alias("price"),
        F.lit(1.25).alias("freight_value"),
    )
    payments = spark.range(2 * n).select(
        (F.col("id") % n).alias("order_id"), F.lit("VOUCHER").alias("payment_type_standardized"),
        (F.col("id") % 9 + 0.25).alias("payment_value"),
    )
    return orders, items, payments


def made(spark):
    plain = facts(spark)
    names = [f"bucketed_{uuid.uuid4().hex}" for _ in plain]
    for df, name, parts in zip(plain, names, (["month"], [], [])):
        half = F.col("order_id") % 2 == 0
        tables.append(df.filter(half), name, partition_by=parts, buckets=BY_ORDER)
        tables.append(df.filter(~half), name)
    return plain, names


def files_by_bucket(spark, name):
    """Names of a table's files by the bucket that is part of them."""
    out = {}
    for f in spark.table(name).inputFiles():
        out.setdefault(f.rsplit("_", 1)[1].split(".")[0], []).append(f)
    return out


def test_facts_stay_where_they_are_below_the_order_join(spark, no_broadcast):
    plain, names = made(spark)
    stored = [spark.table(n) for n in names]
    got, want = (sales.daily_sales(*t, as_of="2020-01-01") for t in (stored, plain))
    text = plan(got)
    assert "hashpartitioning(order_id" not in text and text.count("Bucketed: true") == 3
    assert "hashpartitioning(order_id" in plan(want)
    assert rows(got) == rows(want)


def test_merge_and_refresh_keep_the_layout(spark, no_broadcast):
    (orders, items, _), (name, item_name, _) = made(spark)
    changed = orders.filter("order_id < 40").withColumn("customer_id", F.lit(99).cast("bigint"))
    moved = changed.withColumn("month", F.lit("m9"))
    tables.merge_partitions(moved, name, ["order_id"], "month", upsert_all)
    want = orders.filter("order_id >= 40").unionByName(moved)
    cols = orders.columns
    assert rows(spark.table(name), *cols) == rows(want, *cols)
    tables.refresh(spark.table(item_name).filter("order_id > 10"), item_name)
    assert rows(spark.table(item_name)) == rows(items.filter("order_id > 10"))
    assert set(files_by_bucket(spark, item_name)) == {f"{i:05d}" for i in range(4)}
    assert all(len(f) == 1 for f in files_by_bucket(spark, item_name).values())
    joined = spark.table(name).join(spark.table(item_name), "order_id")
    assert "Exchange" not in plan(joined) and joined.count() == 3 * 289
    wider = spark.table(item_name).withColumn("note", F.lit("x"))
    tables.refresh(wider, item_name)
    assert tables._buckets(spark, item_name) == (4, ["order_id"])


def test_contract_with_buckets(spark):
    name = f"bucketed_{uuid.uuid4().hex}"
    tables.ensure_table(spark, name, "orders_silver", buckets=(6, ["order_id"]))
    assert tables._buckets(spark, name) == (6, ["order_id"])
    plain = f"plain_{uuid.uuid4().hex}"
    tables.ensure_table(spark, plain, "orders_silver")
    assert tables._buckets(spark, plain) is None
