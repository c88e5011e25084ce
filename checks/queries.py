"""Every registered query: (spark, sf_dir) -> DataFrame over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.mapping import AS_OF, CUT, FIRST_LOAD, SECOND_LOAD, feed
from shopgrain.operators.distinct import (
    RELATIVE_ERROR, distinct_counts, sketch_counts, sketches, union_sketches,
)
from shopgrain.operators.history import assign_surrogate, latest_per_key
from shopgrain.operators.incremental import high_water_mark, incremental
from shopgrain.operators.merge import (
    close_rows, differs, upsert, upsert_all, upsert_changed, upsert_newest,
)
from shopgrain.operators.quality import frequency, required, tag_rows
from shopgrain.plans import catalogue, cleaned, partners, sales
from shopgrain.plans.monitoring import audit_events, run_report
from shopgrain.schemas import feed_schema, table_schema
from shopgrain.session import scratch_path, stored
from shopgrain.sources import marks, tables
from shopgrain.sources.dimensions import category_translations
from shopgrain.sources.files import CORRUPT, evolve, infer_schema, read_file_stream, with_ingest_meta
from shopgrain.streaming import feeds
from shopgrain.streaming.lateness import read_counted, read_counts, start_counted
from shopgrain.streaming.latest import compact, read_latest, start_latest
from shopgrain.streaming.sinks import run_to_end, start_append

Query = Callable[[SparkSession, str], DataFrame]

# The given prices are far above the default tiers; these cuts put rows in every tier.
PRODUCT_CUTS = catalogue.ProductCuts(
    revenue=((2_000_000, "PREMIUM"), (1_600_000, "HIGH_PERFORMER"), (1_200_000, "STANDARD")),
    risk=((45, "HIGH_RISK"), (30, "MEDIUM_RISK")),
)
INVENTORY_CUTS = catalogue.InventoryCuts(
    turnover=((1.3, "FAST_MOVING"), (1.2, "REGULAR"), (1.1, "SLOW_MOVING"))
)
RFM_CUTS = sales.RfmCuts(
    orders=((14, 5), (11, 4), (8, 3), (5, 2)),
    spent=((3_000_000, 5), (2_000_000, 4), (1_500_000, 3), (1_000_000, 2)),
)
MARKET_CUTS = partners.MarketCuts(
    revenue_per_customer=(
        (2_500_000, "PREMIUM_MARKET"),
        (2_000_000, "HIGH_VALUE_MARKET"),
        (1_500_000, "STANDARD_MARKET"),
    )
)
BATCH = "2001-06-01"  # items to ship from here on are the newest batch
SPLIT = {"ranges": 64}  # so many that groups go on over their borders


def queries() -> dict[str, Query]:
    return {
        name: _plain(query)
        for name, query in globals().items()
        if getattr(query, "is_query", False)
    }


def _plain(query: Query) -> Query:
    """Times as text and numbers in their widest type, so both engines compare by value."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        plain = {
            "byte": "bigint", "short": "bigint", "integer": "bigint", "decimal": "double",
            "float": "double", "date": "string", "timestamp": "string", "timestamp_ntz": "string",
        }
        return df.select(
            *[
                F.col(f.name).cast(plain[f.dataType.typeName()]).alias(f.name)
                if f.dataType.typeName() in plain
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )

    return run


def _query(fn: Query) -> Query:
    fn.is_query = True
    return fn


# Inputs shared by the queries: cleaned tables straight from the feeds.


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned.order_updates(feed(spark, sf, "src_orders").drop("_ingestion_timestamp"))


def _items(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned.with_freight_ratio(feed(spark, sf, "src_items"))


def _payments(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned.payments_silver(feed(spark, sf, "src_payments"), as_of=AS_OF)


def _products(spark: SparkSession, sf: str) -> DataFrame:
    return cleaned.products_silver(
        feed(spark, sf, "src_products"), category_translations(spark), as_of=AS_OF
    )


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return feed(spark, sf, "src_customers").withColumn("is_current", F.lit(True))


# Cleaned tables.


@_query
def orders_silver(spark, sf):
    changes = feed(spark, sf, "src_order_changes")
    loaded = changes.filter(F.col("_ingestion_timestamp") <= F.lit(CUT).cast("timestamp"))
    target = cleaned.orders_silver(loaded, as_of=CUT)
    mark = high_water_mark(loaded, "_ingestion_timestamp")
    return cleaned.orders_silver(changes, target, since=mark, as_of=AS_OF)


@_query
def order_items_windows(spark, sf):
    return cleaned.order_items_silver(feed(spark, sf, "src_items"), as_of=AS_OF)


@_query
def order_items_windows_split(spark, sf):
    return cleaned.order_items_silver(feed(spark, sf, "src_items"), as_of=AS_OF, **SPLIT)


@_query
def payments_validated(spark, sf):
    return _payments(spark, sf)


@_query
def payment_stats(spark, sf):
    return frequency(_payments(spark, sf), "validation_status")


@_query
def products_enriched(spark, sf):
    return _products(spark, sf)


def _customer_versions(spark, sf):
    return feed(spark, sf, "src_customers_first").unionByName(
        feed(spark, sf, "src_customers_second")
    )


@_query
def customers_latest(spark, sf):
    return latest_per_key(_customer_versions(spark, sf), "customer_id", "updated_at")


def _history(spark, sf):
    empty = spark.createDataFrame([], table_schema("customers_scd2"))
    first = cleaned.customers_scd2(
        empty, feed(spark, sf, "src_customers_first"), as_of=FIRST_LOAD
    )
    return cleaned.customers_scd2(first, _customer_versions(spark, sf), as_of=SECOND_LOAD)


@_query
def customers_scd2(spark, sf):
    return _history(spark, sf).drop("customer_sk")


@_query
def customers_scd2_versions(spark, sf):
    """Loads with one version of a customer, with three, and with one that falls between known ones."""
    dim = spark.createDataFrame([], table_schema("customers_scd2"))
    log = None
    for name, as_of in (("first", FIRST_LOAD), ("third", SECOND_LOAD), ("late", AS_OF)):
        batch = feed(spark, sf, f"src_customers_{name}")
        log = batch if log is None else log.unionByName(batch)
        dim = stored(cleaned.customers_history(dim, batch, log, as_of=as_of), "history")
    return dim.drop("customer_sk", "_hash_key", "_processed_timestamp")


@_query
def customers_surrogate(spark, sf):
    path = scratch_path(spark, "customers_scd2")
    _history(spark, sf).write.parquet(path)
    return assign_surrogate(
        spark.read.parquet(path), "customer_sk", ["customer_id", "version"], ranges=16
    ).select("customer_sk", "customer_id", "version", "is_current")


# Business tables.


@_query
def daily_sales(spark, sf):
    return sales.daily_sales(
        _orders(spark, sf), _items(spark, sf), _payments(spark, sf), as_of=AS_OF
    )


@_query
def daily_sales_order_grain(spark, sf):
    return sales.daily_sales(
        _orders(spark, sf), _items(spark, sf), _payments(spark, sf), grain="order", as_of=AS_OF
    )


@_query
def daily_sales_incremental(spark, sf):
    """Days up to the cut are stored; the cut's day and later ones are recomputed and merged."""
    orders, items, payments = _orders(spark, sf), _items(spark, sf), _payments(spark, sf)
    loaded = orders.filter(F.col("order_purchase_timestamp") <= F.lit(CUT).cast("timestamp"))
    stored = sales.daily_sales(loaded, items, payments, as_of=CUT)
    mark = high_water_mark(loaded, "order_purchase_timestamp")
    fresh = sales.daily_sales(orders, items, payments, since=mark, as_of=AS_OF)
    return upsert_all(stored, fresh, ["report_date"])


def _late(spark, sf):
    """Items without the newest batch, and the orders of the batch."""
    items = _items(spark, sf)
    new = F.col("shipping_limit_date") >= F.lit(BATCH).cast("timestamp")
    return items.filter(~F.coalesce(new, F.lit(False))), items.filter(new)


@_query
def daily_sales_late_items(spark, sf):
    """Items of the newest batch belong to orders of any day; those whole days are recomputed."""
    orders, items, payments = _orders(spark, sf), _items(spark, sf), _payments(spark, sf)
    old, new = _late(spark, sf)
    stored = sales.daily_sales(orders, old, payments, as_of=AS_OF)
    fresh = sales.daily_sales(
        orders, items, payments, touched=new.select("order_id"), as_of=AS_OF
    )
    return upsert_all(stored, fresh, ["report_date"])


@_query
def order_items_incremental(spark, sf):
    """The newest items, and all rows whose order or seller average they change."""
    items = feed(spark, sf, "src_items")
    new = F.coalesce(F.col("shipping_limit_date") >= F.lit(BATCH).cast("timestamp"), F.lit(False))
    stored = cleaned.order_items_silver(items.filter(~new), as_of=AS_OF)
    fresh = cleaned.order_items_silver(items, touched=items.filter(new), as_of=AS_OF)
    return upsert_all(stored, fresh, ["order_id", "order_item_id"], deal="order_id")


@_query
def customer_rfm_incremental(spark, sf):
    orders, items = _orders(spark, sf), _items(spark, sf)
    old, new = _late(spark, sf)
    stored = sales.customer_segmentation(orders, old, as_of=AS_OF, cuts=RFM_CUTS)
    fresh = sales.customer_segmentation(
        orders, items, touched=new.select("order_id"), as_of=AS_OF, cuts=RFM_CUTS
    )
    return upsert_all(stored, fresh, ["customer_id"])


@_query
def order_lifecycle_incremental(spark, sf):
    sides = _orders(spark, sf), _payments(spark, sf), _customers(spark, sf)
    old, new = _late(spark, sf)
    stored = partners.order_lifecycle(*sides, old, as_of=AS_OF)
    fresh = partners.order_lifecycle(
        *sides, _items(spark, sf), touched=new.select("order_id"), as_of=AS_OF
    )
    paid = ["payment_type_standardized", "payment_installments", "payment_value"]
    return upsert_all(stored, fresh, ["order_id", *paid])


@_query
def customer_rfm(spark, sf):
    return sales.customer_segmentation(
        _orders(spark, sf), _items(spark, sf), as_of=AS_OF, cuts=RFM_CUTS
    )


@_query
def segment_distribution(spark, sf):
    return frequency(customer_rfm(spark, sf), "customer_segment")


@_query
def product_performance(spark, sf):
    return catalogue.product_performance(
        _orders(spark, sf), _items(spark, sf), _products(spark, sf),
        as_of=AS_OF, cuts=PRODUCT_CUTS,
    )


@_query
def incremental_touched_keys(spark, sf):
    """Stored result of the older items, with the products of the newest batch recomputed."""
    orders, items, products = _orders(spark, sf), _items(spark, sf), _products(spark, sf)
    new = F.col("shipping_limit_date") >= F.lit(BATCH).cast("timestamp")
    stored = catalogue.product_performance(
        orders, items.filter(~new), products, as_of=AS_OF, cuts=PRODUCT_CUTS
    )
    fresh = catalogue.product_performance(
        orders, items, products, touched=items.filter(new), as_of=AS_OF, cuts=PRODUCT_CUTS
    )
    return upsert_all(stored, fresh, ["product_id"])


@_query
def inventory_analytics(spark, sf):
    return catalogue.inventory_analytics(
        _orders(spark, sf), _items(spark, sf), _products(spark, sf),
        as_of=AS_OF, cuts=INVENTORY_CUTS,
    ).withColumn("stddev_monthly_orders", F.round("stddev_monthly_orders", 6))


@_query
def seller_analytics(spark, sf):
    return partners.seller_analytics(_orders(spark, sf), _items(spark, sf), as_of=AS_OF)


@_query
def seller_analytics_split(spark, sf):
    return partners.seller_analytics(_orders(spark, sf), _items(spark, sf), as_of=AS_OF, **SPLIT)


@_query
def geo_analytics(spark, sf):
    return partners.geographical_analytics(
        _customers(spark, sf), _orders(spark, sf), _items(spark, sf),
        as_of=AS_OF, cuts=MARKET_CUTS,
    )


@_query
def geo_analytics_split(spark, sf):
    return partners.geographical_analytics(
        _customers(spark, sf), _orders(spark, sf), _items(spark, sf),
        as_of=AS_OF, cuts=MARKET_CUTS, **SPLIT,
    )


@_query
def geo_analytics_incremental(spark, sf):
    """A state without the newest items and orders, in which one market segment lives elsewhere and
    nothing is delivered yet; the batch's orders and those of who moved are taken out and added again."""
    orders, items, customers = _orders(spark, sf), _items(spark, sf), _customers(spark, sf)
    recent = F.col("order_purchase_timestamp") > F.lit(CUT).cast("timestamp")
    old_items, new_items = _late(spark, sf)
    moved = feed(spark, sf, "src_customers_second").withColumn("is_current", F.lit(True))
    open_ = F.col("order_status") == "shipped"
    old_orders = orders.filter(~recent).withColumns(
        {c: F.when(~open_, F.col(c)) for c in ("delivery_delay_days", "is_delayed")}
    )
    before, after = (moved, old_orders, old_items), (customers, orders, items)
    who = moved.filter("customer_city LIKE '%-moved'").select("customer_id")
    touched = (
        orders.filter(recent | open_).select("order_id")
        .union(new_items.select("order_id"))
        .union(orders.join(who, "customer_id").select("order_id"))
    )
    state = stored(partners.place_state(*before), "places_before")
    changes = stored(partners.place_changes(before, after, touched), "place_changes")
    state = stored(partners.add_places(state, changes), "places_after")
    return partners.place_table(state, as_of=AS_OF, cuts=MARKET_CUTS)


@_query
def order_lifecycle(spark, sf):
    return partners.order_lifecycle(
        _orders(spark, sf), _payments(spark, sf), _customers(spark, sf), _items(spark, sf),
        as_of=AS_OF,
    )


@_query
def cross_selling_part(spark, sf):
    return catalogue.cross_selling(
        feed(spark, sf, "src_items"), feed(spark, sf, "src_products"), min_co=2, as_of=AS_OF
    )


@_query
def cross_selling_part_split(spark, sf):
    """Baskets of more than two items are treated as huge."""
    return catalogue.cross_selling(
        feed(spark, sf, "src_items"), feed(spark, sf, "src_products"),
        min_co=2, big_basket=2, as_of=AS_OF,
    )


@_query
def cross_selling_brand(spark, sf):
    return catalogue.cross_selling(
        feed(spark, sf, "src_brand_items"), feed(spark, sf, "src_brands"),
        item_col="brand", category_col="maker", scale=1, as_of=AS_OF,
    )


@_query
def distinct_sketches(spark, sf):
    """Months read from stored sketches of days, beside the exact counts that they must come close to."""
    day = F.to_date("order_purchase_timestamp")
    orders = feed(spark, sf, "src_orders").withColumns({"day": day, "month": F.date_format(day, "yyyy-MM")})
    counts = {"customers": "customer_id", "orders": "order_id"}
    days = stored(sketches(orders, ["month", "day"], counts), "day_sketches")
    months = sketch_counts(union_sketches(days, "month", list(counts)), list(counts))
    exact = distinct_counts(orders, "month", counts)
    both = exact.join(months.select("month", *[F.col(c).alias(f"_{c}") for c in counts]), "month")
    close = F.lit(True)
    for c in counts:
        close = close & (F.abs(F.col(f"_{c}") - F.col(c)) <= 5 * RELATIVE_ERROR * F.col(c) + 1)
    return both.select("month", *counts, close.alias("close"))


# Merges. The target holds orders before the cut with shipped ones still open; the source is a
# feed of the orders since 1998, so there are rows only in one side, changed and unchanged ones.


def _merge_sides(spark, sf):
    orders = feed(spark, sf, "src_orders").select(
        "order_id",
        "customer_id",
        "order_status",
        "payment_value",
        F.col("order_purchase_timestamp").alias("placed_at"),
    )
    # Seen zero to two days after the purchase against one day: some source rows are later.
    target = orders.filter(F.col("placed_at") < F.lit(CUT).cast("timestamp")).withColumns(
        {
            "seen_at": F.expr("placed_at + (order_id % 3) * INTERVAL '1' DAY"),
            "payment_value": F.lit(0.0),
            "order_status": F.when(F.col("order_status") == "shipped", "created").otherwise(
                F.col("order_status")
            ),
            "operation": F.lit("INSERT"),
        }
    )
    source = orders.filter(F.col("placed_at") >= F.lit(SECOND_LOAD).cast("timestamp")).withColumns(
        {
            "seen_at": F.expr("placed_at + INTERVAL '1' DAY"),
            "operation": F.lit("INSERT"),
        }
    )
    return target, source


@_query
def upsert_every(spark, sf):
    return upsert_all(*_merge_sides(spark, sf), ["order_id"])


@_query
def upsert_conditional(spark, sf):
    return upsert(
        *_merge_sides(spark, sf),
        ["order_id"],
        when=lambda t, s: differs(t, s, "order_status"),
        update=["order_status"],
        set_={"operation": F.lit("UPDATE")},
    )


@_query
def upsert_latest(spark, sf):
    return upsert_newest(*_merge_sides(spark, sf), ["order_id"], "seen_at")


@_query
def upsert_status(spark, sf):
    return upsert_changed(*_merge_sides(spark, sf), ["order_id"], ["order_status"])


@_query
def scd2_close(spark, sf):
    current = feed(spark, sf, "src_customers").select(
        "customer_id",
        "customer_city",
        F.lit(True).alias("is_current"),
        F.lit(None).cast("timestamp").alias("effective_end_date"),
    )
    moved = feed(spark, sf, "src_customers_second").filter("customer_city LIKE '%-moved'")
    return close_rows(
        current,
        moved,
        ["customer_id"],
        {
            "is_current": F.lit(False),
            "effective_end_date": F.lit(SECOND_LOAD).cast("timestamp"),
        },
    )


@_query
def orders_table_merge(spark, sf):
    """The orders merge on a stored table, rewriting only the months the new batch touches."""
    name = f"orders_merge_{abs(hash(scratch_path(spark, 'x')))}"
    tables.ensure_table(spark, name, "orders_silver", scratch_path(spark, "orders_silver"))
    changes = feed(spark, sf, "src_order_changes")
    loaded = changes.filter(F.col("_ingestion_timestamp") <= F.lit(CUT).cast("timestamp"))
    tables.append(
        tables.conform(cleaned.orders_silver(loaded, as_of=CUT), "orders_silver"), name
    )
    mark = high_water_mark(spark.table(name), "_ingestion_timestamp")
    updates = cleaned.order_updates(
        incremental(changes, "_ingestion_timestamp", mark), as_of=AS_OF
    )
    tables.merge_partitions(
        tables.conform(updates, "orders_silver"), name, ["order_id"], "order_year_month",
        lambda target, source, _: cleaned.merge_orders(target, source),
    )
    return spark.table(name)


@_query
def daily_sales_bucketed(spark, sf):
    """Daily sales over tables stored by order, the orders merged and the others appended to in a second load."""
    orders, items, payments = _orders(spark, sf), _items(spark, sf), _payments(spark, sf)
    by_order, cut = tables.buckets_for(["order_id"], orders, items, payments), F.lit(CUT).cast("timestamp")
    names = [_table(spark, f"bucketed_{kind}") for kind in ("orders", "items", "payments")]
    tables.ensure_table(
        spark, names[0], "orders_silver", scratch_path(spark, "bucketed_orders"), buckets=by_order
    )
    old = F.col("order_purchase_timestamp") <= cut
    tables.append(
        tables.conform(orders.filter(old), "orders_silver").withColumn("order_status", F.lit("old")), names[0]
    )
    tables.merge_partitions(
        tables.conform(orders, "orders_silver"), names[0], ["order_id"], "order_year_month", upsert_all
    )
    for rows, name, first in (
        (items, names[1], F.col("shipping_limit_date") <= cut), (payments, names[2], F.col("order_id") % 2 == 0),
    ):
        tables.append(rows.filter(first), name, buckets=by_order)
        tables.append(rows.filter(~F.coalesce(first, F.lit(False))), name)
    return sales.daily_sales(*[spark.table(name) for name in names], as_of=AS_OF)


@_query
def orders_table_marks(spark, sf):
    """The change feed taken into a stored table in three runs by a durable mark; the last finds nothing."""
    tag = abs(hash(scratch_path(spark, "x")))
    name, marks_name = f"orders_marked_{tag}", f"marks_{tag}"
    tables.ensure_table(spark, name, "orders_silver", scratch_path(spark, "orders_silver"))
    marks.ensure_marks(spark, marks_name, scratch_path(spark, "marks"))
    changes = feed(spark, sf, "src_order_changes")
    loaded = changes.filter(F.col("_ingestion_timestamp") <= F.lit(CUT).cast("timestamp"))
    for rows, as_of in ((loaded, CUT), (changes, AS_OF), (changes, AS_OF)):

        def merge(new: DataFrame, as_of: str = as_of) -> int:
            updates = tables.conform(cleaned.order_updates(new, as_of=as_of), "orders_silver")
            return tables.merge_partitions(
                updates, name, ["order_id"], "order_year_month",
                lambda target, source, _: cleaned.merge_orders(target, source),
            )

        marks.take_new(rows, "_ingestion_timestamp", marks_name, "order_changes", name, merge)
    return spark.table(name)


def _table(spark, kind):
    return f"{kind}_{abs(hash(scratch_path(spark, 'x')))}"


@_query
def table_refreshed(spark, sf):
    """Two stored summaries replaced twice, the second time from what they hold; one is partitioned."""
    payments, flat, split = feed(spark, sf, "src_payments"), _table(spark, "flat"), _table(spark, "split")
    kinds = payments.groupBy("payment_type", "payment_installments").agg(F.count("*").alias("n"))
    for name, parts in ((flat, []), (split, ["payment_type"])):
        tables.refresh(kinds.filter("payment_type = 'pix'"), name, partition_by=parts)
        more = spark.table(name).unionByName(kinds.filter("payment_type <> 'pix'"))
        tables.refresh(more, name, partition_by=parts)
        tables.refresh(spark.table(name).withColumn("n", F.col("n") * 2), name, partition_by=parts)
    return spark.table(flat).withColumn("place", F.lit("flat")).unionByName(
        spark.table(split).withColumn("place", F.lit("split"))
    )


@_query
def table_evolved(spark, sf):
    """A table and a folder of files that gain a column with the second append."""
    products, name, path = feed(spark, sf, "src_products"), _table(spark, "evolved"), scratch_path(spark, "evolved")
    old = products.filter("product_category_name = 'automotivo'").select("product_id", "product_name")
    new = products.filter("product_category_name <> 'automotivo'").select(
        "product_weight_g", "product_name", "product_id"
    )
    for rows in (old, new):
        tables.append(rows, name)
        tables.append_evolving(rows, path)
    cols = ["product_id", "product_name", "product_weight_g"]
    found = spark.table(name).select(*cols).withColumn("place", F.lit("table"))
    return found.unionByName(
        tables.read_evolving(spark, path).select(*cols).withColumn("place", F.lit("files"))
    )


@_query
def audited_writes(spark, sf):
    """The rows that an append, a refresh and a merge say they wrote, logged as events of one run."""
    name = _table(spark, "audited")
    orders = feed(spark, sf, "src_orders").select(
        "order_id", "order_status", F.date_format("order_purchase_timestamp", "yyyy").alias("year")
    )
    shipped = orders.filter("order_status = 'shipped'")
    steps = {
        "append": lambda: tables.append(orders.filter("order_status <> 'shipped'"), name, partition_by=["year"]),
        "refresh": lambda: tables.refresh(orders, name, partition_by=["year"]),
        "nothing": lambda: tables.append(orders.filter("order_id < 0"), name),
        "merge": lambda: tables.merge_partitions(
            shipped.withColumn("order_status", F.lit("sent")), name, ["order_id"], "year", upsert_all
        ),
    }
    at = datetime.fromisoformat(AS_OF)
    events = [
        ("run", at, step, "SUCCESS", str(write()), None, 1.0) for step, write in steps.items()
    ]
    log = audit_events(spark, events).select("module", "status", "records_processed")
    sent = spark.table(name).filter("order_status = 'sent'").count()
    return log.withColumn("sent", F.lit(sent))


@_query
def inferred_products(spark, sf):
    """A CSV feed read with the types that all its landed lines fit, and a column that came later."""
    products = feed(spark, sf, "src_products").select("product_id", "product_name", "product_weight_g")
    path = _land(spark, sf, "inferred", "csv", products)
    first = infer_schema(spark, path)
    more = products.withColumn("product_rating", F.col("product_weight_g") / 8)
    more.write.mode("append").option("header", "true").csv(path + "-later")
    schema = evolve(first, infer_schema(spark, path + "-later"))
    found = None
    for place in (path, path + "-later"):
        raw = read_file_stream(spark, place, "csv", schema)
        got = _streamed(spark, raw.drop(CORRUPT), "inferred_bronze").withColumn("later", F.lit(place != path))
        found = got if found is None else found.unionByName(got)
    kinds = ",".join(f.dataType.simpleString() for f in schema)
    return found.groupBy("later").agg(
        F.sum("product_id").alias("ids"), F.sum("product_weight_g").alias("grams"),
        F.sum("product_rating").alias("ratings"), F.count("product_name").alias("names"),
    ).withColumn("kinds", F.lit(kinds))


@_query
def stream_row_ids(spark, sf):
    """Each row of a stream is named by its file and place there, so no two rows share an id."""
    path = _land(spark, sf, "items")
    raw = read_file_stream(spark, path, "parquet", feed_schema("order_items"), max_files=1)
    out = _streamed(spark, with_ingest_meta(raw, source_file=True, row_id=True), "items_named")
    named = F.col("_batch_id").startswith(F.concat("_source_file", F.lit("#")))
    return out.agg(
        F.count("*").alias("n_rows"), F.count_distinct("_batch_id").alias("n_ids"), F.count_if(named).alias("n_named"),
        F.count("_ingestion_timestamp").alias("n_times"),
    )


# Ingestion.


@_query
def payments_cleaned(spark, sf):
    return feeds.clean_payments(feed(spark, sf, "src_dirty_payments"))


@_query
def products_quarantine(spark, sf):
    tagged = tag_rows(
        feed(spark, sf, "src_dirty_products"), required(["product_id", "product_category_name"])
    )
    return tagged.withColumn("broken", F.concat_ws(";", "_broken_rules")).drop("_broken_rules")


@_query
def items_enriched(spark, sf):
    return feeds.ingest_order_items(
        feed(spark, sf, "src_items"), _categories(spark, sf), row_id=False
    ).drop("_ingestion_timestamp")


def _categories(spark, sf):
    return stored(
        feeds.product_categories(feed(spark, sf, "src_products")), "product_categories"
    )


def _land(spark, sf, name, fmt="parquet", rows=None):
    """A feed as landing files in its own format, written by Spark from the given tables."""
    path = scratch_path(spark, f"landing_{name}")
    rows = feed(spark, sf, f"src_{name}") if rows is None else rows
    rows.write.format(fmt).option("header", "true").save(path)
    return path


def _streamed(spark, stream, name):
    """Run a stream over all landed files and read what it wrote."""
    out = scratch_path(spark, name)
    run_to_end(start_append(stream, out, scratch_path(spark, f"{name}_checkpoint")))
    return spark.read.parquet(out)


@_query
def stream_ingest_orders(spark, sf):
    schema = feed_schema("orders")
    rows = feed(spark, sf, "src_orders").select(*schema.fieldNames())
    path = _land(spark, sf, "orders", rows=rows)
    raw = read_file_stream(spark, path, "parquet", schema, max_files=1000)
    out = _streamed(spark, feeds.ingest_orders(raw), "orders_bronze")
    return out.withColumn("from_file", F.col("_source_file").contains("landing_orders")).drop(
        "_ingestion_timestamp", "_source_file"
    )


@_query
def stream_late_orders(spark, sf):
    """Orders of three spans of years, the middle one last; how many rows each batch had and how many came
    more than a day behind the latest order before the batch."""
    schema = feed_schema("orders")
    landing, out, counts, checkpoint = (scratch_path(spark, f"late_{x}") for x in ("in", "out", "counts", "checkpoint"))
    rows, year = feed(spark, sf, "src_orders").select(*schema.fieldNames()), F.year("order_purchase_timestamp")
    for span in (year < 1996, year > 1997, year.between(1996, 1997)):
        rows.filter(span).write.mode("append").parquet(landing)
        raw = read_file_stream(spark, landing, "parquet", schema, max_files=1000)
        run_to_end(start_counted(feeds.ingest_orders(raw), out, checkpoint, "order_purchase_timestamp", counts))
    written = read_counted(spark, out, schema).groupBy("batch").agg(F.count("*").alias("written"))
    return read_counts(spark, counts).join(written, "batch").select("batch", "rows", "late_rows", "mark", "written")


@_query
def stream_dedup_customers(spark, sf):
    """Both customer loads, the second sent twice; the copies are dropped."""
    schema = feed_schema("customers")
    second = feed(spark, sf, "src_customers_second")
    rows = _customer_versions(spark, sf).unionByName(second).withColumnRenamed(
        "updated_at", "_last_updated"
    )
    path = _land(spark, sf, "customers", "json", rows.select(*schema.fieldNames()))
    raw = read_file_stream(spark, path, "json", schema)
    stored_rows = _streamed(spark, feeds.ingest_customers(raw), "customers_bronze")
    return feeds.distinct_versions(stored_rows).drop("_ingestion_timestamp", CORRUPT)


@_query
def stream_latest_customers(spark, sf):
    """Three loads in a row, the oldest versions last; a file is a micro-batch, and half way the batches
    so far are brought together."""
    schema = feed_schema("customers")
    landing, out = scratch_path(spark, "landing_latest"), scratch_path(spark, "latest")
    checkpoint = scratch_path(spark, "latest_checkpoint")
    args = ("customer_id", "_last_updated")
    for name in ("second", "third", "first"):
        rows = feed(spark, sf, f"src_customers_{name}").withColumnRenamed("updated_at", "_last_updated")
        rows.select(*schema.fieldNames()).write.mode("append").json(landing)
        raw = read_file_stream(spark, landing, "json", schema, max_files=8).drop(CORRUPT)
        run_to_end(start_latest(raw, out, checkpoint, *args))
        if name == "third":
            compact(spark, out, *args, raw.schema)
    return read_latest(spark, out, *args, raw.schema)


@_query
def stream_ingest_products(spark, sf):
    schema = feed_schema("products")
    rows = feed(spark, sf, "src_products").withColumn(
        "product_category_name", F.when(F.col("product_category_name") != "automotivo",
                                        F.col("product_category_name"))
    )
    path = _land(spark, sf, "products", "csv", rows.select(*schema.fieldNames()))
    raw = read_file_stream(spark, path, "csv", schema, keep_corrupt=True)
    # One stream reads each file once; the rows' status is the folder that they go to.
    out = scratch_path(spark, "products")
    tagged = feeds.tag_products(raw)
    checkpoint = scratch_path(spark, "products_checkpoint")
    run_to_end(start_append(tagged, out, checkpoint, partition_by=["_validation_status"]))
    return spark.read.parquet(out).select(
        "product_id", "product_category_name", "product_photos", "_validation_status"
    )


@_query
def stream_ingest_items(spark, sf):
    schema = feed_schema("order_items")
    path = _land(spark, sf, "items")
    raw = read_file_stream(spark, path, "parquet", schema)
    enriched = feeds.ingest_order_items(raw, _categories(spark, sf))
    return _streamed(spark, enriched, "items_bronze").drop("_ingestion_timestamp", "_batch_id")


@_query
def stream_ingest_payments(spark, sf):
    path = _land(spark, sf, "dirty_payments")
    raw = read_file_stream(spark, path, "parquet", feed_schema("payments"))
    return _streamed(spark, feeds.ingest_payments(raw), "payments_bronze").drop(
        "_ingestion_timestamp"
    )


@_query
def audit_report(spark, sf):
    return run_report(feed(spark, sf, "src_audit"))
