"""Landing files to business tables in two runs; the second run is incremental and ends up where
one run over everything would."""

from datetime import datetime

import pytest
from helpers import rows
from pyspark.sql import functions as F

from checks.mapping import feed
from shopgrain.operators.incremental import high_water_mark, incremental
from shopgrain.operators.merge import upsert_all, upsert_changed
from shopgrain.plans import catalogue, cleaned, monitoring, partners, sales
from shopgrain.schemas import feed_schema, table_schema
from shopgrain.session import release_scratch
from shopgrain.sources import tables
from shopgrain.sources.dimensions import category_translations
from shopgrain.sources.files import read_file_stream
from shopgrain.streaming import feeds
from shopgrain.streaming.sinks import run_to_end, start_append

SF = "/root/testdata/sf0.001"
CUT = "1999-01-01"
AS_OF = "2001-08-15"
FORMATS = {"orders": "parquet", "customers": "json", "products": "csv", "order_items": "parquet",
           "payments": "parquet"}


class Lake:
    def __init__(self, spark, root):
        self.spark, self.root = spark, root

    def land(self, name, df):
        df = df.select(*[F.col(f.name).cast(f.dataType) for f in feed_schema(name).fields])
        df.write.mode("append").format(FORMATS[name]).option("header", "true").save(
            f"{self.root}/landing/{name}"
        )

    def raw(self, name):
        return read_file_stream(
            self.spark, f"{self.root}/landing/{name}", FORMATS[name], feed_schema(name),
            keep_corrupt=name == "products",
        )

    def ingest(self, name, stream):
        run_to_end(start_append(stream, f"{self.root}/bronze/{name}", f"{self.root}/cp/{name}"))

    def bronze(self, name):
        return self.spark.read.parquet(f"{self.root}/bronze/{name}")

    def table(self, name):
        return self.spark.table(f"lake.{name}")

    def put(self, name, df, how="append"):
        full = f"lake.{name}"
        tables.ensure_table(self.spark, full, name)
        df = tables.conform(df, name)
        if how == "append":
            tables.append(df, full)
        else:
            parts = [c.name for c in self.spark.catalog.listColumns(full) if c.isPartition]
            tables.refresh(df, full, partition_by=parts)

    def run(self, run_id):
        spark = self.spark
        self.ingest("products", feeds.ingest_products(self.raw("products"))[0])
        self.ingest("orders", feeds.ingest_orders(self.raw("orders")))
        self.ingest("customers", feeds.ingest_customers(self.raw("customers")))
        categories = feeds.product_categories(self.bronze("products"))
        self.ingest("order_items", feeds.ingest_order_items(self.raw("order_items"), categories))
        self.ingest("payments", feeds.ingest_payments(self.raw("payments")))

        tables.ensure_table(spark, "lake.orders_silver", "orders_silver")
        mark = high_water_mark(self.table("orders_silver"), "_ingestion_timestamp")
        updates = cleaned.order_updates(
            incremental(self.bronze("orders"), "_ingestion_timestamp", mark), as_of=AS_OF
        )
        tables.merge_partitions(
            tables.conform(updates, "orders_silver"), "lake.orders_silver", ["order_id"],
            "order_year_month", lambda t, s, _: cleaned.merge_orders(t, s),
        )
        tables.ensure_table(spark, "lake.customers_scd2", "customers_scd2")
        tables.write_scd2(
            cleaned.customers_scd2(
                self.table("customers_scd2"), self.bronze("customers"), newest="_last_updated",
                as_of=AS_OF, current_only=True,
            ),
            "lake.customers_scd2",
        )
        self.put("products_silver", cleaned.products_silver(
            self.bronze("products"), category_translations(spark), as_of=AS_OF), "refresh")
        self.put("order_items_silver", cleaned.order_items_silver(
            self.bronze("order_items"), as_of=AS_OF), "refresh")
        self.put("payments_silver", cleaned.payments_silver(
            self.bronze("payments"), as_of=AS_OF), "refresh")

        orders, items = self.table("orders_silver"), self.table("order_items_silver")
        payments, products = self.table("payments_silver"), self.table("products_silver")
        customers = self.table("customers_scd2")
        tables.ensure_table(spark, "lake.daily_sales_summary", "daily_sales_summary")
        stored = self.table("daily_sales_summary")
        since = high_water_mark(stored, "report_date", "date")
        fresh = sales.daily_sales(orders, items, payments, since=since, as_of=AS_OF)
        self.put("daily_sales_summary", upsert_all(
            stored, tables.conform(fresh, "daily_sales_summary"), ["report_date"]), "refresh")
        self.put("customer_segments", sales.customer_segmentation(orders, items, as_of=AS_OF))
        self.put("product_performance", catalogue.product_performance(
            orders, items, products, as_of=AS_OF), "refresh")
        self.put("seller_analytics", partners.seller_analytics(orders, items, as_of=AS_OF), "refresh")
        self.put("inventory_analytics", catalogue.inventory_analytics(
            orders, items, products, as_of=AS_OF), "refresh")
        self.put("geographical_analytics", partners.geographical_analytics(
            customers, orders, items, as_of=AS_OF), "refresh")
        life = tables.conform(
            partners.order_lifecycle(orders, payments, customers, items, as_of=AS_OF),
            "order_lifecycle",
        )
        tables.ensure_table(spark, "lake.order_lifecycle", "order_lifecycle")
        self.put("order_lifecycle", upsert_changed(
            self.table("order_lifecycle"), life,
            ["order_id", "payment_type_standardized", "payment_installments", "payment_value"],
            ["order_status"]), "refresh")
        self.put("cross_selling_opportunities", catalogue.cross_selling(
            items, products, min_co=2, as_of=AS_OF), "refresh")
        self.put("pipeline_audit_log", monitoring.audit_events(
            spark, [(run_id, datetime(2020, 1, 1), "all", "SUCCESS", "1", None, 1.0)]))
        self.put("pipeline_execution_report", monitoring.run_report(
            self.table("pipeline_audit_log"), run_id))


@pytest.fixture
def lake(spark, tmp_path):
    tables.ensure_namespaces(spark, ["lake"])
    yield Lake(spark, str(tmp_path))
    spark.sql("DROP SCHEMA lake CASCADE")
    release_scratch(spark)


def test_two_runs_equal_one(spark, lake):
    orders = feed(spark, SF, "src_orders")
    items, payments = feed(spark, SF, "src_items"), feed(spark, SF, "src_payments")
    early = F.col("order_purchase_timestamp") < F.lit(CUT).cast("timestamp")
    old = orders.filter(early).select("order_id")
    lake.land("products", feed(spark, SF, "src_products"))
    lake.land("orders", orders.filter(early).withColumn("order_status", F.lit("created")))
    lake.land("order_items", items.join(old, "order_id", "left_semi"))
    lake.land("payments", payments.filter(early))
    lake.land("customers", feed(spark, SF, "src_customers_first").withColumnRenamed(
        "updated_at", "_last_updated"))
    lake.run("r1")
    assert lake.table("orders_silver").count() == old.count()
    assert lake.table("daily_sales_summary").agg(F.max("report_date")).first()[0].year == 1998

    # Second landing: final state of every order, the remaining rows, the moved customers.
    lake.land("orders", orders)
    lake.land("order_items", items.join(old, "order_id", "left_anti"))
    lake.land("payments", payments.filter(~early))
    lake.land("customers", feed(spark, SF, "src_customers_second").withColumnRenamed(
        "updated_at", "_last_updated"))
    lake.run("r2")

    state = rows(lake.table("orders_silver"), "order_id", "order_status")
    assert state == rows(orders, "order_id", "order_status")
    assert {r[0] for r in rows(lake.table("orders_silver"), "_operation")} == {"INSERT", "UPDATE"}
    current = lake.table("customers_scd2").filter("is_current")
    assert current.count() == feed(spark, SF, "src_customers").count()
    assert lake.table("customers_scd2").agg(F.max("version")).first()[0] == 2

    def final(build):
        o, i = lake.table("orders_silver"), cleaned.with_freight_ratio(items)
        return build(o, i)

    products = lake.table("products_silver")
    whole = {
        "product_performance": final(lambda o, i: catalogue.product_performance(o, i, products)),
        "seller_analytics": final(partners.seller_analytics),
        "inventory_analytics": final(lambda o, i: catalogue.inventory_analytics(o, i, products)),
        "geographical_analytics": final(
            lambda o, i: partners.geographical_analytics(current, o, i)),
    }
    for name, df in whole.items():
        cols = [f.name for f in table_schema(name).fields
                if not f.name.startswith("_") and f.name != "stddev_monthly_orders"]
        assert rows(lake.table(name), *cols) == rows(tables.conform(df, name), *cols), name

    # Days before the second run's mark keep the first run's figures, later ones are complete.
    fresh = sales.daily_sales(
        lake.table("orders_silver"), items, cleaned.payments_silver(payments))
    late = F.col("report_date") >= F.lit(CUT).cast("date")
    cols = ["report_date", "total_orders", "total_revenue", "total_payments"]
    assert rows(lake.table("daily_sales_summary").filter(late), *cols) == rows(
        fresh.filter(late), *cols)
    assert lake.table("daily_sales_summary").count() == fresh.count()

    life = lake.table("order_lifecycle")
    assert life.filter("order_status = 'created'").count() == 0
    assert lake.table("customer_segments").count() > 0
    assert lake.table("cross_selling_opportunities").count() > 0
    assert rows(lake.table("pipeline_execution_report"), "pipeline_run_id", "status") == [
        ("r1", "SUCCESS"), ("r2", "SUCCESS")]
