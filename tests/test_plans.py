"""Hand-made rows for the cleaned and business tables: NULLs, zeros, ties, tier boundaries."""

from datetime import date, datetime

import pytest
from helpers import plan, rows
from pyspark.sql import functions as F

from shopgrain.functions import band, exact_sum, money, percent, ratio
from shopgrain.operators.merge import upsert_all
from shopgrain.plans import catalogue, cleaned, monitoring, partners, sales
from shopgrain.schemas import TABLES, table_schema
from shopgrain.sources.dimensions import category_translations
from shopgrain.sources.tables import conform

T = "cast({} as timestamp)"


def orders(spark, data):
    """(order, customer, status, purchase, delivered, estimated)"""
    df = spark.createDataFrame(
        data, "order_id BIGINT, customer_id BIGINT, order_status STRING, p STRING, d STRING, e STRING"
    )
    times = {
        "order_purchase_timestamp": "p", "order_delivered_customer_date": "d",
        "order_estimated_delivery_date": "e",
    }
    df = df.withColumns({n: F.col(c).cast("timestamp") for n, c in times.items()}).withColumns(
        {
            "order_approved_at": F.col("order_purchase_timestamp"),
            "order_delivered_carrier_date": F.col("order_purchase_timestamp"),
        }
    )
    return cleaned.order_updates(df.drop("p", "d", "e"), as_of="2020-06-01")


def items(spark, data):
    """(order, item, product, seller, price, freight)"""
    df = spark.createDataFrame(
        data,
        "order_id BIGINT, order_item_id BIGINT, product_id BIGINT, seller_id BIGINT, price DOUBLE, "
        "freight_value DOUBLE",
    )
    return cleaned.with_freight_ratio(
        df.withColumn("shipping_limit_date", F.lit("2020-01-01").cast("timestamp"))
    )


def payments(spark, data):
    return cleaned.payments_silver(
        spark.createDataFrame(
            data,
            "order_id BIGINT, payment_sequential INT, payment_type STRING, "
            "payment_installments INT, payment_value DOUBLE",
        ),
        as_of="2020-06-01",
    )


@pytest.fixture
def shop(spark):
    """Order 1: two items, two payments. 2: late. 3: canceled. 4: no items. 5: no payment."""
    return (
        orders(spark, [
            (1, 100, "delivered", "2020-01-01 23:00:00", "2020-01-03 01:00:00", "2020-01-05"),
            (2, 100, "delivered", "2020-01-01 10:00:00", "2020-01-09", "2020-01-05"),
            (3, 200, "canceled", "2020-01-02 10:00:00", None, "2020-01-05"),
            (4, 300, "delivered", "2020-01-02 10:00:00", "2020-01-03", "2020-01-05"),
            (5, 400, "shipped", "2020-02-03 10:00:00", None, "2020-02-05"),
        ]),
        items(spark, [
            (1, 1, 10, 7, 10.0, 1.0), (1, 2, 20, 7, 30.0, 3.0), (2, 1, 10, 8, 20.0, 0.0),
            (3, 1, 10, 7, 40.0, 4.0), (5, 1, 30, 9, 0.0, 2.0),
        ]),
        payments(spark, [
            (1, 1, "credit_card", 2, 25.0), (1, 2, "voucher", 1, 15.0), (2, 1, "pix", 0, 20.0),
            (3, 1, None, 1, 44.0), (4, 1, "boleto", 1, 5.0),
        ]),
    )


def test_orders_measures(shop):
    got = rows(shop[0], "order_id", "processing_time_days", "delivery_delay_days", "is_delayed")
    assert got == [
        (1, 2, -2, False), (2, 8, 4, True), (3, None, None, False), (4, 1, -2, False),
        (5, None, None, False),
    ]


def test_orders_change_feed_keeps_the_last_version(spark, shop):
    feed = shop[0].select(
        "order_id", "order_status", "order_purchase_timestamp", "order_delivered_customer_date",
        "order_estimated_delivery_date", F.lit(1.0).alias("payment_value"),
        F.lit("2020-03-01").cast("timestamp").alias("_ingestion_timestamp"),
    )
    newer = feed.filter("order_id = 1").withColumns(
        {"order_status": F.lit("returned"),
         "_ingestion_timestamp": F.lit("2020-03-02").cast("timestamp")}
    )
    both = cleaned.orders_silver(feed.unionByName(newer), as_of="2020-04-01")
    assert both.count() == 5
    assert rows(both.filter("order_id = 1"), "order_status") == [("returned",)]
    merged = cleaned.orders_silver(
        feed.unionByName(newer), cleaned.orders_silver(feed, as_of="2020-04-01"),
        since="2020-03-01 12:00:00", as_of="2020-05-01",
    )
    assert rows(merged, "order_id", "_operation")[:2] == [(1, "UPDATE"), (2, "INSERT")]


def test_daily_sales_joined_grain(shop):
    got = {r.report_date: r for r in sales.daily_sales(*shop, as_of="2020-06-01").collect()}
    assert set(got) == {date(2020, 1, 1), date(2020, 1, 2)}
    day = got[date(2020, 1, 1)]
    # Order 1 gives 2 x 2 rows, order 2 one row.
    assert (day.total_orders, day.unique_customers, day.payment_methods_used) == (2, 1, 3)
    assert day.total_revenue == 100.0 and day.avg_order_value == 20.0
    assert day.total_payments == 100.0 and day.total_freight == 8.0
    assert (day.delayed_orders, day.delay_rate, day.freight_percentage) == (1, 20.0, 8.0)
    assert day.avg_processing_time_days == 3.2 and day._report_year_month == "2020-01"


def test_daily_sales_order_grain(shop):
    got = {r.report_date: r for r in sales.daily_sales(*shop, grain="order").collect()}
    day = got[date(2020, 1, 1)]
    assert (day.total_revenue, day.total_payments, day.total_freight) == (60.0, 60.0, 4.0)
    assert (day.avg_order_value, day.delayed_orders, day.delay_rate) == (30.0, 1, 50.0)
    with pytest.raises(ValueError):
        sales.daily_sales(*shop, grain="item")


def test_daily_sales_since(shop):
    def days(**kw):
        return [r[0].day for r in rows(sales.daily_sales(*shop, **kw), "report_date")]

    assert days(since="2020-01-01") == [1, 2]
    assert days(since="2020-01-01", lookback_days=None) == [2]
    assert days(since="2020-01-02", lookback_days=0) == [2]


def test_daily_sales_refuses_an_unknown_payment_type(shop):
    odd = shop[2].withColumn("payment_type_standardized", F.lit("SHELLS"))
    with pytest.raises(Exception, match="SHELLS"):
        sales.daily_sales(shop[0], shop[1], odd).collect()


def test_item_windows(spark):
    got = cleaned.order_items_silver(
        items(spark, [(1, 1, 1, 7, 20.0, 5.0), (1, 2, 1, 7, 20.0, 1.0), (1, 3, 1, 8, 10.0, 0.0),
                      (2, 1, 1, 7, 0.0, 3.0), (3, 1, 1, 9, None, 3.0)]).drop("freight_ratio")
    )
    cols = ("order_id", "order_item_id", "item_rank", "running_total", "order_total",
            "revenue_contribution_pct", "is_above_avg", "freight_ratio")
    assert rows(got, *cols) == [
        (1, 1, 2, 30.0, 50.0, 40.0, True, 0.25), (1, 2, 3, 50.0, 50.0, 40.0, True, 0.05),
        (1, 3, 1, 10.0, 50.0, 20.0, False, 0.0), (2, 1, 1, 0.0, 0.0, None, False, None),
        (3, 1, 1, None, None, None, False, None),
    ]


def test_touched_items_match_the_full_result(spark):
    """The orders of the touched order's seller come too: its average price moves in all of them."""
    rows_in = items(spark, [(o, i, 1, o % 2, float(o + i), 1.0) for o in range(5) for i in range(4)])
    bronze = rows_in.drop("freight_ratio")
    full = cleaned.order_items_silver(bronze, as_of="2020-01-01")
    new = bronze.filter("order_id = 2")
    part = cleaned.order_items_silver(bronze, touched=new, as_of="2020-01-01")
    assert rows(part) == rows(full.filter("order_id % 2 = 0"))
    old = cleaned.order_items_silver(bronze.filter("order_id <> 2"), as_of="2020-01-01")
    assert rows(upsert_all(old, part, ["order_id", "order_item_id"])) == rows(full)


def test_an_order_with_more_rows_than_a_billion(spark):
    """Row counts multiply as decimals."""
    out = spark.sql("SELECT CAST(3000000000 AS BIGINT) AS n").select(
        F.sum(sales._wide(F.col("n")) * sales._wide(F.col("n"))).alias("rows")
    )
    assert out.first()[0] == 9 * 10**18


def test_payment_rules(spark):
    got = payments(spark, [
        (1, 1, "credit_card", 3, 100.0), (2, 1, "pix", 0, 10.0), (3, 1, "crypto", 1, 60_000.0),
        (4, 1, "boleto", None, 50_000.0), (5, 1, "boleto", 1, 50_000.01), (6, 1, "voucher", 1, 0.0),
        (7, 1, "voucher", -1, None), (8, 1, None, 1, 10_000.0),
    ])
    cols = ("order_id", "payment_type_standardized", "validation_status", "installment_value",
            "is_installment_valid", "is_high_value", "payment_method_category")
    assert rows(got, *cols) == [
        (1, "CREDIT_CARD", "VALID", 33.33, True, False, "CARD"),
        (2, "OTHER", "VALID", None, False, False, "OTHER"),
        (3, "OTHER", "INVALID", 60_000.0, True, True, "OTHER"),
        (4, "BOLETO", "VALID", None, False, True, "BANK_SLIP"),
        (5, "BOLETO", "SUSPICIOUS", 50_000.01, True, True, "BANK_SLIP"),
        (6, "VOUCHER", "ZERO_VALUE", 0.0, True, False, "OTHER"),
        (7, "VOUCHER", "ZERO_VALUE", None, False, False, "OTHER"),
        (8, "OTHER", "INVALID", 10_000.0, True, False, "OTHER"),
    ]


def test_products(spark):
    bronze = spark.createDataFrame(
        [(1, "livros", "ab", "abc", "x,y", 1, 1, 1, 1), (2, "nope", None, "", "", 1, 1, 1, 1),
         (3, None, "a", None, None, 1, 1, 1, 1)],
        "product_id BIGINT, product_category_name STRING, product_name STRING, "
        "product_description STRING, product_photos STRING, product_weight_g INT, "
        "product_length_cm INT, product_height_cm INT, product_width_cm INT",
    )
    got = cleaned.products_silver(bronze, category_translations(spark))
    cols = ("product_id", "product_category_name_english", "product_name_length",
            "product_description_length", "product_photos_qty", "category_level")
    assert rows(got, *cols) == [
        (1, "Books", 2, 3, 2, "KNOWN"), (2, None, None, 0, 1, "UNKNOWN"),
        (3, None, 1, None, None, "UNKNOWN"),
    ]
    assert "BroadcastHashJoin" in plan(got)


def test_product_performance(spark, shop):
    products = spark.createDataFrame(
        [(10, "A"), (20, None), (30, "C"), (99, "D")],
        "product_id BIGINT, product_category_name_english STRING",
    )
    got = {r.product_id: r for r in
           catalogue.product_performance(shop[0], shop[1], products).collect()}
    assert set(got) == {10, 20, 30}
    p = got[10]
    assert (p.total_orders, p.unique_buyers, p.total_revenue) == (3, 2, 70.0)
    assert (p.product_lifetime_days, p.daily_revenue_velocity) == (1, 70.0)
    assert (p.return_count, p.return_value, p.return_rate) == (1, 40.0, 33.33)
    assert (p.revenue_tier, p.risk_level) == ("LOW_PERFORMER", "HIGH_RISK")
    assert (got[20].product_lifetime_days, got[20].daily_revenue_velocity) == (0, None)
    assert got[20].return_value == 0.0 and got[20].category is None


def test_inventory(spark):
    o = orders(spark, [(i, i % 3, "delivered", f"2020-0{1 + i // 4}-02", None, None)
                       for i in range(1, 7)])
    it = items(spark, [(i, 1, 10, 1, 5.0, 0.0) for i in range(1, 7)] + [(1, 2, 20, 1, 5.0, 0.0)])
    products = spark.createDataFrame(
        [(10, "A"), (20, "B")], "product_id BIGINT, product_category_name_english STRING"
    )
    got = {r.product_id: r for r in catalogue.inventory_analytics(o, it, products).collect()}
    r = got[10]
    assert (r.months_active, r.total_orders, r.peak_monthly_orders, r.low_monthly_orders) == (2, 6, 3, 3)
    assert (r.avg_monthly_orders, r.stddev_monthly_orders, r.recommended_reorder_level) == (3.0, 0.0, 3)
    assert (r.total_buyers, r.inventory_turnover_rate, r.inventory_category) == (6, 3.0, "DEAD_STOCK")
    assert got[20].stddev_monthly_orders is None and got[20].recommended_reorder_level == 1


def test_sellers(shop):
    got = {r.seller_id: r for r in partners.seller_analytics(shop[0], shop[1]).collect()}
    s = got[7]
    assert (s.total_orders, s.unique_products_sold, s.unique_customers) == (2, 2, 2)
    assert (s.total_revenue, s.delayed_deliveries, s.delayed_rate) == (80.0, 0, 0.0)
    assert (s.seller_rank, s.seller_tier, s.reliability_score) == (1, "ELITE", 5)
    assert (got[8].delayed_rate, got[8].reliability_score, got[8].daily_revenue) == (100.0, 1, None)
    assert got[9].avg_delivery_days is None and got[9].avg_freight_ratio is None


def test_places(spark, shop):
    customers = spark.createDataFrame(
        [(100, "S", "c1", 1, True), (200, "S", "c2", 2, True), (400, "T", None, 3, True),
         (100, "X", "old", 9, False)],
        "customer_id BIGINT, customer_state STRING, customer_city STRING, "
        "customer_zip_code_prefix INT, is_current BOOLEAN",
    )
    got = {r.customer_zip_code_prefix: r for r in
           partners.geographical_analytics(customers, shop[0], shop[1]).collect()}
    assert set(got) == {1, 2, 3}
    r = got[1]
    assert (r.total_customers, r.total_orders, r.total_revenue, r.active_sellers) == (1, 2, 60.0, 2)
    assert (r.delayed_orders, r.delay_rate, r.avg_delay) == (1, 50.0, 0.0)
    assert (r.city_rank_in_state, got[2].city_rank_in_state) == (1, 2)
    assert got[3].avg_delay is None and got[3].customer_city is None


def test_lifecycle_merges_equal_payments(spark):
    o = orders(spark, [(1, 100, "delivered", "2020-01-01 23:00:00", "2020-01-03 01:00:00", None)])
    p = payments(spark, [(1, 1, "pix", 1, 5.0), (1, 2, "pix", 1, 5.0), (1, 3, "boleto", 6, 5.0)])
    c = spark.createDataFrame(
        [(100, "S", "c", True)],
        "customer_id BIGINT, customer_state STRING, customer_city STRING, is_current BOOLEAN",
    )
    it = items(spark, [(1, 1, 10, 1, 2.0, 0.0), (1, 2, 10, 1, 3.0, 0.0)])
    got = partners.order_lifecycle(o, p, c, it)
    cols = ("payment_type_standardized", "order_value", "items_count", "total_cycle_time_days",
            "approval_sla", "order_complexity", "payment_complexity", "bottleneck_stage")
    # One day and two hours: one whole day, though two calendar days.
    assert rows(got, *cols) == [
        ("BOLETO", 5.0, 1, 1, "WITHIN_SLA", "SIMPLE", "HIGH_INSTALLMENT", "NONE"),
        ("OTHER", 10.0, 1, 1, "WITHIN_SLA", "SIMPLE", "SINGLE_PAYMENT", "NONE"),
    ]


def test_segments(spark, shop):
    got = {r.customer_id: r for r in
           sales.customer_segmentation(shop[0], shop[1], as_of="2020-01-31").collect()}
    assert (got[100].days_since_last_purchase, got[100].recency_score) == (30, 5)
    assert got[200].recency_score == 5 and got[400].days_since_last_purchase == -3
    assert all(3 <= r.rfm_score <= 15 for r in got.values())
    assert got[100].customer_segment == "POTENTIAL_LOYALISTS"


@pytest.mark.parametrize("cuts,test,values", [
    (sales.RfmCuts().recency_days, "<=", {30: 5, 31: 4, 60: 4, 61: 3, 90: 3, 91: 2, 180: 2, 181: 1}),
    (sales.RfmCuts().orders, ">=", {10: 5, 9: 4, 7: 4, 6: 3, 5: 3, 4: 2, 3: 2, 2: 1}),
    (sales.RfmCuts().spent, ">=", {50_000: 5, 49_999: 4, 30_000: 4, 29_999: 3, 10_000: 3,
                                   9_999: 2, 5_000: 2, 4_999: 1}),
    (partners.SellerCuts().delayed_rate, "<=", {5: 5, 6: 4, 10: 4, 11: 3, 20: 3, 21: 2, 30: 2, 31: 1}),
])
def test_score_boundaries(spark, cuts, test, values):
    df = spark.createDataFrame([(float(v), s) for v, s in values.items()] + [(None, 1)], "v DOUBLE, s INT")
    assert df.filter(band("v", test, cuts, 1) != F.col("s")).count() == 0


@pytest.mark.parametrize("cuts,test,default,values", [
    (sales.RfmCuts().segments, ">=", "LOST",
     {13: "CHAMPIONS", 12: "LOYAL_CUSTOMERS", 10: "LOYAL_CUSTOMERS", 9: "POTENTIAL_LOYALISTS",
      7: "POTENTIAL_LOYALISTS", 6: "AT_RISK", 5: "AT_RISK", 4: "LOST"}),
    (catalogue.ProductCuts().revenue, ">=", "LOW_PERFORMER",
     {100_000: "PREMIUM", 99_999: "HIGH_PERFORMER", 50_000: "HIGH_PERFORMER", 49_999: "STANDARD",
      10_000: "STANDARD", 9_999: "LOW_PERFORMER"}),
    (catalogue.ProductCuts().risk, ">", "LOW_RISK",
     {21: "HIGH_RISK", 20: "MEDIUM_RISK", 11: "MEDIUM_RISK", 10: "LOW_RISK"}),
    (catalogue.InventoryCuts().turnover, ">", "DEAD_STOCK",
     {101: "FAST_MOVING", 100: "REGULAR", 51: "REGULAR", 50: "SLOW_MOVING", 11: "SLOW_MOVING",
      10: "DEAD_STOCK"}),
    (partners.SellerCuts().rank, "<=", "NEW",
     {10: "ELITE", 11: "TOP_PERFORMER", 50: "TOP_PERFORMER", 51: "GROWING", 200: "GROWING",
      201: "ESTABLISHED", 500: "ESTABLISHED", 501: "NEW"}),
    (partners.MarketCuts().revenue_per_customer, ">", "DEVELOPING_MARKET",
     {10_001: "PREMIUM_MARKET", 10_000: "HIGH_VALUE_MARKET", 5_000: "STANDARD_MARKET",
      2_000: "DEVELOPING_MARKET"}),
    (catalogue.LiftCuts().strength, ">", "NEGLIGIBLE",
     {5.1: "STRONG", 5: "MODERATE", 3: "WEAK", 1.5: "NEGLIGIBLE"}),
])
def test_tier_boundaries(spark, cuts, test, default, values):
    df = spark.createDataFrame([(float(v), t) for v, t in values.items()], "v DOUBLE, t STRING")
    assert df.filter(band("v", test, cuts, default) != F.col("t")).count() == 0


def test_exact_sum_is_order_free(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(1e9 + 0.01,), (None,)], "v DOUBLE")
    assert df.agg(money(exact_sum("v"))).first()[0] == 1000000001.01
    assert df.limit(0).agg(money(exact_sum("v"))).first()[0] is None


def test_safe_division(spark):
    df = spark.createDataFrame([(1, 0), (1, None), (1, 3)], "a INT, b INT")
    assert rows(df, ratio("a", "b"), percent("a", "b")) == [(0.3333333333333333, 33.33), (None, None), (None, None)]


def test_run_report(spark):
    at = datetime(2020, 1, 1, 0, 0, 10)
    audit = monitoring.audit_events(spark, [
        ("r1", at, "orders", "SUCCESS", "Streaming", None, 4.0),
        ("r1", datetime(2020, 1, 1, 0, 0, 20), "items", "FAILED", None, "boom", 14.0),
        ("r1", datetime(2020, 1, 1, 0, 0, 21), "PIPELINE", "FAILED", None, "boom", 15.0),
        ("r2", at, "orders", "SUCCESS", "12", None, 1.5),
    ])
    got = {r.pipeline_run_id: r for r in monitoring.run_report(audit).collect()}
    r = got["r1"]
    assert (r.start_time, r.end_time) == (datetime(2020, 1, 1, 0, 0, 6), datetime(2020, 1, 1, 0, 0, 21))
    assert (r.duration_seconds, r.successful_modules, r.failed_modules, r.status) == (15.0, 1, 1, "PARTIAL_FAILURE")
    assert monitoring.run_report(audit, "r2").first().status == "SUCCESS"


def test_results_fit_their_contracts(spark, shop):
    products = spark.createDataFrame([(10, "A")], "product_id BIGINT, product_category_name_english STRING")
    built = {
        "orders_silver": shop[0],
        "payments_silver": shop[2],
        "order_items_silver": cleaned.order_items_silver(shop[1].drop("freight_ratio")),
        "daily_sales_summary": sales.daily_sales(*shop),
        "customer_segments": sales.customer_segmentation(shop[0], shop[1]),
        "product_performance": catalogue.product_performance(shop[0], shop[1], products),
        "seller_analytics": partners.seller_analytics(shop[0], shop[1]),
        "inventory_analytics": catalogue.inventory_analytics(shop[0], shop[1], products),
    }
    optional = {"_ingestion_timestamp", "payment_sequential", "payment_type", "payment_installments", "payment_value"}
    for name, df in built.items():
        missing = set(table_schema(name).fieldNames()) - set(df.columns)
        assert missing <= (optional if name == "orders_silver" else set()), (name, missing)
        assert conform(df, name).schema.simpleString() == table_schema(name).simpleString()
    assert set(TABLES) >= set(built)
