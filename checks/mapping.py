"""The given tables as e-commerce feeds. The SQL text runs unchanged in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2001-08-15"  # after the last order; every query is scored as of this day
CUT = "1999-01-01"  # where the two-batch queries split what was loaded before from what is new
FIRST_LOAD, SECOND_LOAD = "1995-01-01", "1998-01-01"  # customer feed times

_STATUS = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'canceled' END"
_BOUGHT = "o_orderdate + (o_orderkey % 24) * INTERVAL '1' HOUR"
_APPROVED = "o_orderdate + (o_orderkey % 24 + o_orderkey % 61) * INTERVAL '1' HOUR"
_CARRIER = (
    "o_orderdate + (o_orderkey % 24 + o_orderkey % 61 + (o_orderkey % 9) * 24) * INTERVAL '1' HOUR"
)
_DELIVERED = (
    "CASE WHEN o_orderstatus = 'F' THEN o_orderdate + (o_orderkey % 24 + o_orderkey % 61"
    " + (o_orderkey % 9) * 24 + (o_custkey % 11) * 24) * INTERVAL '1' HOUR END"
)
_PAY_TYPE = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'credit_card' WHEN '2-HIGH' THEN 'debit_card'"
    " WHEN '3-MEDIUM' THEN 'boleto' WHEN '4-NOT SPECIFIED' THEN 'voucher' ELSE 'pix' END"
)
_INSTALLMENTS = "CAST(o_orderkey % 8 AS INT)"
_PAID = "CASE WHEN o_orderkey % 97 = 0 THEN CAST(0 AS DOUBLE) ELSE o_totalprice / 8 END"


def _order(status: str, delivered: str, ingested: str) -> str:
    return f"""SELECT o_orderkey AS order_id, o_custkey AS customer_id, {status} AS order_status,
      {_BOUGHT} AS order_purchase_timestamp, {_APPROVED} AS order_approved_at,
      {_CARRIER} AS order_delivered_carrier_date, {delivered} AS order_delivered_customer_date,
      o_orderdate + INTERVAL '10' DAY AS order_estimated_delivery_date,
      1 AS payment_sequential, {_PAY_TYPE} AS payment_type, {_INSTALLMENTS} AS payment_installments,
      {_PAID} AS payment_value, {ingested} AS _ingestion_timestamp
    FROM orders"""


def _customer(zip_: str, city: str, time: str) -> str:
    return f"""SELECT c_custkey AS customer_id, c_name AS customer_unique_id,
      {zip_} AS customer_zip_code_prefix, {city} AS customer_city, n_name AS customer_state,
      CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS customer_phone,
      CONCAT('u', CAST(c_custkey AS VARCHAR(20)), '@example.com') AS customer_email,
      TIMESTAMP '{FIRST_LOAD} 00:00:00' AS customer_created_at,
      TIMESTAMP '{time} 00:00:00' AS updated_at
    FROM customer JOIN nation ON c_nationkey = n_nationkey"""


_ZIP = "c_nationkey * 100 + CAST(c_custkey % 10 AS INT)"
_CITY = "CONCAT(n_name, '-', CAST(c_custkey % 5 AS VARCHAR(4)))"
_MOVED = "c_mktsegment = 'BUILDING'"

# Feed -> (given tables it reads, SQL).
FEEDS: dict[str, tuple[tuple[str, ...], str]] = {
    "src_orders": (("orders",), _order(_STATUS, _DELIVERED, _BOUGHT)),
    # Change feed: every order when placed, when final (day 20) and once more unchanged (day 40).
    "src_order_changes": (
        ("orders",),
        _order("'created'", "CAST(NULL AS TIMESTAMP)", _BOUGHT)
        + " UNION ALL "
        + _order(_STATUS, _DELIVERED, "o_orderdate + INTERVAL '20' DAY")
        + " UNION ALL "
        + _order(_STATUS, _DELIVERED, "o_orderdate + INTERVAL '40' DAY"),
    ),
    # Urgent orders have a second payment of another kind, low-priority ones two equal payments.
    "src_payments": (
        ("orders",),
        f"""SELECT o_orderkey AS order_id, 1 AS payment_sequential, {_PAY_TYPE} AS payment_type,
          {_INSTALLMENTS} AS payment_installments, {_PAID} AS payment_value,
          {_BOUGHT} AS order_purchase_timestamp
        FROM orders
        UNION ALL
        SELECT o_orderkey, 2, CASE WHEN o_orderkey % 2 = 0 THEN 'crypto' ELSE 'voucher' END, 1,
          o_totalprice / 16, {_BOUGHT}
        FROM orders WHERE o_orderpriority = '1-URGENT'
        UNION ALL
        SELECT o_orderkey, 2, {_PAY_TYPE}, {_INSTALLMENTS}, {_PAID}, {_BOUGHT}
        FROM orders WHERE o_orderpriority = '5-LOW'""",
    ),
    "src_dirty_payments": (
        ("orders",),
        f"""SELECT CASE WHEN o_orderkey % 19 = 0 THEN CAST(NULL AS BIGINT) ELSE o_orderkey END
            AS order_id, 1 AS payment_sequential,
          CASE WHEN o_orderkey % 13 = 0 THEN NULL WHEN o_orderkey % 14 = 0 THEN ' Credit_Card '
            ELSE {_PAY_TYPE} END AS payment_type,
          {_INSTALLMENTS} AS payment_installments,
          CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 12 = 0 THEN -o_totalprice
            ELSE o_totalprice / 8 END AS payment_value,
          {_BOUGHT} AS order_purchase_timestamp
        FROM orders""",
    ),
    # Line numbers repeat within an order, prices do not: both make the item number.
    "src_items": (
        ("lineitem",),
        """SELECT l_orderkey AS order_id,
          CAST(l_linenumber AS BIGINT) * 10000000000 + CAST(FLOOR(l_extendedprice * 100 + 0.5e0) AS BIGINT)
            AS order_item_id,
          l_partkey AS product_id, l_suppkey AS seller_id, l_shipdate AS shipping_limit_date,
          l_extendedprice AS price,
          FLOOR(l_extendedprice * 100 + 0.5e0) * FLOOR(l_tax * 100 + 0.5e0) / 10000.0e0
            AS freight_value
        FROM lineitem""",
    ),
    "src_customers": (("customer", "nation"), _customer(_ZIP, _CITY, FIRST_LOAD)),
    # First load: accounts not in debt. Second load: everybody; one market segment has moved.
    "src_customers_first": (
        ("customer", "nation"),
        _customer(_ZIP, _CITY, FIRST_LOAD) + " WHERE c_acctbal >= 0",
    ),
    "src_customers_second": (
        ("customer", "nation"),
        _customer(
            f"{_ZIP} + CASE WHEN {_MOVED} THEN 5000 ELSE 0 END",
            f"CONCAT({_CITY}, CASE WHEN {_MOVED} THEN '-moved' ELSE '' END)",
            SECOND_LOAD,
        ),
    ),
    # Three versions of everybody in one batch (cities change back and forth), and one that comes late.
    "src_customers_third": (
        ("customer", "nation"),
        _customer(
            f"{_ZIP} + CASE WHEN {_MOVED} THEN 5000 ELSE 0 END",
            f"CONCAT({_CITY}, CASE WHEN {_MOVED} THEN '-moved' ELSE '' END)",
            "1998-01-01",
        )
        + " UNION ALL "
        + _customer(_ZIP, f"CONCAT({_CITY}, CASE WHEN c_acctbal < 5000 THEN '-new' ELSE '' END)", "1999-01-01")
        + " UNION ALL "
        + _customer(_ZIP, _CITY, "2000-01-01"),
    ),
    "src_customers_late": (
        ("customer", "nation"),
        _customer(_ZIP, f"CONCAT({_CITY}, CASE WHEN c_mktsegment = 'MACHINERY' THEN '-old' ELSE '' END)", "1996-01-01"),
    ),
    "src_products": (
        ("part",),
        """SELECT p_partkey AS product_id,
          CASE p_type WHEN 'ECONOMY' THEN 'beleza_saude' WHEN 'LARGE' THEN 'informatica_acessorios'
            WHEN 'MEDIUM' THEN 'automotivo' WHEN 'PROMO' THEN 'cama_mesa_banho'
            WHEN 'SMALL' THEN 'moveis_decoracao' ELSE 'sem_traducao' END AS product_category_name,
          p_name AS product_name, CONCAT(p_brand, ' ', p_name) AS product_description,
          CASE p_size % 4 WHEN 1 THEN 'a' WHEN 2 THEN 'a,b' WHEN 3 THEN 'a,b,c' END
            AS product_photos,
          p_size * 100 AS product_weight_g, p_size + 10 AS product_length_cm,
          p_size + 5 AS product_height_cm, p_size + 3 AS product_width_cm
        FROM part""",
    ),
    "src_dirty_products": (
        ("part",),
        """SELECT p_partkey AS product_id,
          CASE WHEN p_partkey % 17 <> 0 THEN p_type END AS product_category_name,
          p_name AS product_name
        FROM part""",
    ),
    "src_brand_items": (
        ("lineitem", "part"),
        """SELECT l_orderkey AS order_id, p_brand AS brand
        FROM lineitem JOIN part ON l_partkey = p_partkey""",
    ),
    "src_brands": (
        ("part",),
        "SELECT DISTINCT p_brand AS brand, SUBSTRING(p_brand, 1, 7) AS maker FROM part",
    ),
    # Runs (one per day) of modules (the event types) in an audit log.
    "src_audit": (
        ("events",),
        """SELECT CAST(CAST(ts AS DATE) AS VARCHAR(10)) AS run_id, ts AS timestamp,
          CASE WHEN event_type = 'purchase' AND value > 90 THEN 'PIPELINE' ELSE event_type END
            AS module,
          CASE WHEN event_type = 'error' AND value > 60
            OR event_type = 'purchase' AND value > 93 THEN 'FAILED' ELSE 'SUCCESS' END AS status,
          CAST(event_id AS VARCHAR(20)) AS records_processed,
          CASE WHEN event_type = 'error' AND value > 60 THEN props END AS error,
          CAST(60 AS DOUBLE) AS execution_time_seconds
        FROM events""",
    ),
}


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def feed(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables, text = FEEDS[name]
    return with_timestamps(
        spark.sql(
            _named(text, tables), **{f"t_{t}": given(spark, sf_dir, t) for t in tables}
        )
    )


def with_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less times as UTC timestamps, the type of the table contracts."""
    zoneless = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def _named(text: str, tables: tuple[str, ...]) -> str:
    for t in tables:
        text = text.replace(f"FROM {t}", f"FROM {{t_{t}}}").replace(f"JOIN {t} ", f"JOIN {{t_{t}}} ")
    return text
