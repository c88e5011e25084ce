"""SQL for every registered query, written as the plain joins and windows the result is defined by.

The engine computes most of these another way (sums per order instead of the item x payment join,
nested group-bys instead of distinct counts, ranges instead of global windows), so each oracle is an
independent statement of the result.
"""

from __future__ import annotations

import re

from checks import queries as q
from checks.mapping import AS_OF, CUT, FEEDS, FIRST_LOAD, SECOND_LOAD
from shopgrain.plans import cleaned, partners
from shopgrain.sources.dimensions import CATEGORY_TRANSLATIONS

RUN = f"'{AS_OF} 00:00:00' AS _processed_timestamp"


def rnd(expr: str, digits: int) -> str:
    """Half-up rounding of a double by its shortest decimal text, as Spark rounds."""
    return f"CAST(ROUND(CAST(CAST(({expr}) AS VARCHAR) AS DECIMAL(38,17)), {digits}) AS DOUBLE)"


def dbl(expr: str) -> str:
    """Decimal to the nearest double."""
    return f"CAST(CAST({expr} AS VARCHAR) AS DOUBLE)"


def dec(col: str) -> str:
    return f"CAST({col} AS DECIMAL(18,6))"


def total(col: str) -> str:
    return dbl(f"SUM({dec(col)})")


def mean(col: str) -> str:
    return f"{total(col)} / NULLIF(COUNT({col}), 0)"


def pct(part: str, whole: str) -> str:
    return rnd(f"CAST({part} AS DOUBLE) * 100.0::DOUBLE / NULLIF(CAST({whole} AS DOUBLE), 0)", 2)


def ratio(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0)"


def band(col: str, test: str, cuts, default) -> str:
    def text(v):
        return f"'{v}'" if isinstance(v, str) else f"CAST({v} AS BIGINT)"

    arms = " ".join(f"WHEN {col} {test} {cut} THEN {text(label)}" for cut, label in cuts)
    return f"CASE {arms} ELSE {text(default)} END"


def txt(*cols: str) -> str:
    return ", ".join(f"CAST({c} AS VARCHAR) AS {c.split('.')[-1]}" for c in cols)


_TIMES = (
    "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
    "order_delivered_customer_date", "order_estimated_delivery_date",
)
_MEASURES = """
  CAST(date_diff('day', CAST(order_purchase_timestamp AS DATE),
    CAST(order_delivered_customer_date AS DATE)) AS BIGINT) AS processing_time_days,
  CAST(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
    CAST(order_delivered_customer_date AS DATE)) AS BIGINT) AS delivery_delay_days,
  COALESCE(date_diff('day', CAST(order_estimated_delivery_date AS DATE),
    CAST(order_delivered_customer_date AS DATE)) > 0, FALSE) AS is_delayed,
  strftime(order_purchase_timestamp, '%Y-%m') AS order_year_month"""
_HASH = "sha256(" + " || ".join(
    f"COALESCE(length(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-1:')"
    for c in cleaned.TRACKED
) + ")"
_PRODUCT = f"""SELECT i.product_id, p.product_category_name_english AS category,
    COUNT(DISTINCT i.order_id) AS total_orders, COUNT(DISTINCT o.customer_id) AS unique_buyers,
    {total('i.price')} AS total_revenue, {mean('i.price')} AS avg_selling_price,
    {total('i.freight_value')} / COUNT(*) AS avg_freight_cost,
    CAST(date_diff('day', CAST(MIN(o.order_purchase_timestamp) AS DATE),
      CAST(MAX(o.order_purchase_timestamp) AS DATE)) AS BIGINT) AS product_lifetime_days
  FROM items i JOIN orders_c o ON i.order_id = o.order_id
  JOIN products p ON i.product_id = p.product_id
  GROUP BY i.product_id, p.product_category_name_english"""

# Shared relations; each may use the ones before it and the feeds.
CTES = {
    "orders_c": f"SELECT *, {_MEASURES} FROM src_orders",
    "items": f"SELECT *, {rnd(ratio('freight_value', 'price'), 2)} AS freight_ratio FROM src_items",
    "payments": """SELECT order_id, payment_sequential,
        CASE payment_type WHEN 'credit_card' THEN 'CREDIT_CARD' WHEN 'debit_card' THEN 'DEBIT_CARD'
          WHEN 'boleto' THEN 'BOLETO' WHEN 'voucher' THEN 'VOUCHER' ELSE 'OTHER' END
          AS payment_type_standardized,
        payment_installments, payment_value, """
    + rnd(ratio("payment_value", "payment_installments"), 2)
    + """ AS installment_value,
        CASE WHEN payment_type NOT IN ('credit_card','debit_card','voucher','boleto','pix')
            THEN 'INVALID'
          WHEN payment_value <= 0 THEN 'ZERO_VALUE' WHEN payment_value > 50000 THEN 'SUSPICIOUS'
          ELSE 'VALID' END AS validation_status,
        payment_installments > 0 AS is_installment_valid, payment_value > 10000 AS is_high_value,
        CASE WHEN payment_type IN ('credit_card','debit_card') THEN 'CARD'
          WHEN payment_type = 'boleto' THEN 'BANK_SLIP' ELSE 'OTHER' END AS payment_method_category
      FROM src_payments""",
    "translations": "SELECT * FROM (VALUES "
    + ", ".join(f"('{a}', '{b}')" for a, b in CATEGORY_TRANSLATIONS)
    + ") AS t(product_category_name, product_category_name_english)",
    "products": f"""SELECT s.product_id, s.product_category_name, product_category_name_english,
        LENGTH(product_name) AS product_name_length,
        LENGTH(product_description) AS product_description_length,
        LENGTH(product_photos) - LENGTH(REPLACE(product_photos, ',', '')) + 1 AS product_photos_qty,
        product_weight_g, product_length_cm, product_height_cm, product_width_cm,
        CASE WHEN product_category_name_english IS NULL THEN 'UNKNOWN' ELSE 'KNOWN' END
          AS category_level
      FROM src_products s LEFT JOIN translations t
        ON s.product_category_name = t.product_category_name""",
    "customer_versions": "SELECT * FROM src_customers_first UNION ALL "
    "SELECT * FROM src_customers_second",
    "rfm": f"""SELECT *, recency_score + frequency_score + monetary_score AS rfm_score FROM (
      SELECT *, {band('days_since_last_purchase', '<=', q.RFM_CUTS.recency_days, 1)} AS recency_score,
        {band('total_orders', '>=', q.RFM_CUTS.orders, 1)} AS frequency_score,
        {band('total_spent', '>=', q.RFM_CUTS.spent, 1)} AS monetary_score
      FROM (SELECT o.customer_id,
          MAX(CAST(o.order_purchase_timestamp AS DATE)) AS last_purchase_date,
          COUNT(DISTINCT o.order_id) AS total_orders, {total('i.price')} AS total_spent,
          {mean('i.price')} AS avg_order_value,
          CAST(date_diff('day', MAX(CAST(o.order_purchase_timestamp AS DATE)), DATE '{AS_OF}')
            AS BIGINT) AS days_since_last_purchase
        FROM orders_c o JOIN items i ON o.order_id = i.order_id GROUP BY o.customer_id))""",
    "segments": f"""SELECT *, {band('rfm_score', '>=', q.RFM_CUTS.segments, q.RFM_CUTS.last_segment)}
        AS customer_segment FROM rfm""",
    "product_sales": _PRODUCT,
    "product_returns": f"""SELECT i.product_id, COUNT(*) AS return_count,
        {total('i.price')} AS return_value
      FROM items i JOIN orders_c o ON i.order_id = o.order_id
      WHERE o.order_status = 'canceled' GROUP BY i.product_id""",
    "product_kpis": f"""SELECT s.*, COALESCE(return_count, 0) AS return_count,
        COALESCE(return_value, 0) AS return_value,
        {pct('COALESCE(return_count, 0)', 'total_orders')} AS return_rate,
        {rnd(ratio('total_revenue', 'product_lifetime_days'), 2)} AS daily_revenue_velocity
      FROM product_sales s LEFT JOIN product_returns r ON s.product_id = r.product_id""",
    "movement": f"""SELECT i.product_id, p.product_category_name_english AS category,
        date_trunc('month', o.order_purchase_timestamp) AS sale_month,
        COUNT(DISTINCT i.order_id) AS orders, SUM({dec('i.price')}) AS revenue,
        COUNT(DISTINCT o.customer_id) AS buyers
      FROM items i JOIN orders_c o ON i.order_id = o.order_id
      JOIN products p ON i.product_id = p.product_id GROUP BY ALL""",
    "stock": f"""SELECT product_id, category, COUNT(DISTINCT sale_month) AS months_active,
        CAST(SUM(orders) AS BIGINT) AS total_orders, AVG(orders) AS avg_monthly_orders,
        STDDEV_SAMP(orders) AS stddev_raw, MAX(orders) AS peak_monthly_orders,
        MIN(orders) AS low_monthly_orders, {dbl('SUM(revenue)')} AS total_revenue,
        {dbl('SUM(revenue)')} / COUNT(revenue) AS avg_monthly_revenue,
        CAST(SUM(buyers) AS BIGINT) AS total_buyers,
        {rnd('SUM(orders)::DOUBLE / COUNT(DISTINCT sale_month)', 2)} AS inventory_turnover_rate
      FROM movement GROUP BY product_id, category""",
    "sellers": f"""SELECT i.seller_id, COUNT(DISTINCT i.order_id) AS total_orders,
        COUNT(DISTINCT i.product_id) AS unique_products_sold,
        COUNT(DISTINCT o.customer_id) AS unique_customers, {total('i.price')} AS total_revenue,
        {mean('i.price')} AS avg_order_value, {total('i.freight_value')} AS total_freight_collected,
        {mean('i.freight_ratio')} AS avg_freight_ratio,
        CAST(SUM(o.processing_time_days) AS DOUBLE) / COUNT(o.processing_time_days)
          AS avg_delivery_days,
        CAST(SUM(CASE WHEN o.is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS delayed_deliveries,
        CAST(date_diff('day', CAST(MIN(o.order_purchase_timestamp) AS DATE),
          CAST(MAX(o.order_purchase_timestamp) AS DATE)) AS BIGINT) AS active_days,
        MIN(o.order_purchase_timestamp) AS first_sale_date,
        MAX(o.order_purchase_timestamp) AS last_sale_date
      FROM items i JOIN orders_c o ON i.order_id = o.order_id GROUP BY i.seller_id""",
    "seller_kpis": f"""SELECT *, {pct('delayed_deliveries', 'total_orders')} AS delayed_rate,
        {rnd(ratio('total_revenue', 'active_days'), 2)} AS daily_revenue,
        ROW_NUMBER() OVER (ORDER BY total_revenue DESC, seller_id) AS seller_rank FROM sellers""",
    "places": f"""SELECT c.customer_state, c.customer_city,
        CAST(c.customer_zip_code_prefix AS BIGINT) AS customer_zip_code_prefix,
        COUNT(DISTINCT c.customer_id) AS total_customers,
        COUNT(DISTINCT o.order_id) AS total_orders, {total('i.price')} AS total_revenue,
        {mean('i.price')} AS avg_order_value,
        CAST(SUM(o.delivery_delay_days) AS DOUBLE) / NULLIF(COUNT(o.delivery_delay_days), 0)
          AS avg_delay,
        CAST(SUM(CASE WHEN o.is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS delayed_orders,
        COUNT(DISTINCT i.seller_id) AS active_sellers
      FROM src_customers c JOIN orders_c o ON c.customer_id = o.customer_id
      JOIN items i ON o.order_id = i.order_id GROUP BY ALL""",
    "place_kpis": f"""SELECT *, {pct('delayed_orders', 'total_orders')} AS delay_rate,
        {rnd(ratio('total_revenue', 'total_customers'), 2)} AS revenue_per_customer,
        RANK() OVER (PARTITION BY customer_state ORDER BY total_revenue DESC) AS city_rank_in_state
      FROM places""",
    "lifecycle": f"""SELECT o.order_id, o.order_status, {', '.join('o.' + t for t in _TIMES)},
        date_sub('hour', o.order_purchase_timestamp, o.order_approved_at) AS approval_time_hours,
        date_sub('day', o.order_approved_at, o.order_delivered_carrier_date)
          AS processing_time_days,
        date_sub('day', o.order_delivered_carrier_date, o.order_delivered_customer_date)
          AS shipping_time_days,
        date_sub('day', o.order_purchase_timestamp, o.order_delivered_customer_date)
          AS total_cycle_time_days,
        p.payment_type_standardized, p.payment_installments, p.payment_value,
        c.customer_state, c.customer_city, {total('i.price')} AS order_value,
        COUNT(DISTINCT i.product_id) AS items_count
      FROM orders_c o JOIN payments p ON o.order_id = p.order_id
      JOIN src_customers c ON o.customer_id = c.customer_id
      JOIN items i ON o.order_id = i.order_id GROUP BY ALL""",
    # Orders: state at the cut, the latest later change of each order, and their merge.
    "loaded": f"""SELECT *, {_MEASURES} FROM src_order_changes
      WHERE _ingestion_timestamp <= TIMESTAMP '{CUT}'
      QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY _ingestion_timestamp DESC) = 1""",
    "changed": f"""SELECT *, {_MEASURES} FROM src_order_changes
      WHERE _ingestion_timestamp > (SELECT MAX(_ingestion_timestamp) FROM loaded)
      QUALIFY ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY _ingestion_timestamp DESC) = 1""",
    "order_pairs": """SELECT l.order_id IS NULL AS fresh, l.order_id IS NOT NULL AND
        c.order_id IS NOT NULL AND (l.order_status IS DISTINCT FROM c.order_status
        OR l.order_delivered_customer_date IS DISTINCT FROM c.order_delivered_customer_date
        OR l.payment_value IS DISTINCT FROM c.payment_value) AS moved, l, c
      FROM loaded l FULL JOIN changed c ON l.order_id = c.order_id""",
    "target": f"""SELECT order_id, customer_id,
        CASE order_status WHEN 'shipped' THEN 'created' ELSE order_status END AS order_status,
        CAST(0 AS DOUBLE) AS payment_value, order_purchase_timestamp AS placed_at,
        order_purchase_timestamp + (order_id % 3) * INTERVAL '1' DAY AS seen_at,
        'INSERT' AS operation
      FROM src_orders WHERE order_purchase_timestamp < TIMESTAMP '{CUT}'""",
    "source": f"""SELECT order_id, customer_id, order_status, payment_value,
        order_purchase_timestamp AS placed_at,
        order_purchase_timestamp + INTERVAL '1' DAY AS seen_at, 'INSERT' AS operation
      FROM src_orders WHERE order_purchase_timestamp >= TIMESTAMP '{SECOND_LOAD}'""",
}


def sql(body: str) -> str:
    """``body`` with the feeds and shared relations it uses as CTEs, in the order given above."""
    texts = {**{n: t for n, (_, t) in FEEDS.items()}, **CTES}
    used: set[str] = set()

    def visit(text: str) -> None:
        for name in texts:
            if name not in used and re.search(rf"\b(FROM|JOIN)\s+{name}\b", text):
                used.add(name)
                visit(texts[name])

    visit(body)
    ctes = ",\n".join(f"{n} AS ({t})" for n, t in texts.items() if n in used)
    return f"WITH {ctes}\n{body}" if ctes else body


def _daily(join_grain: bool) -> str:
    tail = f"""{RUN}, 'INCREMENTAL' AS _load_type,
      strftime(d, '%Y-%m') AS _report_year_month"""
    if join_grain:
        return sql(f"""SELECT CAST(d AS VARCHAR) AS report_date, total_orders, unique_customers,
          total_revenue, avg_order_value, delayed_orders, delay_rate, total_payments,
          payment_methods_used, avg_processing_time_days, total_freight, freight_percentage, {tail}
        FROM (SELECT CAST(o.order_purchase_timestamp AS DATE) AS d,
          COUNT(DISTINCT o.order_id) AS total_orders,
          COUNT(DISTINCT o.customer_id) AS unique_customers, {total('i.price')} AS total_revenue,
          {mean('i.price')} AS avg_order_value,
          CAST(SUM(CASE WHEN o.is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS delayed_orders,
          {pct('SUM(CASE WHEN o.is_delayed THEN 1 ELSE 0 END)', 'COUNT(*)')} AS delay_rate,
          {total('p.payment_value')} AS total_payments,
          COUNT(DISTINCT p.payment_type_standardized) AS payment_methods_used,
          {rnd('CAST(SUM(processing_time_days) AS DOUBLE) / NULLIF(COUNT(processing_time_days), 0)', 1)}
            AS avg_processing_time_days,
          {total('i.freight_value')} AS total_freight,
          {pct(total('i.freight_value'), total('i.price'))} AS freight_percentage
        FROM orders_c o JOIN items i ON o.order_id = i.order_id
        JOIN payments p ON o.order_id = p.order_id GROUP BY 1)""")
    return sql(f"""SELECT CAST(d AS VARCHAR) AS report_date, COUNT(*) AS total_orders,
        COUNT(DISTINCT customer_id) AS unique_customers, {dbl('SUM(price)')} AS total_revenue,
        {dbl('SUM(price)')} / COUNT(*) AS avg_order_value,
        CAST(SUM(CASE WHEN is_delayed THEN 1 ELSE 0 END) AS BIGINT) AS delayed_orders,
        {pct('SUM(CASE WHEN is_delayed THEN 1 ELSE 0 END)', 'COUNT(*)')} AS delay_rate,
        {dbl('SUM(paid)')} AS total_payments, any_value(methods) AS payment_methods_used,
        {rnd('CAST(SUM(processing_time_days) AS DOUBLE) / NULLIF(COUNT(processing_time_days), 0)', 1)}
          AS avg_processing_time_days,
        {dbl('SUM(freight)')} AS total_freight,
        {pct(dbl('SUM(freight)'), dbl('SUM(price)'))} AS freight_percentage, {tail}
      FROM (SELECT CAST(o.order_purchase_timestamp AS DATE) AS d, o.*, i.price, i.freight, p.paid
        FROM orders_c o
        JOIN (SELECT order_id, SUM({dec('price')}) AS price, SUM({dec('freight_value')}) AS freight
          FROM items GROUP BY order_id) i ON o.order_id = i.order_id
        JOIN (SELECT order_id, SUM({dec('payment_value')}) AS paid FROM payments GROUP BY order_id) p
          ON o.order_id = p.order_id)
      JOIN (SELECT CAST(o.order_purchase_timestamp AS DATE) AS d2,
          COUNT(DISTINCT p.payment_type_standardized) AS methods
        FROM orders_c o JOIN payments p ON o.order_id = p.order_id
        WHERE o.order_id IN (SELECT order_id FROM items) GROUP BY 1) ON d = d2
      GROUP BY d""")


def _products() -> str:
    cuts = q.PRODUCT_CUTS
    return sql(f"""SELECT *, {band('total_revenue', '>=', cuts.revenue, cuts.low_revenue)}
        AS revenue_tier, {band('return_rate', '>', cuts.risk, cuts.low_risk)} AS risk_level, {RUN}
      FROM product_kpis""")


def _items() -> str:
    return sql(f"""SELECT order_id, order_item_id, product_id, seller_id,
        {txt('shipping_limit_date')}, price, freight_value, item_rank, running_total, order_total,
        {rnd('price / NULLIF(order_total, 0) * 100', 2)} AS revenue_contribution_pct,
        avg_seller_price, price - avg_seller_price AS seller_price_variance,
        price - avg_seller_price > 0 AS is_above_avg, freight_ratio, {RUN}
      FROM (SELECT *,
        ROW_NUMBER() OVER (PARTITION BY order_id ORDER BY price, order_item_id) AS item_rank,
        {dbl(f"SUM({dec('price')}) OVER (PARTITION BY order_id ORDER BY price, order_item_id ROWS UNBOUNDED PRECEDING)")}
          AS running_total,
        {dbl(f"SUM({dec('price')}) OVER (PARTITION BY order_id)")} AS order_total,
        {dbl(f"SUM({dec('price')}) OVER (PARTITION BY seller_id)")}
          / COUNT(price) OVER (PARTITION BY seller_id) AS avg_seller_price
        FROM items)""")


def _sellers() -> str:
    cuts = partners.SellerCuts()
    return sql(f"""SELECT * EXCLUDE (first_sale_date, last_sale_date),
        {txt('first_sale_date', 'last_sale_date')},
        {band('seller_rank', '<=', cuts.rank, cuts.last_tier)} AS seller_tier,
        {band('delayed_rate', '<=', cuts.delayed_rate, 1)} AS reliability_score, {RUN}
      FROM seller_kpis""")


def _places() -> str:
    cuts = q.MARKET_CUTS
    return sql(f"""SELECT *,
        {band('revenue_per_customer', '>', cuts.revenue_per_customer, cuts.last_market)}
          AS market_segment, {RUN}, '{AS_OF}' AS _analysis_date FROM place_kpis""")


def _pairs(items: str, products: str, item: str, category: str, min_co: int, scale: int) -> str:
    lift = f"co::DOUBLE * {scale}::DOUBLE / (na::DOUBLE * nb::DOUBLE / n::DOUBLE)"
    strength = ((5, "STRONG"), (3, "MODERATE"), (1.5, "WEAK"))
    return sql(f"""SELECT *, {band('lift_score', '>', strength, 'NEGLIGIBLE')}
        AS recommendation_strength, COALESCE(category_a <> category_b, FALSE) AS cross_category_flag,
        {RUN}, '{AS_OF}' AS _analysis_date
      FROM (SELECT a AS {item}_a, pa.{category} AS category_a, na AS product_a_orders,
          b AS {item}_b, pb.{category} AS category_b, nb AS product_b_orders,
          co AS co_occurrence_count, {pct('co', 'na')} AS probability_a_to_b,
          {pct('co', 'nb')} AS probability_b_to_a, {rnd(lift, 2)} AS lift_score
        FROM (SELECT x.{item} AS a, y.{item} AS b, COUNT(DISTINCT x.order_id) AS co
          FROM {items} x JOIN {items} y ON x.order_id = y.order_id AND x.{item} < y.{item}
          WHERE x.{item} IN (SELECT {item} FROM {products})
            AND y.{item} IN (SELECT {item} FROM {products})
          GROUP BY 1, 2 HAVING COUNT(DISTINCT x.order_id) >= {min_co})
        JOIN (SELECT {item} AS i, COUNT(DISTINCT order_id) AS na FROM {items} GROUP BY 1) ON a = i
        JOIN (SELECT {item} AS j, COUNT(DISTINCT order_id) AS nb FROM {items} GROUP BY 1) ON b = j
        JOIN {products} pa ON a = pa.{item} JOIN {products} pb ON b = pb.{item}
        CROSS JOIN (SELECT COUNT(DISTINCT order_id) AS n FROM {items}
          WHERE {item} IN (SELECT {item} FROM {products}))
        ORDER BY lift_score DESC, 1, 4 LIMIT 1000)""")


_ORDER_COLS = (
    "order_id", "customer_id", "order_purchase_timestamp", "order_approved_at",
    "order_delivered_carrier_date", "order_estimated_delivery_date", "payment_sequential",
    "payment_type", "payment_installments", "order_year_month",
)
_ORDER_MOVING = (
    "order_status", "order_delivered_customer_date", "payment_value", "processing_time_days",
    "delivery_delay_days", "is_delayed", "_ingestion_timestamp",
)


def _orders_merged() -> str:
    def value(expr: str, col: str) -> str:
        timed = col in _TIMES or col == "_ingestion_timestamp"
        return f"CAST({expr} AS VARCHAR) AS {col}" if timed else f"{expr} AS {col}"

    cols = [value(f"CASE WHEN fresh THEN c.{c} ELSE l.{c} END", c) for c in _ORDER_COLS]
    cols += [value(f"CASE WHEN fresh OR moved THEN c.{c} ELSE l.{c} END", c) for c in _ORDER_MOVING]
    return sql(f"""SELECT {', '.join(cols)}, 'BRONZE_CDC' AS _source_system,
        CASE WHEN moved THEN 'UPDATE' ELSE 'INSERT' END AS _operation,
        CASE WHEN fresh OR moved THEN '{AS_OF} 00:00:00' ELSE '{CUT} 00:00:00' END
          AS _processed_timestamp FROM order_pairs""")


def _merged(condition: str, update: tuple[str, ...], operation: str = "t.operation") -> str:
    """Target-only rows, matched rows (updated where ``condition``), source-only rows."""
    cols = ("customer_id", "order_status", "payment_value", "placed_at", "seen_at")
    hit = f"(t.order_id IS NULL OR (s.order_id IS NOT NULL AND {condition}))"

    def pick(c: str) -> str:
        test = hit if c in update else "t.order_id IS NULL"
        text = f"CASE WHEN {test} THEN s.{c} ELSE t.{c} END"
        return f"CAST({text} AS VARCHAR) AS {c}" if c.endswith("_at") else f"{text} AS {c}"

    return sql(f"""SELECT COALESCE(t.order_id, s.order_id) AS order_id,
        {', '.join(pick(c) for c in cols)},
        CASE WHEN t.order_id IS NULL THEN s.operation
          WHEN s.order_id IS NOT NULL AND {condition} THEN {operation}
          ELSE t.operation END AS operation
      FROM target t FULL JOIN source s ON t.order_id = s.order_id""")


_HISTORY = f"""SELECT f.*, 1 AS version, '{FIRST_LOAD} 00:00:00' AS effective_start_date,
    CASE WHEN s.h <> f.h THEN '{SECOND_LOAD} 00:00:00' END AS effective_end_date,
    s.h = f.h AS is_current, '{FIRST_LOAD} 00:00:00' AS _processed_timestamp
  FROM (SELECT *, {_HASH} AS h FROM src_customers_first) f
  JOIN (SELECT customer_id, {_HASH} AS h FROM src_customers_second) s
    ON f.customer_id = s.customer_id
  UNION ALL
  SELECT s.*, CASE WHEN f.h IS NULL THEN 1 ELSE 2 END, '{SECOND_LOAD} 00:00:00', NULL, TRUE,
    '{SECOND_LOAD} 00:00:00'
  FROM (SELECT *, {_HASH} AS h FROM src_customers_second) s
  LEFT JOIN (SELECT customer_id, {_HASH} AS h FROM src_customers_first) f
    ON f.customer_id = s.customer_id
  WHERE f.h IS NULL OR f.h <> s.h"""
_CUSTOMER = (
    "customer_id, customer_unique_id, customer_zip_code_prefix, customer_city, customer_state, "
    "customer_phone, customer_email"
)
_CLEAN_PAYMENTS = f"""SELECT order_id, payment_sequential,
    COALESCE(lower(trim(payment_type)), 'not_defined') AS payment_type, payment_installments,
    CASE WHEN payment_value IS NULL OR payment_value < 0 THEN 0 ELSE payment_value END
      AS payment_value,
    {txt('order_purchase_timestamp')},
    CAST(CAST(order_purchase_timestamp AS DATE) AS VARCHAR) AS _payment_date
  FROM src_dirty_payments WHERE order_id IS NOT NULL"""
_ENRICHED = f"""SELECT i.* EXCLUDE (shipping_limit_date), {txt('i.shipping_limit_date')},
    p.product_category_name, p.product_category_name AS _enriched_category
  FROM src_items i LEFT JOIN src_products p ON i.product_id = p.product_id"""


def oracle_sql() -> dict[str, str]:
    daily = _daily(True)
    day_mark = f"""SELECT MAX(order_purchase_timestamp) FROM src_orders
        WHERE order_purchase_timestamp <= TIMESTAMP '{CUT}'"""
    stock = q.INVENTORY_CUTS
    life = partners.LifecycleCuts()
    found = {
        "orders_silver": _orders_merged(),
        "orders_table_merge": _orders_merged(),
        "orders_table_marks": _orders_merged(),
        "order_items_windows": _items(),
        "order_items_windows_split": _items(),
        "payments_validated": sql(f"SELECT *, {RUN} FROM payments"),
        "payment_stats": sql(
            "SELECT validation_status, COUNT(*) AS count FROM payments GROUP BY 1"
        ),
        "products_enriched": sql(f"SELECT *, {RUN} FROM products"),
        "customers_latest": sql(f"""SELECT {_CUSTOMER}, {txt('customer_created_at', 'updated_at')}
          FROM customer_versions QUALIFY
          ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1"""),
        "customers_scd2": sql(f"""SELECT {_CUSTOMER}, {txt('customer_created_at')},
            effective_start_date, effective_end_date, is_current, version, _processed_timestamp,
            h AS _hash_key FROM ({_HISTORY})"""),
        "customers_scd2_versions": sql(f"""SELECT {_CUSTOMER}, {txt('customer_created_at')},
            CAST(updated_at AS VARCHAR) AS effective_start_date,
            CAST(LEAD(updated_at) OVER w AS VARCHAR) AS effective_end_date,
            LEAD(updated_at) OVER w IS NULL AS is_current, ROW_NUMBER() OVER w AS version
          FROM (SELECT *, {_HASH} AS h FROM (FROM src_customers_first UNION ALL FROM src_customers_third
              UNION ALL FROM src_customers_late)
            QUALIFY h IS DISTINCT FROM LAG(h) OVER (PARTITION BY customer_id ORDER BY updated_at))
          WINDOW w AS (PARTITION BY customer_id ORDER BY updated_at)"""),
        "customers_surrogate": sql(f"""SELECT ROW_NUMBER() OVER (ORDER BY customer_id, version)
            AS customer_sk, customer_id, version, is_current FROM ({_HISTORY})"""),
        "daily_sales": daily,
        "daily_sales_order_grain": _daily(False),
        "daily_sales_bucketed": daily,
        "daily_sales_incremental": sql_over(daily, f"""SELECT * EXCLUDE (_processed_timestamp),
            CASE WHEN CAST(report_date AS DATE) >= CAST(({day_mark}) AS DATE)
              THEN '{AS_OF} 00:00:00' ELSE '{CUT} 00:00:00' END AS _processed_timestamp"""),
        "customer_rfm": sql(f"""SELECT * EXCLUDE (last_purchase_date), {txt('last_purchase_date')},
            '{AS_OF}' AS segment_date, {RUN} FROM segments"""),
        "segment_distribution": sql(
            "SELECT customer_segment, COUNT(*) AS count FROM segments GROUP BY 1"
        ),
        "product_performance": _products(),
        "incremental_touched_keys": _products(),
        "inventory_analytics": sql(f"""SELECT * EXCLUDE (stddev_raw),
            ROUND(stddev_raw, 6) AS stddev_monthly_orders,
            CAST({rnd('avg_monthly_orders + COALESCE(stddev_raw, 0) * 2', 0)} AS BIGINT)
              AS recommended_reorder_level,
            {band('inventory_turnover_rate', '>', stock.turnover, stock.slowest)}
              AS inventory_category, {RUN}, '{AS_OF}' AS _analysis_date FROM stock"""),
        "seller_analytics": _sellers(),
        "seller_analytics_split": _sellers(),
        "geo_analytics": _places(),
        "geo_analytics_split": _places(),
        "geo_analytics_incremental": _places(),
        "order_lifecycle": sql(f"""SELECT * EXCLUDE ({', '.join(_TIMES)}), {txt(*_TIMES)},
            {band('approval_time_hours', '<=', life.approval_hours, life.breach)} AS approval_sla,
            order_status = 'delivered' AS is_completed,
            CASE WHEN approval_time_hours > 48 THEN 'APPROVAL'
              WHEN processing_time_days > 5 THEN 'PROCESSING'
              WHEN shipping_time_days > 7 THEN 'SHIPPING' ELSE 'NONE' END AS bottleneck_stage,
            {band('items_count', '>', life.items, life.few_items)} AS order_complexity,
            {band('payment_installments', '>', life.installments, life.one_payment)}
              AS payment_complexity, {RUN} FROM lifecycle"""),
        "cross_selling_part": _pairs(
            "src_items", "src_products", "product_id", "product_category_name", 2, 100
        ),
        "cross_selling_part_split": _pairs(
            "src_items", "src_products", "product_id", "product_category_name", 2, 100
        ),
        "cross_selling_brand": _pairs("src_brand_items", "src_brands", "brand", "maker", 11, 1),
        "upsert_every": _merged(
            "TRUE",
            ("customer_id", "order_status", "payment_value", "placed_at", "seen_at"),
            "s.operation",
        ),
        "upsert_conditional": _merged(
            "t.order_status IS DISTINCT FROM s.order_status", ("order_status",), "'UPDATE'"
        ),
        "upsert_latest": _merged(
            "t.seen_at < s.seen_at",
            ("customer_id", "order_status", "payment_value", "placed_at", "seen_at"),
        ),
        "upsert_status": _merged(
            "t.order_status IS DISTINCT FROM s.order_status",
            ("customer_id", "order_status", "payment_value", "placed_at", "seen_at"),
        ),
        "scd2_close": sql(f"""SELECT f.customer_id, f.customer_city, m.customer_id IS NULL
              AS is_current,
            CASE WHEN m.customer_id IS NOT NULL THEN '{SECOND_LOAD} 00:00:00' END
              AS effective_end_date
          FROM src_customers f LEFT JOIN (SELECT customer_id FROM src_customers_second
            WHERE customer_city LIKE '%-moved') m ON f.customer_id = m.customer_id"""),
        "distinct_sketches": sql("""SELECT strftime(order_purchase_timestamp, '%Y-%m') AS month,
            COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT order_id) AS orders, TRUE AS close
          FROM src_orders GROUP BY 1"""),
        "table_refreshed": sql("""SELECT payment_type, CAST(payment_installments AS BIGINT) AS payment_installments,
            2 * COUNT(*) AS n, place
          FROM src_payments, (VALUES ('flat'), ('split')) p(place) GROUP BY ALL"""),
        "table_evolved": sql("""SELECT product_id, product_name,
            CASE WHEN product_category_name <> 'automotivo' THEN product_weight_g END AS product_weight_g, place
          FROM src_products, (VALUES ('table'), ('files')) p(place)"""),
        "audited_writes": sql("""SELECT module, 'SUCCESS' AS status, CAST(CASE module
              WHEN 'append' THEN COUNT(*) FILTER (order_status <> 'shipped') WHEN 'nothing' THEN 0
              WHEN 'refresh' THEN COUNT(*) ELSE (SELECT COUNT(*) FROM src_orders
                WHERE year(order_purchase_timestamp) IN (SELECT year(order_purchase_timestamp)
                  FROM src_orders WHERE order_status = 'shipped')) END AS VARCHAR) AS records_processed,
            COUNT(*) FILTER (order_status = 'shipped') AS sent
          FROM src_orders, (VALUES ('append'), ('refresh'), ('nothing'), ('merge')) m(module) GROUP BY module"""),
        "inferred_products": sql("""SELECT later, CAST(SUM(product_id) AS BIGINT) AS ids,
            CAST(SUM(product_weight_g) AS BIGINT) AS grams,
            CASE WHEN later THEN SUM(product_weight_g / 8.0e0) END AS ratings, COUNT(product_name) AS names,
            'int,string,int,double' AS kinds
          FROM src_products, (VALUES (TRUE), (FALSE)) p(later) GROUP BY later"""),
        "stream_row_ids": sql("""SELECT COUNT(*) AS n_rows, COUNT(*) AS n_ids, COUNT(*) AS n_named,
            COUNT(*) AS n_times FROM src_items"""),
        "payments_cleaned": sql(_CLEAN_PAYMENTS),
        "stream_ingest_payments": sql(_CLEAN_PAYMENTS),
        "products_quarantine": sql("""SELECT product_id, product_category_name, product_name,
            CASE WHEN product_category_name IS NULL THEN 'FAILED' ELSE 'PASSED' END
              AS _validation_status,
            CASE WHEN product_category_name IS NULL THEN 'product_category_name is missing'
              ELSE '' END AS broken FROM src_dirty_products"""),
        "items_enriched": sql(_ENRICHED),
        "stream_ingest_items": sql(_ENRICHED),
        "stream_ingest_orders": sql(f"""SELECT * EXCLUDE (_ingestion_timestamp, {', '.join(_TIMES)}),
            {txt(*_TIMES)}, TRUE AS from_file FROM src_orders"""),
        "stream_late_orders": sql("""SELECT batch, COUNT(*) AS rows, COUNT(*) AS written,
            COUNT(*) FILTER (batch = 2 AND bought < newest - INTERVAL '24' HOUR) AS late_rows,
            CAST(CASE batch WHEN 0 THEN MAX(bought) ELSE MAX(newest) END AS VARCHAR) AS mark
          FROM (SELECT order_purchase_timestamp AS bought, MAX(order_purchase_timestamp) OVER () AS newest,
            CASE WHEN YEAR(order_purchase_timestamp) < 1996 THEN 0
              WHEN YEAR(order_purchase_timestamp) > 1997 THEN 1 ELSE 2 END AS batch FROM src_orders)
          GROUP BY batch"""),
        "stream_dedup_customers": sql(f"""SELECT {_CUSTOMER}, {txt('customer_created_at')},
            CAST(updated_at AS VARCHAR) AS _last_updated FROM customer_versions"""),
        "stream_latest_customers": sql(f"""SELECT {_CUSTOMER}, {txt('customer_created_at')},
            CAST(updated_at AS VARCHAR) AS _last_updated
          FROM (FROM src_customers_first UNION ALL FROM src_customers_second UNION ALL FROM src_customers_third)
          QUALIFY ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY updated_at DESC) = 1"""),
        "stream_ingest_products": sql("""SELECT product_id, CASE WHEN
              product_category_name <> 'automotivo' THEN product_category_name END
              AS product_category_name, product_photos,
            CASE WHEN product_category_name = 'automotivo' THEN 'FAILED' ELSE 'PASSED' END
              AS _validation_status FROM src_products"""),
        "audit_report": sql("""SELECT run_id AS pipeline_run_id,
            CAST(MIN(timestamp - INTERVAL '60' SECOND) AS VARCHAR) AS start_time,
            CAST(MAX(timestamp) AS VARCHAR) AS end_time,
            CAST(epoch_us(MAX(timestamp)) - epoch_us(MIN(timestamp - INTERVAL '60' SECOND))
              AS DOUBLE) / 1e6 AS duration_seconds,
            COUNT(*) FILTER (module <> 'PIPELINE' AND status = 'SUCCESS') AS successful_modules,
            COUNT(*) FILTER (module <> 'PIPELINE' AND status = 'FAILED') AS failed_modules,
            CASE WHEN COUNT(*) FILTER (status = 'FAILED') = 0
              THEN 'SUCCESS' ELSE 'PARTIAL_FAILURE' END AS status
          FROM src_audit GROUP BY run_id"""),
    }
    # What an incremental run leaves is what the full query gives.
    for name, full in {
        "daily_sales_late_items": "daily_sales", "order_items_incremental": "order_items_windows",
        "customer_rfm_incremental": "customer_rfm", "order_lifecycle_incremental": "order_lifecycle",
    }.items():
        found[name] = found[full]
    return found


def sql_over(inner: str, select: str) -> str:
    """``select`` over a finished query, sharing its CTEs."""
    head, body = inner[: inner.rindex("\nSELECT")], inner[inner.rindex("\nSELECT") :]
    return f"{head}\n{select} FROM ({body})"
