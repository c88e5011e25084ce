"""Table contracts: the fixed column names and types of every feed and table."""

from __future__ import annotations

from pyspark.sql.types import StructType

# The landing feeds.
FEEDS = {
    "orders": """order_id BIGINT NOT NULL, customer_id BIGINT, order_status STRING,
        order_purchase_timestamp TIMESTAMP, order_approved_at TIMESTAMP,
        order_delivered_carrier_date TIMESTAMP, order_delivered_customer_date TIMESTAMP,
        order_estimated_delivery_date TIMESTAMP, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DOUBLE""",
    "customers": """customer_id BIGINT NOT NULL, customer_unique_id STRING,
        customer_zip_code_prefix INT, customer_city STRING, customer_state STRING,
        customer_phone STRING, customer_email STRING, customer_created_at TIMESTAMP,
        _last_updated TIMESTAMP""",
    "products": """product_id BIGINT, product_category_name STRING, product_name STRING,
        product_description STRING, product_photos STRING, product_weight_g INT,
        product_length_cm INT, product_height_cm INT, product_width_cm INT""",
    "order_items": """order_id BIGINT, order_item_id BIGINT, product_id BIGINT, seller_id BIGINT,
        shipping_limit_date TIMESTAMP, price DOUBLE, freight_value DOUBLE""",
    "payments": """order_id BIGINT, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DOUBLE, order_purchase_timestamp TIMESTAMP""",
}

# The cleaned tables and the business tables, with their partition columns.
TABLES = {
    "orders_silver": (
        """order_id BIGINT, customer_id BIGINT, order_status STRING,
        order_purchase_timestamp TIMESTAMP, order_approved_at TIMESTAMP,
        order_delivered_carrier_date TIMESTAMP, order_delivered_customer_date TIMESTAMP,
        order_estimated_delivery_date TIMESTAMP, payment_sequential INT, payment_type STRING,
        payment_installments INT, payment_value DOUBLE, processing_time_days INT,
        delivery_delay_days INT, is_delayed BOOLEAN, _ingestion_timestamp TIMESTAMP,
        _processed_timestamp TIMESTAMP, _source_system STRING, _operation STRING,
        order_year_month STRING""",
        ["order_year_month"],
    ),
    "customers_scd2": (
        """customer_sk BIGINT, customer_id BIGINT, customer_unique_id STRING,
        customer_zip_code_prefix INT, customer_city STRING, customer_state STRING,
        customer_phone STRING, customer_email STRING, customer_created_at TIMESTAMP,
        effective_start_date TIMESTAMP, effective_end_date TIMESTAMP, version INT,
        _processed_timestamp TIMESTAMP, _hash_key STRING, is_current BOOLEAN""",
        ["is_current"],
    ),
    "products_silver": (
        """product_id BIGINT, product_category_name STRING, product_category_name_english STRING,
        product_name_length INT, product_description_length INT, product_photos_qty INT,
        product_weight_g INT, product_length_cm INT, product_height_cm INT, product_width_cm INT,
        category_level STRING, _processed_timestamp TIMESTAMP""",
        [],
    ),
    "order_items_silver": (
        """order_id BIGINT, order_item_id BIGINT, product_id BIGINT, seller_id BIGINT,
        shipping_limit_date TIMESTAMP, price DOUBLE, freight_value DOUBLE, item_rank BIGINT,
        running_total DOUBLE, order_total DOUBLE, revenue_contribution_pct DOUBLE,
        avg_seller_price DOUBLE, seller_price_variance DOUBLE, is_above_avg BOOLEAN,
        freight_ratio DOUBLE, _processed_timestamp TIMESTAMP""",
        [],
    ),
    "payments_silver": (
        """order_id BIGINT, payment_sequential INT, payment_type_standardized STRING,
        payment_installments INT, payment_value DOUBLE, installment_value DOUBLE,
        validation_status STRING, is_installment_valid BOOLEAN, is_high_value BOOLEAN,
        payment_method_category STRING, _processed_timestamp TIMESTAMP""",
        [],
    ),
    "daily_sales_summary": (
        """report_date DATE, total_orders BIGINT, unique_customers BIGINT, total_revenue DOUBLE,
        avg_order_value DOUBLE, delayed_orders BIGINT, delay_rate DOUBLE, total_payments DOUBLE,
        payment_methods_used BIGINT, avg_processing_time_days DOUBLE, total_freight DOUBLE,
        freight_percentage DOUBLE, _processed_timestamp TIMESTAMP, _load_type STRING,
        _report_year_month STRING""",
        ["_report_year_month"],
    ),
    "customer_segments": (
        """customer_id BIGINT, last_purchase_date DATE, total_orders BIGINT, total_spent DOUBLE,
        avg_order_value DOUBLE, days_since_last_purchase INT, recency_score INT,
        frequency_score INT, monetary_score INT, rfm_score INT, customer_segment STRING,
        _processed_timestamp TIMESTAMP, segment_date DATE""",
        ["segment_date"],
    ),
    "product_performance": (
        """product_id BIGINT, total_orders BIGINT, unique_buyers BIGINT, total_revenue DOUBLE,
        avg_selling_price DOUBLE, avg_freight_cost DOUBLE, product_lifetime_days INT,
        return_count BIGINT, return_value DOUBLE, return_rate DOUBLE,
        daily_revenue_velocity DOUBLE, revenue_tier STRING, risk_level STRING,
        _processed_timestamp TIMESTAMP, category STRING""",
        ["category"],
    ),
    "seller_analytics": (
        """seller_id BIGINT, total_orders BIGINT, unique_products_sold BIGINT,
        unique_customers BIGINT, total_revenue DOUBLE, avg_order_value DOUBLE,
        total_freight_collected DOUBLE, avg_freight_ratio DOUBLE, avg_delivery_days DOUBLE,
        delayed_deliveries BIGINT, delayed_rate DOUBLE, active_days INT, daily_revenue DOUBLE,
        first_sale_date TIMESTAMP, last_sale_date TIMESTAMP, seller_rank BIGINT,
        reliability_score INT, _processed_timestamp TIMESTAMP, seller_tier STRING""",
        ["seller_tier"],
    ),
    "inventory_analytics": (
        """product_id BIGINT, category STRING, months_active BIGINT, total_orders BIGINT,
        avg_monthly_orders DOUBLE, stddev_monthly_orders DOUBLE, peak_monthly_orders BIGINT,
        low_monthly_orders BIGINT, total_revenue DOUBLE, avg_monthly_revenue DOUBLE,
        total_buyers BIGINT, inventory_turnover_rate DOUBLE, recommended_reorder_level BIGINT,
        _processed_timestamp TIMESTAMP, _analysis_date DATE, inventory_category STRING""",
        ["inventory_category"],
    ),
    "geographical_analytics": (
        """customer_city STRING, customer_zip_code_prefix INT, total_customers BIGINT,
        total_orders BIGINT, total_revenue DOUBLE, avg_order_value DOUBLE, avg_delay DOUBLE,
        delayed_orders BIGINT, active_sellers BIGINT, delay_rate DOUBLE,
        revenue_per_customer DOUBLE, city_rank_in_state BIGINT, _processed_timestamp TIMESTAMP,
        _analysis_date DATE, customer_state STRING, market_segment STRING""",
        ["customer_state", "market_segment"],
    ),
    "order_lifecycle": (
        """order_id BIGINT, order_purchase_timestamp TIMESTAMP, order_approved_at TIMESTAMP,
        order_delivered_carrier_date TIMESTAMP, order_delivered_customer_date TIMESTAMP,
        order_estimated_delivery_date TIMESTAMP, approval_time_hours BIGINT,
        processing_time_days INT, shipping_time_days INT, total_cycle_time_days INT,
        approval_sla STRING, payment_type_standardized STRING, payment_installments INT,
        payment_value DOUBLE, customer_state STRING, customer_city STRING, order_value DOUBLE,
        items_count BIGINT, is_completed BOOLEAN, bottleneck_stage STRING,
        payment_complexity STRING, _processed_timestamp TIMESTAMP, order_status STRING,
        order_complexity STRING""",
        ["order_status", "order_complexity"],
    ),
    "cross_selling_opportunities": (
        """product_id_a BIGINT, category_a STRING, product_a_orders BIGINT, product_id_b BIGINT,
        category_b STRING, product_b_orders BIGINT, co_occurrence_count BIGINT,
        probability_a_to_b DOUBLE, probability_b_to_a DOUBLE, lift_score DOUBLE,
        recommendation_strength STRING, cross_category_flag BOOLEAN,
        _processed_timestamp TIMESTAMP, _analysis_date DATE""",
        [],
    ),
    "pipeline_audit_log": (
        """run_id STRING, timestamp TIMESTAMP, module STRING, status STRING,
        records_processed STRING, error STRING, execution_time_seconds DOUBLE""",
        [],
    ),
    "pipeline_execution_report": (
        """pipeline_run_id STRING, start_time TIMESTAMP, end_time TIMESTAMP,
        duration_seconds DOUBLE, successful_modules INT, failed_modules INT, status STRING""",
        [],
    ),
}


def feed_schema(name: str) -> StructType:
    return StructType.fromDDL(FEEDS[name])


def table_schema(name: str) -> StructType:
    return StructType.fromDDL(TABLES[name][0])
