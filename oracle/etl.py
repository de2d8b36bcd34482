"""ETL stages."""

_FACT = """fact_id, order_id, order_item_id, customer_id, product_id, seller_id, cast(order_date AS varchar) AS order_date,
  order_year, order_month, order_quarter, yyyymm, cast(price AS double) AS price, cast(freight_value AS double) AS freight_value,
  cast(revenue AS double) AS revenue, review_score, order_status, is_delivered, delivery_delay_days,
  cast(total_payment AS double) AS total_payment, payment_installments, payment_type, category, state, lat, lng"""

SQL = {
    "scan_table": "SELECT state, count(*) AS customers FROM dim_customers GROUP BY state",
    "table_row_counts": """
        SELECT 'fact_orders' AS table_name, count(*) AS row_count FROM fact_orders
        UNION ALL SELECT 'dim_customers', count(*) FROM dim_customers
        UNION ALL SELECT 'dim_products', count(*) FROM dim_products
        UNION ALL SELECT 'dim_sellers', count(*) FROM dim_sellers
        UNION ALL SELECT 'dim_date', count(*) FROM dim_date
        UNION ALL SELECT 'dim_geolocation', count(*) FROM dim_geolocation""",
    "scan_csv": "SELECT order_id, order_item_id, product_id, seller_id, cast(price AS double) AS price, cast(freight_value AS double) AS freight_value FROM raw_items",
    "coerce_timestamps": """
        SELECT order_id, strftime(order_purchase_timestamp, '%Y-%m-%d %H:%M:%S') AS order_purchase_timestamp,
          strftime(order_delivered_customer_date, '%Y-%m-%d %H:%M:%S') AS order_delivered_customer_date,
          strftime(order_estimated_delivery_date, '%Y-%m-%d %H:%M:%S') AS order_estimated_delivery_date
        FROM raw_orders""",
    "dim_geolocation_group": "SELECT * FROM geo_groups",
    "dim_geolocation": "SELECT * FROM dim_geolocation",
    "dim_customers": "SELECT * FROM dim_customers",
    "dim_sellers": "SELECT * FROM dim_sellers",
    "product_category_translate": "SELECT product_id, category FROM dim_products",
    "dim_products": "SELECT * FROM dim_products",
    "dim_date": "SELECT * REPLACE (cast(date AS varchar) AS date) FROM dim_date",
    "payments_per_order": "SELECT order_id, cast(total_payment AS double) AS total_payment, payment_installments, payment_type FROM pay",
    "reviews_best_per_order": "SELECT * FROM rev",
    "fact_join": """
        SELECT order_id, order_item_id, product_id, seller_id, cast(price AS double) AS price, customer_id, order_status, review_score,
          cast(total_payment AS double) AS total_payment, payment_installments, payment_type, category, state, lat, lng FROM joined""",
    "fact_date_parts": """
        SELECT order_id, order_item_id, product_id, seller_id, cast(order_date AS varchar) AS order_date, order_year, order_month,
          order_quarter, yyyymm FROM joined""",
    "fact_revenue": "SELECT order_id, order_item_id, product_id, seller_id, cast(revenue AS double) AS revenue FROM joined",
    "fact_is_delivered": "SELECT order_id, order_item_id, product_id, seller_id, is_delivered FROM joined",
    "fact_delivery_delay": "SELECT order_id, order_item_id, product_id, seller_id, delivery_delay_days FROM joined",
    "fact_drop_null_keys": """
        SELECT order_id, order_item_id, customer_id, product_id, seller_id FROM joined
        WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL""",
    "fact_dedupe": "SELECT order_id, order_item_id, product_id, seller_id, cast(price AS double) AS price, cast(freight_value AS double) AS freight_value FROM dedup",
    "fact_impute_review": "SELECT order_id, order_item_id, review_score FROM fact_orders",
    "fact_surrogate_key": "SELECT fact_id, order_id, order_item_id FROM fact_orders",
    "fact_orders": f"SELECT {_FACT} FROM fact_orders",
    "run_etl": f"SELECT {_FACT} FROM fact_orders",
    "write_table": f"SELECT {_FACT} FROM fact_orders",
    "etl_audit": """
        SELECT 'geolocation_raw_rows' AS measure, count(*) AS value FROM raw_customers
        UNION ALL SELECT 'geolocation_rows', count(*) FROM dim_geolocation
        UNION ALL SELECT 'item_rows', count(*) FROM raw_items
        UNION ALL SELECT 'fact_rows', count(*) FROM fact_orders
        UNION ALL SELECT 'fact_orders_distinct', count(DISTINCT order_id) FROM fact_orders
        UNION ALL SELECT 'scores_imputed', count(*) FROM dedup WHERE review_score IS NULL
        UNION ALL SELECT 'item_rows_with_keys', count(*) FROM joined
          WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
        UNION ALL SELECT 'rows_dropped', (SELECT count(*) FROM raw_items) - (SELECT count(*) FROM fact_orders)""",
}
