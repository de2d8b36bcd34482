"""CTEs that bind the test tables to the nine raw inputs and build the star schema."""

STAR = """
shipped AS (
  SELECT l_orderkey, max(l_shipdate + to_hours(cast(l_quantity AS integer))) AS delivered FROM lineitem GROUP BY l_orderkey
),
raw_orders AS (
  SELECT o_orderkey AS order_id, o_custkey AS customer_id,
    CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END AS order_status,
    o_orderdate AS order_purchase_timestamp,
    CASE WHEN o_orderstatus = 'F' AND o_orderkey % 89 <> 0 THEN delivered END AS order_delivered_customer_date,
    o_orderdate + to_days(1900) + to_hours(12) AS order_estimated_delivery_date
  FROM orders LEFT JOIN shipped ON o_orderkey = l_orderkey
),
raw_items AS (
  SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
    CASE WHEN (l_orderkey + l_linenumber) % 101 <> 0 THEN l_suppkey END AS seller_id,
    cast(l_extendedprice AS decimal(12,2)) AS price,
    cast(cast(l_extendedprice AS decimal(12,2)) * cast(l_tax AS decimal(4,2)) AS decimal(12,2)) AS freight_value
  FROM lineitem
),
raw_payments AS (
  SELECT l_orderkey AS order_id, cast(l_extendedprice AS decimal(18,2)) AS payment_value,
    cast(l_quantity AS integer) % 10 + 1 AS payment_installments,
    CASE WHEN l_returnflag = 'A' THEN 'credit_card' WHEN l_returnflag = 'N' THEN 'boleto'
         WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'voucher'
         WHEN l_returnflag = 'R' AND l_linestatus = 'O' THEN 'debit_card' END AS payment_type,
    l_linenumber, l_partkey, l_suppkey, l_shipdate
  FROM lineitem
),
raw_reviews AS (
  SELECT l_orderkey AS order_id, CASE WHEN l_partkey % 17 <> 0 THEN 1 + (l_partkey + l_suppkey) % 5 END AS review_score FROM lineitem
),
raw_customers AS (
  SELECT c_custkey AS customer_id, c_name AS customer_unique_id, c_mktsegment AS city, n_name AS state,
    c_custkey % 97 AS zip_code_prefix, c_acctbal
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
),
raw_sellers AS (
  SELECT s_suppkey AS seller_id, s_name AS seller_city, n_name AS seller_state, s_suppkey * 13 % 131 AS zip_code_prefix
  FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
),
raw_products AS (
  SELECT p_partkey AS product_id, CASE WHEN p_partkey % 41 <> 0 THEN replace(p_name, ' ', '_') END AS product_category_name,
    CASE WHEN p_size % 13 <> 0 THEN cast(p_size * 100 AS double) END AS weight_g, cast(p_size AS double) AS length_cm,
    cast(p_partkey % 20 AS double) AS height_cm, cast(p_partkey % 15 AS double) AS width_cm
  FROM part
),
translation AS (
  SELECT DISTINCT replace(p_name, ' ', '_') AS name, split_part(p_name, ' ', 2) || '_' || split_part(p_name, ' ', 1) AS english
  FROM part WHERE p_name LIKE 's%'
),
geo_groups AS (
  SELECT zip_code_prefix, state, arg_min(city, customer_id) FILTER (WHERE city IS NOT NULL) AS city,
    cast(round(cast(cast(sum(cast(c_acctbal / 1000 AS decimal(20,10))) AS double) / count(*) AS decimal(28,8)), 6) AS double) AS lat,
    cast(round(cast(cast(sum(cast(-c_acctbal / 500 AS decimal(20,10))) AS double) / count(*) AS decimal(28,8)), 6) AS double) AS lng
  FROM raw_customers WHERE zip_code_prefix IS NOT NULL AND state IS NOT NULL GROUP BY zip_code_prefix, state
),
dim_geolocation AS (
  SELECT zip_code_prefix, state, city, lat, lng
  FROM (SELECT *, row_number() OVER (PARTITION BY zip_code_prefix ORDER BY state) AS rn FROM geo_groups) WHERE rn = 1
),
dim_customers AS (
  SELECT c.customer_id, c.customer_unique_id, c.city, c.state, c.zip_code_prefix, g.lat, g.lng
  FROM raw_customers c LEFT JOIN dim_geolocation g USING (zip_code_prefix)
),
dim_sellers AS (
  SELECT s.seller_id, s.seller_city, s.seller_state, s.zip_code_prefix, g.lat AS seller_lat, g.lng AS seller_lng
  FROM raw_sellers s LEFT JOIN dim_geolocation g USING (zip_code_prefix)
),
dim_products AS (
  SELECT product_id,
    array_to_string(list_transform(string_split(replace(coalesce(english, product_category_name), '_', ' '), ' '),
      lambda w: upper(w[1]) || lower(w[2:])), ' ') AS category, weight_g, length_cm, height_cm, width_cm
  FROM raw_products LEFT JOIN translation ON name = product_category_name
),
dim_date AS (
  SELECT cast(strftime(d, '%Y%m%d') AS bigint) AS date_id, d AS date, year(d) AS year, quarter(d) AS quarter, month(d) AS month,
    monthname(d) AS month_name, weekofyear(d) AS week, dayname(d) AS day_name,
    CASE WHEN isodow(d) >= 6 THEN 1 ELSE 0 END AS is_weekend, strftime(d, '%Y-%m') AS yyyymm
  FROM (SELECT cast(unnest(generate_series(date_trunc('year', min(o_orderdate)), date_trunc('year', max(o_orderdate)) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
    INTERVAL 1 DAY)) AS date) AS d FROM orders)
),
pay AS (
  SELECT order_id, sum(payment_value) AS total_payment, max(payment_installments) AS payment_installments,
    arg_min(payment_type, row(l_linenumber, l_partkey, l_suppkey, l_shipdate)) FILTER (WHERE payment_type IS NOT NULL) AS payment_type
  FROM raw_payments WHERE order_id IS NOT NULL GROUP BY order_id
),
rev AS (
  SELECT order_id, max(review_score) AS review_score FROM raw_reviews WHERE review_score IS NOT NULL GROUP BY order_id
),
joined AS (
  SELECT i.order_id, i.order_item_id, o.customer_id, i.product_id, i.seller_id,
    cast(o.order_purchase_timestamp AS date) AS order_date, year(o.order_purchase_timestamp) AS order_year,
    month(o.order_purchase_timestamp) AS order_month, quarter(o.order_purchase_timestamp) AS order_quarter,
    strftime(o.order_purchase_timestamp, '%Y-%m') AS yyyymm,
    i.price, i.freight_value, i.price + i.freight_value AS revenue, r.review_score, o.order_status,
    CASE WHEN o.order_status = 'delivered' THEN 1 ELSE 0 END AS is_delivered,
    cast(floor((epoch(o.order_delivered_customer_date) - epoch(o.order_estimated_delivery_date)) / 86400) AS bigint) AS delivery_delay_days,
    p.total_payment, p.payment_installments, p.payment_type, d.category, c.state, c.lat, c.lng
  FROM raw_items i
  LEFT JOIN raw_orders o USING (order_id)
  LEFT JOIN rev r USING (order_id)
  LEFT JOIN pay p USING (order_id)
  LEFT JOIN dim_customers c ON o.customer_id = c.customer_id
  LEFT JOIN dim_products d ON i.product_id = d.product_id
),
dedup AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY order_id, order_item_id ORDER BY product_id, seller_id, price, freight_value) AS rn
    FROM joined WHERE order_id IS NOT NULL AND customer_id IS NOT NULL AND product_id IS NOT NULL AND seller_id IS NOT NULL
  ) WHERE rn = 1
),
fact_orders AS (
  SELECT row_number() OVER (ORDER BY order_id, order_item_id) AS fact_id,
    * REPLACE (coalesce(cast(review_score AS double), (SELECT quantile_cont(review_score, 0.5) FROM dedup)) AS review_score)
  FROM dedup
)
"""


def mean(expr: str, digits: int) -> str:
    """Exact sum, one division, decimal rounding; returned as double."""
    return rounded(f"cast(sum({expr}) AS double) / count({expr})", digits)


def rounded(expr: str, digits: int) -> str:
    return f"cast(round(cast({expr} AS decimal(28,8)), {digits}) AS double)"


def total(expr: str) -> str:
    return f"cast(sum({expr}) AS double)"


def pct(condition: str, digits: int) -> str:
    return rounded(f"cast(sum(CASE WHEN {condition} THEN 1 ELSE 0 END) AS double) * 100 / count(*)", digits)
