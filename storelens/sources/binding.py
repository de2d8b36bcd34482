"""View the order-and-lineitem test tables as the nine raw inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators.keep_first import READ_ORDER
from storelens.sources.raw import RawTables


def bind_test_tables(spark: SparkSession, directory: str) -> RawTables:
    def table(name: str) -> DataFrame:
        return spark.read.parquet(f"{directory}/{name}.parquet")

    lines, orders, parts = table("lineitem"), table("orders"), table("part")
    nations = table("nation").select(F.col("n_nationkey").alias("nationkey"), F.col("n_name").alias("state"))
    customers = table("customer").join(nations, F.col("c_nationkey") == F.col("nationkey"), "left")
    suppliers = table("supplier").join(nations, F.col("s_nationkey") == F.col("nationkey"), "left")

    shipped = lines.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.max(F.expr("l_shipdate + make_dt_interval(0, cast(l_quantity as int))")).alias("delivered")
    )
    status = F.col("o_orderstatus")
    raw_orders = orders.join(shipped, "o_orderkey", "left").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(status == "F", "delivered").when(status == "O", "shipped").otherwise("processing").alias("order_status"),
        # dates are text, as in the files; some delivery dates are none
        F.col("o_orderdate").cast("string").alias("order_purchase_timestamp"),
        F.when(F.col("o_orderkey") % 89 == 0, "2018-13-40 unknown").when(status == "F", F.col("delivered").cast("string")).alias("order_delivered_customer_date"),
        F.expr("o_orderdate + make_dt_interval(1900, 12)").cast("string").alias("order_estimated_delivery_date"),
    )
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    raw_items = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 101 != 0, F.col("l_suppkey")).alias("seller_id"),  # some items have no seller
        price.alias("price"),
        (price * F.col("l_tax").cast("decimal(4,2)")).cast("decimal(12,2)").alias("freight_value"),
    )
    flag, line_status = F.col("l_returnflag"), F.col("l_linestatus")
    raw_payments = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("payment_value"),
        (F.col("l_quantity").cast("int") % 10 + 1).alias("payment_installments"),
        F.when(flag == "A", "credit_card")
        .when(flag == "N", "boleto")
        .when((flag == "R") & (line_status == "F"), "voucher")
        .when((flag == "R") & (line_status == "O"), "debit_card")
        .alias("payment_type"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate").alias(READ_ORDER),
    )
    raw_reviews = lines.select(
        F.col("l_orderkey").alias("order_id"),
        F.when(F.col("l_partkey") % 17 != 0, (1 + (F.col("l_partkey") + F.col("l_suppkey")) % 5).cast("int")).alias("review_score"),
    )
    raw_customers = customers.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_unique_id"),
        F.col("c_mktsegment").alias("customer_city"),
        F.col("state").alias("customer_state"),
        (F.col("c_custkey") % 97).cast("int").alias("customer_zip_code_prefix"),
    )
    raw_sellers = suppliers.select(
        F.col("s_suppkey").alias("seller_id"),
        F.col("s_name").alias("seller_city"),
        F.col("state").alias("seller_state"),
        (F.col("s_suppkey") * 13 % 131).cast("int").alias("seller_zip_code_prefix"),
    )
    raw_products = parts.select(
        F.col("p_partkey").alias("product_id"),
        F.when(F.col("p_partkey") % 41 != 0, F.translate("p_name", " ", "_")).alias("product_category_name"),
        F.when(F.col("p_size") % 13 != 0, F.col("p_size") * 100.0).alias("product_weight_g"),
        F.col("p_size").cast("double").alias("product_length_cm"),
        (F.col("p_partkey") % 20).cast("double").alias("product_height_cm"),
        (F.col("p_partkey") % 15).cast("double").alias("product_width_cm"),
    )
    words = F.split("p_name", " ")
    translation = parts.filter(F.col("p_name").startswith("s")).select("p_name").distinct().select(
        F.translate("p_name", " ", "_").alias("product_category_name"),
        F.concat_ws("_", words[1], words[0]).alias("product_category_name_english"),
    )
    raw_geo = customers.select(
        (F.col("c_custkey") % 97).cast("int").alias("geolocation_zip_code_prefix"),
        (F.col("c_acctbal") / 1000).alias("geolocation_lat"),
        (-F.col("c_acctbal") / 500).alias("geolocation_lng"),
        F.col("c_mktsegment").alias("geolocation_city"),
        F.col("state").alias("geolocation_state"),
        F.col("c_custkey").alias(READ_ORDER),
    )
    return RawTables(
        raw_orders, raw_items, raw_payments, raw_reviews, raw_customers, raw_products, raw_sellers, raw_geo, translation
    )
