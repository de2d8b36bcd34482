"""The five dimension tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.functions.numeric import exact_mean, round_to
from storelens.functions.text import title_case
from storelens.functions.time import coerce_timestamp
from storelens.operators.keep_first import keep_first, row_order


def geolocation_groups(geo: DataFrame) -> DataFrame:
    """Mean position and first known city per (zip, state); rows without a key are left out."""
    city = F.col("geolocation_city")
    order = F.struct(*row_order(geo, ["geolocation_zip_code_prefix", "geolocation_state"]))
    return (
        geo.filter(F.col("geolocation_zip_code_prefix").isNotNull() & F.col("geolocation_state").isNotNull())
        .groupBy(F.col("geolocation_zip_code_prefix").alias("zip_code_prefix"), F.col("geolocation_state").alias("state"))
        .agg(
            F.min_by(city, F.when(city.isNotNull(), order)).alias("city"),
            round_to(exact_mean(F.col("geolocation_lat")), 6).alias("lat"),
            round_to(exact_mean(F.col("geolocation_lng")), 6).alias("lng"),
        )
    )


def dim_geolocation(groups: DataFrame) -> DataFrame:
    """One row per zip: the group of its smallest state."""
    return keep_first(groups, ["zip_code_prefix"], ["state"]).select("zip_code_prefix", "state", "city", "lat", "lng")


def dim_customers(customers: DataFrame, geolocation: DataFrame) -> DataFrame:
    position = geolocation.select("zip_code_prefix", "lat", "lng")
    return (
        keep_first(customers, ["customer_id"])
        .select(
            "customer_id",
            "customer_unique_id",
            F.col("customer_city").alias("city"),
            F.col("customer_state").alias("state"),
            F.col("customer_zip_code_prefix").alias("zip_code_prefix"),
        )
        .join(position, "zip_code_prefix", "left")
        .select("customer_id", "customer_unique_id", "city", "state", "zip_code_prefix", "lat", "lng")
    )


def dim_sellers(sellers: DataFrame, geolocation: DataFrame) -> DataFrame:
    position = geolocation.select("zip_code_prefix", F.col("lat").alias("seller_lat"), F.col("lng").alias("seller_lng"))
    return (
        keep_first(sellers, ["seller_id"])
        .withColumnRenamed("seller_zip_code_prefix", "zip_code_prefix")
        .join(position, "zip_code_prefix", "left")
        .select("seller_id", "seller_city", "seller_state", "zip_code_prefix", "seller_lat", "seller_lng")
    )


def translate_categories(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Add ``category``: the English name, else the original, spaced and title-cased."""
    name = F.coalesce("product_category_name_english", "product_category_name")
    return products.join(translation.select("product_category_name", "product_category_name_english"), "product_category_name", "left").withColumn(
        "category", title_case(F.translate(name, "_", " "))
    )


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Deduplicated before the translation join, so the join sees each product once."""
    unique = keep_first(products, ["product_id"])
    one_name_each = keep_first(translation, ["product_category_name"])
    return translate_categories(unique, one_name_each).select(
        "product_id",
        "category",
        F.col("product_weight_g").alias("weight_g"),
        F.col("product_length_cm").alias("length_cm"),
        F.col("product_height_cm").alias("height_cm"),
        F.col("product_width_cm").alias("width_cm"),
    )


def calendar_range(orders: DataFrame) -> DataFrame:
    """One row (start, end): whole years around all purchases. Texts that are no timestamp do not count."""
    bought = coerce_timestamp("order_purchase_timestamp").cast("date")
    return orders.select(bought.alias("day")).agg(
        F.make_date(F.year(F.min("day")), F.lit(1), F.lit(1)).alias("start"), F.make_date(F.year(F.max("day")), F.lit(12), F.lit(31)).alias("end")
    )


def fixed_range(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("date").alias("start"), F.lit(end).cast("date").alias("end"))


def dim_date(bounds: DataFrame) -> DataFrame:
    """Calendar with ISO week and weekend flag, from one row (start, end); empty where that is null."""
    days = bounds.where("start is not null").select(F.explode(F.sequence("start", "end", F.expr("interval 1 day"))).alias("date"))
    return days.select(
        F.date_format("date", "yyyyMMdd").cast("int").alias("date_id"),
        "date",
        F.year("date").alias("year"),
        F.quarter("date").alias("quarter"),
        F.month("date").alias("month"),
        F.date_format("date", "MMMM").alias("month_name"),
        F.weekofyear("date").alias("week"),
        F.date_format("date", "EEEE").alias("day_name"),
        (F.weekday("date") >= 5).cast("int").alias("is_weekend"),
        F.date_format("date", "yyyy-MM").alias("yyyymm"),
    )
