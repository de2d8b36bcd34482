"""Raw inputs to star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.plans import dims, fact
from storelens.sources.raw import RawTables, corrupt_counts
from storelens.sources.warehouse import Warehouse, write_table


def dimensions(spark: SparkSession, raw: RawTables, start: str | None = None, end: str | None = None) -> dict[str, DataFrame]:
    """The five dimensions. Without ``start`` and ``end`` the calendar covers the years of the orders."""
    geo = dims.dim_geolocation(dims.geolocation_groups(raw.geolocation))
    return {
        "dim_geolocation": geo,
        "dim_customers": dims.dim_customers(raw.customers, geo),
        "dim_products": dims.dim_products(raw.products, raw.category_translation),
        "dim_sellers": dims.dim_sellers(raw.sellers, geo),
        "dim_date": dims.dim_date(dims.fixed_range(spark, start, end) if start and end else dims.calendar_range(raw.orders)),
    }


def transform(spark: SparkSession, raw: RawTables, start: str | None = None, end: str | None = None,
              with_key: bool = True) -> Warehouse:
    """All six tables, unwritten. Of the fact only the rows per order are stored beforehand."""
    found = dimensions(spark, raw, start, end)
    return Warehouse(fact_orders=fact.fact_orders(raw, found["dim_customers"], found["dim_products"], with_key), **found)


def run_etl(spark: SparkSession, raw: RawTables, path: str, start: str | None = None, end: str | None = None) -> Warehouse:
    """Transform, write, and return the tables as read back from storage.

    The dimensions are stored first and the fact joins the stored ones: they are computed
    once, and their real sizes decide how they are joined.
    """
    stored = {name: write_table(df, path, name) for name, df in dimensions(spark, raw, start, end).items()}
    facts = fact.fact_orders(raw, stored["dim_customers"], stored["dim_products"])
    return Warehouse(fact_orders=write_table(facts, path, "fact_orders"), **stored)


def etl_audit(raw: RawTables, tables: Warehouse) -> DataFrame:
    """Row counts before and after cleaning, as (measure, value) rows."""
    count = F.count(F.lit(1))
    facts = tables.fact_orders

    def one(name: str, counted: DataFrame) -> DataFrame:
        return counted.select(F.lit(name).alias("measure"), F.coalesce(counted.columns[0], F.lit(0)).alias("value"))

    # rows are counted per order before the joins, so that a large order is one row there
    fact_sizes = facts.groupBy("order_id").agg(count.alias("n"))
    item_sizes = fact.drop_null_keys(raw.order_items).groupBy("order_id").agg(count.alias("n"))
    owned = raw.orders.filter(F.col("customer_id").isNotNull()).select("order_id")
    scored = fact.best_review_per_order(raw.order_reviews).select("order_id")
    measures = [
        one("geolocation_raw_rows", raw.geolocation.agg(count)),
        one("geolocation_rows", tables.dim_geolocation.agg(count)),
        one("item_rows", raw.order_items.agg(count)),
        one("item_rows_with_keys", item_sizes.join(owned, "order_id", "left_semi").agg(F.sum("n"))),
        one("fact_rows", facts.agg(count)),
        one("fact_orders_distinct", fact_sizes.agg(count)),
        one("scores_imputed", fact_sizes.join(scored, "order_id", "left_anti").agg(F.sum("n"))),
    ]
    broken = corrupt_counts(raw.items())
    if broken is not None:
        measures.append(broken.select(F.concat(F.lit("corrupt_rows_"), "table_name").alias("measure"), F.col("row_count").alias("value")))
    out = measures[0]
    for m in measures[1:]:
        out = out.unionByName(m)
    sign = F.when(F.col("measure") == "item_rows", F.col("value")).when(F.col("measure") == "fact_rows", -F.col("value"))
    return out.unionByName(out.agg(F.lit("rows_dropped").alias("measure"), F.sum(sign).alias("value")))
