"""The star schema on storage: write, open, count, query, export."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.numeric import finite_or_null
from storelens.sources.raw import row_counts


@dataclass(frozen=True)
class Warehouse:
    fact_orders: DataFrame
    dim_customers: DataFrame
    dim_products: DataFrame
    dim_sellers: DataFrame
    dim_date: DataFrame
    dim_geolocation: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]

    def row_counts(self) -> DataFrame:
        return row_counts(self.items())

    def register_views(self) -> None:
        for name, df in self.items():
            df.createOrReplaceTempView(name)


PARTITION_BY = {"fact_orders": ["order_year"]}
BUCKETED = ("fact_orders", "dim_customers")
#: Partition values that a task writes at a time without sorting its rows; with more, Spark sorts the rest.
OPEN_FILES = 16
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_table(df: DataFrame, path: str, name: str, max_records_per_file: int = 50_000_000) -> DataFrame:
    """Overwrite one table as Parquet and return it as stored.

    A partitioned table is written where its rows are, neither shuffled nor sorted once more: adaptive execution has
    given tasks of the advisory size, and a task keeps one open file for each partition value it meets, up to ``OPEN_FILES``.
    """
    spark, keys = df.sparkSession, PARTITION_BY.get(name)
    writer = df.write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
    if keys:
        before = spark.conf.get(_WRITERS)
        spark.conf.set(_WRITERS, OPEN_FILES)
        try:
            writer.partitionBy(*keys).parquet(f"{path}/{name}")
        finally:
            spark.conf.set(_WRITERS, before)
    else:
        writer.parquet(f"{path}/{name}")
    return spark.read.parquet(f"{path}/{name}")


def write_warehouse(tables: Warehouse, path: str) -> None:
    """Overwrite the six tables as Parquet; the fact is split by year."""
    for name, df in tables.items():
        write_table(df, path, name)


def save_warehouse(spark: SparkSession, tables: Warehouse, database: str, buckets: int | None = None) -> None:
    """The same, as catalog tables in a database created on demand.

    With ``buckets``, the fact and the customers are both bucketed by customer, so that
    joining and grouping them by customer needs no shuffle. A customer stays in one bucket:
    use it where no customer dominates.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    for name, df in tables.items():
        keys = PARTITION_BY.get(name, [])
        if buckets and name in BUCKETED:
            writer = df.repartition(buckets, "customer_id").write.bucketBy(buckets, "customer_id").sortBy("customer_id")
        else:
            writer = (df.hint("rebalance", *keys) if keys else df).write
        if keys:
            writer = writer.partitionBy(*keys)
        writer.mode("overwrite").format("parquet").saveAsTable(f"`{database}`.`{name}`")


def open_database(spark: SparkSession, database: str) -> Warehouse:
    return Warehouse(**{f.name: spark.table(f"`{database}`.`{f.name}`") for f in fields(Warehouse)})


def open_warehouse(spark: SparkSession, path: str) -> Warehouse:
    return Warehouse(**{f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(Warehouse)})


def query(spark: SparkSession, sql: str) -> DataFrame:
    """Run SQL text over the registered tables; the result stays distributed."""
    return spark.sql(sql)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def clean_records(df: DataFrame) -> DataFrame:
    """NaN and infinite values become null so that rows serialise as plain JSON."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite_or_null(F.col(c)) for c in floats})


def to_records(df: DataFrame) -> DataFrame:
    """One JSON document per row, as a ``record`` column, nulls included."""
    cleaned = clean_records(df)
    return cleaned.select(F.to_json(F.struct(*cleaned.columns), {"ignoreNullFields": "false"}).alias("record"))


def bounded_n(n: int, low: int, high: int, name: str = "n") -> int:
    """Validate a top-n style argument."""
    if not low <= n <= high:
        raise ValueError(f"{name} must be between {low} and {high}, got {n}")
    return n
