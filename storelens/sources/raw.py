"""The nine raw inputs: declared schemas and the CSV scan."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators.keep_first import READ_ORDER

# Column names and types of the raw files. Timestamps stay text until coerced.
RAW_SCHEMAS = {
    "orders": "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
    "order_approved_at string, order_delivered_carrier_date string, order_delivered_customer_date string, "
    "order_estimated_delivery_date string",
    "order_items": "order_id string, order_item_id int, product_id string, seller_id string, "
    "shipping_limit_date string, price decimal(18,2), freight_value decimal(18,2)",
    "order_payments": "order_id string, payment_sequential int, payment_type string, payment_installments int, "
    "payment_value decimal(18,2)",
    "order_reviews": "review_id string, order_id string, review_score int, review_comment_title string, "
    "review_comment_message string, review_creation_date string, review_answer_timestamp string",
    "customers": "customer_id string, customer_unique_id string, customer_zip_code_prefix string, "
    "customer_city string, customer_state string",
    "products": "product_id string, product_category_name string, product_name_lenght int, "
    "product_description_lenght int, product_photos_qty int, product_weight_g double, product_length_cm double, "
    "product_height_cm double, product_width_cm double",
    "sellers": "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string",
    "geolocation": "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, "
    "geolocation_city string, geolocation_state string",
    "category_translation": "product_category_name string, product_category_name_english string",
}


@dataclass(frozen=True)
class RawTables:
    orders: DataFrame
    order_items: DataFrame
    order_payments: DataFrame
    order_reviews: DataFrame
    customers: DataFrame
    products: DataFrame
    sellers: DataFrame
    geolocation: DataFrame
    category_translation: DataFrame

    def items(self) -> list[tuple[str, DataFrame]]:
        return [(f.name, getattr(self, f.name)) for f in fields(self)]


#: Column with the whole line where it does not fit the schema (a field too many or too few, a number that is none); else null.
CORRUPT = "_corrupt"


def _schema_by_header(spark: SparkSession, path: str, name: str) -> str:
    """The declared types in the order of the file's header. Columns that are not declared are read as text and left out later."""
    declared = dict(c.split(" ", 1) for c in RAW_SCHEMAS[name].split(", "))
    header = spark.read.option("header", True).option("inferSchema", False).csv(path).columns
    missing = [c for c in declared if c not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)} of {name}")
    return ", ".join(f"`{c}` {declared.get(c, 'string')}" for c in header)


def scan_csv(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Scan one raw CSV, its columns found by name; every file of a folder has to have the same header.

    The read order (file, block, row) is kept as a struct so that 'first row of a key'
    means the first one in the file. Quoted fields may hold line breaks in reviews only,
    so the other files stay splittable. Lines that do not fit keep what could be read; see CORRUPT.
    """
    schema = f"{_schema_by_header(spark, path, name)}, {CORRUPT} string"
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False).option("escape", '"').option("columnNameOfCorruptRecord", CORRUPT)
    if name == "order_reviews":
        reader = reader.option("multiLine", True)
    read_order = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
    known = [c.split(" ")[0] for c in RAW_SCHEMAS[name].split(", ")]
    return reader.csv(path).select(*known, CORRUPT, read_order.alias(READ_ORDER))


def extract(spark: SparkSession, directory: str, files: dict[str, str] | None = None) -> RawTables:
    """All nine inputs; ``files`` maps table names to file or folder names (default ``<name>.csv``)."""
    names = files or {}
    return RawTables(**{n: scan_csv(spark, f"{directory}/{names.get(n, n + '.csv')}", n) for n in RAW_SCHEMAS})


def row_counts(tables: list[tuple[str, DataFrame]]) -> DataFrame:
    """(table_name, row_count), one count per table in a single plan."""
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


def corrupt_counts(tables: list[tuple[str, DataFrame]]) -> DataFrame | None:
    """(table_name, row_count) of lines that did not fit their schema, for scanned tables; None if no table was scanned."""

    def broken(df: DataFrame) -> DataFrame:
        # a field is checked only if it is read, so the count has to depend on all of them
        read = F.xxhash64(*[c for c in df.columns if c not in (CORRUPT, READ_ORDER)]) >= F.lit(-(1 << 63))
        return df.agg(F.count_if(F.col(CORRUPT).isNotNull() & read).alias("row_count"))

    counts = [broken(df).select(F.lit(n).alias("table_name"), "row_count") for n, df in tables if CORRUPT in df.columns]
    out = counts[0] if counts else None
    for c in counts[1:]:
        out = out.unionByName(c)
    return out
