"""The order-item fact table.

Order-level inputs are joined first, at order grain, and the item table joins that header
once, with very large orders split. Joins to stored dimensions read both sides straight
from a shuffle, which lets adaptive execution split a hot product or customer. Items are
cut to their key columns and take their category while they are narrow; then they are dealt by
order once and sorted once, which serves duplicates, numbers and the join with the header alike.

One table of rows per order, counted from the key columns, tells which orders are large,
where the numbers of each order begin and how often its score counts. So fact rows are
numbered while they pass and are never stored but in the fact itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.functions.time import coerce_timestamp, floor_days
from storelens.operators.joins import ROWS_PER_TASK, hot_keys, skew_join
from storelens.operators.keep_first import READ_ORDER, keep_first, row_order
from storelens.operators.ranking import distributed_rank, grouped_rank, running_totals
from storelens.session import stored
from storelens.sources.raw import RawTables
from storelens.plans import dims

# Names of columns and keys of the fact table.
ITEM_KEYS = ["order_id", "order_item_id"]
REQUIRED_KEYS = ["order_id", "customer_id", "product_id", "seller_id"]
TIMESTAMPS = ["order_purchase_timestamp", "order_delivered_customer_date", "order_estimated_delivery_date"]
FACT_COLUMNS = [
    "fact_id", "order_id", "order_item_id", "customer_id", "product_id", "seller_id",
    "order_date", "order_year", "order_month", "order_quarter", "yyyymm",
    "price", "freight_value", "revenue", "review_score", "order_status", "is_delivered", "delivery_delay_days",
    "total_payment", "payment_installments", "payment_type", "category", "state", "lat", "lng",
]


def coerce_timestamps(orders: DataFrame) -> DataFrame:
    return orders.withColumns({c: coerce_timestamp(c) for c in TIMESTAMPS})


def payments_per_order(payments: DataFrame) -> DataFrame:
    """Total paid, most installments and first known type per order."""
    kind = F.col("payment_type")
    order = F.col(READ_ORDER) if READ_ORDER in payments.columns else F.struct("payment_value", "payment_installments", "payment_type")
    return (
        payments.filter(F.col("order_id").isNotNull())
        .groupBy("order_id")
        .agg(
            F.coalesce(F.sum("payment_value"), F.lit(0)).alias("total_payment"),
            F.max("payment_installments").alias("payment_installments"),
            F.min_by(kind, F.when(kind.isNotNull(), order)).alias("payment_type"),
        )
    )


def best_review_per_order(reviews: DataFrame) -> DataFrame:
    return reviews.select("order_id", "review_score").dropna().groupBy("order_id").agg(F.max("review_score").alias("review_score"))


def drop_null_keys(df: DataFrame) -> DataFrame:
    """Rows missing any of the identifying keys the table has are dropped."""
    return df.dropna(subset=[c for c in REQUIRED_KEYS if c in df.columns])


def dedupe_items(df: DataFrame) -> DataFrame:
    return keep_first(df, ITEM_KEYS)


def order_header(orders: DataFrame, reviews: DataFrame, payments: DataFrame, customers: DataFrame) -> DataFrame:
    """One row per order with customer position, best review and payment summary."""
    return (
        coerce_timestamps(orders)
        .select("order_id", "customer_id", "order_status", *TIMESTAMPS)
        .join(customers.select("customer_id", "state", "lat", "lng"), "customer_id", "left")
        .join(best_review_per_order(reviews), "order_id", "left")
        .join(payments_per_order(payments), "order_id", "left")
    )


def fact_join(items: DataFrame, header: DataFrame, products: DataFrame) -> DataFrame:
    """Every item row with its order header and category (null where unknown)."""
    return skew_join(items, header, ["order_id"]).join(products.select("product_id", "category"), "product_id", "left")


def add_date_parts(df: DataFrame) -> DataFrame:
    ts = F.col("order_purchase_timestamp")
    return df.withColumns({
        "order_date": ts.cast("date"),
        "order_year": F.year(ts),
        "order_month": F.month(ts),
        "order_quarter": F.quarter(ts),
        "yyyymm": F.date_format(ts.cast("date"), "yyyy-MM"),
    })


def add_revenue(df: DataFrame) -> DataFrame:
    return df.withColumn("revenue", F.round(F.col("price") + F.col("freight_value"), 2))


def add_is_delivered(df: DataFrame) -> DataFrame:
    return df.withColumn("is_delivered", F.coalesce((F.col("order_status") == "delivered").cast("int"), F.lit(0)))


def add_delivery_delay(df: DataFrame) -> DataFrame:
    delay = floor_days(F.col("order_delivered_customer_date"), F.col("order_estimated_delivery_date"))
    return df.withColumn("delivery_delay_days", delay)


def order_sizes(raw: RawTables) -> DataFrame:
    """``n`` clean items per order, their ``rows`` with duplicates, and whether the order has a customer, from key columns; stored, because several steps read it."""
    items = drop_null_keys(raw.order_items.select("order_id", "order_item_id", "product_id", "seller_id")).groupBy(*ITEM_KEYS).agg(F.count(F.lit(1)).alias("rows"))
    owners = raw.orders.filter(F.col("order_id").isNotNull()).groupBy("order_id").agg(F.max(F.col("customer_id").isNotNull()).alias("owned"))
    counted = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows")).join(owners, "order_id", "left")
    return stored(counted.withColumn("owned", F.coalesce("owned", F.lit(False))), "order-sizes")


def review_median(sizes: DataFrame, reviews: DataFrame) -> Column:
    """Median score over the fact's rows, from one row per order: its best score counts once for each of its items."""
    scored = best_review_per_order(reviews).join(sizes.filter("owned"), "order_id")
    return scored.agg(F.percentile("review_score", F.lit(0.5), F.col("n"))).scalar()


def order_starts(sizes: DataFrame) -> DataFrame:
    """How many fact rows stand before each order's, in order of order_id."""
    cum = running_totals(sizes.filter("owned").select("order_id", "n"), ["order_id"], ["n"])
    return cum.select("order_id", (F.col("cum_n") - F.col("n")).alias("_start"))


def _first_of_each(items: DataFrame, rest: list[str]) -> DataFrame:
    """One row per (order, item), the least by ``rest``, out of rows that are dealt by order: the sort also serves numbers and joins by order."""
    copy = F.row_number().over(W.partitionBy(*ITEM_KEYS).orderBy(*rest))
    return items.repartition("order_id").withColumn("_copy", copy).filter(F.col("_copy") == 1).drop("_copy")


def numbered_items(items: DataFrame, sizes: DataFrame, rest: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """One row per (order, item), the least by ``rest``, with ``_item`` = 1.. in each order by item. Orders too large for a task, duplicates
    included, are combined before they are dealt, and ranked over several tasks."""
    in_order = F.row_number().over(W.partitionBy("order_id").orderBy("order_item_id"))
    large = hot_keys(sizes.select("order_id", "rows"), "rows", rows_per_task).select("order_id")
    if large.isEmpty():
        return _first_of_each(items, rest).withColumn("_item", in_order)
    small = _first_of_each(items.join(large, "order_id", "left_anti"), rest).withColumn("_item", in_order)
    combined = keep_first(items.join(large, "order_id", "left_semi").select(*items.columns), ITEM_KEYS, rest)
    return small.unionByName(grouped_rank(combined, ["order_id"], ["order_item_id"], "_item"))


def impute_review(df: DataFrame, median: Column | None = None) -> DataFrame:
    """Null review scores become the median score, of the table itself unless it is given."""
    if median is None:
        median = df.agg(F.percentile("review_score", F.lit(0.5))).scalar()  # a handful of distinct values
    return df.withColumn("review_score", F.coalesce(F.col("review_score").cast("double"), median))


def derive(df: DataFrame) -> DataFrame:
    return add_delivery_delay(add_is_delivered(add_revenue(add_date_parts(df))))


def surrogate_key(df: DataFrame) -> DataFrame:
    """fact_id = position in (order, item) order."""
    return distributed_rank(df, ITEM_KEYS, "fact_id")


def project_fact(df: DataFrame) -> DataFrame:
    return df.select([c for c in FACT_COLUMNS if c in df.columns])


def joined_rows(raw: RawTables, customers: DataFrame, products: DataFrame) -> DataFrame:
    """Raw items with every joined attribute, before cleaning."""
    header = order_header(raw.orders, raw.order_reviews, raw.order_payments, customers)
    return fact_join(raw.order_items, header, products)


def keyed_items(raw: RawTables, products: DataFrame) -> tuple[DataFrame, list[str]]:
    """Item rows with all their keys and their category, and the columns that say which of several rows of an item is the first."""
    columns = [*ITEM_KEYS, "product_id", "seller_id", "price", "freight_value"]
    kept = [*columns, READ_ORDER] if READ_ORDER in raw.order_items.columns else columns
    items = drop_null_keys(raw.order_items.select(kept))
    order = row_order(items, ITEM_KEYS)
    return items.join(products.select("product_id", "category"), "product_id", "left"), [*order, *[c for c in columns if c not in ITEM_KEYS and c not in order]]


def fact_orders(raw: RawTables, customers: DataFrame, products: DataFrame, with_key: bool = True,
                rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The fact table. Orders are unique on their id. With a key, fact_id = position in (order, item) order: the rows before the order plus the item's own."""
    sizes = order_sizes(raw)
    keyed, rest = keyed_items(raw, products)
    items = numbered_items(keyed, sizes, rest, rows_per_task).drop(READ_ORDER)
    header = order_header(raw.orders, raw.order_reviews, raw.order_payments, customers)
    if with_key:
        header = header.join(order_starts(sizes), "order_id", "left")
    rows = derive(drop_null_keys(skew_join(items, header, ["order_id"], counts=sizes.select("order_id", "n"), rows_per_task=rows_per_task)))
    if with_key:
        rows = rows.withColumn("fact_id", F.col("_start") + F.col("_item"))
    return project_fact(impute_review(rows, review_median(sizes, raw.order_reviews)))


def customer_dim(raw: RawTables) -> DataFrame:
    return dims.dim_customers(raw.customers, dims.dim_geolocation(dims.geolocation_groups(raw.geolocation)))


def product_dim(raw: RawTables) -> DataFrame:
    return dims.dim_products(raw.products, raw.category_translation)
