"""Business reports over the star schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.functions.numeric import mean_of, pct_of_rows, round_to, safe_div
from storelens.functions.time import month_name_short
from storelens.operators.growth import add_growth
from storelens.sources.warehouse import bounded_n


def _rows() -> Column:
    return F.count(F.lit(1))


def _total(col: str) -> Column:
    return round_to(F.sum(col), 2)


def _mean(col: str, digits: int = 2) -> Column:
    return round_to(mean_of(F.col(col)), digits)


def _distinct(col: str) -> Column:
    return F.count_distinct(col)


def _delivered(fact: DataFrame) -> DataFrame:
    return fact.filter((F.col("is_delivered") == 1) & F.col("delivery_delay_days").isNotNull())


def _late() -> Column:
    return F.col("delivery_delay_days") > 0


def _on_time() -> Column:
    return F.col("delivery_delay_days") <= 0


def _zero_if_null(df: DataFrame) -> DataFrame:
    return df.select([F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in df.columns])


def _sums(*columns: str) -> list[Column]:
    """Sums and counts that can be added up again: of the columns, of rows, and of delivered, late and punctual rows."""
    flags = {"rows": F.lit(True), "delivered": F.col("is_delivered") == 1, "late": _late(), "on_time": _on_time()}
    return [
        *[F.sum(c).alias(f"s_{c}") for c in columns], *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.sum(F.when(f, 1).otherwise(0)).alias(f"n_{k}") for k, f in flags.items()],
    ]


def _cells(fact: DataFrame, keys: list[Column], *columns: str) -> DataFrame:
    """One row per key and order, with the order's customer. Reports count its rows instead of distinct order ids, so
    that no fact row is repeated for a distinct count."""
    return fact.groupBy(*keys, "order_id").agg(F.min("customer_id").alias("customer_id"), *_sums(*columns))


def _added(col: str, digits: int = 2) -> Column:
    return round_to(F.sum(f"s_{col}"), digits)


def _added_mean(col: str, digits: int = 2) -> Column:
    return round_to(F.sum(f"s_{col}").cast("double") / F.sum(f"n_{col}"), digits)


def _added_pct(part: str, digits: int = 2) -> Column:
    return round_to(F.sum(f"n_{part}").cast("double") * 100 / F.sum("n_rows"), digits)


def eda_kpis(fact: DataFrame) -> DataFrame:
    """Orders, customers, money, scores and delivery in one row; nulls are kept."""
    return _kpis(fact).drop("total_freight")


def _kpis(fact: DataFrame) -> DataFrame:
    return _cells(fact, [], "revenue", "price", "review_score", "freight_value").agg(
        _rows().alias("total_orders"),
        _distinct("customer_id").alias("unique_customers"),
        _added("revenue").alias("total_revenue"),
        _added_mean("price").alias("avg_order_value"),
        _added_mean("review_score").alias("avg_review_score"),
        _added("freight_value").alias("total_freight"),
        _added_pct("delivered").alias("delivery_rate_pct"),
    )


def kpi_summary(fact: DataFrame) -> DataFrame:
    return _zero_if_null(_kpis(fact))


def monthly_revenue(fact: DataFrame) -> DataFrame:
    keys = [F.col("order_year").alias("year"), F.col("order_month").alias("month"), F.col("yyyymm")]
    months = _cells(fact, keys, "revenue", "freight_value").groupBy("year", "month", "yyyymm").agg(
        _added("revenue").alias("revenue"),
        _added("freight_value").alias("freight"),
        _rows().alias("orders"),
        _distinct("customer_id").alias("customers"),
    )
    return add_growth(months, "revenue", ["year", "month"], "mom_growth_pct").orderBy("year", "month")


def yoy_comparison(fact: DataFrame) -> DataFrame:
    years = _cells(fact, [F.col("order_year").alias("year")], "revenue", "review_score").groupBy("year").agg(
        _added("revenue").alias("revenue"),
        _rows().alias("orders"),
        _distinct("customer_id").alias("customers"),
        _added_mean("review_score").alias("avg_review"),
    )
    return add_growth(years, "revenue", ["year"], "yoy_growth").orderBy("year")


def category_performance(fact: DataFrame) -> DataFrame:
    """Share is of all revenue, rows without a category included."""
    categories = fact.groupBy("category").agg(
        _distinct("order_id").alias("orders"),
        F.sum("revenue").alias("part"),
        _mean("price").alias("avg_price"),
        _mean("review_score").alias("avg_review"),
    )
    whole = F.sum("part").over(W.partitionBy())  # a row a category
    shares = categories.withColumn("revenue_share_pct", round_to(safe_div(F.col("part").cast("double") * 100, whole), 2))
    return (
        shares.filter(F.col("category").isNotNull())
        .select("category", "orders", round_to(F.col("part"), 2).alias("revenue"), "avg_price", "avg_review", "revenue_share_pct")
        .orderBy(F.desc("revenue"), "category")
    )


def top_products(fact: DataFrame, products: DataFrame, n: int = 10) -> DataFrame:
    """``orders`` counts item rows. Aggregated per product before the join."""
    per_product = fact.groupBy("product_id").agg(
        F.count("order_id").alias("orders"),
        _total("revenue").alias("revenue"),
        _mean("price").alias("avg_price"),
        _mean("review_score").alias("avg_review"),
    )
    return (
        per_product.join(products.select("product_id", "category"), "product_id")
        .select("product_id", "category", "orders", "revenue", "avg_price", "avg_review")
        .orderBy(F.desc("revenue"), "product_id")
        .limit(bounded_n(n, 1, 50))
    )


def seller_leaderboard(fact: DataFrame, sellers: DataFrame, n: int = 10) -> DataFrame:
    """``orders`` counts distinct orders."""
    per_seller = fact.groupBy("seller_id").agg(
        _distinct("order_id").alias("orders"),
        _total("revenue").alias("revenue"),
        _mean("review_score").alias("avg_review"),
        _mean("delivery_delay_days", 1).alias("avg_delay_days"),
    )
    return (
        per_seller.join(sellers.select("seller_id", "seller_state"), "seller_id")
        .select("seller_id", "seller_state", "orders", "revenue", "avg_review", "avg_delay_days")
        .orderBy(F.desc("revenue"), "seller_id")
        .limit(bounded_n(n, 1, 30))
    )


def _by_state(fact: DataFrame, customers: DataFrame, *columns: str):
    """Per-customer sums joined to the customers' states: rows of the fact are added up before anything is joined.
    An order has one customer, so orders add up too."""
    per_customer = fact.groupBy("customer_id").agg(_distinct("order_id").alias("n_orders"), *_sums(*columns))
    return per_customer.join(customers.select("customer_id", "state"), "customer_id").groupBy("state")


def state_performance(fact: DataFrame, customers: DataFrame) -> DataFrame:
    return (
        _by_state(fact, customers, "revenue", "review_score", "delivery_delay_days")
        .agg(
            F.sum("n_orders").alias("orders"),
            _rows().alias("customers"),
            _added("revenue").alias("revenue"),
            _added_mean("review_score").alias("avg_review"),
            _added_mean("delivery_delay_days", 1).alias("avg_delay_days"),
        )
        .orderBy(F.desc("revenue"), "state")
    )


def top_states(fact: DataFrame, customers: DataFrame, n: int = 12) -> DataFrame:
    return (
        _by_state(fact, customers, "revenue")
        .agg(F.sum("n_orders").alias("orders"), _added("revenue").alias("revenue"))
        .orderBy(F.desc("revenue"), "state")
        .limit(n)
    )


def payment_analysis(fact: DataFrame) -> DataFrame:
    return (
        fact.filter(F.col("payment_type").isNotNull())
        .groupBy("payment_type")
        .agg(
            _distinct("order_id").alias("orders"),
            _total("revenue").alias("revenue"),
            _mean("payment_installments", 1).alias("avg_installments"),
            _mean("price").alias("avg_order_value"),
        )
        .orderBy(F.desc("revenue"), "payment_type")
    )


def eda_payments(fact: DataFrame) -> DataFrame:
    return payment_analysis(fact).drop("avg_order_value")


def delivery_performance(fact: DataFrame) -> DataFrame:
    return _zero_if_null(
        _delivered(fact).agg(
            _mean("delivery_delay_days", 1).alias("avg_delay_days"),
            round_to(pct_of_rows(_late()), 2).alias("late_pct"),
            round_to(pct_of_rows(_on_time()), 2).alias("on_time_pct"),
        )
    )


def delivery_counts(fact: DataFrame) -> DataFrame:
    return (
        _delivered(fact)
        .agg(
            _mean("delivery_delay_days", 1).alias("avg_delay"),
            F.sum(F.when(_late(), 1).otherwise(0)).alias("late"),
            F.sum(F.when(_on_time(), 1).otherwise(0)).alias("ontime"),
            _rows().alias("total"),
        )
        .withColumns({
            "late_pct": round_to(safe_div(F.col("late") * 100, F.col("total")), 1),
            "ontime_pct": round_to(safe_div(F.col("ontime") * 100, F.col("total")), 1),
        })
    )


def late_by_state(fact: DataFrame, customers: DataFrame, n: int = 15) -> DataFrame:
    return (
        _by_state(_delivered(fact), customers, "delivery_delay_days")
        .agg(
            F.sum("n_rows").alias("total_orders"),
            F.sum("n_late").alias("late_orders"),
            _added_mean("delivery_delay_days", 1).alias("avg_delay_days"),
            _added_pct("late", 1).alias("late_pct"),
        )
        .orderBy(F.desc("late_pct"), "state")
        .limit(n)
    )


def late_by_month(fact: DataFrame) -> DataFrame:
    return (
        _delivered(fact)
        .groupBy("order_month")
        .agg(_mean("delivery_delay_days", 1).alias("avg_delay"), round_to(pct_of_rows(_late()), 1).alias("late_pct"))
        .withColumn("month_name", month_name_short(F.col("order_month")))
        .orderBy("order_month")
    )


def eda_monthly(fact: DataFrame) -> DataFrame:
    return fact.groupBy("yyyymm").agg(_total("revenue").alias("revenue"), _distinct("order_id").alias("orders")).orderBy("yyyymm")


def peak_month(fact: DataFrame) -> DataFrame:
    """The month with the largest revenue (earliest on a tie)."""
    months = fact.groupBy("yyyymm").agg(_total("revenue").alias("revenue"))
    return months.orderBy(F.desc("revenue"), "yyyymm").limit(1)


def top_categories(fact: DataFrame, n: int = 15) -> DataFrame:
    return (
        fact.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            _total("revenue").alias("revenue"),
            _mean("review_score").alias("avg_review"),
            _distinct("order_id").alias("orders"),
        )
        .orderBy(F.desc("revenue"), "category")
        .limit(n)
        .withColumn("label", F.substring("category", 1, 12))
    )


def review_distribution(fact: DataFrame) -> DataFrame:
    return fact.groupBy("review_score").agg(_rows().alias("count")).orderBy("review_score")


def sentiment_label(score: Column) -> Column:
    return F.when(score >= 4, "Positive").otherwise("Not Positive")


def sentiment_distribution(fact: DataFrame) -> DataFrame:
    scored = fact.filter(F.col("review_score").isNotNull())
    total = scored.agg(_rows()).scalar()
    return (
        scored.groupBy(sentiment_label(F.col("review_score")).alias("sentiment"))
        .agg(_rows().alias("count"))
        .withColumn("share_pct", round_to(safe_div(F.col("count") * 100, total), 1))
        .orderBy(F.desc("count"), "sentiment")
    )


def sentiment_vs_delay(fact: DataFrame) -> DataFrame:
    known = fact.filter(F.col("review_score").isNotNull() & F.col("delivery_delay_days").isNotNull())
    return known.groupBy(sentiment_label(F.col("review_score")).alias("sentiment")).agg(
        _mean("delivery_delay_days", 1).alias("avg_delay"),
        _mean("price").alias("avg_price"),
        _mean("freight_value").alias("avg_freight"),
    )


def category_sentiment(fact: DataFrame, n: int = 15) -> DataFrame:
    """The lowest-scored categories with their colour band."""
    score = F.col("avg_score")
    return (
        fact.filter(F.col("review_score").isNotNull() & F.col("category").isNotNull())
        .groupBy("category")
        .agg(
            _mean("review_score").alias("avg_score"),
            round_to(pct_of_rows(F.col("review_score") >= 4), 1).alias("positive_pct"),
            _rows().alias("orders"),
        )
        .orderBy("avg_score", "category")
        .limit(n)
        .withColumn("band", F.when(score < 3.5, "low").when(score < 4.2, "medium").otherwise("high"))
    )


def monthly_series(fact: DataFrame) -> DataFrame:
    month = F.trunc("order_date", "month")
    return fact.groupBy(month.alias("ds")).agg(_total("revenue").alias("y")).orderBy("ds")
