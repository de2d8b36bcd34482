"""Feature tables for churn, late delivery, review sentiment and the revenue forecast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.functions.numeric import clip, exact_mean, mean_of, min_max_scale, round_to, safe_div
from storelens.functions.time import days_since
from storelens.operators.ranking import grouped_rank
from storelens.plans.customers import AS_OF, CHURN_DAYS
from storelens.plans.reports import sentiment_label
from storelens.session import materialize

# Model inputs in the order the models use them.
CHURN_FEATURES = [
    "frequency", "monetary", "avg_order_value", "avg_review_score", "avg_freight_pct", "avg_installments",
    "late_deliveries", "avg_delay_days", "unique_categories", "unique_products", "max_order_value", "min_order_value",
    "positive_reviews", "negative_reviews", "active_years", "active_months", "customer_lifetime_days",
    "avg_days_between_orders", "category_diversity", "revenue_per_order", "revenue_trend", "velocity_change",
    "days_since_second_last",
]
DELIVERY_FEATURES = [
    "price", "freight_value", "freight_ratio", "order_month", "order_quarter", "order_year", "payment_installments",
    "customer_state_enc", "seller_state_enc", "cross_state", "weight_g", "length_cm", "height_cm", "width_cm",
    "volume_cm3", "peak_season", "weekend_order",
]
SENTIMENT_FEATURES = [
    "price", "freight_value", "delivery_delay_days", "payment_installments", "is_delivered", "order_month",
    "order_quarter", "order_year", "is_late", "freight_ratio", "price_per_installment", "very_late", "early_delivery",
    "abs_delay_days", "late_and_expensive", "very_very_late",
]
REGRESSORS = ["n_sellers", "n_products", "n_orders", "month_num"]

# Last item rows first; an unknown date counts as the latest.
_RECENT_FIRST = ("order_date", "order_id", "order_item_id")


def _recent_first() -> list[Column]:
    return [F.desc_nulls_first("order_date"), F.asc("order_id"), F.asc("order_item_id")]


def _delivered(fact: DataFrame) -> DataFrame:
    return fact.filter(F.col("is_delivered") == 1)


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def churn_recent_orders(fact: DataFrame) -> DataFrame:
    """Every delivered item with its recency rank and the item count of its customer."""
    items = _delivered(fact).select("customer_id", "order_id", "order_item_id", "order_date", "revenue")
    ranked = grouped_rank(items, ["customer_id"], _recent_first(), "order_rank", "total_orders")
    return ranked.select("customer_id", "order_id", "order_item_id", "order_date", "revenue", "order_rank", "total_orders")


def _last_three(fact: DataFrame) -> DataFrame:
    """The three latest item rows per customer; each map task keeps at most three before the shuffle."""
    items = _delivered(fact).select("customer_id", *_RECENT_FIRST, "revenue")
    position = F.row_number().over(W.partitionBy("customer_id").orderBy(*_recent_first()))
    return items.withColumn("order_rank", position).filter(F.col("order_rank") <= 3)


def _pivot_last_three(fact: DataFrame) -> DataFrame:
    def date_at(k: int) -> Column:
        return F.max(F.when(F.col("order_rank") == k, F.col("order_date")))

    return _last_three(fact).groupBy("customer_id").agg(
        date_at(1).alias("last_order_date"),
        date_at(2).alias("second_last_order_date"),
        date_at(3).alias("third_last_order_date"),
        F.sum("revenue").alias("recent_sum"),
        F.count(F.lit(1)).alias("recent_count"),
    )


def churn_last_orders(fact: DataFrame) -> DataFrame:
    return _pivot_last_three(fact).select("customer_id", "last_order_date", "second_last_order_date", "third_last_order_date")


def churn_recent_revenue(fact: DataFrame) -> DataFrame:
    """Revenue and rows of the last three items, and of all older ones (total minus recent)."""
    totals = _delivered(fact).groupBy("customer_id").agg(F.sum("revenue").alias("all_sum"), F.count(F.lit(1)).alias("all_count"))
    return totals.join(_pivot_last_three(fact), "customer_id").select(
        "customer_id",
        round_to(F.col("recent_sum"), 2).alias("last_3_revenue"),
        round_to(F.col("all_sum") - F.col("recent_sum"), 2).alias("older_revenue"),
        F.col("recent_count").alias("last_3_count"),
        (F.col("all_count") - F.col("recent_count")).alias("older_count"),
    )


def _spend_totals(fact: DataFrame, as_of: str) -> DataFrame:
    """Additive measures per customer. Months are counted as bits."""
    delay, score = F.col("delivery_delay_days"), F.col("review_score")
    return (
        _delivered(fact)
        .groupBy("customer_id")
        .agg(
            F.sum("revenue").alias("spent"),
            round_to(mean_of(F.col("price")), 2).alias("avg_order_value"),
            round_to(mean_of(score), 2).alias("avg_review_score"),
            round_to(exact_mean(safe_div(F.col("freight_value"), F.col("revenue"))), 4).alias("avg_freight_pct"),
            round_to(mean_of(F.col("payment_installments")), 2).alias("avg_installments"),
            F.sum(_flag(delay > 0)).alias("late_deliveries"),
            round_to(mean_of(delay), 1).alias("avg_delay_days"),
            round_to(F.max("price"), 2).alias("max_order_value"),
            round_to(F.min("price"), 2).alias("min_order_value"),
            F.sum(_flag(score >= 4)).alias("positive_reviews"),
            F.sum(_flag(score <= 2)).alias("negative_reviews"),
            F.bit_count(F.bit_or(F.expr("shiftleft(1, order_month)"))).alias("active_months"),
            F.datediff(F.max("order_date"), F.min("order_date")).alias("customer_lifetime_days"),
            days_since(as_of, F.max("order_date")).alias("recency_days"),
        )
    )


def _variety(fact: DataFrame) -> DataFrame:
    """Distinct orders, products, categories and years per customer, over just those columns.

    Spark repeats each row once per distinct column, so the measures are kept out of this
    aggregate; the values are spread over (customer, value) before they are counted.
    """
    return _delivered(fact).groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("frequency"),
        F.count_distinct("category").alias("unique_categories"),
        F.count_distinct("product_id").alias("unique_products"),
        F.count_distinct("order_year").alias("active_years"),
    )


def churn_features(fact: DataFrame, as_of: str = AS_OF) -> DataFrame:
    """The churn inputs plus ``recency_days``, one row per customer with a delivered item.

    Totals, distinct counts and the three latest rows are separate aggregates, all
    hash-partitioned on the customer, so that joining them moves nothing.
    """
    orders, lifetime = F.col("frequency"), F.col("customer_lifetime_days")
    second, third = F.col("second_last_order_date"), F.col("third_last_order_date")
    older = F.col("spent") - F.col("recent_sum")
    usual_gap = safe_div(lifetime, orders - 1)
    recent_gap = F.datediff("last_order_date", second)
    joined = _spend_totals(fact, as_of).join(_variety(fact), "customer_id").join(_pivot_last_three(fact), "customer_id")
    return joined.select(
        "customer_id",
        "frequency",
        round_to(F.col("spent"), 2).alias("monetary"),
        "avg_order_value", "avg_review_score", "avg_freight_pct", "avg_installments", "late_deliveries", "avg_delay_days",
        "unique_categories", "unique_products", "max_order_value", "min_order_value", "positive_reviews",
        "negative_reviews", "active_years", "active_months", "customer_lifetime_days",
        F.when(orders > 1, F.expr("customer_lifetime_days div nullif(frequency - 1, 0)")).otherwise(0).alias("avg_days_between_orders"),
        F.col("unique_categories").alias("category_diversity"),
        round_to(safe_div(F.col("spent"), orders), 2).alias("revenue_per_order"),
        F.when(older > 0, round_to(safe_div(F.col("recent_sum"), older), 4))
        .when(F.col("recent_sum") > 0, 2.0).otherwise(1.0).alias("revenue_trend"),
        F.when(second.isNotNull(), days_since(as_of, second)).otherwise(999).alias("days_since_second_last"),
        F.when(second.isNotNull() & third.isNotNull(), round_to(safe_div(recent_gap, usual_gap), 4))
        .otherwise(1.0).alias("velocity_change"),
        "recency_days",
    )


def churn_labels_weights(features: DataFrame, churn_days: int = CHURN_DAYS) -> DataFrame:
    """Add the churn flag and value-based weight, limit the trend features, drop recency.

    The weight needs the range of all spending, so the customer table is computed once and read twice.
    """
    features = materialize(features)
    churned = F.col("recency_days") > churn_days
    urgency = clip(1 + (F.col("recency_days") - churn_days) / 365, 1.0, 3.0)
    span = features.agg(F.struct(F.min("monetary").alias("low"), F.max("monetary").alias("high"))).scalar()
    spend = min_max_scale(F.col("monetary"), span["low"], span["high"])
    return (
        features.withColumn("churned", F.coalesce(churned.cast("int"), F.lit(0)))
        .withColumn("sample_weight", F.when(churned, 1.0 + spend * urgency).otherwise(1.0))
        .withColumn("revenue_trend", clip(F.col("revenue_trend"), 0.0, 10.0))
        .withColumn("velocity_change", clip(F.col("velocity_change"), 0.0, 10.0))
        .drop("recency_days")
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows and share of the positive class."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).alias("positives"),
        round_to(safe_div(F.sum(label) * 100, F.count(F.lit(1))), 1).alias("positive_pct"),
    )


def delivery_features(fact: DataFrame, products: DataFrame, sellers: DataFrame) -> DataFrame:
    """Item-grain inputs and the late flag, delivered items with a known delay only."""
    items = (
        _delivered(fact)
        .filter(F.col("delivery_delay_days").isNotNull())
        .select("order_id", "order_item_id", "product_id", "seller_id", "price", "freight_value", "order_date", "order_month",
                "order_quarter", "order_year", "payment_installments", F.col("state").alias("customer_state"), "delivery_delay_days")
    )
    sizes = [F.nullif(F.col(c), F.lit(0.0)) for c in ("length_cm", "height_cm", "width_cm")]
    return (
        items.join(products.select("product_id", "weight_g", "length_cm", "height_cm", "width_cm"), "product_id")
        .join(sellers.select("seller_id", "seller_state"), "seller_id")
        .select(
            "order_id", "order_item_id",
            F.col("price").cast("double").alias("price"), F.col("freight_value").cast("double").alias("freight_value"),
            "order_month", "order_quarter", "order_year", "payment_installments", "customer_state", "seller_state",
            "weight_g", "length_cm", "height_cm", "width_cm",
            _flag(F.col("seller_state") != F.col("customer_state")).alias("cross_state"),
            round_to(safe_div(F.col("freight_value"), F.col("price") + F.col("freight_value")), 4).alias("freight_ratio"),
            round_to(sizes[0] * sizes[1] * sizes[2], 2).alias("volume_cm3"),
            _flag(F.col("order_month").isin(11, 12)).alias("peak_season"),
            _flag(F.dayofweek("order_date").isin(1, 7)).alias("weekend_order"),
            _flag(F.col("delivery_delay_days") > 0).alias("is_late"),
        )
    )


def sentiment_features(fact: DataFrame) -> DataFrame:
    """Item-grain inputs and the two-class label; a pure projection."""
    delay, price = F.col("delivery_delay_days"), F.col("price")
    return fact.filter(F.col("review_score").isNotNull()).select(
        "order_id", "order_item_id",
        price.cast("double").alias("price"), F.col("freight_value").cast("double").alias("freight_value"),
        "delivery_delay_days", "payment_installments", "is_delivered", "order_month", "order_quarter", "order_year", "review_score",
        _flag(delay > 0).alias("is_late"),
        round_to(safe_div(F.col("freight_value"), price + F.col("freight_value")), 4).alias("freight_ratio"),
        round_to(safe_div(price, F.col("payment_installments")), 2).alias("price_per_installment"),
        _flag(delay > 7).alias("very_late"),
        _flag(delay <= 0).alias("early_delivery"),
        F.abs(delay).cast("double").alias("abs_delay_days"),
        _flag((delay > 0) & (price > 200)).alias("late_and_expensive"),
        _flag(delay > 14).alias("very_very_late"),
        sentiment_label(F.col("review_score")).alias("sentiment"),
    )


def forecast_monthly(fact: DataFrame, series_key: str | None = None) -> DataFrame:
    """Monthly revenue with scaled regressors, for the whole business or per value of ``series_key``.

    Everything after the first aggregate works on one row per series and month.
    """
    key = F.col(series_key).cast("string") if series_key else F.lit("all")
    months = (
        fact.filter(key.isNotNull())
        .groupBy(key.alias("series_key"), F.trunc("order_date", "month").alias("ds"))
        .agg(
            round_to(F.sum("revenue"), 2).alias("y"),
            F.count_distinct("seller_id").alias("n_sellers"),
            F.count_distinct("product_id").alias("n_products"),
            F.count_distinct("order_id").alias("n_orders"),
        )
    )
    series = W.partitionBy("series_key")
    numbered = months.withColumn("month_num", F.row_number().over(series.orderBy("ds")).cast("bigint"))
    return numbered.withColumns({f"{c}_norm": min_max_scale(F.col(c), F.min(c).over(series), F.max(c).over(series)) for c in REGRESSORS})


def project_regressors(monthly: DataFrame, periods: int = 6) -> DataFrame:
    """Straight line through the last six months of each regressor, extended and scaled like the history.

    One aggregate per series: the line only looks at its last six rows, the range at all of them.
    """
    latest = W.partitionBy("series_key").orderBy(F.desc("ds"))
    counted = [c for c in REGRESSORS if c != "month_num"]
    x = -F.col("_back").cast("double")

    def recent(c: str) -> Column:
        return F.when(F.col("_back") <= 6, F.col(c).cast("double"))

    lines = (
        monthly.withColumn("_back", F.row_number().over(latest))
        .groupBy("series_key")
        .agg(
            *[F.regr_slope(recent(c), x).alias(f"_s_{c}") for c in counted],
            *[F.regr_intercept(recent(c), x).alias(f"_i_{c}") for c in counted],
            *[f(c).alias(f"_{n}_{c}") for c in REGRESSORS for n, f in (("lo", F.min), ("hi", F.max))],
            F.max("ds").alias("_last"),
        )
    )
    future = lines.select("*", F.explode(F.sequence(F.lit(1), F.lit(periods))).alias("months_ahead"))
    step = F.col("months_ahead")
    values = {c: F.greatest(F.lit(0.0), F.coalesce(F.col(f"_i_{c}") + F.col(f"_s_{c}") * (step - 1), F.col(f"_hi_{c}").cast("double"))) for c in counted}
    values["month_num"] = (F.col("_hi_month_num") + step).cast("double")
    return future.withColumns(values).select(
        "series_key",
        "months_ahead",
        F.add_months("_last", step).alias("ds"),
        *REGRESSORS,
        *[clip(min_max_scale(F.col(c), F.col(f"_lo_{c}"), F.col(f"_hi_{c}")), 0.0, 2.0).alias(f"{c}_norm") for c in REGRESSORS],
    )


def future_frame(monthly: DataFrame, periods: int = 6) -> DataFrame:
    """History and the next months with their regressors, gaps filled from the neighbours."""
    monthly = materialize(monthly)
    names = [f"{c}_norm" for c in ("n_sellers", "n_products", "month_num")]
    history = monthly.select("series_key", "ds", "y", *names)
    ahead = project_regressors(monthly, periods).select("series_key", "ds", F.lit(None).cast("double").alias("y"), *names)
    forward = W.partitionBy("series_key").orderBy("ds").rowsBetween(W.unboundedPreceding, 0)
    backward = W.partitionBy("series_key").orderBy("ds").rowsBetween(0, W.unboundedFollowing)
    filled = history.unionByName(ahead)
    filled = filled.withColumns({c: F.last(c, ignorenulls=True).over(forward) for c in names})
    return filled.withColumns({c: F.first(c, ignorenulls=True).over(backward) for c in names})
