"""Recency, frequency, monetary value: base table, scores, segments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.functions.numeric import exact_mean, mean_of, round_to
from storelens.functions.time import days_since
from storelens.operators.ranking import distributed_rank, rank_quantile, value_quantile, value_quantile_edges

AS_OF = "2018-09-01"
CHURN_DAYS = 180
# Lowest total score and label, best first.
SEGMENTS = ((13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (5, "At Risk"), (0, "Lost"))
SHORT_SEGMENTS = ((13, "Champions"), (10, "Loyal"), (7, "Potential"), (5, "At Risk"), (0, "Lost"))


def rfm_customers(fact: DataFrame, customers: DataFrame, as_of: str = AS_OF, customer_col: str = "customer_id") -> DataFrame:
    """Aggregated per customer before the join that keeps only known customers."""
    per_customer = (
        fact.filter(F.col("is_delivered") == 1)
        .groupBy("customer_id")
        .agg(
            F.max("order_date").alias("last_date"),
            F.count_distinct("order_id").alias("frequency"),
            F.sum("revenue").alias("spent"),
        )
    )
    known = per_customer.join(customers.select("customer_id", "customer_unique_id"), "customer_id")
    if customer_col == "customer_unique_id":
        known = known.groupBy("customer_unique_id").agg(
            F.max("last_date").alias("last_date"), F.sum("frequency").alias("frequency"), F.sum("spent").alias("spent")
        )
    ids = ["customer_id", "customer_unique_id"] if customer_col == "customer_id" else [customer_col]
    return known.select(
        *ids,
        days_since(as_of, F.col("last_date")).alias("recency_days"),
        "frequency",
        round_to(F.col("spent"), 2).alias("monetary"),
    )


def rfm_scores(base: DataFrame, key: str = "customer_id", strict: bool = True) -> DataFrame:
    """Quintile scores 1..5: recency by value (recent is 5), frequency and money by first-come rank.

    Equal values are ranked by the customer key.
    """
    ranked = distributed_rank(base, ["frequency", key], "_f_rank")
    ranked = distributed_rank(ranked, ["monetary", key], "_m_rank")
    size = ranked.agg(F.count(F.lit(1))).scalar()
    edges = value_quantile_edges(ranked, "recency_days", 5, strict).scalar()
    return (
        ranked.withColumn("r_score", 6 - value_quantile(F.col("recency_days"), edges))
        .withColumn("f_score", rank_quantile(F.col("_f_rank"), size))
        .withColumn("m_score", rank_quantile(F.col("_m_rank"), size))
        .withColumn("rfm", F.col("r_score") + F.col("f_score") + F.col("m_score"))
        .drop("_f_rank", "_m_rank")
    )


def with_segment(scores: DataFrame, segments=SEGMENTS) -> DataFrame:
    label = F.lit(segments[-1][1])
    for lowest, name in reversed(segments[:-1]):
        label = F.when(F.col("rfm") >= lowest, name).otherwise(label)
    return scores.withColumn("segment", label)


def rfm_segmentation(scores: DataFrame) -> DataFrame:
    return (
        with_segment(scores)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            round_to(exact_mean(F.col("monetary")), 2).alias("avg_monetary"),
            round_to(mean_of(F.col("frequency")), 2).alias("avg_frequency"),
            round_to(mean_of(F.col("recency_days")), 2).alias("avg_recency"),
        )
        .orderBy("segment")
    )


def rfm_segment_summary(scores: DataFrame) -> DataFrame:
    """Short labels, biggest spenders first."""
    return (
        with_segment(scores, SHORT_SEGMENTS)
        .groupBy("segment")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            round_to(exact_mean(F.col("monetary")), 2).alias("avg_spend"),
            round_to(mean_of(F.col("recency_days")), 2).alias("avg_recency"),
        )
        .orderBy(F.desc("avg_spend"), "segment")
    )


def rfm_base_features(fact: DataFrame, as_of: str = AS_OF, churn_days: int = CHURN_DAYS) -> DataFrame:
    """Customer features of delivered rows, without the customer dimension, plus the churn flag."""
    delivered = fact.filter(F.col("is_delivered") == 1)
    totals = delivered.groupBy("customer_id").agg(
        days_since(as_of, F.max("order_date")).alias("recency_days"),
        round_to(F.sum("revenue"), 2).alias("monetary"),
        round_to(mean_of(F.col("review_score")), 2).alias("avg_review_score"),
        F.sum(F.when(F.col("delivery_delay_days") > 0, 1).otherwise(0)).alias("late_deliveries"),
        F.datediff(F.max("order_date"), F.min("order_date")).alias("customer_lifetime_days"),
    )
    # distinct counts repeat rows per counted column, so they run apart from the measures
    variety = delivered.groupBy("customer_id").agg(
        F.count_distinct("order_id").alias("frequency"), F.count_distinct("category").alias("unique_categories")
    )
    return totals.join(variety, "customer_id").select(
        "customer_id", "recency_days", "frequency", "monetary", "avg_review_score", "late_deliveries", "unique_categories",
        "customer_lifetime_days", (F.col("recency_days") > churn_days).cast("int").alias("churned"),
    )
