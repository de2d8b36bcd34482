"""Shape of the physical plans, and independence from the number of partitions."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from compare import table
from storelens.plans import features, prep, reports
from storelens.registry import AS_OF


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(stored):
    text = plan(reports.delivery_performance(stored.fact_orders))
    assert "EqualTo(is_delivered,1)" in text and "IsNotNull(delivery_delay_days)" in text
    assert re.search(r"ReadSchema: struct<is_delivered:int,delivery_delay_days:int>", text)


def test_top_k_is_not_a_full_sort(stored):
    assert "TakeOrderedAndProject" in plan(reports.top_products(stored.fact_orders, stored.dim_products))


def test_latest_rows_are_limited_before_the_shuffle(stored):
    text = plan(features.churn_last_orders(stored.fact_orders))
    assert re.search(r"WindowGroupLimit .*Partial", text)
    assert len(re.findall(r"Exchange hashpartitioning\(customer_id", text)) == 1


def test_split_moves_no_rows(stored):
    rows = features.sentiment_features(stored.fact_orders).withColumn("label", F.col("is_late"))
    text = plan(prep.stratified_split(rows, "label", ["order_id", "order_item_id"]))
    main = text.split("Subquery")[0]
    assert "Exchange" not in main


@pytest.mark.parametrize("key", ["category_performance", "state_performance", "rfm_segmentation", "churn_features", "late_by_state",
                                 "describe_features", "roc_auc", "stratified_split", "future_frame"])
def test_same_result_for_any_partitioning(spark, stored, sf, key):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "16"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            df = contract.queries()[key](spark, sf)
            results.append(table(df.columns, df.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1]


def test_no_plan_needs_a_global_window_over_rows(stored):
    text = plan(features.churn_features(stored.fact_orders, AS_OF))
    assert "Exchange SinglePartition" not in text


def test_reports_repeat_no_fact_row_and_add_up_before_joins(spark, stored):
    """No Expand over fact rows, and customers are joined to one row each, not to fact rows."""
    from storelens.plans import reports

    for build in (reports.kpi_summary, reports.eda_kpis, reports.monthly_revenue, reports.yoy_comparison, reports.category_performance):
        assert "Expand" not in build(stored.fact_orders)._jdf.queryExecution().executedPlan().toString()
    for build in (reports.state_performance, reports.top_states, reports.late_by_state):
        plan = build(stored.fact_orders, stored.dim_customers)._jdf.queryExecution().optimizedPlan().toString()
        assert "Expand" not in plan
        joined = plan[plan.index("Join Inner") :]
        assert joined.index("Aggregate [customer_id") < joined.index("Relation")

