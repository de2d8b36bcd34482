"""Column expressions and table operators on tiny tables with known answers."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storelens.functions.numeric import clip, finite_or_null, round_to, safe_div
from storelens.functions.text import risk_band, title_case
from storelens.functions.time import coerce_timestamp, floor_days
from storelens.operators.growth import add_growth
from storelens.operators.joins import skew_join
from storelens.operators.keep_first import keep_first
from storelens.operators.ranking import (
    distributed_rank, exact_quantiles, grouped_rank, rank_quantile, running_totals, value_quantile, value_quantile_edges,
)


def column(df, name):
    return [r[name] for r in df.collect()]


def test_floor_days_rounds_down(spark):
    due = dt.datetime(2018, 10, 20, 20)
    hours = [-14, 0, 14, 24, 36, None]
    rows = [(i, None if h is None else due + dt.timedelta(hours=h), due) for i, h in enumerate(hours)]
    df = spark.createDataFrame(rows, "i int, got timestamp_ntz, due timestamp_ntz")
    assert column(df.select("i", floor_days(F.col("got"), F.col("due")).alias("d")).orderBy("i"), "d") == [-1, 0, 0, 1, 1, None]


def test_bad_timestamps_become_null(spark):
    df = spark.createDataFrame([(0, "2018-13-40"), (1, ""), (2, None), (3, "2018-11-04 00:10:00")], "i int, t string")
    got = column(df.select("i", coerce_timestamp("t").alias("t")).orderBy("i"), "t")
    assert got == [None, None, None, dt.datetime(2018, 11, 4, 0, 10)]


def test_title_case_follows_non_letters(spark):
    texts = ["o'neil home-decor 2nd", None, "cama mesa banho", "", "ação 3d x"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = column(df.select("i", title_case(F.col("t")).alias("t")).orderBy("i"), "t")
    assert got == [None if t is None else t.title() for t in texts]


def test_rounding_and_guards(spark):
    df = spark.createDataFrame([(1.005, 0.0), (2.675, 2.0), (-0.125, 4.0)], "x double, y double")
    assert column(df.select(round_to(F.col("x"), 2).alias("r")), "r") == [1.01, 2.68, -0.13]
    assert column(df.select(safe_div(F.col("x"), F.col("y")).alias("r")), "r")[0] is None
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (50.0,)], "x double")
    assert column(odd.select(finite_or_null(F.col("x")).alias("r")), "r") == [None, None, None, 50.0]
    assert column(odd.filter("x is null or x = 50").select(clip(F.col("x"), 0.0, 10.0).alias("r")), "r") == [None, 10.0]
    assert column(odd.filter("x = 50").select(risk_band(F.lit(0.7)).alias("r")), "r") == ["High"]


def test_growth_matches_pandas(spark):
    values = [100.0, 150.0, None, 120.0, 0.0, 80.0]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v double")
    got = column(add_growth(df, "v", ["i"], "g").orderBy("i"), "g")
    want = pd.Series(values).ffill().pct_change().mul(100).round(2).replace([np.inf], np.nan)
    assert got == [None if pd.isna(w) else w for w in want]


def test_keep_first_uses_read_order(spark):
    df = spark.createDataFrame([("a", 3, 2), ("a", 9, 1), ("b", 5, 7)], "k string, v int, _order int")
    assert sorted(map(tuple, keep_first(df, ["k"]).select("k", "v").collect())) == [("a", 9), ("b", 5)]
    assert sorted(map(tuple, keep_first(df.drop("_order"), ["k"]).collect())) == [("a", 3), ("b", 5)]


@pytest.mark.parametrize("n", [5, 7, 12, 101])
def test_rank_bins_match_pandas_on_ties(spark, n):
    df = spark.range(n).withColumn("v", F.lit(1))
    ranked = distributed_rank(df, ["v", "id"], "r")
    got = {r["id"]: (r["r"], r["q"]) for r in ranked.select("id", "r", rank_quantile(F.col("r"), F.lit(n)).alias("q")).collect()}
    want = pd.qcut(pd.Series([1] * n).rank(method="first"), 5, labels=[1, 2, 3, 4, 5]).astype(int)
    assert got == {i: (i + 1, want[i]) for i in range(n)}


def test_value_bins_match_pandas(spark):
    values = [3, 8, 8, 15, 22, 22, 40, 41, 41, 90, 91, 120]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v int")
    edges = value_quantile_edges(df, "v").scalar()
    got = column(df.withColumn("q", value_quantile(F.col("v"), edges)).orderBy("i"), "q")
    assert got == list(pd.qcut(pd.Series(values), 5, labels=[1, 2, 3, 4, 5]).astype(int))


def test_coinciding_edges(spark):
    df = spark.createDataFrame([(1,), (1,), (1,), (1,), (2,)], "v int")
    with pytest.raises(Exception, match="bin edges must be unique"):
        value_quantile_edges(df, "v").collect()
    assert value_quantile_edges(df, "v", strict=False).first()["edges"] == pytest.approx([1.0, 1.2])


@pytest.fixture
def many_partitions(spark):
    """Stop the coalescing of small partitions, so that tiny tables really are spread out."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_rank_and_totals_on_one_hot_key(spark, many_partitions):
    """A third of all rows share one group; ranks stay exact and the group spans partitions."""
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("g"))
    spread = df.repartitionByRange("g", "id").filter("g = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert spread > 1
    ranked = grouped_rank(df, ["g"], [F.desc("id")], "r", "n").filter("g = 'hot'").orderBy("r").collect()
    assert [r["r"] for r in ranked] == list(range(1, 1001))
    assert [r["id"] for r in ranked] == list(range(2997, -1, -3)) and ranked[0]["n"] == 1000
    totals = running_totals(df.select("id"), ["id"], ["id"]).orderBy("id").collect()
    assert [r["cum_id"] for r in totals] == list(np.cumsum(range(3000)))


def test_exact_quantiles_match_pandas(spark):
    rng = np.random.default_rng(3)
    a, b = rng.normal(size=501), np.repeat([1.0, 2.0, 9.0], [300, 5, 61])
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("b", None)]
    got = {r["column"]: r for r in exact_quantiles(spark.createDataFrame(rows, "column string, value double"), {"p25": 0.25, "p50": 0.5, "p99": 0.99}).collect()}
    for name, values in (("a", a), ("b", b)):
        want = pd.Series(values).quantile([0.25, 0.5, 0.99])
        assert [got[name][p] for p in ("p25", "p50", "p99")] == pytest.approx(list(want))


def test_hot_keys_are_split_and_results_whole(spark, many_partitions):
    """One key holds a third of the rows; with a small limit it spreads over several tasks."""
    left = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id") % 50).alias("k"))
    right = spark.range(-1, 45).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    plain = left.join(right, "k", "left").select("id", "k", "v")
    split = skew_join(left, right, ["k"], rows_per_task=100).select("id", "k", "v")
    assert split.count() == 3000 and split.exceptAll(plain).isEmpty()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spread = skew_join(left, right, ["k"], rows_per_task=100).filter("k = -1").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert spread > 1
    assert skew_join(left, right, ["k"], "inner").count() == plain.filter("v is not null").count()
