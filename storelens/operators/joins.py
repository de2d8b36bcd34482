"""Joins that split keys too large for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 2_000_000


def hot_keys(counts: DataFrame, count: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every key with more rows than a task should take, and in how many ``_parts`` it is dealt. It stays a table:
    of n rows at most n / rows_per_task keys are hot, and its size decides how it is joined."""
    return counts.filter(F.col(count) > rows_per_task).withColumn("_parts", F.ceil(F.col(count) / F.lit(rows_per_task))).drop(count)


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", counts: DataFrame | None = None,
              rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Join many ``left`` rows per key to the one ``right`` row of that key.

    Adaptive execution splits a skewed join only where both inputs come straight from a
    shuffle. This one does not depend on that: keys that are too large (counted first, on
    the key columns alone, unless ``counts`` with (keys, n) is at hand) are spread over
    several salts, and only their right rows are repeated. Without such keys it is the
    plain join.
    """
    if counts is None:
        counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    parts = hot_keys(counts, "n", rows_per_task)
    if parts.isEmpty():
        return left.join(right, keys, how)
    share = F.coalesce("_parts", F.lit(1).cast("bigint"))
    salted = left.join(parts, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(*left.columns), share)).drop("_parts")
    repeated = right.join(parts, keys, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), share - 1))).drop("_parts")
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
