"""Column summaries, histograms and correlations of any numeric table."""

from __future__ import annotations

from itertools import product

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storelens.operators.ranking import exact_quantiles
from storelens.session import materialize, stored

QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def to_long(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value) rows."""
    return df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")


def describe(df: DataFrame, columns: list[str], digits: int = 2) -> DataFrame:
    """count, mean, sample deviation, min, quartiles, max per column; the quartiles are exact."""
    long = to_long(stored(df.select(*columns)), columns)  # read twice
    moments = long.groupBy("column").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    both = moments.join(exact_quantiles(long, QUARTILES), "column", "left")
    measures = ["mean", "std", "min", "p25", "p50", "p75", "max"]
    return both.select("column", "count", *[F.round(c, digits).alias(c) for c in measures])


#: Classes whose ranges are sent to every executor; with more, rows meet them by a shuffle.
MOST_SENT = 100_000


def histogram(df: DataFrame, column: str, bins: int, upper: float | None = None, by: str | None = None) -> DataFrame:
    """Equal-width bins, empty ones included; values above ``upper`` count as ``upper``.

    A constant column gets a range of width one around its value.

    With ``by``, every class has its own range, as when each class is plotted on its own.
    """
    value = F.col(column).cast("double")
    if upper is not None:
        value = F.when(value.isNotNull(), F.least(value, F.lit(float(upper))))
    keys = [by] if by else []
    values = df.select(*keys, value.alias("value")).filter(F.col("value").isNotNull())
    pad = F.when(F.min("value") == F.max("value"), 0.5).otherwise(0.0)
    span = values.groupBy(*keys).agg((F.min("value") - pad).alias("low"), (F.max("value") + pad).alias("high"))
    if by:
        span = materialize(span)  # one row per class, used for placing and for the grid
        ranges = span.withColumnRenamed(by, "_by")
        ranges = F.broadcast(ranges) if span.count() <= MOST_SENT else ranges  # counting then combines before the only shuffle
        placed = values.join(ranges, F.col(by).eqNullSafe(F.col("_by"))).drop("_by")
    else:
        one = span.select(F.struct("low", "high")).scalar()
        placed = values.withColumns({"low": one["low"], "high": one["high"]})
    position = F.floor((F.col("value") - F.col("low")) * bins / (F.col("high") - F.col("low"))) + 1
    filled = placed.groupBy(*keys, F.least(position, F.lit(bins)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    grid = span.select(*keys, "low", "high", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(bins).cast("bigint"))).alias("bin"))
    step = (F.col("high") - F.col("low")) / bins
    return (
        grid.join(filled, [*keys, "bin"], "left")
        .select(
            *keys,
            "bin",
            F.round(F.col("low") + step * (F.col("bin") - 1), 6).alias("bin_start"),
            F.round(F.col("low") + step * F.col("bin"), 6).alias("bin_end"),
            F.coalesce("n", F.lit(0)).alias("count"),
        )
    )


def correlation_matrix(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Pearson r of every pair, from one aggregation pass over the table."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    numbers = df.select([F.col(c).cast("double").alias(c) for c in columns])
    wide = numbers.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    entries = [
        F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.round(F.col(f"`{a}|{b}`" if (a, b) in pairs else f"`{b}|{a}`"), digits).alias("r"))
        for a, b in product(columns, columns)
    ]
    return wide.select(F.inline(F.array(*entries)))
