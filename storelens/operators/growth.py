"""Period-over-period change on an already aggregated, ordered result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.functions.numeric import round_to


def add_growth(df: DataFrame, value: str, order_by: list[str], name: str) -> DataFrame:
    """Percent change to the last known earlier value; null at the start and after a zero.

    ``df`` is a table of periods (months, years): its size does not grow with the data.
    """
    previous = F.last(value, ignorenulls=True).over(W.orderBy(*order_by).rowsBetween(W.unboundedPreceding, -1))
    current = F.last(value, ignorenulls=True).over(W.orderBy(*order_by).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn(name, round_to((current / F.nullif(previous, F.lit(0.0)) - 1) * 100, 2))
