"""Keep one row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

READ_ORDER = "_order"


def row_order(df: DataFrame, keys: list[str]) -> list[str]:
    """Columns that define 'first': the scan's read order if present, else all non-key columns."""
    return [READ_ORDER] if READ_ORDER in df.columns else [c for c in df.columns if c not in keys]


def keep_first(df: DataFrame, keys: list[str], order_by: list[str] | None = None) -> DataFrame:
    """First row per key under ``order_by``.

    A minimum over a struct is combined before the shuffle, so a key with very many
    copies reaches its reducer as one row per map task.
    """
    order = order_by or row_order(df, keys)
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.min(F.struct(*order, *rest)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, "_best.*").select(*df.columns)
