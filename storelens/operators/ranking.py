"""Exact global ranks, running totals and quantiles without a single-partition window.

Rows are range-partitioned on the full sort key and stored once (as Parquet where they are
wide, so that later steps read the columns they need), so partition numbers are fixed; only one row per partition takes part in the prefix sum, and that small table
(bounded by the number of shuffle partitions) is what gets broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.operators.joins import skew_join
from storelens.session import materialize, stored

# monotonically_increasing_id: partition number above bit 33, row number below.
_ROW_BITS = 33


def _before(slots: DataFrame, names: Sequence[str]) -> DataFrame:
    earlier = W.orderBy("_slot").rowsBetween(W.unboundedPreceding, -1)
    return slots.select(
        "_slot",
        *[F.coalesce(F.sum(n).over(earlier), F.lit(0).cast(slots.schema[n].dataType)).alias(f"_before_{n}") for n in names],
    )


def distributed_rank(df: DataFrame, order_by: Sequence[Column | str], name: str = "rank") -> DataFrame:
    """Add 1..n in the given order. Ties must be broken by ``order_by`` itself."""
    ordered = stored(df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).withColumn("_pos", F.monotonically_increasing_id()), "ranked")
    slotted = ordered.withColumn("_slot", F.shiftright("_pos", _ROW_BITS))
    sizes = slotted.groupBy("_slot").agg(F.count(F.lit(1)).alias("n"))
    in_slot = F.col("_pos").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        slotted.join(F.broadcast(_before(sizes, ["n"])), "_slot")
        .withColumn(name, F.col("_before_n") + in_slot + 1)
        .select(*df.columns, name)
    )


def grouped_rank(df: DataFrame, group: Sequence[str], order_by: Sequence[Column | str], name: str = "rank",
                 size: str | None = None) -> DataFrame:
    """Rank 1..n inside each group (and optionally the group size); a group may span many partitions."""
    ranked = distributed_rank(df, [*group, *order_by], "_global")
    starts = ranked.groupBy(*group).agg(F.min("_global").alias("_start"), F.count(F.lit(1)).alias("_size"))
    sizes = starts.select(*group, F.col("_size").alias("n"))
    out = skew_join(ranked, starts, list(group), "inner", sizes).withColumn(name, F.col("_global") - F.col("_start") + 1)
    if size:
        out = out.withColumn(size, F.col("_size"))
    return out.select(*df.columns, name, *([size] if size else []))


def running_totals(df: DataFrame, order_by: Sequence[Column | str], sums: Sequence[str]) -> DataFrame:
    """Add ``cum_<c>``, the inclusive running total over the whole table, for each column in ``sums``.

    Rows must be unique on ``order_by`` (aggregate first).
    """
    slotted = materialize(df.repartitionByRange(*order_by).withColumn("_slot", F.spark_partition_id()))
    totals = slotted.groupBy("_slot").agg(*[F.sum(c).alias(c) for c in sums])
    inside = W.partitionBy("_slot").orderBy(*order_by).rowsBetween(W.unboundedPreceding, W.currentRow)
    out = slotted.join(F.broadcast(_before(totals, sums)), "_slot")
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.col(f"_before_{c}") + F.sum(c).over(inside))
    return out.select(*df.columns, *[f"cum_{c}" for c in sums])


def exact_quantiles(long: DataFrame, probs: dict[str, float], column: str = "column", value: str = "value") -> DataFrame:
    """Linear-interpolation quantiles of every ``column`` of a (column, value) table.

    Equal values are counted before the shuffle; the sorted distinct values stay distributed.
    ``column`` holds column names, so the sizes that are broadcast are one row per unpivoted column.
    """
    counts = long.filter(F.col(value).isNotNull()).groupBy(column, value).agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(counts, [column, value], ["n"])
    sizes = cum.groupBy(column).agg(F.sum("n").alias("_size"), F.min(F.col("cum_n") - F.col("n")).alias("_base"))
    first = F.col("cum_n") - F.col("n") - F.col("_base")
    last = F.col("cum_n") - F.col("_base") - 1

    def at(position: Column) -> Column:
        return F.max(F.when((first <= position) & (position <= last), F.col(value)))

    found = []
    for name, p in probs.items():
        h = (F.col("_size") - 1) * F.lit(p)
        low = F.floor(h)
        found += [
            at(low).alias(f"_lo_{name}"),
            at(F.least(low + 1, F.col("_size") - 1)).alias(f"_hi_{name}"),
            F.max(h - low).alias(f"_w_{name}"),
        ]
    picked = cum.join(F.broadcast(sizes), column).groupBy(column).agg(*found)
    return picked.select(
        column,
        *[
            (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
            for n in probs
        ],
    )


def rank_quantile(rank: Column, size: Column, bins: int = 5) -> Column:
    """Equal-count bin 1..bins of a first-come rank (edges by linear interpolation, right-closed)."""
    position = F.ceil((rank - 1) * bins / F.nullif(size - 1, F.lit(0)))
    return F.greatest(F.lit(1), position).cast("int")


def value_quantile_edges(df: DataFrame, col: str, bins: int = 5, strict: bool = True) -> DataFrame:
    """One row with the inner bin edges of a small-domain integer column, as ``edges``.

    Coinciding edges (the outer ones included) raise at run time in strict mode, else are merged.
    """
    probs = F.array(*[F.lit(i / bins) for i in range(bins + 1)])
    edges = df.agg(F.percentile(col, probs).alias("all_edges"))
    inner = F.slice("all_edges", 2, bins - 1)
    if not strict:
        return edges.select(F.array_distinct(inner).alias("edges"))
    distinct = F.size(F.array_distinct("all_edges")) == bins + 1
    return edges.select(F.when(distinct, inner).otherwise(F.raise_error(F.lit("bin edges must be unique"))).alias("edges"))


def value_quantile(value: Column, edges: Column, bins: int = 5) -> Column:
    """Right-closed bin 1..bins of a value given the inner edges (missing edges are merged bins)."""
    position = F.lit(1)
    for i in range(bins - 1):
        position = position + F.when(F.get(edges, F.lit(i)) < value, 1).otherwise(0)
    return position
