"""Splitting, scaling, encoding and weighting of model inputs."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.operators.ranking import distributed_rank

# Hex digits of the hash that are counted at a time, and how often: 65,536 cells per class, then as many inside the cell
# with the cut. The rows left to sort are one in four thousand million.
_DIGITS = 4
_LEVELS = 2


def row_hash(keys: list[str], seed: int) -> Column:
    """Repeatable pseudo-random order: md5 of the row key and the seed."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))


def _class_map(df: DataFrame, label: str, value: str) -> Column:
    """{class: value} of a one-row-per-class table, as a scalar."""
    return df.agg(F.map_from_entries(F.collect_list(F.struct(label, value)))).scalar()


def _cut_cell(cells: DataFrame, label: str, wanted: Column) -> DataFrame:
    """(label, cut): per class the cell of (label, _cell, n) in which the row number ``wanted`` lies, and its number inside that cell."""
    whole = W.partitionBy(label)
    summed = cells.withColumns({"cum": F.sum("n").over(whole.orderBy("_cell")), "wanted": wanted})
    found = summed.filter((F.col("cum") >= F.col("wanted")) & (F.col("cum") - F.col("n") < F.col("wanted")))
    return found.select(label, F.struct("_cell", (F.col("wanted") - F.col("cum") + F.col("n")).alias("left")).alias("cut"))


def split_limits(df: DataFrame, label: str, keys: list[str], train_share: str = "0.8", seed: int = 42) -> DataFrame:
    """(label, limit): the largest hash of the training rows of each class, see ``stratified_split``.

    The position of the cut is found by counting hash prefixes, then longer ones inside the cell of the cut,
    so no row is shuffled or sorted except the handful that share the long prefix at the cut.
    """
    rows = df.select(label, row_hash(keys, seed).alias("_hash"))
    wanted = F.ceil(F.sum("n").over(W.partitionBy(label)) * F.lit(Decimal(train_share)))
    for level in range(_LEVELS):
        rows = rows.withColumn("_cell", F.substring("_hash", 1 + level * _DIGITS, _DIGITS))
        grouped = rows.groupBy(label, "_cell")
        cells = grouped.agg(F.count(F.lit(1)).alias("n")) if level == 0 else grouped.agg(F.count(F.lit(1)).alias("n"), F.max("_left").alias("_left"))
        cut = F.element_at(_class_map(_cut_cell(cells, label, wanted), label, "cut"), F.col(label))
        rows = rows.withColumn("_cut", cut).filter(F.col("_cell") == F.col("_cut._cell")).select(label, "_hash", F.col("_cut.left").alias("_left"))
        wanted = F.col("_left")
    position = F.row_number().over(W.partitionBy(label).orderBy("_hash"))
    return rows.withColumn("_rn", position).filter(F.col("_rn") == F.col("_left")).select(label, F.col("_hash").alias("limit"))


def with_split(df: DataFrame, label: str, keys: list[str], limits: DataFrame, seed: int = 42) -> DataFrame:
    """Add ``is_train`` from the limits of the classes."""
    hashed = df.withColumn("_hash", row_hash(keys, seed))
    return hashed.withColumn("is_train", (F.col("_hash") <= F.element_at(_class_map(limits, label, "limit"), F.col(label))).cast("int")).drop("_hash")


def stratified_split(df: DataFrame, label: str, keys: list[str], train_share: str = "0.8", seed: int = 42) -> DataFrame:
    """Add ``is_train``: exactly ceil(share * n) rows of each class, chosen by hash order; see ``split_limits``."""
    return with_split(df, label, keys, split_limits(df, label, keys, train_share, seed), seed)


def standardize(df: DataFrame, columns: list[str], fit_on: DataFrame | None = None) -> DataFrame:
    """(x - mean) / population deviation of ``fit_on``; a constant column is only centred."""
    fitted = df if fit_on is None else fit_on
    stats = fitted.agg(
        F.struct(
            *[F.avg(c).alias(f"m_{c}") for c in columns],
            *[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)).alias(f"s_{c}") for c in columns],
        )
    ).scalar()
    return df.withColumns({c: (F.col(c) - stats[f"m_{c}"]) / stats[f"s_{c}"] for c in columns})


def label_codes(df: DataFrame, column: str, missing: str = "unknown") -> DataFrame:
    """(value, code): sorted distinct values numbered from 0."""
    values = df.select(F.coalesce(F.col(column), F.lit(missing)).alias("value")).distinct()
    return distributed_rank(values, ["value"], "code").select("value", (F.col("code") - 1).alias("code"))


def label_encode(df: DataFrame, column: str, codes: DataFrame, name: str, missing: str = "unknown") -> DataFrame:
    """Add the code of ``column``; a value not seen at fit time gets code 0."""
    lookup = codes.withColumnsRenamed({"value": "_value", "code": "_code"})
    keyed = df.withColumn("_key", F.coalesce(F.col(column), F.lit(missing)))
    joined = keyed.join(lookup, F.col("_key") == F.col("_value"), "left")
    return joined.withColumn(name, F.coalesce("_code", F.lit(0))).drop("_key", "_value", "_code")


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select([F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) if c in columns else F.col(c) for c in df.columns])


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """n / (classes * n_class) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    whole = W.partitionBy()
    return counts.select(label, (F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("weight"))


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    return df.withColumn(name, F.element_at(_class_map(class_weights(df, label), label, "weight"), F.col(label)))


def scale_pos_weight(df: DataFrame, label: str) -> DataFrame:
    """Negatives per positive, one row."""
    positives = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    negatives = F.sum(F.when(F.col(label) == 0, 1).otherwise(0))
    return df.agg((negatives / F.nullif(positives, F.lit(0))).alias("scale_pos_weight"))


def positive_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight positives by ``scale_pos_weight``, negatives by one."""
    ratio = scale_pos_weight(df, label).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, ratio).otherwise(1.0))
