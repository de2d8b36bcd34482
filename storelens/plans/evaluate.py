"""Evaluation of scored rows: ``label`` (0/1), ``probability`` of class 1, and thresholds.

Rows are reduced to counts before anything is ordered: per (label, prediction), per
threshold bucket, or per distinct score.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from storelens.functions.numeric import safe_div
from storelens.operators.ranking import running_totals

# The grids searched for a decision threshold.
BALANCE_GRID = [float(t) for t in np.arange(0.2, 0.8, 0.01)]
RECALL_GRID = [float(t) for t in np.arange(0.1, 0.6, 0.01)]


def with_prediction(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    return scored.withColumn("prediction", (F.col("probability") >= threshold).cast("int"))


def confusion_matrix(predicted: DataFrame, classes: list[int] | None = None) -> DataFrame:
    """Count of every (label, prediction) pair of the given classes, absent pairs included."""
    classes = classes or [0, 1]
    grid = [
        F.struct(
            F.lit(a).alias("label"),
            F.lit(p).alias("prediction"),
            F.sum(F.when((F.col("label") == a) & (F.col("prediction") == p), 1).otherwise(0)).alias("count"),
        )
        for a in classes
        for p in classes
    ]
    return predicted.agg(F.array(*grid).alias("cells")).select(F.inline("cells"))


def classification_report(predicted: DataFrame, names: list[str]) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    One pass counts the confusion cells; the report is arithmetic on that single row.
    """
    classes = range(len(names))
    cell = {(a, p): F.col(f"n_{a}_{p}") for a in classes for p in classes}
    counts = predicted.agg(
        *[
            F.sum(F.when((F.col("label") == a) & (F.col("prediction") == p), 1).otherwise(0)).alias(f"n_{a}_{p}")
            for a in classes
            for p in classes
        ]
    )

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(safe_div(part, whole), F.lit(0.0))

    def row(name: str, precision: Column, recall: Column, f1_score: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), precision.alias("precision"), recall.alias("recall"), f1_score.alias("f1"), support.alias("support"))

    total = sum(cell.values(), F.lit(0))
    per_class = []
    for c in classes:
        support, guessed = sum((cell[c, p] for p in classes), F.lit(0)), sum((cell[a, c] for a in classes), F.lit(0))
        per_class.append((ratio(cell[c, c], guessed), ratio(cell[c, c], support), ratio(2 * cell[c, c], support + guessed), support))
    hits = ratio(sum((cell[c, c] for c in classes), F.lit(0)), total)
    macro = [sum((m[i] for m in per_class), F.lit(0.0)) / len(names) for i in range(3)]
    weighted = [ratio(sum((m[i] * m[3] for m in per_class), F.lit(0.0)), total) for i in range(3)]
    rows = [row(n, *m) for n, m in zip(names, per_class)]
    rows += [row("accuracy", hits, hits, hits, total), row("macro avg", *macro, total), row("weighted avg", *weighted, total)]
    return counts.select(F.inline(F.array(*rows)))


def metrics(predicted: DataFrame) -> DataFrame:
    """One row: accuracy, recall of both classes, F1 of class 1, macro F1."""

    def count(a: int, p: int) -> Column:
        return F.sum(F.when((F.col("label") == a) & (F.col("prediction") == p), 1).otherwise(0))

    counts = predicted.agg(count(1, 1).alias("tp"), count(0, 1).alias("fp"), count(1, 0).alias("fn"), count(0, 0).alias("tn"))
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    zero = F.lit(0.0)
    f1 = F.coalesce(safe_div(2 * tp, 2 * tp + fp + fn), zero)
    f0 = F.coalesce(safe_div(2 * tn, 2 * tn + fp + fn), zero)
    return counts.select(
        safe_div(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        F.coalesce(safe_div(tn, tn + fp), zero).alias("recall_0"),
        F.coalesce(safe_div(tp, tp + fn), zero).alias("recall_1"),
        f1.alias("f1"),
        ((f0 + f1) / 2).alias("f1_macro"),
    )


def accuracy(predicted: DataFrame) -> DataFrame:
    return metrics(predicted).select("accuracy")


def recall_by_class(predicted: DataFrame) -> DataFrame:
    return metrics(predicted).select("recall_0", "recall_1")


def f1(predicted: DataFrame) -> DataFrame:
    return metrics(predicted).select("f1")


def f1_macro(predicted: DataFrame) -> DataFrame:
    return metrics(predicted).select("f1_macro")


def _grid_points_up_to(score: Column, grid: list[float]) -> Column:
    """How many points of an evenly spaced grid are <= score: computed, then settled on the stored points."""
    points, size = F.array(*[F.lit(t) for t in grid]), len(grid)
    width = (grid[-1] - grid[0]) / (size - 1)
    guess = F.greatest(F.lit(0), F.least(F.lit(size), F.floor((score - grid[0]) / width).cast("int") + 1))
    too_low = (guess < size) & (F.get(points, guess) <= score)
    too_high = (guess > 0) & (F.get(points, guess - 1) > score)
    return guess + F.when(too_low, 1).when(too_high, -1).otherwise(0)


def threshold_curve(scored: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """Recall of both classes at every threshold, from one pass that counts rows per gap of the grid."""
    grid = grid or BALANCE_GRID
    passed = _grid_points_up_to(F.col("probability"), grid)
    positive = F.col("label") == 1
    buckets = scored.groupBy(passed.alias("passed")).agg(
        F.sum(F.when(positive, 1).otherwise(0)).alias("pos"), F.sum(F.when(positive, 0).otherwise(1)).alias("neg")
    )
    steps = F.array(*[F.struct(F.lit(i + 1).alias("step"), F.lit(t).alias("threshold")) for i, t in enumerate(grid)])
    # at most len(grid) + 1 buckets from here on
    packed = buckets.agg(F.collect_list(F.struct("passed", "pos", "neg")).alias("b"), F.sum("pos").alias("p"), F.sum("neg").alias("n"))
    rows = packed.select("b", "p", "n", F.inline(steps))

    def total(field: str, keep) -> Column:
        return F.aggregate(F.filter("b", keep), F.lit(0).cast("bigint"), lambda a, x: a + x[field])

    return rows.select(
        "threshold",
        F.coalesce(safe_div(total("neg", lambda x: x["passed"] < F.col("step")), F.col("n")), F.lit(0.0)).alias("recall_0"),
        F.coalesce(safe_div(total("pos", lambda x: x["passed"] >= F.col("step")), F.col("p")), F.lit(0.0)).alias("recall_1"),
    )


def threshold_balanced(scored: DataFrame) -> DataFrame:
    """The threshold with the best worse recall; the lowest one on a tie."""
    curve = threshold_curve(scored, BALANCE_GRID).withColumn("balance", F.least("recall_0", "recall_1"))
    return curve.orderBy(F.desc("balance"), "threshold").limit(1).select("threshold", "balance")


def threshold_target_recall(scored: DataFrame, target: float = 0.55, default: float = 0.5) -> DataFrame:
    """The first threshold from below that reaches the target recall of class 1, else the default."""
    curve = threshold_curve(scored, RECALL_GRID)
    first = F.min(F.when(F.col("recall_1") >= target, F.col("threshold")))
    return curve.agg(F.coalesce(first, F.lit(default)).alias("threshold"))


def _score_totals(scored: DataFrame) -> DataFrame:
    positive = F.col("label") == 1
    per_score = scored.groupBy("probability").agg(
        F.sum(F.when(positive, 1).otherwise(0)).alias("pos"), F.sum(F.when(positive, 0).otherwise(1)).alias("neg")
    )
    return running_totals(per_score, [F.desc("probability")], ["pos", "neg"])


def roc_auc(scored: DataFrame) -> DataFrame:
    """Area under the ROC curve; equal scores count half."""
    won = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2)
    return _score_totals(scored).agg(safe_div(F.sum(won), F.sum("pos").cast("double") * F.sum("neg")).alias("roc_auc"))


def roc_curve(scored: DataFrame) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the origin."""
    totals = _score_totals(scored)
    sums = totals.agg(F.struct(F.sum("pos").alias("p"), F.sum("neg").alias("n"))).scalar()
    points = totals.select(
        F.col("probability").alias("threshold"),
        safe_div(F.col("cum_neg"), sums["n"]).alias("fpr"),
        safe_div(F.col("cum_pos"), sums["p"]).alias("tpr"),
    )
    origin = scored.sparkSession.range(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return points.unionByName(origin)


def evaluation_report(scored: DataFrame, threshold: float = 0.5) -> DataFrame:
    """(section, name, value): confusion counts, headline metrics and AUC at one threshold."""
    predicted = with_prediction(scored, threshold)
    cells = confusion_matrix(predicted).select(
        F.lit("confusion").alias("section"), F.concat_ws("/", "label", "prediction").alias("name"), F.col("count").cast("double").alias("value")
    )
    headline = metrics(predicted)
    rows = headline.unpivot([], headline.columns, "name", "value").select(F.lit("metric").alias("section"), "name", "value")
    area = roc_auc(scored).select(F.lit("metric").alias("section"), F.lit("roc_auc").alias("name"), F.col("roc_auc").alias("value"))
    return cells.unionByName(rows).unionByName(area)


def forecast_metrics(errors: DataFrame, by: list[str]) -> DataFrame:
    """MAE, RMSE and MAPE of (y, yhat) rows per group, as for each forecast horizon."""
    miss = F.col("y") - F.col("yhat")
    return errors.groupBy(*by).agg(
        F.avg(F.abs(miss)).alias("mae"),
        F.sqrt(F.avg(miss * miss)).alias("rmse"),
        F.avg(F.abs(miss) / F.nullif(F.abs(F.col("y")), F.lit(0.0))).alias("mape"),
    )


def select_best(results: DataFrame, name: str, value: str, order: str) -> DataFrame:
    """The candidate with the largest value; the lowest ``order`` wins a tie."""
    return results.orderBy(F.desc(value), F.asc(order)).limit(1).select(name, value)


def cv_test_gap(cv_score: float, test_score: float) -> float:
    return cv_score - test_score
