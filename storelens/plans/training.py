"""Model training: data preparation, seeded random search over all draws and folds at once, selection, tree models, metrics.

Models are fitted to all training rows. Up to ``FIT_ROWS`` of them travel with the tasks; more stay a stored table of binned rows
(a byte a feature), and every task reads the rows of its fit from it. A search is one Spark job: each task takes one fold and the
draws that share a run, because they differ only in how many trees they keep or how far trees are cut back.
"""

from __future__ import annotations

import json
import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from decimal import ROUND_DOWN, Decimal

import numpy as np
import pandas as pd
from pyspark.ml.feature import StringIndexer, StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelens.operators import neighbours
from storelens.operators import trees as T
from storelens.operators.ranking import grouped_rank, running_totals
from storelens.plans import evaluate, prep
from storelens.plans.features import CHURN_FEATURES, DELIVERY_FEATURES, SENTIMENT_FEATURES
from storelens.session import materialize, stored

# The searched settings. A depth of None is no limit.
CHURN_GRID = {
    "n_estimators": [100, 200, 300], "max_depth": [3, 4, 5], "learning_rate": [0.01, 0.05, 0.1], "subsample": [0.6, 0.8, 1.0],
    "colsample_bytree": [0.6, 0.8, 1.0], "min_child_weight": [5, 10, 15], "reg_alpha": [0, 0.1, 0.5], "reg_lambda": [1.0, 1.5, 2.0],
}
DELIVERY_BOOSTING_GRID = {
    "n_estimators": [100, 150, 200], "max_depth": [3, 4, 5], "learning_rate": [0.05, 0.1, 0.15], "subsample": [0.7, 0.8, 1.0],
}
DELIVERY_FOREST_GRID = {"n_estimators": [100, 200, 300], "max_depth": [5, 8, 10, None], "min_samples_split": [2, 5, 10]}
DELIVERY_FIXED = {"n_estimators": [200], "max_depth": [5], "learning_rate": [0.1]}
SENTIMENT_FOREST_GRID = {
    "n_estimators": [100, 200, 300], "max_depth": [6, 8, 10, None], "min_samples_split": [2, 5, 10], "min_samples_leaf": [1, 2, 4],
}
SENTIMENT_BOOSTING_GRID = {
    "n_estimators": [100, 200, 300], "max_depth": [3, 4, 5, 6], "learning_rate": [0.01, 0.05, 0.1], "subsample": [0.7, 0.8, 1.0],
    "colsample_bytree": [0.7, 0.8, 1.0],
}
SEED = 42
#: Training rows up to which the driver sends them out itself; more are read from a stored table.
FIT_ROWS = 6000


@dataclass
class Search:
    """How much to search, and the rows up to which the driver holds them."""

    n_iter: int
    folds: int = 5
    fit_rows: int = FIT_ROWS


@dataclass(frozen=True)
class Candidate:
    """A kind of model with its grid. ``newton``: boosting whose splits are weighed by hessians. ``balance``: classes are evened out by oversampling before a fit."""

    name: str
    grid: dict
    forest: bool = False
    newton: bool = True
    balance: bool = True


@dataclass
class Sample:
    """The rows of the fits, in hash order within each class, with their folds."""

    x: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    fold: np.ndarray
    scale: np.ndarray  # deviations over all training rows, for distances
    edges: list[np.ndarray] = field(default_factory=list)


def random_draws(grid: dict[str, list], n_iter: int, seed: int = SEED) -> list[dict]:
    """Distinct seeded draws from a grid; the whole grid if it is smaller."""
    total = 1
    for values in grid.values():
        total *= len(values)
    names = list(grid)

    def combination(index: int) -> dict:
        out = {}
        for name in names:
            index, i = divmod(index, len(grid[name]))
            out[name] = grid[name][i]
        return out

    return [combination(i) for i in random.Random(seed).sample(range(total), min(n_iter, total))]


def bounded_sample(train: DataFrame, features: list[str], keys: list[str], search: Search, weight: str | None = None) -> Sample:
    """At most ``search.fit_rows`` rows (and one a class, from rounding up), the same share of each class, the same ones under any partitioning.

    Models are fitted to it only where it is the whole table, see ``training_rows``.
    """
    total = train.count()
    if total > search.fit_rows:
        share = (Decimal(search.fit_rows) / Decimal(total)).quantize(Decimal("1e-9"), rounding=ROUND_DOWN)
        train_rows = prep.stratified_split(train, "label", keys, str(share), SEED + 1).filter("is_train = 1")
    else:
        train_rows = train
    weighed = F.col(weight).cast("double") if weight else F.lit(1.0)
    taken = train_rows.select(*features, F.col("label").cast("int").alias("_y"), weighed.alias("_w"), prep.row_hash(keys, SEED + 2).alias("_h"))
    rows = taken.toPandas().sort_values(["_y", "_h"], kind="stable")  # bounded by fit_rows
    deviations = train.agg(*[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)) for c in features]).first()
    x, y = rows[features].to_numpy(np.float64), rows["_y"].to_numpy()
    fold = rows.groupby("_y").cumcount().to_numpy() % search.folds
    return Sample(x, y, rows["_w"].to_numpy(np.float64), fold, np.array(deviations, np.float64), T.bin_edges(x) if len(x) else [])


def _fit_data(sample: Sample, chosen: np.ndarray, balance: bool, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and weights of a fit; classes weigh the same, by oversampling or as the sample's weights say."""
    x, y, weight = sample.x[chosen], sample.y[chosen], sample.weight[chosen]
    if balance:
        x, y = T.oversampled(x, y, sample.scale, seed)
        counts = np.maximum(np.bincount(y, minlength=2), 1)
        weight = len(y) / (2.0 * counts[y])
    return T.binned(x, sample.edges), y, weight


# -- training rows as a stored table ---------------------------------------------------------------------------------------

_BLOCKS = "fold int, made int, bins binary, y binary, weight binary"


@dataclass
class StoredRows:
    """All training rows, binned, in blocks of a few thousand: rows with their fold, and those that oversampling made, with the run they belong to.

    Run r leaves out fold r; run ``folds`` has all rows.
    """

    blocks: DataFrame
    edges: list[np.ndarray]
    folds: int

    def runs(self, units: list[int], run, schema: str) -> DataFrame:
        """The frames that ``run`` yields for (unit, blocks of its rows), a task a unit; ``units`` has the run of each."""
        spark, n = self.blocks.sparkSession, len(units)
        wanted = spark.createDataFrame(list(enumerate(units)), "unit int, run int")
        dealt = self.blocks.join(F.broadcast(wanted), F.col("made").isNull() | (F.col("made") == F.col("run"))).repartitionById(n, F.col("unit"))

        def task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            parts, unit = [], None
            for batch in batches:
                parts += batch[["fold", "bins", "y", "weight"]].itertuples(index=False, name=None)
                unit = int(batch["unit"].iloc[0]) if len(batch) else unit
            if unit is not None:
                yield from run(unit, parts)

        return dealt.mapInPandas(task, schema)


def _joined_blocks(parts: list[tuple], n_features: int, balance: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bins, labels and weights of blocks, in an order that does not depend on how rows were dealt."""
    bins = np.concatenate([np.frombuffer(b, np.uint8).reshape(n_features, -1) for _, b, _, _ in parts], axis=1)
    y = np.concatenate([np.frombuffer(b, np.uint8) for _, _, b, _ in parts]).astype(np.int64)
    weight = None if balance else np.concatenate([np.frombuffer(b, np.float64) for _, _, _, b in parts])
    order = np.lexsort([*bins, y] if balance else [weight, *bins, y])
    bins, y = bins[:, order], y[order]
    return bins, y, len(y) / (2.0 * np.maximum(np.bincount(y, minlength=2), 1)[y]) if balance else weight[order]


def _unit_rows(parts: list[tuple], edges: list[np.ndarray], fold: int, balance: bool):
    """(rows of the fit, rows of the fold that it leaves out), of the blocks of a run. Rows that were made have no fold, and go where balanced rows are asked for."""
    original = [p for p in parts if p[0] is not None and p[0] == p[0]]
    made = [p for p in parts if p[0] is None or p[0] != p[0]]
    fit = [p for p in original if p[0] != fold] + (made if balance else [])
    held = [p for p in original if p[0] == fold]
    return _joined_blocks(fit, len(edges), balance), _joined_blocks(held, len(edges), True) if held else None


def exact_edges(rows: DataFrame, n_features: int) -> list[np.ndarray]:
    """``trees.bin_edges`` of the ``vec`` column over all rows: quantiles are found by counting equal values, which stay distributed."""
    counts = rows.select(F.posexplode("vec").alias("column", "value")).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    cum = running_totals(counts, ["column", "value"], ["n"])
    sizes = cum.groupBy("column").agg(F.count(F.lit(1)).alias("different"), F.sum("n").alias("size"), F.min(F.col("cum_n") - F.col("n")).alias("base"))
    low, high = F.col("cum_n") - F.col("n") - F.col("base"), F.col("cum_n") - F.col("base")

    def inside(i):
        at = F.floor((F.col("size") - 1) * i / T.BINS)
        return (low <= at) & (at < high)

    cut = F.exists(F.sequence(F.lit(1), F.lit(T.BINS - 1)), inside)
    few = F.col("different") <= T.BINS
    picked = cum.join(F.broadcast(sizes), "column").where(few | cut).select("column", "value", few.alias("few")).toPandas()  # BINS rows a feature at most
    edges = []
    for f in range(n_features):
        own = picked[picked["column"] == f].sort_values("value")
        values = own["value"].to_numpy(np.float64)
        edges.append(values[:-1] if len(own) and own["few"].iloc[0] else values)
    return edges


def _blocks(rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
    """Blocks of (fold, made, y, vec, weight) rows."""
    names = ["fold", "made", "bins", "y", "weight"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (fold, made), part in batch.groupby(["fold", "made"], dropna=False):
                bins = T.binned(np.stack(part["vec"].to_numpy()), edges)
                out = [fold, made, bins.tobytes(), part["y"].to_numpy(np.uint8).tobytes(), part["weight"].to_numpy(np.float64).tobytes()]
                frame = pd.DataFrame([out], columns=names)
                yield frame.astype({"fold": "Int32", "made": "Int32"})

    return rows.mapInPandas(run, _BLOCKS)


def _made_rows(base: DataFrame, scale: list[float], folds: int) -> DataFrame | None:
    """(made, y, vec): rows of the smaller class that oversampling adds to each run until its classes are equal; ``vec`` is divided by ``scale``."""
    sizes = {(r["fold"], r["y"]): r["n"] for r in base.groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a fold and class
    plan, before = [], 0
    for run in range(folds + 1):
        n = [sum(c for (fold, y), c in sizes.items() if y == of and fold != run) for of in (0, 1)]
        rare = int(n[1] < n[0])
        if n[rare] and n[0] != n[1]:
            rounds, extra = divmod(abs(n[0] - n[1]), n[rare])
            plan.append((2 * run + rare, len(plan), before, rounds, extra))
            before += n[rare]
    if not plan:
        return None
    spark = base.sparkSession
    classes = spark.createDataFrame(plan, "label int, part int, before long, rounds long, extra long")
    runs = spark.createDataFrame([(label // 2, label % 2, label) for label, *_ in plan], "run int, y int, label int")
    scaled = F.transform("vec", lambda v, i: v / F.element_at(F.array(*map(F.lit, scale)), i + 1))
    original = base.join(F.broadcast(runs), "y").where("fold <> run").select("label", scaled.alias("vec"))
    made = neighbours._synthetic(stored(original, "rare"), classes, 5, SEED)
    return made.select((F.col("label") / 2).cast("int").alias("made"), (F.col("label") % 2).alias("y"), "vec")


def training_rows(train: DataFrame, features: list[str], keys: list[str], search: Search, weight: str | None = None, balance: bool = True) -> Sample | StoredRows:
    """All rows of the fits: in memory up to ``search.fit_rows`` of them, else a stored table. ``balance``: some fits even out classes."""
    if train.count() <= search.fit_rows:
        return bounded_sample(train, features, keys, search, weight)
    weighed = F.col(weight).cast("double") if weight else F.lit(1.0)
    vec = F.array(*[F.col(c).cast("double") for c in features]).alias("vec")
    rows = train.select(F.col("label").cast("int").alias("y"), weighed.alias("weight"), prep.row_hash(keys, SEED + 2).alias("_h"), vec)
    ranked = grouped_rank(rows, ["y"], ["_h", "vec"], "place")
    fold = ((F.col("place") - 1) % search.folds).cast("int").alias("fold")
    base = stored(ranked.select(fold, F.lit(None).cast("int").alias("made"), "y", "vec", "weight"), "fit")
    edges = exact_edges(base, len(features))
    blocks = stored(_blocks(base, edges), "blocks")
    deviations = [float(x) for x in train.agg(*[F.coalesce(F.nullif(F.stddev_pop(c), F.lit(0.0)), F.lit(1.0)) for c in features]).first()]
    made = _made_rows(base, deviations, search.folds) if balance else None
    if made is not None:
        even = made.select(F.lit(None).cast("int").alias("fold"), "made", "y", "vec", F.lit(1.0).alias("weight"))
        blocks = blocks.unionByName(stored(_blocks(even, [e / s for e, s in zip(edges, deviations)]), "blocks"))  # scaled values meet scaled cuts
    return StoredRows(blocks, edges, search.folds)


def _boosting(settings: dict, newton: bool) -> T.Boosting:
    return T.Boosting(
        settings["n_estimators"], settings["max_depth"], settings["learning_rate"], settings.get("subsample", 1.0), settings.get("colsample_bytree", 1.0),
        float(settings.get("min_child_weight", 1 if newton else 0)), float(settings.get("reg_alpha", 0)), float(settings.get("reg_lambda", 1.0 if newton else 0.0)), newton,
    )


def _forest_limits(settings: dict, cut_back: bool = True) -> T.Limits:
    depth, split = (settings["max_depth"], float(settings.get("min_samples_split", 2))) if cut_back else (None, 2.0)
    return T.Limits(depth, float(settings.get("min_samples_leaf", 1)), split)


def run_groups(candidate: Candidate, draws: list[dict]) -> list[list[int]]:
    """Draws that one run serves: boosting that differs in the number of trees alone; forests that differ in number, depth and least split."""
    free = ("n_estimators", "max_depth", "min_samples_split") if candidate.forest else ("n_estimators",)
    groups: dict[tuple, list[int]] = {}
    for i, draw in enumerate(draws):
        groups.setdefault(tuple((k, v) for k, v in draw.items() if k not in free), []).append(i)
    return list(groups.values())


def fold_scores(candidate: Candidate, draws: list[dict], sample: Sample, fold: int, measure: str) -> list[float]:
    """Score on the held fold of each draw of one run group."""
    held = sample.fold == fold
    return _held_scores(candidate, draws, _fit_data(sample, sample.fold != fold, candidate.balance, SEED + fold), T.binned(sample.x[held], sample.edges), sample.y[held], measure)


def _held_scores(candidate: Candidate, draws: list[dict], fit: tuple, watch: np.ndarray, truth: np.ndarray, measure: str) -> list[float]:
    (bins, y, weight), marks = fit, tuple(sorted({d["n_estimators"] for d in draws}))
    if candidate.forest:
        rules = sorted({(d["max_depth"], float(d["min_samples_split"])) for d in draws}, key=str)
        limits, total, staged = _forest_limits(draws[0], False), np.zeros((len(rules), watch.shape[1])), {}
        for t in range(marks[-1]):
            total += T.forest_tree(bins, y, weight, limits, SEED, t).stops(watch, rules)
            if t + 1 in marks:
                staged[t + 1] = total / (t + 1)
        found = [staged[d["n_estimators"]][rules.index((d["max_depth"], float(d["min_samples_split"])))] for d in draws]
    else:
        longest = {**draws[0], "n_estimators": marks[-1]}
        _, _, logits = T.boost(bins, y, weight, _boosting(longest, candidate.newton), SEED, watch, marks)
        found = [T.sigmoid(logits[d["n_estimators"]]) for d in draws]
    return [T.MEASURES[measure](truth, p) for p in found]


def random_search(spark: SparkSession, sample: Sample | StoredRows, candidates: list[Candidate], measure: str, search: Search) -> dict[str, tuple[dict, float]]:
    """Best drawn settings of every candidate by mean score over the folds. All draws and folds of all candidates are tasks of one job.

    Classes are balanced inside a fold: rows made from a fold never take part in a fit that is scored on it.
    """
    drawn = {c.name: random_draws(c.grid, search.n_iter) for c in candidates}
    units = [(c, group, fold) for c in candidates for group in run_groups(c, drawn[c.name]) for fold in range(search.folds)]
    units.sort(key=lambda u: -max(drawn[u[0].name][i]["n_estimators"] for i in u[1]) * (3 if u[0].forest else drawn[u[0].name][u[1][0]]["max_depth"]))  # long runs first
    table_of = "name string, draw int, fold int, score double"
    if isinstance(sample, StoredRows):
        edges = sample.edges

        def one(unit: int, parts: list[tuple]) -> Iterator[pd.DataFrame]:
            candidate, group, fold = units[unit]
            fit, (watch, truth, _) = _unit_rows(parts, edges, fold, candidate.balance)
            parts.clear()
            scores = _held_scores(candidate, [drawn[candidate.name][i] for i in group], fit, watch, truth, measure)
            yield pd.DataFrame({"name": candidate.name, "draw": group, "fold": fold, "score": scores})

        return _best_draws(sample.runs([fold for _, _, fold in units], one, table_of).toPandas(), candidates, drawn)
    data = spark.sparkContext.broadcast((sample, units, drawn))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sample, units, drawn = data.value
        for batch in batches:
            for unit in batch["id"].tolist():
                candidate, group, fold = units[unit]
                scores = fold_scores(candidate, [drawn[candidate.name][i] for i in group], sample, fold, measure)
                yield pd.DataFrame({"name": candidate.name, "draw": group, "fold": fold, "score": scores})

    rows = spark.range(0, len(units), 1, len(units)).mapInPandas(run, table_of)
    table = rows.toPandas()  # a row a draw and fold
    data.unpersist()
    return _best_draws(table, candidates, drawn)


def _best_draws(table: pd.DataFrame, candidates: list[Candidate], drawn: dict[str, list[dict]]) -> dict[str, tuple[dict, float]]:
    best = {}
    for c in candidates:
        means = table[table["name"] == c.name].sort_values(["draw", "fold"]).groupby("draw")["score"].mean()
        best[c.name] = (drawn[c.name][int(means.idxmax())], float(means.max()))
    return best


# -- models as tables of nodes -------------------------------------------------------------------------------------------

_NODES = "tree int, node int, feature int, threshold double, left int, gain double, value double, rows double"
_TREES_PER_TASK = 10
#: Nodes of a model that the driver and a worker hold at a time when rows are scored.
_NODES_SENT = 2_000_000


@dataclass
class TreeModel:
    """Trees as a table of nodes: a row goes to ``left`` where its feature is at most the threshold, else to left + 1; leaves have left -1.

    ``kind`` boosting: the values reached are added to ``start`` and taken as log-odds. forest: their mean is the probability.
    """

    kind: str
    features: list[str]
    start: float
    n_trees: int
    settings: dict
    nodes: DataFrame

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (of both classes) and ``prediction``. Trees go to the workers in parts of about ``_NODES_SENT`` nodes, a tree at least; where there
        are several parts, the sums so far are stored between them."""
        sizes = {r["tree"]: r["count"] for r in self.nodes.groupBy("tree").count().collect()}  # a row a tree
        parts, held = [], _NODES_SENT
        for tree in sorted(sizes):
            if held + sizes[tree] > _NODES_SENT:
                parts.append([tree, tree])
                held = 0
            parts[-1][1] = tree
            held += sizes[tree]
        total = df.withColumn("_total", F.lit(0.0))
        for k, (low, high) in enumerate(parts):
            total = total.withColumn("_total", F.col("_total") + self._sums(df.sparkSession, low, high)(*[F.col(c).cast("double") for c in self.features]))
            total = stored(total, "sums") if k + 1 < len(parts) else total
        p = F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.lit(-500.0), F.least(F.lit(500.0), F.lit(self.start) + F.col("_total")))))
        scored = total.withColumn("_p1", p if self.kind == "boosting" else F.col("_total") / F.lit(float(max(len(sizes), 1)))).drop("_total")
        p = F.col("_p1")
        return scored.withColumns({"probability": array_to_vector(F.array(F.lit(1.0) - p, p)), "prediction": (p >= 0.5).cast("double")}).drop("_p1")

    def _sums(self, spark: SparkSession, low: int, high: int):
        """The sum of the values that a row reaches in the trees from ``low`` to ``high``."""
        table = self.nodes.where(F.col("tree").between(low, high)).select("tree", "node", "feature", "threshold", "left", "value").toPandas().sort_values(["tree", "node"])
        first = np.concatenate([[0], np.flatnonzero(np.diff(table["tree"])) + 1]).astype(np.int64)
        model = spark.sparkContext.broadcast(T.Walker(len(self.features), first, *(table[c].to_numpy() for c in ("feature", "threshold", "left", "value"))))

        @F.pandas_udf("double")
        def sums(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                yield pd.Series(model.value.sums(np.stack([c.to_numpy(np.float64) for c in columns], axis=1)))

        return sums

    def importance(self) -> DataFrame:
        """(feature, importance): the share of all gains that splits on a feature bring. Features that are never used have none."""
        spark = self.nodes.sparkSession
        names = spark.createDataFrame(list(enumerate(self.features)), "feature int, name string")
        gains = self.nodes.filter("left >= 0").groupBy("feature").agg(F.sum("gain").alias("gain"))
        whole = gains.agg(F.sum("gain")).scalar()
        joined = names.join(gains, "feature", "left")
        return joined.select(F.col("name").alias("feature"), F.coalesce(F.col("gain") / whole, F.lit(0.0)).alias("importance"))

    def sql(self, rows: str, nodes: str, key: str) -> str:
        """SQL with the same probabilities, as (key, probability), from a table of complete feature rows and the stored nodes: rows walk one level a step."""
        own, carried = (", ".join(f'{side}."{f}"' for f in self.features) for side in "rw")
        value = "CASE w.feature " + " ".join(f'WHEN {i} THEN w."{f}"' for i, f in enumerate(self.features)) + " END"
        total = f"{self.start!r} + sum(value)"
        probability = f"1 / (1 + exp(-({total})))" if self.kind == "boosting" else f"sum(value) / {max(self.n_trees, 1)}"
        return f"""
            WITH RECURSIVE walk AS (
                SELECT r."{key}", {own}, n.tree, n.feature, n.threshold, n."left" AS down, n.value
                FROM {rows} r JOIN {nodes} n ON n.node = 0
                UNION ALL
                SELECT w."{key}", {carried}, n.tree, n.feature, n.threshold, n."left", n.value
                FROM walk w JOIN {nodes} n ON n.tree = w.tree AND n.node = w.down + CASE WHEN {value} > w.threshold THEN 1 ELSE 0 END
                WHERE w.down >= 0
            )
            SELECT "{key}", {probability} AS probability FROM walk WHERE down < 0 GROUP BY "{key}"
        """

    def importance_sql(self, nodes: str) -> str:
        """SQL with the same (feature, importance) from the stored nodes."""
        names = ", ".join(f"({i}, '{f}')" for i, f in enumerate(self.features))
        return f"""
            SELECT f.name AS feature, coalesce(sum(n.gain) / (SELECT sum(gain) FROM {nodes} WHERE "left" >= 0), 0) AS importance
            FROM (VALUES {names}) f(number, name) LEFT JOIN {nodes} n ON n.feature = f.number AND n."left" >= 0
            GROUP BY f.name
        """


def fit_model(spark: SparkSession, sample: Sample | StoredRows, candidate: Candidate, settings: dict, features: list[str]) -> TreeModel:
    """The candidate with these settings, fitted to all rows; trees of a forest are dealt over tasks."""
    n = settings["n_estimators"]
    per_task = _TREES_PER_TASK if candidate.forest else n
    tasks, edges = -(-n // per_task), sample.edges

    def table(trees: list[T.Tree], number: int) -> Iterator[pd.DataFrame]:
        for t, tree in enumerate(trees, number):
            cut = np.full(len(tree.left), np.nan)
            for f, own in enumerate(edges):
                at = (tree.left >= 0) & (tree.feature == f)
                cut[at] = own[tree.bin[at]]
            yield pd.DataFrame({"tree": t, "node": np.arange(len(tree.left)), "feature": tree.feature, "threshold": cut, "left": tree.left,
                                "gain": tree.gain, "value": tree.value, "rows": tree.rows})

    def fitted(task: int, fit: tuple) -> Iterator[pd.DataFrame]:
        if candidate.forest:
            for t in range(task * per_task, min(n, (task + 1) * per_task)):
                yield from table([T.forest_tree(*fit, _forest_limits(settings), SEED, t)], t)
        else:
            made, start, _ = T.boost(*fit, _boosting(settings, candidate.newton), SEED)
            made[0].value = made[0].value + start  # the table holds all there is to add
            yield from table(made, 0)

    if isinstance(sample, StoredRows):
        whole = sample.folds
        nodes = sample.runs([whole] * tasks, lambda task, parts: fitted(task, _unit_rows(parts, edges, whole, candidate.balance)[0]), _NODES)
    else:
        data = spark.sparkContext.broadcast(sample)

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for task in batch["id"].tolist():
                    yield from fitted(task, _fit_data(data.value, np.ones(len(data.value.y), bool), candidate.balance, SEED - 1))

        nodes = spark.range(0, tasks, 1, tasks).mapInPandas(run, _NODES)
    return TreeModel("forest" if candidate.forest else "boosting", features, 0.0, n, settings, stored(nodes, "nodes"))


@dataclass
class Trained:
    name: str
    model: TreeModel
    scored: DataFrame  # held-out rows with label and probability
    cv_score: float
    threshold: float
    metrics: dict[str, float]


def split_sets(df: DataFrame, label: str, keys: list[str]) -> tuple[DataFrame, DataFrame]:
    """Stratified 80/20 sets. Rows are written once, as Parquet, so that every later pass reads the same ones and only the columns it needs;
    the sets are told apart by the stored limits of the split."""
    rows = stored(df.withColumn("label", F.col(label).cast("double")), "training")
    split = prep.with_split(rows, "label", keys, materialize(prep.split_limits(rows, "label", keys)))
    return split.filter("is_train = 1"), split.filter("is_train = 0")


def score(model, prepared: DataFrame, keys: list[str]) -> DataFrame:
    out = model.transform(prepared)
    return out.select(
        *keys, F.col("label").cast("int").alias("label"), vector_to_array("probability")[1].alias("probability"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def _numbers(df: DataFrame) -> dict[str, float]:
    return {k: float(v) for k, v in df.first().asDict().items() if v is not None}


def _measure(scored: DataFrame, threshold: float) -> dict[str, float]:
    predicted = evaluate.with_prediction(scored, threshold)
    return {**_numbers(evaluate.metrics(predicted)), **_numbers(evaluate.roc_auc(scored))}


def _searched(train: DataFrame, test: DataFrame, features: list[str], keys: list[str], candidates: list[Candidate], measure: str, search: Search,
              weight: str | None = None) -> dict[str, tuple[TreeModel, DataFrame, float]]:
    """Each candidate's best model, its scored held-out rows, and its mean score over the folds. A grid of one point is not searched."""
    spark = train.sparkSession
    sample = training_rows(train, features, keys, search, weight, any(c.balance for c in candidates))
    several = [c for c in candidates if len(random_draws(c.grid, 2)) > 1]
    best = random_search(spark, sample, several, measure, search) if several else {}
    out = {}
    for c in candidates:
        settings, cv = best.get(c.name) or (random_draws(c.grid, 1)[0], float("nan"))
        model = fit_model(spark, sample, c, settings, features)
        out[c.name] = (model, stored(score(model, test, keys), "scored"), cv)
    return out


def train_churn(features: DataFrame, search: Search | None = None, use_value_weights: bool = False, grid: dict | None = None) -> Trained:
    """Second-order boosting with penalised leaves on balanced churn features; ROC-AUC picks the settings.

    ``use_value_weights`` trains on the original rows with the value-based weights instead of balancing them. Trees need no scaled
    features; only the distances of oversampling are scaled.
    """
    search = search or Search(n_iter=25)
    train, test = split_sets(prep.fill_zero(features, CHURN_FEATURES), "churned", ["customer_id"])
    candidate = Candidate("GradientBoosting", grid or CHURN_GRID, balance=not use_value_weights)
    weight = "sample_weight" if use_value_weights else None
    model, scored, cv = _searched(train, test, CHURN_FEATURES, ["customer_id"], [candidate], "roc_auc", search, weight)["GradientBoosting"]
    threshold = evaluate.threshold_balanced(scored).first()["threshold"]
    measured = _measure(scored, threshold)
    measured.update(cv_auc=cv, cv_test_gap=evaluate.cv_test_gap(cv, measured["roc_auc"]), best_threshold=threshold)
    return Trained("GradientBoosting", model, scored, cv, threshold, measured)


def _state_indexer(train: DataFrame) -> StringIndexerModel:
    known = train.select(*[F.coalesce(c, F.lit("unknown")).alias(c) for c in ("customer_state", "seller_state")])
    return StringIndexer(
        inputCols=["customer_state", "seller_state"], outputCols=["customer_state_idx", "seller_state_idx"],
        stringOrderType="alphabetAsc", handleInvalid="keep",
    ).fit(known)


def encode_states(indexer: StringIndexerModel, df: DataFrame) -> DataFrame:
    """Alphabetical codes of both states; values not seen in training get code 0."""
    known = df.withColumns({c: F.coalesce(c, F.lit("unknown")) for c in ("customer_state", "seller_state")})
    indexed = indexer.transform(known)
    for i, c in enumerate(("customer_state", "seller_state")):
        unseen = F.lit(float(len(indexer.labelsArray[i])))
        indexed = indexed.withColumn(f"{c}_enc", F.when(F.col(f"{c}_idx") < unseen, F.col(f"{c}_idx")).otherwise(0.0)).drop(f"{c}_idx")
    return indexed


def train_delivery(features: DataFrame, search: Search | None = None, boosting: dict | None = None, forest: dict | None = None) -> tuple[Trained, StringIndexerModel]:
    """Three candidates on balanced rows, settings by F1 of the late class; the best held-out ROC-AUC wins. The third has fixed settings."""
    search = search or Search(n_iter=15)
    keys = ["order_id", "order_item_id"]
    indexer = _state_indexer(features)
    train, test = split_sets(prep.fill_zero(encode_states(indexer, features), DELIVERY_FEATURES), "is_late", keys)
    fixed = DELIVERY_FIXED if boosting is None else {k: v[:1] for k, v in boosting.items()}
    candidates = [
        Candidate("GradientBoosting", boosting or DELIVERY_BOOSTING_GRID, newton=False),
        Candidate("RandomForest", forest or DELIVERY_FOREST_GRID, forest=True),
        Candidate("WeightedBoosting", fixed),
    ]
    found = _searched(train, test, DELIVERY_FEATURES, keys, candidates, "f1", search)
    auc = {n: evaluate.roc_auc(scored).first()["roc_auc"] for n, (_, scored, _) in found.items()}
    name = max(auc, key=lambda n: auc[n])
    model, scored, cv = found[name]
    threshold = evaluate.threshold_target_recall(scored).first()["threshold"]
    measured = {**_measure(scored, threshold), "best_threshold": threshold}
    return Trained(name, model, scored, cv, threshold, measured), indexer


def train_sentiment(features: DataFrame, search: Search | None = None, boosting: dict | None = None, forest: dict | None = None) -> Trained:
    """Forest against boosted trees by held-out macro F1; the forest wins a tie."""
    search = search or Search(n_iter=15)
    keys = ["order_id", "order_item_id"]
    labelled = features.withColumn("positive", (F.col("sentiment") == "Positive").cast("int"))
    train, test = split_sets(prep.fill_zero(labelled, SENTIMENT_FEATURES), "positive", keys)
    candidates = [Candidate("RandomForest", forest or SENTIMENT_FOREST_GRID, forest=True), Candidate("GradientBoosting", boosting or SENTIMENT_BOOSTING_GRID)]
    found = _searched(train, test, SENTIMENT_FEATURES, keys, candidates, "f1_macro", search)
    quality = {n: evaluate.f1_macro(scored).first()["f1_macro"] for n, (_, scored, _) in found.items()}
    name = max(quality, key=lambda n: quality[n])
    model, scored, cv = found[name]
    return Trained(name, model, scored, cv, 0.5, {**_measure(scored, 0.5), "cv_best_f1": cv})


def feature_importance(spark: SparkSession, model: TreeModel, features: list[str], n: int | None = None) -> DataFrame:
    """(feature, importance), most important first; ties by name."""
    ordered = model.importance().filter(F.col("feature").isin(features)).orderBy(F.desc("importance"), "feature")
    return ordered if n is None else ordered.limit(n)


def log_metrics(spark: SparkSession, path: str, run_id: str, model: str, params: dict, metrics: dict) -> None:
    """Append (run_id, model, kind, key, value) rows."""
    rows = [(run_id, model, "param", k, str(v)) for k, v in params.items()] + [(run_id, model, "metric", k, repr(float(v))) for k, v in metrics.items()]
    spark.createDataFrame(rows, "run_id string, model string, kind string, key string, value string").write.mode("append").parquet(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_model(model: TreeModel, path: str) -> None:
    """The node table and, beside it, one row that describes the model."""
    model.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    about = json.dumps({"kind": model.kind, "features": model.features, "start": model.start, "n_trees": model.n_trees, "settings": model.settings})
    model.nodes.sparkSession.createDataFrame([(about,)], "about string").coalesce(1).write.mode("overwrite").parquet(f"{path}/about")


def load_model(path: str, spark: SparkSession | None = None) -> TreeModel:
    spark = spark or SparkSession.getActiveSession()
    about = json.loads(spark.read.parquet(f"{path}/about").first()["about"])
    return TreeModel(nodes=spark.read.schema(_NODES).parquet(f"{path}/nodes"), **about)
