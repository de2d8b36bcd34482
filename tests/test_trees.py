"""Trees, boosting, forests and the search against plain versions on small rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.operators import trees as T
from storelens.plans import features, scoring, training


def rows(n=300, d=4, seed=0):
    r = np.random.default_rng(seed)
    x = r.integers(0, 9, (n, d)).astype(float)
    y = ((x[:, 0] > 4) ^ (x[:, 1] > 5) ^ (r.random(n) < 0.15)).astype(int)
    return x, y


def plain_tree(x, g, h, leaf_h, count, limits, depth=0):
    """Exact greedy splits on values, one node at a time: (value) or (feature, threshold, left, right, gain, value)."""

    def soft(v):
        return np.sign(v) * max(abs(v) - limits.alpha, 0)

    def strength(a, b):
        return soft(a) ** 2 / (b + limits.reg)

    value = -soft(g.sum()) / (leaf_h.sum() + limits.reg)
    best = None
    if depth != limits.depth and count.sum() >= limits.split:
        for f in range(x.shape[1]):
            for cut in sorted(set(x[:, f]))[:-1]:
                side = x[:, f] <= cut
                if min(h[side].sum(), h[~side].sum()) < max(limits.child, 1e-9):
                    continue
                gain = strength(g[side].sum(), h[side].sum()) + strength(g[~side].sum(), h[~side].sum()) - strength(g.sum(), h.sum())
                if best is None or gain > best[0] + 1e-12:
                    best = (gain, f, cut, side)
    if best is None or best[0] <= 1e-9 * max(1, abs(strength(g.sum(), h.sum()))):
        return (value,)
    gain, f, cut, side = best
    parts = [plain_tree(x[s], g[s], h[s], leaf_h[s], count[s], limits, depth + 1) for s in (side, ~side)]
    return (f, cut, *parts, gain, value)


def plain_value(tree, row):
    while len(tree) > 1:
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree[0]


@pytest.mark.parametrize("limits", [T.Limits(3), T.Limits(None, 2.0, 5.0), T.Limits(4, 1.5, 2.0, 0.7, 1.5), T.Limits(0)])
def test_tree_like_exact_greedy_splits(limits):
    x, y = rows()
    r = np.random.default_rng(1)
    g, h, weight = r.normal(size=len(y)) + (y - 0.5), r.uniform(0.1, 1, len(y)), r.integers(0, 3, len(y)).astype(float)
    edges = T.bin_edges(x)
    bins = T.binned(x, edges)
    tree = T.grow(bins, g, h, limits, np.arange(4), weight)
    on = weight > 0
    want = plain_tree(x[on], (g * weight)[on], (h * weight)[on], (h * weight)[on], weight[on], limits)
    assert tree.predict(bins)[on] == pytest.approx([plain_value(want, row) for row in x[on]])  # other rows may meet cuts that are equal for these


def test_gain_with_both_penalties_by_hand():
    x = np.array([[0.0], [0.0], [1.0], [1.0]])
    g, h = np.array([-1.0, -1.0, 1.0, 2.0]), np.ones(4)
    tree = T.grow(T.binned(x, T.bin_edges(x)), g, h, T.Limits(1, alpha=0.5, reg=1.0), np.arange(1))
    # left: (2 - .5)^2 / 3, right: (3 - .5)^2 / 3, whole: (1 - .5)^2 / 5
    assert tree.gain[0] == pytest.approx(2.25 / 3 + 6.25 / 3 - 0.25 / 5)
    assert tree.value.tolist() == pytest.approx([-0.1, 0.5, -2.5 / 3])


def test_hessian_bound_on_children():
    x = np.array([[float(i)] for i in range(10)])
    g = np.array([-9.0] + [1.0] * 9)
    tree = T.grow(T.binned(x, T.bin_edges(x)), g, np.full(10, 0.25), T.Limits(1, child=0.7), np.arange(1))
    assert tree.left[0] == 1 and tree.bin[0] == 2  # the best cut after the first row leaves too little


@pytest.mark.parametrize("newton", [True, False])
def test_staged_scores_equal_separate_runs(newton):
    x, y = rows(400)
    bins = T.binned(x, T.bin_edges(x))
    settings = T.Boosting(12, 3, 0.2, 0.7, 0.5, 1.0, 0.1, 1.0, newton)
    _, _, staged = T.boost(bins[:, :300], y[:300], np.ones(300), settings, 7, bins[:, 300:], (4, 12))
    for n in (4, 12):
        short = T.Boosting(n, 3, 0.2, 0.7, 0.5, 1.0, 0.1, 1.0, newton)
        made, start, _ = T.boost(bins[:, :300], y[:300], np.ones(300), short, 7)
        assert len(made) == n and staged[n] == pytest.approx(start + sum(t.predict(bins[:, 300:]) for t in made))


def test_first_boosting_steps_by_hand():
    """One split, both orders: Newton steps in the leaves."""
    x, y = np.array([[0.0]] * 4 + [[1.0]] * 4), np.array([0, 0, 0, 1, 1, 1, 1, 0])
    bins = T.binned(x, T.bin_edges(x))
    made, start, _ = T.boost(bins, y, np.ones(8), T.Boosting(1, 1, 1.0, reg=1.0), 0)
    assert start == 0 and made[0].value[1:].tolist() == pytest.approx([-(4 * 0.5 - 1) / 2, -(4 * 0.5 - 3) / 2])
    made, start, _ = T.boost(bins, y, np.ones(8), T.Boosting(1, 1, 1.0, newton=False), 0)
    assert start == 0 and made[0].value[1:].tolist() == pytest.approx([-1.0, 1.0])


def test_cut_back_trees_equal_trees_under_limits():
    x, y = rows(500, 6, 3)
    bins = T.binned(x, T.bin_edges(x))
    bins_few, r = bins[:, 400:], np.ones(400)
    full = T.forest_tree(bins[:, :400], y[:400], r, T.Limits(None, 1.0, 2.0), 5, 0)
    # without drawn features a limited tree is the beginning of the full one
    free = [T.grow(bins[:, :400], -y[:400].astype(float), np.ones(400), T.Limits(d, 1.0, s), np.arange(6)) for d, s in ((2, 2.0), (None, 40.0), (4, 10.0))]
    whole = T.grow(bins[:, :400], -y[:400].astype(float), np.ones(400), T.Limits(None, 1.0, 2.0), np.arange(6))
    assert [p.tolist() for p in whole.stops(bins_few, [(2, 2.0), (None, 40.0), (4, 10.0)])] == [t.predict(bins_few).tolist() for t in free]
    assert (full.rows[full.left >= 0] >= 2).all() and full.value.min() >= 0 and full.value.max() <= 1


def test_forest_split_is_the_gini_split():
    x, y = rows(200)
    bins = T.binned(x, T.bin_edges(x))
    tree = T.grow(bins, -y.astype(float), np.ones(200), T.Limits(1), np.arange(4))

    def gini(v):
        return 2 * v.mean() * (1 - v.mean()) * len(v)

    cuts = [(gini(y[x[:, f] <= c]) + gini(y[x[:, f] > c]), f, c) for f in range(4) for c in range(8)]
    assert min(cuts)[1] == tree.feature[0] and tree.value[0] == pytest.approx(y.mean())


def test_oversampling_lies_between_neighbours():
    r = np.random.default_rng(2)
    x, y = np.concatenate([r.normal(size=(60, 2)), r.normal(loc=30, size=(9, 2)) * [1, 100]]), np.array([0] * 60 + [1] * 9)
    more, labels = T.oversampled(x, y, np.array([1.0, 100.0]), 1)
    assert np.bincount(labels).tolist() == [60, 60] and (more[:69] == x).all()
    own = x[60:]
    d = (((own[:, None] - own[None]) / [1, 100]) ** 2).sum(axis=2)
    near = np.argsort(d + np.diag([np.inf] * 9), axis=1)[:, :5]
    for i, point in enumerate(more[69:]):
        a = own[i % 9]
        steps = [(b, ((point - a) @ (b - a)) / ((b - a) @ (b - a))) for b in own[near[i % 9]]]
        assert any(0 <= u <= 1 and np.allclose(a + u * (b - a), point) for b, u in steps)
    assert T.oversampled(x[:60], y[:60], np.ones(2), 1)[1].sum() == 0  # one class stays as it is
    assert len(T.oversampled(x[:61], y[:61], np.ones(2), 1)[1]) == 120  # a row without neighbours is repeated


def test_measures():
    from pyspark.ml.evaluation import BinaryClassificationEvaluator  # noqa: F401  (the same definitions as plans.evaluate)

    y, p = np.array([1, 1, 0, 1, 0, 0]), np.array([0.9, 0.8, 0.8, 0.3, 0.3, 0.1])
    assert T.area(y, p) == pytest.approx((3 + 2.5 + 1.5) / 9) and T.area(y[:2], p[:2]) == 0.5
    assert T.MEASURES["f1"](y, p) == pytest.approx(2 * 2 / (3 + 3)) and T.MEASURES["f1_macro"](y, p) == pytest.approx((2 / 3 + 2 / 3) / 2)


GRIDS = [
    training.Candidate("b", {"n_estimators": [2, 5], "max_depth": [2, 3], "learning_rate": [0.3], "subsample": [0.8, 1.0], "reg_alpha": [0, 0.5]}),
    training.Candidate("g", {"n_estimators": [2, 4], "max_depth": [2], "learning_rate": [0.3]}, newton=False),
    training.Candidate("f", {"n_estimators": [2, 5], "max_depth": [2, None], "min_samples_split": [2, 10], "min_samples_leaf": [1, 4]}, forest=True),
]


def sample_of(x, y, folds=3):
    fold = np.zeros(len(y), int)
    for c in (0, 1):
        fold[y == c] = np.arange((y == c).sum()) % folds
    return training.Sample(x, y, np.ones(len(y)), fold, x.std(axis=0), T.bin_edges(x))


def test_search_equals_a_fit_for_every_draw_and_fold(spark):
    sample = sample_of(*rows(240, 4, 9))
    search = training.Search(n_iter=16, folds=3)
    best = training.random_search(spark, sample, GRIDS, "f1", search)
    for c in GRIDS:
        draws, means = training.random_draws(c.grid, 16), []
        for draw in draws:
            means.append(np.mean([training.fold_scores(c, [draw], sample, k, "f1")[0] for k in range(3)]))
        assert best[c.name] == (draws[int(np.argmax(means))], pytest.approx(max(means)))


def test_runs_are_shared():
    draws = training.random_draws(training.DELIVERY_FOREST_GRID, 15)
    assert training.run_groups(GRIDS[2], draws) == [list(range(15))]
    groups = training.run_groups(GRIDS[0], training.random_draws(GRIDS[0].grid, 16))
    assert sorted(map(len, groups)) == [2] * 8


@pytest.mark.parametrize("candidate", GRIDS, ids=lambda c: c.name)
def test_model_table_scores_like_its_trees(spark, candidate, tmp_path):
    x, y = rows(150, 3, 4)
    sample, names = sample_of(x, y), ["a", "b", "c"]
    settings = training.random_draws(candidate.grid, 3)[-1]
    model = training.fit_model(spark, sample, candidate, settings, names)
    training.save_model(model, str(tmp_path / "m"))
    loaded = training.load_model(str(tmp_path / "m"))
    assert loaded.settings == settings
    frame = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "i long, a double, b double, c double")
    got = {r["i"]: r["p"] for r in loaded.transform(frame).select("i", F.expr("prediction"), training.vector_to_array("probability")[1].alias("p")).collect()}
    nodes = {}
    for r in model.nodes.collect():
        nodes.setdefault(r["tree"], {})[r["node"]] = r
    assert len(nodes) == settings["n_estimators"]
    for i, row in enumerate(x):
        total = 0.0
        for tree in nodes.values():
            at = 0
            while tree[at]["left"] >= 0:
                at = tree[at]["left"] + int(row[tree[at]["feature"]] > tree[at]["threshold"])
            total += tree[at]["value"]
        assert got[i] == pytest.approx(total / len(nodes) if candidate.forest else 1 / (1 + np.exp(-total)))
    shares = {r["feature"]: r["importance"] for r in model.importance().collect()}
    assert sum(shares.values()) == pytest.approx(1.0) and set(shares) == set(names)


@pytest.mark.parametrize("candidate", GRIDS, ids=lambda c: c.name)
def test_model_table_scores_like_its_sql(spark, candidate, tmp_path):
    """DuckDB walks the stored node table to the same probabilities and importances, at thresholds too."""
    x, y = rows(400, 4, 6)
    sample, names = sample_of(x, y), ["a", "b", "c", "left"]
    model = training.fit_model(spark, sample, candidate, training.random_draws(candidate.grid, 2)[-1], names)
    training.save_model(model, str(tmp_path / "m"))
    loaded = training.load_model(str(tmp_path / "m"))
    cuts = [r["threshold"] for r in loaded.nodes.filter("left >= 0").select("threshold").distinct().collect()]
    cells = [*x, *[[c] * 4 for c in cuts], [-1e300] * 4, [1e300] * 4]
    frame = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(cells)], "i long, a double, b double, c double, left double")
    frame.write.parquet(str(tmp_path / "rows"))
    con = duckdb.connect()
    table, nodes = f"'{tmp_path}/rows/*.parquet'", f"'{tmp_path}/m/nodes/*.parquet'"
    got = loaded.transform(frame).select("i", training.vector_to_array("probability")[1].alias("p")).collect()
    assert {r["i"]: pytest.approx(r["p"], abs=1e-12) for r in got} == dict(con.execute(loaded.sql(table, nodes, "i")).fetchall())
    shares = dict(con.execute(loaded.importance_sql(nodes)).fetchall())
    assert {r["feature"]: pytest.approx(r["importance"], abs=1e-12) for r in loaded.importance().collect()} == shares


def test_delivery_and_sentiment_with_small_grids(spark, stored):
    from storelens import registry

    boosting = {"n_estimators": [3, 6], "max_depth": [2], "learning_rate": [0.3]}
    forest = {"n_estimators": [3], "max_depth": [3, None], "min_samples_split": [2], "min_samples_leaf": [1]}
    search = training.Search(2, 2, 400)
    trained, indexer = training.train_delivery(registry._delivery(stored), search, boosting, forest)
    assert 0 <= trained.metrics["roc_auc"] <= 1
    scores = scoring.score_delivery(trained.model, indexer, registry._requests(stored), registry.ITEM)
    assert scores.count() == stored.fact_orders.count()
    sentiment = training.train_sentiment(features.sentiment_features(stored.fact_orders), search, boosting, forest)
    assert sentiment.name in ("RandomForest", "GradientBoosting") and 0 <= sentiment.metrics["cv_best_f1"] <= 1


def test_walker_reaches_the_leaves_that_a_plain_walk_reaches():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(800, 5))
    y = (x[:, 0] * x[:, 1] + rng.normal(size=800) > 0).astype(int)
    edges = T.bin_edges(x)
    made = [T.forest_tree(T.binned(x, edges), y, np.ones(800), T.Limits(depth, 1.0, 2.0), 42, t) for t, depth in enumerate((None, 3, 0, None))]
    cuts = [np.array([edges[f][b] if n >= 0 else np.nan for f, b, n in zip(t.feature, t.bin, t.left)]) for t in made]
    first = np.concatenate([[0], np.cumsum([len(t.left) for t in made])[:-1]]).astype(np.int64)
    feature, left, value = (np.concatenate([getattr(t, c) for t in made]) for c in ("feature", "left", "value"))
    walker = T.Walker(5, first, feature, np.concatenate(cuts), left, value)
    rows = rng.normal(size=(5000, 5))
    rows[::7, 2], rows[::11, 0], rows[3] = np.nan, np.inf, cuts[0][0]

    def plain(row):
        total = 0.0
        for tree, cut in zip(made, cuts):
            at = 0
            while tree.left[at] >= 0:
                at = tree.left[at] + int(row[tree.feature[at]] > cut[at])
            total += tree.value[at]
        return total

    assert walker.depth[0] > T._WALK_LEVELS and walker.depth[2] == 0
    assert walker.sums(rows).tolist() == [plain(r) for r in rows]
    assert T.Walker(5, first[:0], feature[:0], cuts[0][:0], left[:0], value[:0]).sums(rows[:2]).tolist() == [0.0, 0.0]


def many_rows(spark, n=900):
    """More rows than the driver holds in these tests: whole and broken numbers, one class in five, a key that repeats."""
    x = F.pmod(F.xxhash64("id"), F.lit(7)).cast("double")
    z = F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100_003)) / 7.0
    y = ((x > 3) & (z > 6000)).cast("int").cast("double")
    return spark.range(n).select(F.greatest(F.col("id"), F.lit(3)).alias("id"), x.alias("x"), z.alias("z"), y.alias("label"), (x + 1).alias("w"))


def test_edges_of_a_stored_table_are_those_of_all_its_rows(spark):
    table = many_rows(spark).toPandas()[["x", "z"]].to_numpy()
    table[:50, 1] = 5.0  # equal values over several quantiles
    frame = spark.createDataFrame([(row.tolist(),) for row in table], "vec array<double>")
    assert [e.tolist() for e in training.exact_edges(frame.repartition(5), 2)] == [e.tolist() for e in T.bin_edges(table)]


def unit_rows(rows, balance):
    edges = rows.edges

    def shapes(unit, parts):
        fit, held = training._unit_rows(parts, edges, unit, balance)
        yield training.pd.DataFrame({"unit": [unit], "fit": fit[0].shape[1], "rare": int(fit[1].sum()), "weight": fit[2].sum(), "held": held[0].shape[1] if held else 0})

    units = list(range(rows.folds + 1))
    return rows.runs(units, shapes, "unit int, fit long, rare long, weight double, held long").orderBy("unit").toPandas()


def test_every_row_is_fitted_and_held_out_once(spark):
    frame = many_rows(spark)
    rare = int(frame.agg(F.sum("label")).first()[0])
    search = training.Search(1, 4, fit_rows=100)
    even = unit_rows(training.training_rows(frame, ["x", "z"], ["id"], search), True)
    assert even["held"].sum() == 900 and even["held"].tolist()[4] == 0
    assert (even["rare"] * 2 == even["fit"]).all() and even["fit"].tolist()[4] == 2 * (900 - rare)
    plain = unit_rows(training.training_rows(frame, ["x", "z"], ["id"], search, "w", False), False)
    assert plain["fit"].tolist() == (900 - plain["held"]).tolist() and plain["rare"].tolist()[4] == rare
    assert plain["weight"].tolist()[4] == frame.agg(F.sum("w")).first()[0]
    small = training.training_rows(frame, ["x", "z"], ["id"], training.Search(1, 4, fit_rows=900))
    assert isinstance(small, training.Sample) and len(small.y) == 900


@pytest.mark.parametrize("candidate", GRIDS, ids=lambda c: c.name)
def test_models_of_a_stored_table_do_not_depend_on_its_partitions(spark, candidate):
    """Search and fit see all rows: the same scores and trees however rows are dealt, and roots with all of them."""
    found = []
    for parts in (1, 7):
        frame = many_rows(spark).repartition(parts)
        rows = training.training_rows(frame, ["x", "z"], ["id"], training.Search(3, 3, fit_rows=100))
        best = training.random_search(spark, rows, [candidate], "roc_auc", training.Search(3, 3))[candidate.name]
        model = training.fit_model(spark, rows, candidate, {**best[0], "subsample": 1.0}, ["x", "z"])
        found.append((best, [tuple(r)[:5] for r in model.nodes.orderBy("tree", "node").collect() if r["left"] >= 0]))
    assert found[0] == found[1] and found[0][0][1] > 0.9
    if not candidate.forest:
        root = model.nodes.where("node = 0 and tree = 0").first()["rows"]
        assert root == 2 * frame.where("label = 0").count()


def test_training_on_more_rows_than_the_driver_holds(spark):
    names = training.CHURN_FEATURES
    base = spark.range(1000).withColumns({c: ((F.col("id") * (i + 3) * 7919) % 101).cast("double") for i, c in enumerate(names)})
    rows = base.withColumnRenamed("id", "customer_id").withColumn("churned", (F.col("avg_days_between_orders") > 75).cast("int"))
    grid = {"n_estimators": [4], "max_depth": [2, 3], "learning_rate": [0.3]}
    trained = training.train_churn(rows, training.Search(2, 2, fit_rows=50), grid=grid)
    train, _ = training.split_sets(training.prep.fill_zero(rows, names), "churned", ["customer_id"])
    assert trained.metrics["roc_auc"] > 0.9
    assert trained.model.nodes.where("node = 0 and tree = 0").first()["rows"] == 2 * train.where("label = 0").count()  # 50 rows before


def test_levels_with_many_nodes_are_split_part_by_part(monkeypatch):
    x, y = rows(700, 5, 11)
    bins, weight = T.binned(x, T.bin_edges(x)), np.random.default_rng(0).uniform(0.5, 2, 700)
    want = [T.forest_tree(bins, y, weight, T.Limits(), 3, 0), T.grow(bins, y - 0.5, weight, T.Limits(6, 0.5, 2.0, 0.1, 1.0), np.arange(5))]
    monkeypatch.setattr(T, "_NODES_AT_ONCE", 3)
    got = [T.forest_tree(bins, y, weight, T.Limits(), 3, 0), T.grow(bins, y - 0.5, weight, T.Limits(6, 0.5, 2.0, 0.1, 1.0), np.arange(5))]
    for a, b in zip(want, got):
        assert all((getattr(a, name) == getattr(b, name)).all() for name in ("feature", "bin", "left", "gain", "value", "rows"))


@pytest.mark.parametrize("candidate", GRIDS[1:], ids=lambda c: c.name)
def test_models_are_sent_in_parts(spark, candidate, monkeypatch):
    x, y = rows(200, 3, 5)
    model = training.fit_model(spark, sample_of(x, y), candidate, training.random_draws(candidate.grid, 3)[-1], ["a", "b", "c"])
    frame = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "i long, a double, b double, c double")

    def scores():
        return [r["p"] for r in model.transform(frame).orderBy("i").select(training.vector_to_array("probability")[1].alias("p")).collect()]

    want = scores()
    monkeypatch.setattr(training, "_NODES_SENT", 8)
    assert scores() == pytest.approx(want, abs=1e-12)
