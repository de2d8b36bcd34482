"""Preparation, neighbours, evaluation, forecasts, training and scoring."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from storelens.operators import neighbours
from storelens.plans import evaluate, features, forecast, prep, scoring, training


def brute_force(vectors, ids, k):
    d = np.sqrt(((vectors[:, None, :] - vectors[None, :, :]) ** 2).sum(axis=2))
    out = {}
    for i, row in enumerate(d):
        order = sorted((j for j in range(len(ids)) if j != i), key=lambda j: (row[j], ids[j]))[:k]
        out[ids[i]] = [ids[j] for j in order]
    return out


@pytest.mark.parametrize("block", [40, 4096])
def test_neighbours_match_brute_force(spark, block):
    """Clustered points, one cluster with a third of them; small blocks force many cells and tiles."""
    rng = np.random.default_rng(5)
    centres = rng.normal(scale=20, size=(6, 3))
    which = np.where(np.arange(300) % 3 == 0, 0, rng.integers(1, 6, 300))
    vectors = centres[which] + rng.normal(size=(300, 3))
    points = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vec array<double>")
    got = {}
    for r in neighbours.nearest_neighbours(points, 5, block).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute_force(vectors, list(range(300)), 5)


def test_cells_and_pivots_both_grow_slower_than_the_table():
    for n in (10**6, 10**8, 10**10):
        pivots = neighbours.n_pivots(n)
        assert pivots + n / pivots <= 2.1 * max(n**0.5, neighbours.BLOCK)
    assert neighbours.n_pivots(0) == neighbours.n_pivots(5) == 1


def test_few_points(spark):
    points = spark.createDataFrame([(1, [0.0]), (2, [1.0])], "id bigint, vec array<double>")
    assert [tuple(r)[:2] for r in neighbours.nearest_neighbours(points, 5).orderBy("id").collect()] == [(1, 2), (2, 1)]


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(1)
    rows = [(i, 0, [float(x) for x in rng.normal(size=2)]) for i in range(200)]
    rare = rng.normal(loc=30, size=(31, 2))
    rare[:10] = rare[0]  # a third of the rare class are copies of one row
    rows += [(1000 + i, 1, [float(x) for x in v]) for i, v in enumerate(rare)]
    out = neighbours.smote(spark.createDataFrame(rows, "id int, label int, vec array<double>"), "label", "vec").collect()
    made = np.array([r["vec"] for r in out if r["synthetic"]])
    assert sum(r["label"] for r in out) == 200 and len(made) == 169
    for point in made:
        on_a_line = False
        for a in rare:
            for b in rare:
                span = b - a
                length = span @ span
                u = 0.0 if length == 0 else (point - a) @ span / length
                on_a_line |= -1e-9 <= u <= 1 and np.allclose(a + u * span, point, atol=1e-9)
        assert on_a_line


def test_smote_balances_every_class(spark):
    rng = np.random.default_rng(3)
    rows = [(c, [float(x) for x in rng.normal(loc=10 * c, size=2)]) for c, n in ((0, 6), (1, 9), (2, 48)) for _ in range(n)]
    frame = spark.createDataFrame(rows, "label int, vec array<double>")
    made = neighbours.smote(frame, "label", "vec")
    assert {r["label"]: r["count"] for r in made.groupBy("label").count().collect()} == {0: 48, 1: 48, 2: 48}
    assert all(abs(r.vec[0] - 10 * r.label) < 6 for r in made.filter("synthetic = 1").collect())
    with pytest.raises(ValueError):
        neighbours.smote(spark.createDataFrame([(None, [1.0]), (1, [1.0])], "label int, vec array<double>"), "label", "vec")


@pytest.mark.parametrize("block", [25, 4096])
def test_neighbours_within_groups_match_brute_force(spark, block):
    """Overlapping groups, one with most rows and a dense cluster, one with two rows, one with one."""
    rng = np.random.default_rng(8)
    groups = np.array([3] * 200 + [1] * 60 + [7] * 2 + [4])
    vectors = rng.normal(scale=5, size=(len(groups), 2))
    vectors[:90] = vectors[0] + rng.normal(scale=1e-3, size=(90, 2))
    rows = [(i, int(g), [float(x) for x in v]) for i, (g, v) in enumerate(zip(groups, vectors))]
    points = spark.createDataFrame(rows, "id bigint, g int, vec array<double>")
    got = {}
    for r in neighbours.nearest_neighbours(points, 5, block, group="g").orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    expected = {}
    for g in np.unique(groups):
        ids = np.flatnonzero(groups == g)
        expected |= {i: n for i, n in brute_force(vectors[ids], [int(i) for i in ids], 5).items() if n}
    assert got == expected
    assert neighbours.nearest_neighbours(points.limit(0), 5, block, group="g").count() == 0


def test_smote_of_many_classes_is_that_of_each_in_as_many_jobs(spark):
    """A class gets the same rows whether others are there or not, and more classes need no more jobs."""
    rng = np.random.default_rng(4)
    rows = [(c, [float(x) for x in rng.normal(scale=3, size=2)]) for c, n in enumerate((50, 7, 11, 1, 23, 50, 19)) for _ in range(n)]

    def balanced(classes):
        frame = spark.createDataFrame([r for r in rows if r[0] in classes], "label int, vec array<double>")
        name = f"smote-{len(classes)}"
        spark.sparkContext.setJobGroup(name, name)
        try:
            made = neighbours.smote(frame, "label", "vec").filter("synthetic = 1").collect()
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return sorted((r["label"], tuple(r["vec"])) for r in made), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))

    together, jobs = balanced(range(7))
    alone = []
    for c in (1, 2, 3, 4, 6):
        found, single = balanced({0, c})
        alone += found
    assert together == sorted(alone)
    assert {c: sum(label == c for label, _ in together) for c in range(7)} == {0: 0, 1: 43, 2: 39, 3: 49, 4: 27, 5: 0, 6: 31}
    assert 0 < jobs <= single / 5 * 1.5  # the five runs of two classes share a job group


def test_folds_keep_the_class_shares(spark):
    df = spark.range(503).select("id", (F.col("id") % 10 == 0).cast("double").alias("label"), F.col("id").cast("double").alias("x"))
    sample = training.bounded_sample(df, ["x"], ["id"], training.Search(1))
    counts = {(y, k): int(((sample.y == y) & (sample.fold == k)).sum()) for y in (0, 1) for k in range(5)}
    assert all(counts[0, k] in (90, 91) and counts[1, k] in (10, 11) for k in range(5))
    less = training.bounded_sample(df.repartition(3), ["x"], ["id"], training.Search(1, fit_rows=100))
    again = training.bounded_sample(df.repartition(7), ["x"], ["id"], training.Search(1, fit_rows=100))
    assert len(less.y) in (100, 101) and less.y.sum() in (10, 11) and (less.x == again.x).all() and (less.fold == again.fold).all()
    assert less.scale == pytest.approx(np.std(np.arange(503)))  # over all rows, not the sample


def test_split_is_exact_and_stable(spark):
    df = spark.range(1003).withColumn("y", (F.col("id") % 10 == 0).cast("int"))
    split = prep.stratified_split(df, "y", ["id"])
    counts = {(r["y"], r["is_train"]): r["count"] for r in split.groupBy("y", "is_train").count().collect()}
    assert counts == {(0, 1): 722, (0, 0): 180, (1, 1): 81, (1, 0): 20}
    again = prep.stratified_split(df.repartition(7), "y", ["id"])
    assert split.exceptAll(again).isEmpty()


def test_encoding_and_scaling(spark):
    df = spark.createDataFrame([("b", 1.0, 5.0), ("a", 3.0, 5.0), (None, 5.0, 5.0)], "s string, x double, c double")
    codes = prep.label_codes(df, "s")
    assert {r["value"]: r["code"] for r in codes.collect()} == {"a": 0, "b": 1, "unknown": 2}
    new = spark.createDataFrame([("b",), ("zz",), (None,)], "s string")
    assert sorted(r["e"] for r in prep.label_encode(new, "s", codes, "e").collect()) == [0, 1, 2]
    scaled = prep.standardize(df, ["x", "c"]).collect()
    assert [r["x"] for r in scaled] == pytest.approx([-1.2247448, 0, 1.2247448]) and {r["c"] for r in scaled} == {0.0}


SCORES = [(1, 0.9), (1, 0.8), (0, 0.8), (1, 0.6), (0, 0.55), (1, 0.55), (0, 0.3), (0, 0.3), (1, 0.3), (0, 0.1)]


@pytest.fixture(scope="module")
def scored(spark):
    return spark.createDataFrame(SCORES, "label int, probability double")


def test_auc_counts_ties_half(scored):
    pos, neg = [p for y, p in SCORES if y], [p for y, p in SCORES if not y]
    want = np.mean([1.0 if a > b else 0.5 if a == b else 0.0 for a in pos for b in neg])
    assert evaluate.roc_auc(scored).first()["roc_auc"] == pytest.approx(want)
    curve = evaluate.roc_curve(scored).orderBy("fpr", "tpr").toPandas()
    assert np.trapezoid(curve["tpr"], curve["fpr"]) == pytest.approx(want)
    assert curve["tpr"].is_monotonic_increasing


def test_auc_agrees_with_spark_ml(spark, scored):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    ml = BinaryClassificationEvaluator(rawPredictionCol="probability", labelCol="label", numBins=0)
    assert evaluate.roc_auc(scored).first()[0] == pytest.approx(ml.evaluate(scored.withColumn("label", F.col("label").cast("double"))))


def test_threshold_search_matches_loop(scored):
    y, p = np.array([s[0] for s in SCORES]), np.array([s[1] for s in SCORES])
    best, found = -1.0, None
    for t in np.arange(0.2, 0.8, 0.01):
        balance = min(np.mean(p[y == 0] < t), np.mean(p[y == 1] >= t))
        if balance > best:
            best, found = balance, t
    row = evaluate.threshold_balanced(scored).first()
    assert (row["threshold"], row["balance"]) == (pytest.approx(found), pytest.approx(best))
    assert evaluate.threshold_target_recall(scored).first()[0] == 0.1
    low = scored.withColumn("probability", F.lit(0.05))
    assert evaluate.threshold_target_recall(low).first()[0] == 0.5


def test_grid_ties(spark):
    grid = evaluate.BALANCE_GRID
    df = spark.createDataFrame([(float(t),) for t in grid] + [(float(np.nextafter(t, 0)),) for t in grid] + [(0.0,), (1.0,)], "p double")
    got = [r[0] for r in df.select(evaluate._grid_points_up_to(F.col("p"), grid)).collect()]
    assert got == [sum(g <= r["p"] for g in grid) for r in df.collect()]


def test_report_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "label int, prediction int")
    rows = {r["name"]: r for r in evaluate.classification_report(df, ["No", "Yes"]).collect()}
    assert rows["Yes"]["precision"] == 0 and rows["No"]["recall"] == 1 and rows["accuracy"]["f1"] == 0.5
    assert rows["macro avg"]["f1"] == pytest.approx(1 / 3) and rows["weighted avg"]["support"] == 2


@pytest.fixture(scope="module")
def planted(spark):
    """Line plus the 30.5-day wave, three series of 36 months."""
    months = pd.date_range("2015-01-01", periods=36, freq="MS")
    day = (months - pd.Timestamp("1970-01-01")).days.to_numpy()
    rows = []
    for s, slope in (("a", 5.0), ("b", 0.0), ("c", -2.0)):
        y = 1000 + slope * np.arange(36) + 20 * np.sin(2 * np.pi * day / 30.5)
        rows += [(s, m.date(), float(v), 10 + i, 20, 30, i + 1) for i, (m, v) in enumerate(zip(months, y))]
    df = spark.createDataFrame(rows, "series_key string, ds date, y double, n_sellers long, n_products long, n_orders long, month_num long")
    from pyspark.sql import Window as W

    from storelens.functions.numeric import min_max_scale

    w = W.partitionBy("series_key")
    return df.withColumns({f"{c}_norm": min_max_scale(F.col(c), F.min(c).over(w), F.max(c).over(w)) for c in features.REGRESSORS})


def test_forecast_recovers_planted_series(planted):
    out = forecast.forecast(planted, 6).toPandas()
    past = out[out["y"].notna()]
    assert (past["yhat"] - past["y"]).abs().max() < 15
    ahead = out[out["y"].isna()].sort_values("ds")
    assert len(ahead) == 18 and (ahead["yhat_lower"] < ahead["yhat"]).all()
    assert ahead[ahead["series_key"] == "a"]["yhat"].iloc[-1] == pytest.approx(1000 + 5 * 41, rel=0.06)
    width = ahead[ahead["series_key"] == "a"]["yhat_upper"] - ahead[ahead["series_key"] == "a"]["yhat_lower"]
    assert width.is_monotonic_increasing


def test_forecast_scores_and_cv(planted):
    scores = forecast.score_forecast(forecast.fit(planted), planted, 3).collect()
    assert sorted({r["month"] for r in scores}) == ["2018-01", "2018-02", "2018-03"] and len(scores) == 9
    errors = forecast.rolling_origin(planted)
    assert errors.agg(F.max("horizon")).first()[0] <= 90 and errors.select("cutoff").distinct().count() == 15
    assert all(r["mape"] < 0.1 for r in forecast.forecast_cv(planted).collect())
    short = planted.filter("month_num <= 12")
    assert {r["mae"] for r in forecast.forecast_cv(short).collect()} == {0.0}
    with pytest.raises(ValueError):
        forecast.score_forecast(forecast.fit(planted), planted, 13)


def test_single_month_series(planted):
    one = planted.filter("month_num = 1")
    assert forecast.forecast(one, 2).count() == 9


def test_regressor_projection_matches_polyfit(planted):
    got = features.project_regressors(planted.filter("series_key = 'a'"), 4).orderBy("months_ahead").toPandas()
    recent = np.arange(40, 46, dtype=float)
    slope, intercept = np.polyfit(np.arange(6), recent, 1)
    assert list(got["n_sellers"]) == pytest.approx([intercept + slope * (6 + i - 1) for i in range(1, 5)])
    assert list(got["month_num"]) == [37, 38, 39, 40] and got["n_sellers_norm"].max() <= 2


def test_random_draws_are_distinct_and_seeded():
    draws = training.random_draws(training.CHURN_GRID, 25)
    assert len({tuple(d.items()) for d in draws}) == 25 and draws == training.random_draws(training.CHURN_GRID, 25)
    assert len(training.random_draws({"max_depth": [1, 2]}, 25)) == 2


@pytest.fixture(scope="module")
def churn_rows(spark):
    """A planted signal: customers with long gaps churn."""
    base = spark.range(400).withColumns({c: ((F.col("id") * (i + 3) * 7919) % 101).cast("double") for i, c in enumerate(features.CHURN_FEATURES)})
    return base.withColumnRenamed("id", "customer_id").withColumns({
        "churned": (F.col("avg_days_between_orders") > 75).cast("int"), "sample_weight": F.lit(1.0) + F.col("monetary") / 100,
    })


TINY = training.Search(n_iter=2, folds=2)
SMALL = {**{k: v[:1] for k, v in training.CHURN_GRID.items()}, "n_estimators": [5, 10], "learning_rate": [0.3]}
SMALL_FOREST = {"n_estimators": [3, 5], "max_depth": [3, None], "min_samples_split": [2]}


def test_train_save_score_churn(spark, churn_rows, tmp_path):
    trained = training.train_churn(churn_rows, TINY, grid=SMALL)
    assert trained.metrics["roc_auc"] > 0.8 and trained.metrics["cv_test_gap"] == trained.metrics["cv_auc"] - trained.metrics["roc_auc"]
    top = training.feature_importance(spark, trained.model, features.CHURN_FEATURES, 1).first()
    assert top["feature"] == "avg_days_between_orders"
    path = str(tmp_path / "churn")
    training.save_model(trained.model, path)
    loaded = training.load_model(path)
    a = scoring.score_churn(trained.model, churn_rows, ["customer_id"])
    assert a.exceptAll(scoring.score_churn(loaded, churn_rows, ["customer_id"])).isEmpty()
    request = spark.createDataFrame([(1, 3.0, 50.0)], "customer_id long, frequency double, monetary double")
    answer = scoring.score_churn(loaded, request, ["customer_id"]).first()
    assert answer["churned"] == int(answer["churn_probability"] >= 0.5) and answer["risk_level"] in ("High", "Medium", "Low")
    log = str(tmp_path / "log")
    training.log_metrics(spark, log, "r1", trained.name, {"smote": True}, trained.metrics)
    training.log_metrics(spark, log, "r2", trained.name, {}, {"roc_auc": 0.5})
    assert training.read_metrics(spark, log).filter("key = 'roc_auc'").count() == 2


def test_value_weighted_training(churn_rows):
    assert training.train_churn(churn_rows, TINY, use_value_weights=True, grid=SMALL).metrics["roc_auc"] > 0.8


def test_derived_request_fields(spark):
    bare = spark.createDataFrame([(1, 100.0, 25.0, 12, 4)], "id int, price double, freight_value double, order_month int, order_quarter int")
    row = scoring.derive_delivery(bare).first()
    assert (row["cross_state"], row["freight_ratio"], row["volume_cm3"], row["peak_season"], row["weight_g"]) == (0, 0.2, 3000.0, 1, 500.0)
    free = spark.createDataFrame([(1, 0.0, 0.0, 15.0, 0.0), (2, 300.0, 0.0, 8.0, 3.0)],
                                 "id int, price double, freight_value double, delivery_delay_days double, payment_installments double")
    rows = scoring.derive_sentiment(free).orderBy("id").collect()
    assert (rows[0]["freight_ratio"], rows[0]["price_per_installment"], rows[0]["very_very_late"]) == (0.0, 0.0, 1)
    assert (rows[1]["price_per_installment"], rows[1]["late_and_expensive"], rows[1]["very_late"]) == (100.0, 1, 1)


def test_unseen_state_is_code_zero(spark):
    seen = spark.createDataFrame([("RJ", "SP"), ("SP", None)], "customer_state string, seller_state string")
    indexer = training._state_indexer(seen)
    got = training.encode_states(indexer, spark.createDataFrame([("SP", "XX"), ("ZZ", None)], "customer_state string, seller_state string"))
    assert [(r["customer_state_enc"], r["seller_state_enc"]) for r in got.collect()] == [(1.0, 0.0), (0.0, 1.0)]


def test_forecast_run_is_recorded(spark, tmp_path):
    months = pd.date_range("2019-01-01", periods=30, freq="MS")
    rows = [("a", d.date(), 100.0 + 3 * i, i % 4 + 1, i % 5 + 1, i % 6 + 1, i + 1, (i % 4) / 3, (i % 5) / 4, (i % 6) / 5, i / 29) for i, d in enumerate(months)]
    columns = "series_key string, ds date, y double, n_sellers bigint, n_products bigint, n_orders bigint, month_num bigint, n_sellers_norm double, n_products_norm double, n_orders_norm double, month_num_norm double"
    predicted = forecast.record_forecast(spark.createDataFrame(rows, columns), str(tmp_path / "metrics"), str(tmp_path / "csv"), "run1")
    logged = {(r.kind, r.key): r.value for r in training.read_metrics(spark, str(tmp_path / "metrics")).collect()}
    assert {k for kind, k in logged if kind == "metric"} == {"mae", "rmse", "mape"} and logged["param", "periods"] == "6" and logged["param", "series"] == "1"
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == predicted.count() == 36


def test_registered_training_searches_in_full(monkeypatch):
    from storelens import registry

    searches = {}
    monkeypatch.setattr(registry, "_once", lambda w, name, build: build())
    for name in ("_churn_labelled", "_delivery"):
        monkeypatch.setattr(registry, name, lambda w: None)
    monkeypatch.setattr(registry.features, "sentiment_features", lambda fact: None)
    for name in ("churn", "delivery", "sentiment"):
        monkeypatch.setattr(registry.training, f"train_{name}", lambda rows, search, name=name: searches.update({name: search}))
    for model in (registry._churn_model, registry._delivery_model, registry._sentiment_model):
        model(type("Warehouse", (), {"fact_orders": None}))
    assert {n: (s.n_iter, s.folds, s.fit_rows) for n, s in searches.items()} == {"churn": (25, 5, 6000), "delivery": (15, 5, 6000), "sentiment": (15, 5, 6000)}


def test_a_query_is_sent_to_few_bundles_however_many_cells(spark, monkeypatch):
    """Where nothing can be pruned, points are sent to a bounded number of bundles, and neighbours are still exact."""
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(1200, 24))
    vectors[1] = vectors[0] + 1e-9
    points = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id bigint, vec array<double>")
    asked, tiles = [], neighbours._tiles

    def counted(queries, *rest):
        asked.append(queries.count())
        return tiles(queries, *rest)

    monkeypatch.setattr(neighbours, "_tiles", counted)
    monkeypatch.setattr(neighbours, "SIDES", 4)
    got = {}
    for r in neighbours.nearest_neighbours(points, 5, 8).orderBy("id", "rank").collect():
        got.setdefault(r["id"], []).append(r["neighbour"])
    assert got == brute_force(vectors, list(range(1200)), 5)
    assert asked[0] == 1200 and asked[1] <= 1200 * 2 * 4 < 1200 * neighbours.n_pivots(1200, 8) / 4


def test_sides_of_a_comparison_grow_with_the_table_and_fit_a_task():
    assert [neighbours.tile_rows(n, 64) for n in (100, 100_000, 600_000, 10**9)] == [1024, 4167, 25_000, 32_768]
    assert neighbours.tile_rows(10**9, 7) == 1 << 16


def test_points_without_finite_distance_have_no_such_neighbour(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 0.0]), (2, [float("inf"), 0.0]), (3, [0.0, 3.0])]
    found = neighbours.nearest_neighbours(spark.createDataFrame(rows, "id bigint, vec array<double>"), 2).orderBy("id", "rank").collect()
    assert [(r["id"], r["neighbour"]) for r in found] == [(0, 1), (0, 3), (1, 0), (1, 3), (3, 0), (3, 1)]


@pytest.mark.parametrize("block", [8, 1024])
def test_rows_with_equal_vectors_are_neighbours(spark, block):
    """Copies of a vector, rows that come twice, and an id with several vectors: the nearest of all pairs of rows with different ids."""
    rng = np.random.default_rng(12)
    vectors = rng.integers(0, 4, (90, 2)).astype(float) * [1, 7]
    vectors[:25] = vectors[0]
    ids = rng.permutation(90).tolist()
    ids[40], ids[60] = ids[3], ids[50]
    rows = [(i, v.tolist()) for i, v in zip(ids, vectors)]
    rows[70] = (ids[70], None)
    rows += rows[30:45] + [(None, [0.0, 0.0])]
    want = []
    for one in {i for i, v in rows if i is not None}:
        pairs = [(float(np.hypot(*(np.subtract(a, b)))) if a and b else np.inf, j) for i, a in rows if i == one for j, b in rows if j not in (one, None)]
        want += [(one, j, round(d, 6), k + 1) for k, (d, j) in enumerate(sorted(pairs)[:5])]
    frame = spark.createDataFrame(rows, "id bigint, vec array<double>")
    got = neighbours.row_neighbours(frame, "id", "vec", 5, block)
    assert sorted((r["id"], r["neighbour"], np.inf if r["distance"] is None else round(r["distance"], 6), r["rank"]) for r in got.collect()) == sorted(want)
    few = neighbours.row_neighbours(frame.where(f"id = {ids[5]} or vec is null or id = {ids[80]}"), "id", "vec", 5, block).orderBy("id", "rank").collect()
    assert {(r["id"], r["neighbour"], r["distance"] is None) for r in few} == {(i, j, ids[70] in (i, j)) for i in (ids[5], ids[70], ids[80]) for j in (ids[5], ids[70], ids[80]) if i != j}
