"""Sparse slope changes and simulated intervals of the forecast."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from storelens.plans import forecast


def _design(n: int, bends: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Columns as the module orders them: level, slope, bends, six waves, three regressors (none here)."""
    t = np.arange(n) / (n - 1)
    past = int(n * forecast.HISTORY_SHARE)
    points = t[np.round(np.arange(1, bends + 1) * (past - 1) / bends).astype(int)]
    waves = [f(2 * np.pi * k * t * 80) for k in (1, 2, 3) for f in (np.sin, np.cos)]
    x = np.column_stack([np.ones(n), t, np.maximum(t[:, None] - points, 0), *waves, np.zeros((n, 3))])
    return t, points, x


def test_two_planted_changes_are_the_two_found():
    t, points, x = _design(120)
    rng = np.random.default_rng(3)
    y = 0.2 + 0.3 * t + 1.5 * np.maximum(t - points[6], 0) - 2.5 * np.maximum(t - points[16], 0) + rng.normal(0, 0.004, len(t))
    coef, noise = forecast.fit_series(x, y / np.abs(y).max(), 25)
    changes = coef[2:27] * np.abs(y).max()
    large = np.flatnonzero(np.abs(changes) > 0.3)
    assert (changes == 0).sum() >= 18
    assert {6, 16} <= {int(j + o) for j in large for o in (-1, 0, 1)} and np.abs(large[:, None] - [6, 16]).min(axis=1).max() <= 1
    assert changes[5:8].sum() == pytest.approx(1.5, abs=0.3) and changes[15:18].sum() == pytest.approx(-2.5, abs=0.3)
    assert noise < 0.05


def test_changes_on_a_straight_line_are_all_zero():
    t, _, x = _design(60)
    coef, _ = forecast.fit_series(x, 0.1 + 0.8 * t, 25)
    assert (coef[2:27] == 0).all()


@pytest.mark.parametrize("n", [18, 24, 90])
@pytest.mark.parametrize("seed", range(4))
def test_fit_meets_its_optimality_conditions(n, seed):
    rng = np.random.default_rng(seed)
    bends = min(25, int(n * 0.8) - 1)
    t, _, x = _design(n, bends)
    x[:, -3:] = rng.random((n, 3))
    y = np.cumsum(rng.normal(0, 0.1, n)) + rng.normal(0, 0.05, n)
    y /= np.abs(y).max()
    coef, noise = forecast.fit_series(x, y, bends)
    change = np.zeros(x.shape[1], bool)
    change[2 : 2 + bends] = True
    prior = np.full(x.shape[1], forecast.REST_SCALE**-2)
    prior[:2] = forecast.BASE_SCALE**-2
    pull = x.T @ (y - x @ coef) / noise**2  # gradient of the likelihood
    assert np.abs(pull[~change] - prior[~change] * coef[~change]).max() < 1e-4 * max(1, np.abs(pull).max())
    lim = 1 / forecast.CHANGE_SCALE
    live = change & (coef != 0)
    assert np.abs(pull[live] - lim * np.sign(coef[live])).max(initial=0) < 1e-3 * lim
    assert np.abs(pull[change]).max() <= lim * (1 + 1e-3)
    if noise > forecast.LEAST_NOISE * 1.01:
        squares = ((y - x @ coef) ** 2).sum()
        assert n / noise - squares / noise**3 + noise / forecast.NOISE_SCALE**2 == pytest.approx(0, abs=1e-2 * n / noise)


def _model(spark, n_series: int, noise: float, bend: float, bends: int = 20):
    """Flat series with known noise and size of changes; 40 months of history end on 2020-01-01."""
    points = F.array(*[F.lit(0.8 * (j + 1) / bends) for j in range(bends)])
    coef = F.array(F.lit(1.0), *[F.lit(0.0)] * (1 + bends + 9))
    return spark.range(n_series).select(
        F.concat(F.lit("s"), F.col("id")).alias("series_key"), F.lit("2016-10-01").cast("date").alias("start"), F.lit(1187).alias("span"),
        points.alias("points"), F.lit(10.0).alias("scale"), coef.alias("coef"), F.lit(noise).alias("noise"), F.lit(bend).alias("bend_size"))


def _months(spark, model, dates):
    days = spark.createDataFrame([(d,) for d in dates], "d string").select(F.col("d").cast("date").alias("ds"))
    frame = model.select("series_key").crossJoin(days)
    return frame.withColumns({c: F.lit(0.0) for c in forecast.USED})


def test_intervals_cover_planted_futures(spark):
    """Futures drawn by numpy from the process itself: 95 % of them, within two points, lie inside."""
    noise, bend, bends = 0.02, 0.3, 20
    model = _model(spark, 20, noise, bend, bends)
    dates = ["2020-02-01", "2020-04-01", "2020-07-01", "2021-01-01"]
    got = forecast.predict(model, _months(spark, model, dates)).toPandas()
    rng = np.random.default_rng(1)
    for day, rows in got.groupby("ds"):
        t = (day - np.datetime64("2016-10-01").astype(object)).days / 1187
        draws = 10 * (1 + rng.normal(0, noise, 20000))
        counts = rng.poisson(bends * (t - 1), 20000)
        for k in range(20000):
            at, size = rng.uniform(1, t, counts[k]), rng.laplace(0, bend, counts[k])
            draws[k] += 10 * ((t - at) * size).sum()
        inside = [((draws >= r.yhat_lower) & (draws <= r.yhat_upper)).mean() for r in rows.itertuples()]
        assert abs(np.mean(inside) - 0.95) < 0.01 and min(inside) > 0.91


def test_intervals_repeat_and_history_has_noise_only(spark):
    model = _model(spark, 6, 0.05, 0.4)
    frame = _months(spark, model, ["2019-06-01", "2020-01-01", "2020-06-01"])
    a = forecast.predict(model, frame.repartition(7)).orderBy("series_key", "ds").collect()
    b = forecast.predict(model.coalesce(1), frame.coalesce(1)).orderBy("series_key", "ds").collect()
    assert a == b
    past = [r for r in a if str(r["ds"]) <= "2020-01-01"]
    assert all(r["yhat_upper"] - r["yhat"] == pytest.approx(10 * 0.05 * 1.959964, rel=1e-6) for r in past)
    assert len({r["yhat_upper"] for r in a if str(r["ds"]) == "2020-06-01"}) == 6  # series have draws of their own


def test_intervals_without_room_for_changes(spark):
    model = _model(spark, 2, 0.05, 0.0).withColumn("points", F.array().cast("array<double>")).withColumn("coef", F.array(*[F.lit(1.0), *[F.lit(0.0)] * 10]))
    rows = forecast.predict(model, _months(spark, model, ["2020-06-01"])).collect()
    assert all(r["yhat"] == 10 and r["yhat_upper"] == pytest.approx(10 + 10 * 0.05 * 1.959964) for r in rows)


@pytest.mark.parametrize("noise", [0.5, 0.01, 1e-6])
def test_quantiles_of_paths_with_noise(spark, noise):
    """Against bisection on the same mixture in Python, also where the noise is far smaller than the steps between paths."""
    from statistics import NormalDist

    rng = np.random.default_rng(5)
    drifts = rng.laplace(0, 0.2, 190).tolist()  # 4.75 of them below the quantile: it lies within a step, not on a flat stretch
    df = spark.createDataFrame([(drifts, noise)], "_drifts array<double>, noise double")
    got = df.select(forecast._quantile(0.025, 190).alias("low"), forecast._quantile(0.975, 190).alias("high")).first()
    for p, value in ((0.025, got.low), (0.975, got.high)):
        low, high = -10.0, 10.0
        for _ in range(100):
            middle = (low + high) / 2
            share = np.mean([NormalDist(d, noise).cdf(middle) for d in drifts])
            low, high = (middle, high) if share < p else (low, middle)
        assert value == pytest.approx(low, abs=max(1e-4 * noise, 1e-5 if noise < 1e-3 else 0))


def test_months_are_added_up_from_the_fact_once(spark, stored):
    """What fits, validates and predicts reads the stored months, not the fact again."""
    from storelens.registry import _monthly

    plan = _monthly(stored)._jdf.queryExecution().executedPlan().toString()
    assert "ExistingRDD" in plan and "parquet" not in plan.lower()
