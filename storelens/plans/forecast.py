"""Monthly forecasts for any number of series at once.

Model per series: piecewise-linear trend whose slope changes have a Laplace prior, so that
most are exactly zero, a 30.5-day season of three harmonics, and three regressors. The
design row is a Spark expression used for fitting and for prediction alike; only the small
solve (one row per month of one series) runs in numpy. Intervals of future months are
quantiles over simulated paths whose draws come from hashes, all in expressions.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.numeric import round_to
from storelens.plans.evaluate import forecast_metrics
from storelens.plans.features import future_frame
from storelens.plans.training import log_metrics
from storelens.session import materialize
from storelens.sources.warehouse import bounded_n, write_csv

# Season length and order, trend flexibility, interval width, CV windows in days.
PERIOD, ORDER = 30.5, 3
CHANGEPOINTS, HISTORY_SHARE, CHANGE_SCALE = 25, 0.8, 0.1
WIDTH = 0.95
PATHS = 1000
BASE_SCALE, REST_SCALE, NOISE_SCALE = 5.0, 10.0, 0.5
INITIAL, STEP, HORIZON = 540, 30, 90
USED = ["n_sellers_norm", "n_products_norm", "month_num_norm"]

# Least noise that a fit assumes, as a share of the largest value: below it, a short series would be interpolated.
LEAST_NOISE = 0.01
_SWEEPS, _ROUNDS = 2000, 50


def _frame_of(history: DataFrame, keys: list[str]) -> DataFrame:
    """Time origin, span, scale and changepoints of each series."""
    spec = history.groupBy(*keys).agg(
        F.min("ds").alias("start"),
        F.greatest(F.datediff(F.max("ds"), F.min("ds")), F.lit(1)).alias("span"),
        F.array_sort(F.collect_list("ds")).alias("days"),  # one entry per month
        F.max(F.abs("y")).alias("largest"),
    )
    past = F.floor(F.size("days") * F.lit(HISTORY_SHARE)).cast("int")
    spec = spec.withColumn("past", past).withColumn("changes", F.least(F.lit(CHANGEPOINTS), F.col("past") - 1))
    points = F.expr(
        "CASE WHEN changes >= 1 THEN transform(sequence(1, changes), j -> "
        "datediff(days[cast(round(j * (past - 1) / changes) AS int)], start) / span) ELSE cast(array() AS array<double>) END"
    )
    return spec.select(
        *keys, "start", "span", points.alias("points"), F.when(F.col("largest") > 0, F.col("largest")).otherwise(1.0).alias("scale")
    )


def _design() -> Column:
    """level, slope, slope changes, harmonics, regressors."""
    t = F.datediff("ds", "start") / F.col("span")
    day = F.datediff("ds", F.lit("1970-01-01").cast("date"))
    waves = [f(day * (2 * math.pi * k / PERIOD)) for k in range(1, ORDER + 1) for f in (F.sin, F.cos)]
    bends = F.transform("points", lambda p: F.greatest(t - p, F.lit(0.0)))
    return F.concat(F.array(F.lit(1.0), t), bends, F.array(*waves, *[F.coalesce(c, F.lit(0.0)) for c in USED]))


def _sparse_changes(gram: np.ndarray, target: np.ndarray, threshold: float, start: np.ndarray) -> np.ndarray:
    """The d that minimises d'Gd / 2 - c'd + threshold * |d|, by coordinate descent with a soft threshold.

    Neighbouring bends are nearly collinear, so sweeps alone end slowly: every few sweeps the equations of the
    non-zero changes are solved as they stand, and the solution is taken once it meets the optimality conditions.
    """
    d = start.copy()
    size = np.diag(gram)
    slack = 1e-9 * max(threshold, float(np.abs(target).max(initial=0.0)), 1e-12)
    for sweep in range(_SWEEPS):
        moved = 0.0
        for j in np.flatnonzero(size > 0):
            pull = target[j] - gram[j] @ d + size[j] * d[j]
            new = math.copysign(max(abs(pull) - threshold, 0.0), pull) / size[j]
            moved, d[j] = max(moved, abs(new - d[j])), new
        if sweep % 5 == 4 or moved == 0:
            live = np.flatnonzero(d)
            exact = np.zeros_like(d)
            sign = np.sign(d[live])
            exact[live] = np.linalg.lstsq(gram[np.ix_(live, live)], target[live] - threshold * sign, rcond=None)[0]
            rest = target - gram @ exact
            if (np.sign(exact[live]) == sign).all() and np.abs(rest[live] - threshold * sign).max(initial=0.0) <= slack and (np.abs(rest) <= threshold + slack).all():
                return exact
        if moved <= 1e-13:
            break
    return d


def fit_series(x: np.ndarray, y: np.ndarray, bends: int) -> tuple[np.ndarray, float]:
    """Most probable coefficients and noise of one series (``y`` as a share of its largest value).

    Columns 2 to 2 + ``bends`` of ``x`` are slope changes (Laplace prior), the others have normal priors and are
    eliminated exactly, so the descent runs over the changes alone. The noise has a half-normal prior; starting
    above every possible value, coefficients and noise take turns, which ends at the largest noise that explains itself.
    """
    change = np.zeros(x.shape[1], bool)
    change[2 : 2 + bends] = True
    z, b = x[:, ~change], x[:, change]
    prior = np.full(z.shape[1], REST_SCALE**-2)
    prior[:2] = BASE_SCALE**-2
    variance, d = 1.0, np.zeros(bends)
    for _ in range(_ROUNDS):
        solve = np.linalg.solve(z.T @ z + variance * np.diag(prior), z.T)
        apart = b - z @ (solve @ b)  # what the other columns cannot take over
        d = _sparse_changes(b.T @ apart, apart.T @ y, variance / CHANGE_SCALE, d)
        rest = solve @ (y - b @ d)
        squares = float(((y - b @ d - z @ rest) ** 2).sum())
        # root of 0 = n / noise - squares / noise^3 + noise / NOISE_SCALE^2, written without cancellation
        n, curve = len(y), NOISE_SCALE**-2
        found = max(2 * squares / (n + math.sqrt(n * n + 4 * curve * squares)), LEAST_NOISE**2)
        done = variance - found <= 1e-6 * variance
        if done:
            break
        variance = found
    coef = np.empty(x.shape[1])
    coef[change], coef[~change] = d, rest
    return coef, math.sqrt(variance)


def _solve(keys: list[str]):
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ds")
        bends = len(rows["points"].iloc[0])
        coef, noise = fit_series(np.stack(rows["x"].to_numpy()), rows["y"].to_numpy(dtype="float64") / rows["scale"].iloc[0], bends)
        # changes that were found to be zero do not prove that none will come: the prior counts as one more change
        bend_size = (float(np.abs(coef[2 : 2 + bends]).sum()) + CHANGE_SCALE) / (bends + 1)
        out = {k: [rows[k].iloc[0]] for k in keys}
        return pd.DataFrame({**out, "coef": [coef.tolist()], "noise": [noise], "bend_size": [bend_size]})

    return fit


def fit(history: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """One coefficient row per series; the months of a series are one small group."""
    keys = keys or ["series_key"]
    spec = _frame_of(history, keys)
    rows = history.filter(F.col("y").isNotNull()).join(spec, keys).withColumn("x", _design()).select(*keys, "ds", "y", "scale", "points", "x")
    key_schema = ", ".join(f"{k} {history.schema[k].dataType.simpleString()}" for k in keys)
    solved = rows.groupBy(*keys).applyInPandas(_solve(keys), f"{key_schema}, coef array<double>, noise double, bend_size double")
    return spec.join(solved, keys)


def _draw(*parts: Column) -> Column:
    """Repeatable number within (0, 1) from the given values."""
    return (F.shiftrightunsigned(F.xxhash64(*parts), 11) + 0.5) / float(1 << 53)


def _density(x: Column) -> Column:
    return F.exp(-x * x / 2) / math.sqrt(2 * math.pi)


def _below(x: Column) -> Column:
    """The normal distribution function within 1e-7 (Abramowitz and Stegun, formula 26.2.17, whose constants these are)."""
    k = 1 / (1 + 0.2316419 * F.abs(x))
    tail = _density(x) * k * (0.319381530 + k * (-0.356563782 + k * (1.781477937 + k * (-1.821255978 + k * 1.330274429))))
    return F.when(x > 0, 1 - tail).otherwise(tail)


def _drifts(t: Column, keys: list[str], paths: int) -> Column:
    """What the slope changes of each simulated path have added to the trend by time ``t`` (1: end of the history).

    After the history, slope changes arrive as a Poisson process with as many in a span as the history has; their sizes
    are Laplace with the mean size of the fitted ones. A path is the same for all months of its series. The loop runs
    over more arrivals than can occur: the chance of missing one is below 1e-12.
    """
    rate = F.size("points").cast("double")
    expected = rate * F.greatest(t - 1, F.lit(0.0))
    arrivals = F.ceil(expected + 10 * F.sqrt(expected) + 20).cast("int")
    series = [F.col(k) for k in keys]

    def path(p: Column) -> Column:
        def step(state: Column, j: Column) -> Column:
            # the change that the step before placed at state.at takes effect, then the next one is placed
            u = _draw(*series, p, j, F.lit("size"))
            size = F.col("bend_size") * F.signum(u - 0.5) * -F.log(1 - 2 * F.abs(u - 0.5))
            effect = F.when((j > 0) & (state["at"] < t), (t - state["at"]) * size).otherwise(0.0)
            placed = F.when(state["at"] < t, state["at"] - F.log(_draw(*series, p, j, F.lit("gap"))) / rate).otherwise(state["at"])
            return F.struct(placed.alias("at"), (state["drift"] + effect).alias("drift"))

        return F.aggregate(F.sequence(F.lit(0), arrivals), F.struct(F.lit(1.0).alias("at"), F.lit(0.0).alias("drift")), step, lambda s: s["drift"])

    return F.transform(F.sequence(F.lit(1), F.lit(paths)), path)


def _quantile(p: float, paths: int) -> Column:
    """The p-quantile over the paths in ``_drifts``, each with normal noise about it: drawn changes, exact noise.

    Newton's steps within a bracket; every third step halves it, so a distribution in steps ends too.
    """
    spread = F.greatest(F.col("noise"), F.lit(1e-12))

    def state(low: Column, high: Column, at: Column, done: Column) -> Column:
        return F.struct(low.alias("low"), high.alias("high"), at.alias("at"), done.alias("done"))

    def measured(at: Column) -> Column:
        def add(s: Column, d: Column) -> Column:
            x = (at - d) / spread
            return F.struct((s["share"] + _below(x) / paths).alias("share"), (s["slope"] + _density(x) / spread / paths).alias("slope"))

        return F.aggregate("_drifts", F.struct(F.lit(0.0).alias("share"), F.lit(0.0).alias("slope")), add)

    def step(s: Column, i: Column) -> Column:
        def moved(found: Column) -> Column:
            low, high = F.when(found["share"] < p, s["at"]).otherwise(s["low"]), F.when(found["share"] < p, s["high"]).otherwise(s["at"])
            newton = s["at"] - (found["share"] - p) / F.greatest(found["slope"], F.lit(1e-300))
            close = F.abs(newton - s["at"]) <= 1e-7 * spread
            inside = (newton > low) & (newton < high) & (i % 3 != 0)
            return state(low, high, F.when(close | inside, newton).otherwise((low + high) / 2), close | (high - low <= 1e-7 * spread))

        return F.when(s["done"], s).otherwise(F.transform(F.array(measured(s["at"])), moved)[0])

    low, high = F.array_min("_drifts") - 8 * spread, F.array_max("_drifts") + 8 * spread
    mean = F.aggregate("_drifts", F.lit(0.0), lambda s, d: s + d) / paths
    return F.aggregate(F.sequence(F.lit(1), F.lit(90)), state(low, high, mean + NormalDist().inv_cdf(p) * spread, F.lit(False)), step, lambda s: s["at"])


def predict(model: DataFrame, frame: DataFrame, keys: list[str] | None = None, paths: int = PATHS) -> DataFrame:
    """yhat and its interval for every row of ``frame``.

    Within the history, and where a series has no place for slope changes, only the noise spreads the values, so the
    interval is the normal one. Later it is read off ``paths`` simulated paths (see ``_drifts``), whose draws
    depend on the series alone: the same rows under any partitioning.
    """
    keys = keys or ["series_key"]
    tail = (1 - WIDTH) / 2
    rows = frame.join(model, keys).withColumn("x", _design())
    value = F.aggregate(F.zip_with("coef", "x", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    t = F.datediff("ds", "start") / F.col("span")
    rows = rows.withColumn("_drifts", F.when((t > 1) & (F.size("points") > 0), _drifts(t, keys, paths)))

    def offset(p: float) -> Column:
        normal = F.col("noise") * NormalDist().inv_cdf(p)
        return F.when(F.col("_drifts").isNotNull(), _quantile(p, paths)).otherwise(normal) * F.col("scale")

    kept = [c for c in frame.columns if c not in USED]
    yhat = value * F.col("scale")
    return rows.select(*kept, yhat.alias("yhat"), (yhat + offset(tail)).alias("yhat_lower"), (yhat + offset(1 - tail)).alias("yhat_upper"))


def forecast(monthly: DataFrame, periods: int = 6) -> DataFrame:
    """Fit on the history and predict history and future."""
    monthly = materialize(monthly)
    return predict(fit(monthly), future_frame(monthly, periods))


def score_forecast(model: DataFrame, monthly: DataFrame, periods: int = 6) -> DataFrame:
    """The next months as (series_key, month, forecast, lower_bound, upper_bound)."""
    ahead = future_frame(monthly, bounded_n(periods, 1, 12, "periods")).filter(F.col("y").isNull())
    return predict(model, ahead).select(
        "series_key",
        F.date_format("ds", "yyyy-MM").alias("month"),
        round_to(F.col("yhat"), 2).alias("forecast"),
        round_to(F.col("yhat_lower"), 2).alias("lower_bound"),
        round_to(F.col("yhat_upper"), 2).alias("upper_bound"),
    )


def rolling_origin(monthly: DataFrame, initial: int = INITIAL, step: int = STEP, horizon: int = HORIZON) -> DataFrame:
    """Forecast errors from every cut-off: (series_key, cutoff, ds, horizon, y, yhat).

    Cut-offs go back in steps from one horizon before the end, as long as the initial
    window fits; every (series, cut-off) is fitted independently.
    """
    monthly = materialize(monthly)
    span = monthly.groupBy("series_key").agg(F.min("ds").alias("_from"), F.max("ds").alias("_to"))
    room = F.datediff("_to", "_from") - initial - horizon
    back = F.explode(F.sequence(F.lit(0), F.floor(room / step).cast("int")))
    cutoffs = span.filter(room >= 0).select("series_key", F.date_sub("_to", horizon).alias("_last"), back.alias("_k")).select(
        "series_key", F.date_sub("_last", F.col("_k") * step).alias("cutoff")
    )
    rows = monthly.select("series_key", "ds", "y", *USED).join(cutoffs, "series_key")
    keys = ["series_key", "cutoff"]
    model = fit(rows.filter(F.col("ds") <= F.col("cutoff")), keys)
    ahead = rows.filter((F.col("ds") > F.col("cutoff")) & (F.col("ds") <= F.date_add("cutoff", horizon)))
    return predict(model, ahead, keys).select(*keys, "ds", F.datediff("ds", "cutoff").alias("horizon"), "y", "yhat")


def forecast_cv(monthly: DataFrame, initial: int = INITIAL, step: int = STEP, horizon: int = HORIZON) -> DataFrame:
    """MAE, RMSE and MAPE per series, averaged over the horizons; zeros where no cut-off fits."""
    monthly = materialize(monthly)
    errors = rolling_origin(monthly, initial, step, horizon)
    per_horizon = forecast_metrics(errors, ["series_key", "horizon"])
    averaged = per_horizon.groupBy("series_key").agg(*[F.avg(m).alias(m) for m in ("mae", "rmse", "mape")])
    names = monthly.select("series_key").distinct()
    return names.join(averaged, "series_key", "left").na.fill(0.0, ["mae", "rmse", "mape"])


def fit_error(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """Absolute percent error of each month that has both values."""
    both = actual.select("series_key", "ds", "y").join(predicted.select("series_key", "ds", "yhat"), ["series_key", "ds"])
    return both.withColumn("error_pct", F.abs(F.col("yhat") - F.col("y")) / F.nullif(F.col("y"), F.lit(0.0)) * 100)


def record_forecast(monthly: DataFrame, metrics_path: str, csv_path: str, run_id: str, periods: int = 6) -> DataFrame:
    """Fit, validate and predict; append parameters and errors of the run to the metrics table, write the predicted rows as CSV.

    Errors are the means over the series. Returns the predicted rows.
    """
    spark = monthly.sparkSession
    monthly = materialize(monthly)
    predicted = materialize(forecast(monthly, periods))
    errors = forecast_cv(monthly).agg(F.count(F.lit(1)).alias("series"), *[F.avg(m).alias(m) for m in ("mae", "rmse", "mape")]).first()
    params = {"initial_days": INITIAL, "step_days": STEP, "horizon_days": HORIZON, "periods": periods, "series": errors["series"]}
    log_metrics(spark, metrics_path, run_id, "forecast", params, {m: errors[m] or 0.0 for m in ("mae", "rmse", "mape")})
    write_csv(predicted.select("series_key", "ds", "yhat", "yhat_lower", "yhat_upper"), csv_path)
    return predicted
