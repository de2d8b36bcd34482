"""Batch scoring: request tables in, probabilities and bands out.

Absent input columns are added as null; missing numbers count as zero after the request
defaults are applied.
"""

from __future__ import annotations

from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.functions.numeric import round_to
from storelens.functions.text import risk_band
from storelens.plans.features import CHURN_FEATURES, DELIVERY_FEATURES, SENTIMENT_FEATURES
from storelens.plans.prep import fill_zero
from storelens.plans.training import TreeModel, encode_states

# Defaults of the three request forms.
CHURN_DEFAULTS = {
    "avg_review_score": 4.0, "avg_freight_pct": 0.15, "avg_installments": 1.0, "late_deliveries": 0.0,
    "avg_delay_days": 0.0, "unique_categories": 1.0, "unique_products": 1.0,
}
DELIVERY_DEFAULTS = {
    "payment_installments": 1.0, "customer_state": "SP", "seller_state": "SP", "weight_g": 500.0,
    "length_cm": 20.0, "height_cm": 10.0, "width_cm": 15.0,
}
SENTIMENT_DEFAULTS = {
    "delivery_delay_days": 0.0, "payment_installments": 1.0, "is_delivered": 1, "order_month": 6, "order_quarter": 2,
}
DECISION = 0.5


class FormulaModel:
    """A model written down as weights: probability 1/2 + z / (2 (1 + |z|)) with z the weighted sum of features and a bias."""

    def __init__(self, weights: dict[str, float], bias: float):
        self.weights, self.bias = weights, bias

    def transform(self, df: DataFrame) -> DataFrame:
        z = F.lit(self.bias)
        for name, weight in self.weights.items():
            z = z + F.lit(weight) * F.col(name)
        p = F.lit(0.5) + z / (F.lit(1.0) + F.abs(z)) * F.lit(0.5)
        return df.withColumn("probability", array_to_vector(F.array(F.lit(1.0) - p, p)))


def scoring_inputs(requests: DataFrame, defaults: dict) -> DataFrame:
    """Fill missing request fields, whether null or absent."""
    absent = {c: F.lit(v) for c, v in defaults.items() if c not in requests.columns}
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items() if c in requests.columns}
    return requests.withColumns({**absent, **filled})


def _with_columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.withColumns({c: F.lit(None).cast("double") for c in names if c not in df.columns})


def _ratio(part: Column, whole: Column, otherwise: Column) -> Column:
    return F.when(whole > 0, part / F.nullif(whole, F.lit(0))).otherwise(otherwise)


def _number(name: str) -> Column:
    return F.coalesce(F.col(name).cast("double"), F.lit(0.0))


def _apply(model: TreeModel | FormulaModel, df: DataFrame, features: list[str]) -> DataFrame:
    ready = fill_zero(_with_columns(df, features), features)
    return model.transform(ready).withColumn("_p", vector_to_array("probability"))


def score_churn(model: TreeModel | FormulaModel, requests: DataFrame, keys: list[str]) -> DataFrame:
    p = F.col("_p")[1]
    out = _apply(model, scoring_inputs(requests, CHURN_DEFAULTS), CHURN_FEATURES)
    return out.select(*keys, (p >= DECISION).cast("int").alias("churned"), round_to(p, 4).alias("churn_probability"), risk_band(p).alias("risk_level"))


def derive_delivery(requests: DataFrame) -> DataFrame:
    """Derived delivery inputs of a request; the weekend flag is unknown and set to 0."""
    base = _with_columns(scoring_inputs(requests, DELIVERY_DEFAULTS), ["price", "freight_value", "order_month"])
    total = _number("price") + _number("freight_value")
    return base.withColumns({
        "cross_state": (F.col("customer_state") != F.col("seller_state")).cast("int"),
        "freight_ratio": _ratio(_number("freight_value"), total, F.lit(0.0)),
        "volume_cm3": _number("length_cm") * _number("height_cm") * _number("width_cm"),
        "peak_season": _number("order_month").isin(11.0, 12.0).cast("int"),
        "weekend_order": F.lit(0),
    })


def score_delivery(model: TreeModel | FormulaModel, indexer: StringIndexerModel | None, requests: DataFrame, keys: list[str]) -> DataFrame:
    """Without an indexer the state codes count as zero."""
    p = F.col("_p")[1]
    derived = derive_delivery(requests)
    out = _apply(model, encode_states(indexer, derived) if indexer else derived, DELIVERY_FEATURES)
    return out.select(*keys, (p >= DECISION).alias("will_be_late"), round_to(p, 4).alias("late_probability"), risk_band(p).alias("risk_level"))


def derive_sentiment(requests: DataFrame) -> DataFrame:
    base = _with_columns(scoring_inputs(requests, SENTIMENT_DEFAULTS), ["price", "freight_value"])
    price, delay, parts = _number("price"), _number("delivery_delay_days"), _number("payment_installments")
    return base.withColumns({
        "is_late": (delay > 0).cast("int"),
        "freight_ratio": _ratio(_number("freight_value"), price + _number("freight_value"), F.lit(0.0)),
        "price_per_installment": _ratio(price, parts, price),
        "very_late": (delay > 7).cast("int"),
        "early_delivery": (delay <= 0).cast("int"),
        "abs_delay_days": F.abs(delay),
        "late_and_expensive": ((delay > 0) & (price > 200)).cast("int"),
        "very_very_late": (delay > 14).cast("int"),
    })


def score_sentiment(model: TreeModel | FormulaModel, requests: DataFrame, keys: list[str]) -> DataFrame:
    p = F.col("_p")
    out = _apply(model, derive_sentiment(requests), SENTIMENT_FEATURES)
    return out.select(
        *keys,
        F.when(p[1] > p[0], "Positive").otherwise("Not Positive").alias("sentiment"),
        round_to(F.array_max(p), 4).alias("confidence"),
        F.create_map(F.lit("Not Positive"), round_to(p[0], 4), F.lit("Positive"), round_to(p[1], 4)).alias("probabilities"),
    )
