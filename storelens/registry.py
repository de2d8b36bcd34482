"""Every operator under its query name, bound to a data folder."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.operators import neighbours
from storelens.plans import customers, dims, etl, evaluate, explore, fact, features, forecast, prep, reports, scoring, training
from storelens.session import materialize, scratch_path
from storelens.shared_warehouse import warehouse_for
from storelens.sources import raw as raw_source
from storelens.sources import warehouse as wh
from storelens.sources.binding import bind_test_tables
from storelens.sources.raw import RawTables
from storelens.sources.warehouse import Warehouse

# The test tables cover other years and a thousand times larger prices than the real dump.
SPEND_LIMIT = 2_000_000
AS_OF = "2001-08-02"

Query = Callable[[SparkSession, str], DataFrame]


def portable(df: DataFrame) -> DataFrame:
    """Only bigint, double and string columns, so that two engines can be compared."""

    def cast(field: T.StructField):
        c = F.col(f"`{field.name}`")
        kind = field.dataType
        if isinstance(kind, (T.DecimalType, T.FloatType)):
            c = c.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(kind, (T.DateType, T.TimestampNTZType, T.TimestampType)):
            c = c.cast("string")
        return c.alias(field.name)

    return df.select([cast(f) for f in df.schema.fields])


def _raw(build: Callable[[SparkSession, RawTables], DataFrame]) -> Query:
    return lambda spark, directory: portable(build(spark, bind_test_tables(spark, directory)))


def _stored(build: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, directory: portable(build(warehouse_for(spark, directory)))


def _fresh_path(spark: SparkSession, kind: str) -> str:
    return scratch_path(spark, kind)


def _run_etl(spark: SparkSession, raw: RawTables) -> DataFrame:
    return fact.project_fact(etl.run_etl(spark, raw, _fresh_path(spark, "etl")).fact_orders)


def _scan_csv(spark: SparkSession, raw: RawTables) -> DataFrame:
    path = _fresh_path(spark, "csv")
    items = raw.order_items.withColumn("shipping_limit_date", F.lit(None).cast("string"))
    wh.write_csv(items.select("price", "seller_id", "order_item_id", "shipping_limit_date", "freight_value", "order_id", "product_id"), path)  # columns are found by name
    scanned = raw_source.scan_csv(spark, path, "order_items")
    ids = {c: F.col(c).cast("bigint") for c in ("order_id", "product_id", "seller_id")}
    return scanned.withColumns(ids).drop("_order", "_corrupt", "shipping_limit_date")


def _joined(raw: RawTables) -> DataFrame:
    return fact.joined_rows(raw, fact.customer_dim(raw), fact.product_dim(raw))


def _item_stage(step: Callable[[DataFrame], DataFrame], columns: list[str]) -> Query:
    keys = ["order_id", "order_item_id", "product_id", "seller_id"]
    return _raw(lambda spark, raw: step(_joined(raw)).select(*keys, *columns))


def _geo(raw: RawTables) -> DataFrame:
    return dims.dim_geolocation(dims.geolocation_groups(raw.geolocation))


def _scan_table(w: Warehouse) -> DataFrame:
    w.register_views()
    return wh.query(w.fact_orders.sparkSession, "SELECT state, count(*) AS customers FROM dim_customers GROUP BY state")


def _etl_audit(spark: SparkSession, directory: str) -> DataFrame:
    return portable(etl.etl_audit(bind_test_tables(spark, directory), warehouse_for(spark, directory)))


def _records(w: Warehouse) -> DataFrame:
    revenue = w.fact_orders.filter("state IS NOT NULL").groupBy("state").agg(F.sum("revenue").cast("double").alias("revenue"))
    documents = wh.to_records(revenue)
    return documents.select(F.from_json("record", "state string, revenue double").alias("r")).select("r.*")


def _rfm(w: Warehouse) -> DataFrame:
    return customers.rfm_customers(w.fact_orders, w.dim_customers, AS_OF)


def _scores(w: Warehouse) -> DataFrame:
    return customers.rfm_scores(_rfm(w))


def _base(w: Warehouse) -> DataFrame:
    return customers.rfm_base_features(w.fact_orders, AS_OF)


BASE_COLUMNS = [
    "recency_days", "frequency", "monetary", "avg_review_score", "late_deliveries", "unique_categories",
    "customer_lifetime_days", "churned",
]


def _etl_queries() -> dict[str, Query]:
    joined_columns = ["price", "customer_id", "order_status", "review_score", "total_payment", "payment_installments",
                      "payment_type", "category", "state", "lat", "lng"]
    return {
        "scan_csv": _raw(_scan_csv),
        "scan_table": _stored(_scan_table),
        "write_table": _stored(lambda w: fact.project_fact(w.fact_orders)),
        "table_row_counts": _stored(lambda w: w.row_counts()),
        "to_records": _stored(_records),
        "run_etl": _raw(_run_etl),
        "coerce_timestamps": _raw(lambda spark, raw: fact.coerce_timestamps(raw.orders).select("order_id", *fact.TIMESTAMPS)),
        "dim_geolocation_group": _raw(lambda spark, raw: dims.geolocation_groups(raw.geolocation)),
        "dim_geolocation": _raw(lambda spark, raw: _geo(raw)),
        "dim_customers": _raw(lambda spark, raw: fact.customer_dim(raw)),
        "dim_sellers": _raw(lambda spark, raw: dims.dim_sellers(raw.sellers, _geo(raw))),
        "product_category_translate": _raw(
            lambda spark, raw: dims.translate_categories(raw.products, raw.category_translation).select("product_id", "category")
        ),
        "dim_products": _raw(lambda spark, raw: fact.product_dim(raw)),
        "dim_date": _raw(lambda spark, raw: dims.dim_date(dims.calendar_range(raw.orders))),
        "payments_per_order": _raw(lambda spark, raw: fact.payments_per_order(raw.order_payments)),
        "reviews_best_per_order": _raw(lambda spark, raw: fact.best_review_per_order(raw.order_reviews)),
        "fact_join": _item_stage(lambda df: df, joined_columns),
        "fact_date_parts": _item_stage(fact.add_date_parts, ["order_date", "order_year", "order_month", "order_quarter", "yyyymm"]),
        "fact_revenue": _item_stage(fact.add_revenue, ["revenue"]),
        "fact_is_delivered": _item_stage(fact.add_is_delivered, ["is_delivered"]),
        "fact_delivery_delay": _item_stage(fact.add_delivery_delay, ["delivery_delay_days"]),
        "fact_drop_null_keys": _item_stage(fact.drop_null_keys, ["customer_id"]),
        "fact_dedupe": _raw(lambda spark, raw: fact.dedupe_items(fact.drop_null_keys(raw.order_items))),
        "fact_impute_review": _raw(
            lambda spark, raw: fact.fact_orders(raw, fact.customer_dim(raw), fact.product_dim(raw), with_key=False).select(
                "order_id", "order_item_id", "review_score"
            )
        ),
        "fact_surrogate_key": _raw(
            lambda spark, raw: fact.surrogate_key(fact.dedupe_items(fact.drop_null_keys(raw.order_items))).select(
                "fact_id", "order_id", "order_item_id"
            )
        ),
        "fact_orders": _raw(lambda spark, raw: fact.fact_orders(raw, fact.customer_dim(raw), fact.product_dim(raw))),
        "etl_audit": _etl_audit,
    }


def _report_queries() -> dict[str, Query]:
    on_fact = [
        reports.kpi_summary, reports.eda_kpis, reports.monthly_revenue, reports.yoy_comparison, reports.category_performance,
        reports.payment_analysis, reports.eda_payments, reports.delivery_performance, reports.delivery_counts,
        reports.late_by_month, reports.eda_monthly, reports.peak_month, reports.top_categories, reports.review_distribution,
        reports.sentiment_distribution, reports.sentiment_vs_delay, reports.category_sentiment, reports.monthly_series,
    ]
    with_customers = [reports.state_performance, reports.top_states, reports.late_by_state]
    return {
        **{f.__name__: _stored(lambda w, f=f: f(w.fact_orders)) for f in on_fact},
        **{f.__name__: _stored(lambda w, f=f: f(w.fact_orders, w.dim_customers)) for f in with_customers},
        "top_products": _stored(lambda w: reports.top_products(w.fact_orders, w.dim_products)),
        "seller_leaderboard": _stored(lambda w: reports.seller_leaderboard(w.fact_orders, w.dim_sellers)),
    }


def _customer_queries() -> dict[str, Query]:
    return {
        "rfm_customers": _stored(_rfm),
        "rfm_scores": _stored(_scores),
        "rfm_segmentation": _stored(lambda w: customers.rfm_segmentation(_scores(w))),
        "rfm_segment_summary": _stored(lambda w: customers.rfm_segment_summary(_scores(w))),
        "rfm_base_features": _stored(_base),
        "describe_features": _stored(lambda w: explore.describe(_base(w), BASE_COLUMNS)),
        "histogram": _stored(lambda w: explore.histogram(_base(w), "recency_days", 50)),
        "histogram_frequency": _stored(lambda w: explore.histogram(_base(w), "frequency", 10, 10)),
        "histogram_monetary": _stored(lambda w: explore.histogram(_base(w), "monetary", 50, SPEND_LIMIT)),
        "histogram_by_class": _stored(lambda w: explore.histogram(_base(w), "monetary", 40, SPEND_LIMIT, "churned")),
        "correlation_matrix": _stored(lambda w: explore.correlation_matrix(_base(w), BASE_COLUMNS)),
    }


def _rounded(df: DataFrame, columns: list[str], digits: int) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _churn(w: Warehouse) -> DataFrame:
    return features.churn_features(w.fact_orders, AS_OF)


def _churn_labelled(w: Warehouse) -> DataFrame:
    return features.churn_labels_weights(_churn(w))


def _delivery(w: Warehouse) -> DataFrame:
    return features.delivery_features(w.fact_orders, w.dim_products, w.dim_sellers)


def _monthly(w: Warehouse, key: str | None = "state") -> DataFrame:
    """A row a series and month, computed from the fact once: what follows reads it several times."""
    return materialize(features.forecast_monthly(w.fact_orders, key))


def _csv_regressors(w: Warehouse) -> DataFrame:
    """The regressor table written as CSV and read back."""
    spark, rows = w.fact_orders.sparkSession, _rounded(_monthly(w), NORMS, 6)
    path = _fresh_path(spark, "csv")
    wh.write_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


NORMS = [f"{c}_norm" for c in features.REGRESSORS]
USED_NORMS = ["n_sellers_norm", "n_products_norm", "month_num_norm"]


def _feature_queries() -> dict[str, Query]:
    return {
        "churn_recent_orders": _stored(lambda w: features.churn_recent_orders(w.fact_orders)),
        "churn_last_orders": _stored(lambda w: features.churn_last_orders(w.fact_orders)),
        "churn_recent_revenue": _stored(lambda w: features.churn_recent_revenue(w.fact_orders)),
        "churn_features": _stored(_churn),
        "churn_labels_weights": _stored(lambda w: _rounded(_churn_labelled(w), ["sample_weight"], 6)),
        "churn_class_balance": _stored(lambda w: features.class_balance(_churn_labelled(w), "churned")),
        "value_weights": _stored(lambda w: _rounded(_churn_labelled(w).select("customer_id", "churned", "sample_weight"), ["sample_weight"], 6)),
        "delivery_features": _stored(_delivery),
        "delivery_class_balance": _stored(lambda w: features.class_balance(_delivery(w), "is_late")),
        "sentiment_features": _stored(lambda w: features.sentiment_features(w.fact_orders)),
        "forecast_monthly": _stored(lambda w: _rounded(_monthly(w, None), NORMS, 6)),
        "forecast_monthly_by_state": _stored(lambda w: _rounded(_monthly(w), NORMS, 6)),
        "write_csv": _stored(_csv_regressors),
        "project_regressors": _stored(lambda w: _rounded(features.project_regressors(_monthly(w)), [*features.REGRESSORS, *NORMS], 6)),
        "future_frame": _stored(lambda w: _rounded(features.future_frame(_monthly(w)), USED_NORMS, 6)),
    }


ITEM = ["order_id", "order_item_id"]


def _split(w: Warehouse) -> DataFrame:
    rows = features.sentiment_features(w.fact_orders).withColumn("label", (F.col("sentiment") == "Positive").cast("int"))
    return prep.stratified_split(rows, "label", ITEM)


def _standardized(w: Warehouse) -> DataFrame:
    split = _split(w)
    scaled = prep.standardize(split, ["price", "freight_value"], split.filter("is_train = 1"))
    return _rounded(scaled.select(*ITEM, "price", "freight_value"), ["price", "freight_value"], 6)


def _encoded(w: Warehouse) -> DataFrame:
    rows = _delivery(w).select(*ITEM, "customer_state", "seller_state")
    for c in ("customer_state", "seller_state"):
        rows = prep.label_encode(rows, c, prep.label_codes(rows, c), f"{c}_enc")
    return rows


def _knn(spark: SparkSession, directory: str) -> DataFrame:
    vectors = spark.read.parquet(f"{directory}/embeddings.parquet")
    return portable(_rounded(neighbours.row_neighbours(vectors, "vec_id", "embedding", 5), ["distance"], 6))


SMOTE_INPUTS = ["price", "freight_value", "freight_ratio", "order_month", "order_year", "payment_installments", "volume_cm3"]


def _balanced(w: Warehouse) -> DataFrame:
    rows = prep.fill_zero(_delivery(w), SMOTE_INPUTS)
    return neighbours.smote(rows.select("is_late", F.array(*SMOTE_INPUTS).alias("vec")), "is_late", "vec")


def _prep_queries() -> dict[str, Query]:
    zeroed = ["weight_g", "volume_cm3", "freight_ratio"]
    return {
        "stratified_split": _stored(lambda w: _split(w).select(*ITEM, "label", "is_train")),
        "standardize": _stored(_standardized),
        "label_encode": _stored(_encoded),
        "fill_zero": _stored(lambda w: prep.fill_zero(_delivery(w).select(*ITEM, *zeroed), zeroed)),
        "balanced_weights": _stored(lambda w: _rounded(prep.balanced_weights(_delivery(w).select(*ITEM, "is_late"), "is_late"), ["weight"], 9)),
        "scale_pos_weight": _stored(lambda w: _rounded(prep.scale_pos_weight(_delivery(w), "is_late"), ["scale_pos_weight"], 9)),
        "knn": _knn,
        "smote": _stored(lambda w: _balanced(w).select("label", "synthetic", F.concat_ws(",", F.transform("vec", lambda v: v.cast("decimal(28,6)").cast("string"))).alias("vec"))),
        "smote_balance": _stored(lambda w: _balanced(w).groupBy("label").agg(F.count(F.lit(1)).alias("rows"))),
    }


def fixed_scores(w: Warehouse) -> DataFrame:
    """Scores from a formula over every fact row, so that the metrics can be checked in SQL."""
    label = (F.col("review_score") >= 4).cast("int")
    mixed = (F.col("product_id") * 7 + F.col("seller_id") * 3 + F.col("order_item_id") * 11) % 100
    return w.fact_orders.select(label.alias("label"), ((mixed + 25 * label) / F.lit(130.0)).alias("probability"))


def _scored(build: Callable[[DataFrame], DataFrame], digits: int = 9) -> Query:
    def run(w: Warehouse) -> DataFrame:
        out = build(fixed_scores(w))
        return _rounded(out, [c for c, kind in out.dtypes if kind == "double"], digits)

    return _stored(run)


def _predicted(build: Callable[[DataFrame], DataFrame]) -> Query:
    return _scored(lambda scored: build(evaluate.with_prediction(scored)))


def _best_category(w: Warehouse) -> DataFrame:
    candidates = w.fact_orders.filter("category IS NOT NULL").groupBy(F.col("category").alias("name")).agg(
        F.round((F.sum("review_score").cast("double") / F.count("review_score")).cast("decimal(28,8)"), 4).cast("double").alias("value")
    )
    return evaluate.select_best(candidates, "name", "value", "name")


def _naive_forecast(w: Warehouse) -> DataFrame:
    """Last month's value as the forecast: a fixed table to check error measures on."""
    monthly = _monthly(w, None)
    shifted = monthly.select("series_key", (F.col("month_num") + 1).alias("month_num"), F.col("y").alias("yhat"))
    return monthly.select("series_key", "ds", "y", "month_num").join(shifted, ["series_key", "month_num"])


def _forecast_errors(w: Warehouse) -> DataFrame:
    errors = _naive_forecast(w).withColumn("horizon", F.col("month_num") % 3)
    return _rounded(_rounded(evaluate.forecast_metrics(errors, ["horizon"]), ["mae", "rmse"], 4), ["mape"], 6)


def _fit_error(w: Warehouse) -> DataFrame:
    naive = _naive_forecast(w)
    return _rounded(forecast.fit_error(naive, naive).select("ds", "y", "yhat", "error_pct"), ["error_pct"], 6)


def _evaluation_queries() -> dict[str, Query]:
    names = ["Not Positive", "Positive"]
    return {
        "accuracy": _predicted(evaluate.accuracy),
        "recall_by_class": _predicted(evaluate.recall_by_class),
        "f1": _predicted(evaluate.f1),
        "f1_macro": _predicted(evaluate.f1_macro),
        "confusion_matrix": _predicted(evaluate.confusion_matrix),
        "classification_report": _predicted(lambda p: evaluate.classification_report(p, names)),
        "roc_auc": _scored(evaluate.roc_auc),
        "roc_curve": _scored(evaluate.roc_curve),
        "threshold_curve": _scored(evaluate.threshold_curve),
        "threshold_balanced": _scored(evaluate.threshold_balanced),
        "threshold_target_recall": _scored(evaluate.threshold_target_recall),
        "evaluation_report": _scored(evaluate.evaluation_report),
        "select_best": _stored(_best_category),
        "forecast_metrics": _stored(_forecast_errors),
        "forecast_fit_error": _stored(_fit_error),
    }


# Searches of the registered training queries: all draws and folds, whole grids, all training rows.
CHURN_SEARCH, DELIVERY_SEARCH, SENTIMENT_SEARCH = training.Search(n_iter=25), training.Search(n_iter=15), training.Search(n_iter=15)
_trained: dict[tuple, object] = {}


def _once(w: Warehouse, name: str, build: Callable[[], object]):
    """Fit once per application and warehouse, however many queries use the model."""
    key = (w.fact_orders.sparkSession.sparkContext.applicationId, w.fact_orders.semanticHash(), name)
    if key not in _trained:
        _trained[key] = build()
    return _trained[key]


def _churn_model(w: Warehouse) -> training.Trained:
    return _once(w, "churn", lambda: training.train_churn(_churn_labelled(w), CHURN_SEARCH))


def _delivery_model(w: Warehouse):
    return _once(w, "delivery", lambda: training.train_delivery(_delivery(w), DELIVERY_SEARCH))


def _sentiment_model(w: Warehouse) -> training.Trained:
    return _once(w, "sentiment", lambda: training.train_sentiment(features.sentiment_features(w.fact_orders), SENTIMENT_SEARCH))


def _logged(w: Warehouse, trained: training.Trained, inputs: list[str]) -> DataFrame:
    """Metrics as written to and read back from the metrics table."""
    spark = w.fact_orders.sparkSession
    path = _fresh_path(spark, "metrics")
    params = {"threshold": trained.threshold, "features_count": len(inputs), "best_params": trained.model.settings}
    training.log_metrics(spark, path, uuid.uuid4().hex, trained.name, params, trained.metrics)
    return training.read_metrics(spark, path).drop("run_id")


def _reloaded(w: Warehouse, trained: training.Trained):
    path = _fresh_path(w.fact_orders.sparkSession, "model")
    training.save_model(trained.model, path)
    return training.load_model(path, w.fact_orders.sparkSession)


def _requests(w: Warehouse) -> DataFrame:
    """Every fact row as a delivery request."""
    items = w.fact_orders.select(*ITEM, "product_id", "seller_id", "price", "freight_value", "order_month", "order_quarter", "order_year",
                                 "payment_installments", F.col("state").alias("customer_state"))
    return items.join(w.dim_products.drop("category"), "product_id", "left").join(w.dim_sellers.select("seller_id", "seller_state"), "seller_id", "left")


def _scoring_inputs(w: Warehouse) -> DataFrame:
    filled = scoring.scoring_inputs(_requests(w), scoring.DELIVERY_DEFAULTS)
    return filled.select(*ITEM, *scoring.DELIVERY_DEFAULTS)


def _score_delivery(w: Warehouse) -> DataFrame:
    trained, indexer = _delivery_model(w)
    return scoring.score_delivery(_reloaded(w, trained), indexer, _requests(w), ITEM)


# Models as formulas, so that scoring itself (defaults, derived fields, bands, labels) can be checked in SQL.
CHURN_FORMULA = scoring.FormulaModel({"frequency": -0.125, "late_deliveries": 0.25, "avg_review_score": -0.5, "active_years": -0.25, "revenue_trend": 0.125}, 3.0)
DELIVERY_FORMULA = scoring.FormulaModel({"freight_ratio": 8.0, "cross_state": 0.5, "payment_installments": -0.125, "peak_season": 0.75, "weight_g": 0.0001220703125}, -1.0)
SENTIMENT_FORMULA = scoring.FormulaModel({"is_late": -1.5, "freight_ratio": -4.0, "very_late": -0.5, "early_delivery": 0.5, "price_per_installment": 0.0000152587890625}, 0.75)
DELIVERY_DERIVED = ["cross_state", "freight_ratio", "volume_cm3", "peak_season", "weekend_order"]
SENTIMENT_DERIVED = ["is_late", "freight_ratio", "price_per_installment", "very_late", "early_delivery", "abs_delay_days", "late_and_expensive", "very_very_late"]


def _sentiment_requests(w: Warehouse) -> DataFrame:
    return w.fact_orders.select(*ITEM, "price", "freight_value", "delivery_delay_days", "payment_installments", "is_delivered", "order_month", "order_quarter", "order_year")


def _score_sentiment(w: Warehouse, model=None) -> DataFrame:
    scored = scoring.score_sentiment(model or _sentiment_model(w).model, _sentiment_requests(w), ITEM)
    positive = F.element_at("probabilities", F.lit("Positive"))
    return scored.withColumn("positive_probability", positive).drop("probabilities")


def _importance(w: Warehouse, trained: training.Trained, inputs: list[str]) -> DataFrame:
    return training.feature_importance(w.fact_orders.sparkSession, trained.model, inputs, 5)


def _forecast_rows(w: Warehouse) -> DataFrame:
    return forecast.forecast(_monthly(w))


def _recorded_forecast(w: Warehouse) -> DataFrame:
    """The logged parameters and errors of a run beside the rows of its CSV, both read back from storage."""
    spark, monthly = w.fact_orders.sparkSession, _monthly(w)
    metrics, csv = _fresh_path(spark, "forecast_metrics"), _fresh_path(spark, "forecast_csv")
    forecast.record_forecast(monthly, metrics, csv, "forecast")
    logged = training.read_metrics(spark, metrics).select("kind", "key", "value")
    written = spark.read.option("header", True).csv(csv)
    return logged.unionByName(written.agg(F.lit("csv").alias("kind"), F.lit("rows").alias("key"), F.count(F.lit(1)).cast("string").alias("value")))


def _model_error(w: Warehouse) -> DataFrame:
    """Error of the fitted forecast for every month of the history."""
    monthly = _monthly(w)
    return forecast.fit_error(forecast.forecast(monthly), monthly)


def _score_forecast(w: Warehouse) -> DataFrame:
    """Coefficients are stored as rows and read back before scoring."""
    spark, monthly = w.fact_orders.sparkSession, _monthly(w)
    path = _fresh_path(spark, "forecast")
    forecast.fit(monthly).write.parquet(path)
    return forecast.score_forecast(spark.read.parquet(path), monthly, 6)


def _model_queries() -> dict[str, Query]:
    return {
        "train_churn": _stored(lambda w: _logged(w, _churn_model(w), features.CHURN_FEATURES)),
        "train_delivery": _stored(lambda w: _logged(w, _delivery_model(w)[0], features.DELIVERY_FEATURES)),
        "train_sentiment": _stored(lambda w: _logged(w, _sentiment_model(w), features.SENTIMENT_FEATURES)),
        "feature_importance": _stored(lambda w: _importance(w, _churn_model(w), features.CHURN_FEATURES)),
        "feature_importance_delivery": _stored(lambda w: _importance(w, _delivery_model(w)[0], features.DELIVERY_FEATURES)),
        "feature_importance_sentiment": _stored(lambda w: _importance(w, _sentiment_model(w), features.SENTIMENT_FEATURES)),
        "evaluation_report_churn": _stored(lambda w: evaluate.evaluation_report(_churn_model(w).scored)),
        "evaluation_report_delivery": _stored(lambda w: evaluate.evaluation_report(_delivery_model(w)[0].scored)),
        "evaluation_report_sentiment": _stored(lambda w: evaluate.evaluation_report(_sentiment_model(w).scored)),
        "scoring_inputs": _stored(_scoring_inputs),
        "score_churn": _stored(lambda w: scoring.score_churn(_reloaded(w, _churn_model(w)), _churn(w), ["customer_id"])),
        "score_delivery": _stored(_score_delivery),
        "score_churn_formula": _stored(lambda w: scoring.score_churn(CHURN_FORMULA, _churn(w), ["customer_id"])),
        "score_delivery_formula": _stored(lambda w: scoring.score_delivery(DELIVERY_FORMULA, None, _requests(w), ITEM)),
        "score_sentiment_formula": _stored(lambda w: _score_sentiment(w, SENTIMENT_FORMULA)),
        "delivery_request_features": _stored(lambda w: scoring.derive_delivery(_requests(w)).select(*ITEM, *DELIVERY_DERIVED)),
        "sentiment_request_features": _stored(lambda w: scoring.derive_sentiment(_sentiment_requests(w)).select(*ITEM, *SENTIMENT_DERIVED)),
        "score_sentiment": _stored(_score_sentiment),
        "train_forecast": _stored(_forecast_rows),
        "forecast_cv": _stored(lambda w: forecast.forecast_cv(_monthly(w))),
        "score_forecast": _stored(_score_forecast),
        "record_forecast": _stored(_recorded_forecast),
        "forecast_model_error": _stored(_model_error),
    }


def registered() -> dict[str, Query]:
    return {
        **_etl_queries(), **_report_queries(), **_customer_queries(), **_feature_queries(), **_prep_queries(), **_evaluation_queries(),
        **_model_queries(),
    }
