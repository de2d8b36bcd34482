"""Features, preparation, evaluation and forecast inputs."""

import numpy as np

from oracle.star import mean, rounded, total

_AS_OF = "DATE '2001-08-02'"

# One row a customer: sorted lists of its delivered items stand for everything that depends on their order.
_CHURN = f"""WITH mine AS (
  SELECT customer_id,
    list({{'day': order_date, 'paid': revenue, 'order': order_id, 'item': order_item_id}} ORDER BY order_date DESC NULLS FIRST, order_id, order_item_id) AS items,
    len(list(DISTINCT order_id)) AS frequency, len(list(DISTINCT product_id)) AS unique_products,
    count(DISTINCT category) AS unique_categories, len(list(DISTINCT order_year)) AS active_years, len(list(DISTINCT order_month)) AS active_months,
    {total('revenue')} AS monetary, {mean('price', 2)} AS avg_order_value, {mean('review_score', 2)} AS avg_review_score,
    {mean('payment_installments', 2)} AS avg_installments, {mean('delivery_delay_days', 1)} AS avg_delay_days,
    {mean('cast(cast(freight_value AS double) / nullif(cast(revenue AS double), 0) AS decimal(20,10))', 4)} AS avg_freight_pct,
    cast(count_if(delivery_delay_days > 0) AS bigint) AS late_deliveries,
    cast(count_if(review_score >= 4) AS bigint) AS positive_reviews, cast(count_if(review_score <= 2) AS bigint) AS negative_reviews,
    cast(min(price) AS double) AS min_order_value, cast(max(price) AS double) AS max_order_value,
    max(order_date) - min(order_date) AS customer_lifetime_days, {_AS_OF} - max(order_date) AS recency_days
  FROM fact_orders WHERE is_delivered = 1 GROUP BY customer_id
),
paid AS (
  SELECT *, items[2].day AS before_last, coalesce(list_sum(list_transform(items[1:3], lambda i: i.paid)), 0) AS recent,
    coalesce(list_sum(list_transform(items[4:], lambda i: i.paid)), 0) AS older,
    cast(items[1].day - items[2].day AS double) / nullif(cast(customer_lifetime_days AS double) / nullif(frequency - 1, 0), 0) AS pace
  FROM mine
),
churn AS (
  SELECT * EXCLUDE (items, before_last, recent, older, pace), unique_categories AS category_diversity,
    if(frequency > 1, customer_lifetime_days // (frequency - 1), 0) AS avg_days_between_orders,
    {rounded('monetary / frequency', 2)} AS revenue_per_order,
    if(older > 0, {rounded('cast(recent AS double) / cast(older AS double)', 4)}, if(recent > 0, 2.0, 1.0)) AS revenue_trend,
    coalesce({_AS_OF} - before_last, 999) AS days_since_second_last,
    if(before_last IS NULL OR items[3].day IS NULL, 1.0, {rounded('pace', 4)}) AS velocity_change
  FROM paid
)"""

_LABELLED = f"""{_CHURN}, span AS (SELECT min(monetary) AS lo, max(monetary) AS hi FROM churn),
labelled AS (
  SELECT * EXCLUDE (recency_days, lo, hi) REPLACE (
      greatest(0, least(10, cast(revenue_trend AS double))) AS revenue_trend,
      CASE WHEN velocity_change IS NOT NULL THEN greatest(0, least(10, cast(velocity_change AS double))) END AS velocity_change),
    CASE WHEN recency_days > 180 THEN 1 ELSE 0 END AS churned,
    CASE WHEN recency_days > 180 THEN 1.0 + (monetary - lo) / (hi - lo + cast(1e-9 AS double))
      * greatest(1, least(3, 1 + cast(recency_days - 180 AS double) / 365)) ELSE 1 END AS sample_weight
  FROM churn, span
)"""

_FREIGHT_RATIO = rounded("cast(freight_value AS double) / nullif(cast(freight_value + price AS double), 0)", 4)

_DELIVERY = f"""WITH delivery AS (
  SELECT order_id, order_item_id, seller_state, state AS customer_state, cast(coalesce(seller_state != state, false) AS integer) AS cross_state,
    weight_g, length_cm, height_cm, width_cm, {rounded('nullif(length_cm * height_cm * width_cm, 0)', 2)} AS volume_cm3,
    cast(price AS double) AS price, cast(freight_value AS double) AS freight_value, {_FREIGHT_RATIO} AS freight_ratio, payment_installments,
    order_year, order_quarter, order_month, cast(order_month > 10 AND order_month < 13 AS integer) AS peak_season,
    cast(isodow(order_date) > 5 AS integer) AS weekend_order, cast(delivery_delay_days > 0 AS integer) AS is_late
  FROM (SELECT * EXCLUDE (category) FROM fact_orders WHERE is_delivered = 1 AND delivery_delay_days IS NOT NULL)
  JOIN dim_sellers USING (seller_id) JOIN dim_products USING (product_id)
)"""

_SENTIMENT = f"""WITH sentiment AS (
  SELECT order_id, order_item_id, review_score, if(review_score < 4, 'Not Positive', 'Positive') AS sentiment, is_delivered, order_year, order_quarter,
    order_month, cast(price AS double) AS price, cast(freight_value AS double) AS freight_value, {_FREIGHT_RATIO} AS freight_ratio,
    payment_installments, {rounded('cast(price AS double) / nullif(payment_installments, 0)', 2)} AS price_per_installment,
    delivery_delay_days, cast(abs(delivery_delay_days) AS double) AS abs_delay_days, coalesce(late, 0) AS is_late,
    coalesce(cast(NOT cast(late AS boolean) AS integer), 0) AS early_delivery, coalesce(late * cast(price > 200 AS integer), 0) AS late_and_expensive,
    cast(coalesce(delivery_delay_days, 0) > 7 AS integer) AS very_late, cast(coalesce(delivery_delay_days, 0) > 14 AS integer) AS very_very_late
  FROM (SELECT *, cast(delivery_delay_days > 0 AS integer) AS late FROM fact_orders) WHERE review_score IS NOT NULL
)"""

_REG = ["n_sellers", "n_products", "n_orders", "month_num"]


def _monthly(key: str) -> str:
    norms = ", ".join(
        f"({c} - min({c}) OVER s) / (max({c}) OVER s - min({c}) OVER s + cast(1e-9 AS double)) AS {c}_norm" for c in _REG
    )
    return f"""WITH months AS (
      SELECT {key} AS series_key, cast(date_trunc('month', order_date) AS date) AS ds, {total('revenue')} AS y,
        count(DISTINCT seller_id) AS n_sellers, count(DISTINCT product_id) AS n_products, count(DISTINCT order_id) AS n_orders
      FROM fact_orders WHERE {key} IS NOT NULL GROUP BY 1, 2
    ),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ds) AS month_num FROM months),
    monthly AS (SELECT *, {norms} FROM numbered WINDOW s AS (PARTITION BY series_key)),
    recent AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY series_key ORDER BY ds DESC) AS back FROM monthly) WHERE back <= 6
    ),
    lines AS (
      SELECT series_key, max(ds) AS last_ds, {', '.join(f'regr_slope({c}, -back) AS s_{c}, regr_intercept({c}, -back) AS i_{c}' for c in _REG[:3])}
      FROM recent GROUP BY series_key
    ),
    ranges AS (SELECT series_key, {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in _REG)} FROM monthly GROUP BY series_key),
    ahead AS (SELECT *, unnest(range(1, 7)) AS months_ahead FROM lines JOIN ranges USING (series_key)),
    projected AS (
      SELECT *, {', '.join(f'greatest(0, coalesce(i_{c} + s_{c} * (months_ahead - 1), cast(hi_{c} AS double))) AS {c}' for c in _REG[:3])},
        cast(hi_month_num + months_ahead AS double) AS month_num, cast(last_ds + to_months(cast(months_ahead AS integer)) AS date) AS ds
      FROM ahead
    ),
    scaled AS (
      SELECT series_key, months_ahead, ds, {', '.join(_REG)},
        {', '.join(f'greatest(0, least(2, ({c} - lo_{c}) / (hi_{c} - lo_{c} + cast(1e-9 AS double)))) AS {c}_norm' for c in _REG)}
      FROM projected
    )"""


def _monthly_out(extra: str = "") -> str:
    return f"""SELECT series_key, cast(ds AS varchar) AS ds, y, {', '.join(_REG)},
      {', '.join(f'round({c}_norm, 6) AS {c}_norm' for c in _REG)} FROM monthly"""


_PROJECTED = f"""SELECT series_key, months_ahead, cast(ds AS varchar) AS ds, {', '.join(f'round({c}, 6) AS {c}' for c in _REG)},
  {', '.join(f'round({c}_norm, 6) AS {c}_norm' for c in _REG)} FROM scaled"""
_FUTURE = """SELECT series_key, cast(ds AS varchar) AS ds, y, round(n_sellers_norm, 6) AS n_sellers_norm,
    round(n_products_norm, 6) AS n_products_norm, round(month_num_norm, 6) AS month_num_norm FROM (
    SELECT series_key, ds, y, n_sellers_norm, n_products_norm, month_num_norm FROM monthly
    UNION ALL SELECT series_key, ds, NULL, n_sellers_norm, n_products_norm, month_num_norm FROM scaled)"""

_SPLIT = f"""{_SENTIMENT}, hashed AS (
  SELECT *, md5(concat_ws('|', order_id, order_item_id, '42')) AS h, CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS label FROM sentiment
),
split AS (
  SELECT order_id, order_item_id, label, price, freight_value,
    CASE WHEN row_number() OVER (PARTITION BY label ORDER BY h) <= ceil(0.8 * count(*) OVER (PARTITION BY label)) THEN 1 ELSE 0 END AS is_train
  FROM hashed
)"""

_SCORED = """WITH scored AS (
  SELECT label, ((product_id * 7 + seller_id * 3 + order_item_id * 11) % 100 + 25 * label) / cast(130 AS double) AS probability
  FROM (SELECT *, CASE WHEN review_score >= 4 THEN 1 ELSE 0 END AS label FROM fact_orders)
),
cells AS (
  SELECT cast(sum(CASE WHEN label = 1 AND probability >= 0.5 THEN 1 ELSE 0 END) AS double) AS tp,
    cast(sum(CASE WHEN label = 0 AND probability >= 0.5 THEN 1 ELSE 0 END) AS double) AS fp,
    cast(sum(CASE WHEN label = 1 AND probability < 0.5 THEN 1 ELSE 0 END) AS double) AS fn,
    cast(sum(CASE WHEN label = 0 AND probability < 0.5 THEN 1 ELSE 0 END) AS double) AS tn
  FROM scored
),
measured AS (
  SELECT (tp + tn) / (tp + fp + fn + tn) AS accuracy, tn / (tn + fp) AS recall_0, tp / (tp + fn) AS recall_1,
    tp / (tp + fp) AS precision_1, tn / (tn + fn) AS precision_0, 2 * tp / (2 * tp + fp + fn) AS f1, 2 * tn / (2 * tn + fp + fn) AS f0,
    tp + fn AS n1, tn + fp AS n0, tp + fp + fn + tn AS n
  FROM cells
),
counts AS (
  SELECT probability, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY probability
),
running AS (
  SELECT *, sum(pos) OVER (ORDER BY probability DESC) AS cum_pos, sum(neg) OVER (ORDER BY probability DESC) AS cum_neg FROM counts
),
area AS (
  SELECT round(cast(sum(neg * (cum_pos - cast(pos AS double) / 2)) AS double) / (cast(sum(pos) AS double) * cast(sum(neg) AS double)), 9) AS roc_auc FROM running
)"""


def _curve(grid) -> str:
    values = ", ".join(f"cast({float(t)!r} AS double)" for t in grid)
    return f"""curve AS (
      SELECT t AS threshold, cast(sum(CASE WHEN label = 0 AND probability < t THEN 1 ELSE 0 END) AS double) / sum(1 - label) AS recall_0,
        cast(sum(CASE WHEN label = 1 AND probability >= t THEN 1 ELSE 0 END) AS double) / sum(label) AS recall_1
      FROM scored, (SELECT unnest([{values}]) AS t) GROUP BY t)"""


_BALANCE = np.arange(0.2, 0.8, 0.01)
_RECALL = np.arange(0.1, 0.6, 0.01)

_REPORT = """
  SELECT 'Not Positive' AS name, precision_0 AS precision, recall_0 AS recall, f0 AS f1, cast(n0 AS bigint) AS support FROM measured
  UNION ALL SELECT 'Positive', precision_1, recall_1, f1, cast(n1 AS bigint) FROM measured
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, cast(n AS bigint) FROM measured
  UNION ALL SELECT 'macro avg', (precision_0 + precision_1) / 2, (recall_0 + recall_1) / 2, (f0 + f1) / 2, cast(n AS bigint) FROM measured
  UNION ALL SELECT 'weighted avg', (precision_0 * n0 + precision_1 * n1) / n, (recall_0 * n0 + recall_1 * n1) / n,
    (f0 * n0 + f1 * n1) / n, cast(n AS bigint) FROM measured"""

# Scores by formula: z is a weighted sum, the probability z / (1 + |z|) moved to 0..1.
_P = "cast(0.5 AS double) + z / (1 + abs(z)) * 0.5"
_BAND = "if(p >= 0.7, 'High', if(p >= 0.4, 'Medium', 'Low'))"
_PAID_RATIO = """if(cast(price AS double) + cast(freight_value AS double) > 0,
    cast(freight_value AS double) / (cast(price AS double) + cast(freight_value AS double)), 0)"""
_DELIVERY_REQUESTS = f"""WITH asked AS (
  SELECT order_id, order_item_id, coalesce(f.state, 'SP') AS buyer, coalesce(s.seller_state, 'SP') AS sender, {_PAID_RATIO} AS freight_ratio,
    coalesce(f.payment_installments, 1) AS parts, cast(f.order_month >= 11 AS integer) AS peak_season, coalesce(p.weight_g, 500) AS weight,
    coalesce(p.length_cm, 20) * coalesce(p.height_cm, 10) * coalesce(p.width_cm, 15) AS volume_cm3
  FROM fact_orders f LEFT JOIN dim_products p USING (product_id) LEFT JOIN dim_sellers s USING (seller_id)
)"""
_SENTIMENT_REQUESTS = f"""WITH given AS (
  SELECT *, coalesce(delivery_delay_days, 0) AS days, cast(price AS double) AS pays, coalesce(payment_installments, 1) AS parts FROM fact_orders
), asked AS (
  SELECT order_id, order_item_id, cast(days > 0 AS integer) AS is_late, {_PAID_RATIO} AS freight_ratio, if(parts > 0, pays / parts, pays) AS price_per_installment,
    cast(days > 7 AS integer) AS very_late, cast(days <= 0 AS integer) AS early_delivery, cast(abs(days) AS double) AS abs_delay_days,
    cast(days > 0 AND pays > 200 AS integer) AS late_and_expensive, cast(days > 14 AS integer) AS very_very_late
  FROM given
)"""

_INPUTS = ["price", "freight_value", "freight_ratio", "order_month", "order_year", "payment_installments", "volume_cm3"]


def _uniform(kind: str) -> str:
    return f"cast(cast('0x' || left(md5(concat_ws('|', id, turn, '{kind}42')), 12) AS bigint) AS double) / 281474976710656"


# Oversampling: neighbours by comparing all pairs of the rarer class, turns and draws from the same hashes.
_SMOTE = f"""{_DELIVERY}, given AS (
  SELECT is_late AS label, [{', '.join(f'cast(coalesce({c}, 0) AS double)' for c in _INPUTS)}] AS vec FROM delivery
), rare AS (
  SELECT label, n, (max(n) OVER ()) - n AS missing FROM (SELECT label, count(*) AS n FROM given GROUP BY label) QUALIFY missing > 0
), points AS (
  SELECT label, n, missing, vec, copies, row_number() OVER (PARTITION BY label ORDER BY vec) AS id
  FROM (SELECT label, vec, count(*) AS copies FROM given GROUP BY ALL) JOIN rare USING (label)
), near AS (
  SELECT a.label, a.id, b.vec AS other, b.copies AS others,
    row_number() OVER (PARTITION BY a.label, a.id ORDER BY sqrt({' + '.join(f'(a.vec[{i}] - b.vec[{i}]) * (a.vec[{i}] - b.vec[{i}])' for i in range(1, 8))}), b.id) AS place
  FROM points a JOIN points b ON a.label = b.label AND a.id <> b.id QUALIFY place <= 5
), beside AS (
  SELECT label, id, flatten(list(list_transform(range(least(others, 5)), lambda x: other) ORDER BY place)) AS slots FROM near GROUP BY label, id
), turns AS (
  SELECT *, sum(copies) OVER (PARTITION BY label ORDER BY md5(concat_ws('|', id, '42')), id) AS through FROM points
), planned AS (
  SELECT t.label, t.id, t.vec, copies * (missing // n) + greatest(0, least(through, missing % n) - (through - copies)) AS wanted,
    list_concat(list_transform(range(least(copies - 1, 5)), lambda x: t.vec), coalesce(slots, []))[1:5] AS slots
  FROM turns t LEFT JOIN beside USING (label, id)
), drawn AS (SELECT *, unnest(range(cast(wanted AS bigint))) AS turn FROM planned),
made AS (
  SELECT label, vec, {_uniform('u')} AS step, coalesce(slots[cast(floor({_uniform('n')} * len(slots)) AS bigint) + 1], vec) AS target FROM drawn
), balanced AS (
  SELECT label, 0 AS synthetic, vec FROM given
  UNION ALL SELECT label, 1, list_transform(range(1, 8), lambda i: vec[i] + step * (target[i] - vec[i])) FROM made
)"""

SQL = {
    "smote": f"""{_SMOTE} SELECT label, synthetic, array_to_string(list_transform(vec, lambda v: cast(cast(v AS decimal(28,6)) AS varchar)), ',') AS vec
        FROM balanced""",
    "score_churn_formula": f"""{_CHURN}, z AS (SELECT customer_id, cast(3 AS double) - 0.125 * cast(frequency AS double) + 0.25 * cast(late_deliveries AS double)
        - 0.5 * cast(coalesce(avg_review_score, 4) AS double) - 0.25 * cast(active_years AS double) + 0.125 * cast(coalesce(revenue_trend, 0) AS double) AS z FROM churn),
      p AS (SELECT customer_id, {_P} AS p FROM z)
      SELECT customer_id, cast(p >= 0.5 AS integer) AS churned, {rounded('p', 4)} AS churn_probability, {_BAND} AS risk_level FROM p""",
    "score_delivery_formula": f"""{_DELIVERY_REQUESTS}, z AS (SELECT order_id, order_item_id, cast(-1 AS double) + 8 * freight_ratio
        + 0.5 * cast(buyer != sender AS integer) - 0.125 * cast(parts AS double) + 0.75 * peak_season + 0.0001220703125 * cast(weight AS double) AS z FROM asked),
      p AS (SELECT order_id, order_item_id, {_P} AS p FROM z)
      SELECT order_id, order_item_id, p >= 0.5 AS will_be_late, {rounded('p', 4)} AS late_probability, {_BAND} AS risk_level FROM p""",
    "score_sentiment_formula": f"""{_SENTIMENT_REQUESTS}, z AS (SELECT order_id, order_item_id, cast(0.75 AS double) - 1.5 * is_late - 4 * freight_ratio
        - 0.5 * very_late + 0.5 * early_delivery + 0.0000152587890625 * price_per_installment AS z FROM asked),
      p AS (SELECT order_id, order_item_id, {_P} AS p FROM z)
      SELECT order_id, order_item_id, if(p > 1 - p, 'Positive', 'Not Positive') AS sentiment, {rounded('greatest(p, 1 - p)', 4)} AS confidence,
        {rounded('p', 4)} AS positive_probability FROM p""",
    "delivery_request_features": f"""{_DELIVERY_REQUESTS} SELECT order_id, order_item_id, cast(buyer != sender AS integer) AS cross_state, freight_ratio,
        cast(volume_cm3 AS double) AS volume_cm3, peak_season, 0 AS weekend_order FROM asked""",
    "sentiment_request_features": f"{_SENTIMENT_REQUESTS} SELECT * FROM asked",
    "churn_recent_orders": f"""{_CHURN} SELECT customer_id, i."order" AS order_id, i.item AS order_item_id, cast(i.day AS varchar) AS order_date,
        cast(i.paid AS double) AS revenue, order_rank, total_orders
        FROM (SELECT customer_id, unnest(items) AS i, generate_subscripts(items, 1) AS order_rank, len(items) AS total_orders FROM mine)""",
    "churn_last_orders": f"""{_CHURN} SELECT customer_id, cast(items[1].day AS varchar) AS last_order_date,
        cast(items[2].day AS varchar) AS second_last_order_date, cast(items[3].day AS varchar) AS third_last_order_date FROM mine""",
    "churn_recent_revenue": f"""{_CHURN} SELECT customer_id, cast(recent AS double) AS last_3_revenue, cast(older AS double) AS older_revenue,
        least(3, len(items)) AS last_3_count, greatest(0, len(items) - 3) AS older_count FROM paid""",
    "churn_features": f"{_CHURN} SELECT * FROM churn",
    "churn_labels_weights": f"{_LABELLED} SELECT * REPLACE (round(sample_weight, 6) AS sample_weight) FROM labelled",
    "churn_class_balance": f"""{_LABELLED} SELECT count(*) AS rows, cast(sum(churned) AS bigint) AS positives,
        {rounded('cast(sum(churned) * 100 AS double) / count(*)', 1)} AS positive_pct FROM labelled""",
    "value_weights": f"{_LABELLED} SELECT customer_id, churned, round(sample_weight, 6) AS sample_weight FROM labelled",
    "delivery_features": f"{_DELIVERY} SELECT * FROM delivery",
    "delivery_class_balance": f"""{_DELIVERY} SELECT count(*) AS rows, cast(sum(is_late) AS bigint) AS positives,
        {rounded('cast(sum(is_late) * 100 AS double) / count(*)', 1)} AS positive_pct FROM delivery""",
    "sentiment_features": f"{_SENTIMENT} SELECT * FROM sentiment",
    "forecast_monthly": f"{_monthly(chr(39) + 'all' + chr(39))} {_monthly_out()}",
    "forecast_monthly_by_state": f"{_monthly('state')} {_monthly_out()}",
    "write_csv": f"{_monthly('state')} {_monthly_out()}",
    "project_regressors": f"{_monthly('state')} {_PROJECTED}",
    "future_frame": f"{_monthly('state')} {_FUTURE}",
    "stratified_split": f"{_SPLIT} SELECT order_id, order_item_id, label, is_train FROM split",
    "standardize": f"""{_SPLIT}, fitted AS (
        SELECT avg(price) AS mp, stddev_pop(price) AS sp, avg(freight_value) AS mf, stddev_pop(freight_value) AS sf FROM split WHERE is_train = 1)
        SELECT order_id, order_item_id, round((price - mp) / sp, 6) AS price, round((freight_value - mf) / sf, 6) AS freight_value
        FROM split, fitted""",
    "label_encode": f"""{_DELIVERY}, customer_codes AS (
        SELECT value, dense_rank() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT coalesce(customer_state, 'unknown') AS value FROM delivery)),
        seller_codes AS (
        SELECT value, dense_rank() OVER (ORDER BY value) - 1 AS code FROM (SELECT DISTINCT coalesce(seller_state, 'unknown') AS value FROM delivery))
        SELECT order_id, order_item_id, customer_state, coalesce(a.code, 0) AS customer_state_enc, seller_state, coalesce(b.code, 0) AS seller_state_enc
        FROM delivery LEFT JOIN customer_codes a ON a.value = coalesce(customer_state, 'unknown')
        LEFT JOIN seller_codes b ON b.value = coalesce(seller_state, 'unknown')""",
    "fill_zero": f"""{_DELIVERY} SELECT order_id, order_item_id, coalesce(weight_g, 0) AS weight_g, coalesce(volume_cm3, 0) AS volume_cm3,
        coalesce(freight_ratio, 0) AS freight_ratio FROM delivery""",
    "balanced_weights": f"""{_DELIVERY}, c AS (SELECT is_late, count(*) AS n FROM delivery GROUP BY is_late)
        SELECT d.order_id, d.order_item_id, d.is_late, round(cast((SELECT sum(n) FROM c) AS double) / ((SELECT count(*) FROM c) * c.n), 9) AS weight
        FROM delivery d JOIN c USING (is_late)""",
    "scale_pos_weight": f"{_DELIVERY} SELECT round(cast(sum(1 - is_late) AS double) / sum(is_late), 9) AS scale_pos_weight FROM delivery",
    "accuracy": f"{_SCORED} SELECT round(accuracy, 9) AS accuracy FROM measured",
    "recall_by_class": f"{_SCORED} SELECT round(recall_0, 9) AS recall_0, round(recall_1, 9) AS recall_1 FROM measured",
    "f1": f"{_SCORED} SELECT round(f1, 9) AS f1 FROM measured",
    "f1_macro": f"{_SCORED} SELECT round((f0 + f1) / 2, 9) AS f1_macro FROM measured",
    "roc_auc": f"{_SCORED} SELECT roc_auc FROM area",
    "roc_curve": f"""{_SCORED} SELECT round(probability, 9) AS threshold, round(cast(cum_neg AS double) / (SELECT sum(neg) FROM counts), 9) AS fpr,
        round(cast(cum_pos AS double) / (SELECT sum(pos) FROM counts), 9) AS tpr FROM running UNION ALL SELECT NULL, 0, 0""",
    "confusion_matrix": f"""{_SCORED} SELECT 0 AS label, 0 AS prediction, cast(tn AS bigint) AS count FROM cells
        UNION ALL SELECT 0, 1, cast(fp AS bigint) FROM cells UNION ALL SELECT 1, 0, cast(fn AS bigint) FROM cells
        UNION ALL SELECT 1, 1, cast(tp AS bigint) FROM cells""",
    "classification_report": f"""{_SCORED} SELECT name, round(precision, 9) AS precision, round(recall, 9) AS recall, round(f1, 9) AS f1, support
        FROM ({_REPORT})""",
    "threshold_curve": f"""{_SCORED}, {_curve(_BALANCE)} SELECT round(threshold, 9) AS threshold, round(recall_0, 9) AS recall_0,
        round(recall_1, 9) AS recall_1 FROM curve""",
    "threshold_balanced": f"""{_SCORED}, {_curve(_BALANCE)} SELECT round(threshold, 9) AS threshold, round(least(recall_0, recall_1), 9) AS balance
        FROM curve ORDER BY least(recall_0, recall_1) DESC, threshold LIMIT 1""",
    "threshold_target_recall": f"""{_SCORED}, {_curve(_RECALL)}
        SELECT round(coalesce(min(CASE WHEN recall_1 >= 0.55 THEN threshold END), 0.5), 9) AS threshold FROM curve""",
    "evaluation_report": f"""{_SCORED}
        SELECT 'confusion' AS section, '0/0' AS name, tn AS value FROM cells UNION ALL SELECT 'confusion', '0/1', fp FROM cells
        UNION ALL SELECT 'confusion', '1/0', fn FROM cells UNION ALL SELECT 'confusion', '1/1', tp FROM cells
        UNION ALL SELECT 'metric', 'accuracy', round(accuracy, 9) FROM measured UNION ALL SELECT 'metric', 'recall_0', round(recall_0, 9) FROM measured
        UNION ALL SELECT 'metric', 'recall_1', round(recall_1, 9) FROM measured UNION ALL SELECT 'metric', 'f1', round(f1, 9) FROM measured
        UNION ALL SELECT 'metric', 'f1_macro', round((f0 + f1) / 2, 9) FROM measured UNION ALL SELECT 'metric', 'roc_auc', roc_auc FROM area""",
    "select_best": f"""{_CHURN} SELECT category AS name, {mean('review_score', 4)} AS value FROM fact_orders WHERE category IS NOT NULL
        GROUP BY category ORDER BY value DESC, name LIMIT 1""",
    "forecast_metrics": f"""{_monthly("'all'")}, e AS (
        SELECT month_num % 3 AS horizon, y, lag(y) OVER (ORDER BY ds) AS yhat FROM monthly)
        SELECT horizon, round(avg(abs(y - yhat)), 4) AS mae, round(sqrt(avg((y - yhat) * (y - yhat))), 4) AS rmse,
          round(avg(abs(y - yhat) / nullif(abs(y), 0)), 6) AS mape FROM e WHERE yhat IS NOT NULL GROUP BY horizon""",
    "forecast_fit_error": f"""{_monthly("'all'")}, e AS (SELECT ds, y, lag(y) OVER (ORDER BY ds) AS yhat FROM monthly)
        SELECT cast(ds AS varchar) AS ds, y, yhat, round(abs(yhat - y) / y * 100, 6) AS error_pct FROM e WHERE yhat IS NOT NULL""",
    "scoring_inputs": """SELECT f.order_id, f.order_item_id, cast(payment_installments AS double) AS payment_installments,
        coalesce(f.state, 'SP') AS customer_state, coalesce(s.seller_state, 'SP') AS seller_state, coalesce(p.weight_g, 500) AS weight_g,
        coalesce(p.length_cm, 20) AS length_cm, coalesce(p.height_cm, 10) AS height_cm, coalesce(p.width_cm, 15) AS width_cm
        FROM fact_orders f LEFT JOIN dim_products p USING (product_id) LEFT JOIN dim_sellers s USING (seller_id)""",
    "knn": """WITH pairs AS (
        SELECT a.vec_id AS id, b.vec_id AS neighbour, list_distance(cast(a.embedding AS double[]), cast(b.embedding AS double[])) AS distance
        FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id)
        SELECT id, neighbour, round(distance, 6) AS distance, rank FROM (
          SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour) AS rank FROM pairs) WHERE rank <= 5""",
    "smote_balance": f"""{_DELIVERY}, c AS (SELECT is_late, count(*) AS n FROM delivery GROUP BY is_late)
        SELECT is_late AS label, (SELECT max(n) FROM c) AS rows FROM c""",
}
