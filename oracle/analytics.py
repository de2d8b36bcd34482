"""Reports, customer segments and exploration."""

from oracle.star import rounded

_AS_OF = "DATE '2001-08-02'"
_DELIVERED = "is_delivered = 1 AND delivery_delay_days IS NOT NULL"
_SENTIMENT = "if(review_score >= 4, 'Positive', 'Not Positive')"

# Every report is rolled up from cells: one row for each key and order, with sums and counts.
_CELL = """order_id, min(customer_id) AS customer_id, count(*) AS n, sum(revenue) AS revenue, sum(freight_value) AS freight,
  sum(price) AS price, count(price) AS priced, sum(review_score) AS stars, count(review_score) AS starred,
  sum(delivery_delay_days) AS delay, count(delivery_delay_days) AS measured, count_if(delivery_delay_days > 0) AS late,
  count_if(delivery_delay_days <= 0) AS punctual, count_if(is_delivered = 1) AS arrived, count_if(review_score >= 4) AS liked,
  sum(payment_installments) AS parts, count(payment_installments) AS paid"""
_ADDED = ["n", "revenue", "freight", "price", "priced", "stars", "starred", "delay", "measured", "late", "punctual", "arrived", "liked", "parts", "paid"]


def _ratio(part: str, whole: str, digits: int, times: int = 1) -> str:
    return rounded(f"cast(sum({part}) AS double) * {times} / sum({whole})", digits)


def _mean(part: str, digits: int) -> str:
    return _ratio(part, {"price": "priced", "stars": "starred", "delay": "measured", "parts": "paid"}.get(part, "n"), digits)


def _share(part: str, digits: int) -> str:
    return _ratio(part, "n", digits, 100)


_ORDERS, _BUYERS, _LINES, _SALES, _FREIGHT = (
    "count(*)", "count(DISTINCT customer_id)", "cast(sum(n) AS bigint)", "cast(sum(revenue) AS double)", "cast(sum(freight) AS double)",
)


def _rollup(keys: dict[str, str], out: dict[str, str], where: str = "true", tail: str = "") -> str:
    """``out`` columns by the given keys (alias to expression), through the cells."""
    made = "".join(f"{e} AS {k}, " for k, e in keys.items())
    grouped = f"GROUP BY {', '.join(keys)}" if keys else ""
    columns = ", ".join([*keys, *(f"{e} AS {k}" for k, e in out.items())])
    return f"""WITH cells AS (SELECT {made}{_CELL} FROM fact_orders WHERE {where} GROUP BY {', '.join([*keys.values(), 'order_id'])})
      SELECT {columns} FROM cells {grouped} {tail}"""


def _through(key: str, dim: str, keys: list[str], out: dict[str, str], where: str = "true", tail: str = "") -> str:
    """The same by columns of a dimension: cells are added up by the dimension's key before it is looked up."""
    added = ", ".join(f"sum({c}) AS {c}" for c in _ADDED)
    columns = ", ".join([*keys, *(f"{e} AS {k}" for k, e in out.items())])
    return f"""WITH cells AS (SELECT {key} AS entity, {_CELL} FROM fact_orders WHERE {where} GROUP BY {key}, order_id),
      entities AS (SELECT entity AS {key}, count(*) AS order_count, {added} FROM cells GROUP BY entity)
      SELECT {columns} FROM {dim} JOIN entities USING ({key}) GROUP BY {', '.join(keys)} {tail}"""


_KPI = {"total_orders": _ORDERS, "unique_customers": _BUYERS, "total_revenue": _SALES, "avg_order_value": _mean("price", 2),
        "avg_review_score": _mean("stars", 2), "delivery_rate_pct": _share("arrived", 2)}
_PAYMENTS = {"orders": _ORDERS, "revenue": _SALES, "avg_installments": _mean("parts", 1)}


def _growth(report: str, order: str, name: str) -> str:
    """Change of revenue against the row before, in per cent."""
    return f"""WITH report AS ({report}), numbered AS (SELECT *, row_number() OVER (ORDER BY {order}) AS k FROM report)
      SELECT a.* EXCLUDE (k), {rounded("(a.revenue / nullif(b.revenue, 0) - 1) * 100", 2)} AS {name}
      FROM numbered a LEFT JOIN numbered b ON b.k = a.k - 1"""


RFM = f"""WITH base AS (
  SELECT customer_id, customer_unique_id, recency_days, frequency, monetary FROM dim_customers JOIN (
    SELECT customer_id, {_AS_OF} - max(day) AS recency_days, count(*) AS frequency, cast(sum(spent) AS double) AS monetary
    FROM (SELECT customer_id, order_id, max(order_date) AS day, sum(revenue) AS spent FROM fact_orders WHERE is_delivered = 1 GROUP BY ALL)
    GROUP BY customer_id) USING (customer_id)
),
edges AS (SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS e, count(*) AS n FROM base),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY frequency, customer_id) AS fr, row_number() OVER (ORDER BY monetary, customer_id) AS mr FROM base
),
scored AS (
  SELECT customer_id, customer_unique_id, recency_days, frequency, monetary,
    5 - len(list_filter(e, lambda x: x < recency_days)) AS r_score,
    greatest(1, cast(ceil((fr - 1) * 5 / (n - 1)) AS bigint)) AS f_score,
    greatest(1, cast(ceil((mr - 1) * 5 / (n - 1)) AS bigint)) AS m_score
  FROM ranked, edges
),
rfm AS (SELECT *, r_score + f_score + m_score AS rfm FROM scored)"""


def _of(value: str) -> str:
    return rounded(f"cast(sum({value}) AS double) / count({value})", 2)


def _segments(loyal: str, potential: str) -> str:
    names = f"['Lost', 'At Risk', '{potential}', '{loyal}', 'Champions']"
    return f"{names}[1 + len(list_filter([5, 7, 10, 13], lambda least: rfm >= least))] AS segment"


BASE_FEATURES = f"""SELECT customer_id, {_AS_OF} - newest AS recency_days, len(baskets) AS frequency, cast(spent AS double) AS monetary,
    {rounded("cast(stars AS double) / starred", 2)} AS avg_review_score, cast(late AS bigint) AS late_deliveries, len(kinds) AS unique_categories,
    newest - oldest AS customer_lifetime_days, cast({_AS_OF} - newest > 180 AS integer) AS churned FROM (
  SELECT customer_id, max(order_date) AS newest, min(order_date) AS oldest, list(DISTINCT order_id) AS baskets, sum(revenue) AS spent,
    sum(review_score) AS stars, count(review_score) AS starred, count_if(delivery_delay_days > 0) AS late,
    coalesce(list(DISTINCT category) FILTER (category IS NOT NULL), []) AS kinds
  FROM fact_orders WHERE is_delivered = 1 GROUP BY customer_id)"""

_FEATURES = ["recency_days", "frequency", "monetary", "avg_review_score", "late_deliveries", "unique_categories",
             "customer_lifetime_days", "churned"]


def _describe(column: str) -> str:
    v = f"cast({column} AS double)"
    quartiles = ", ".join(f"round(quantile_cont({v}, {p}), 2) AS {n}" for n, p in (("p25", 0.25), ("p50", 0.5), ("p75", 0.75)))
    return f"""SELECT '{column}' AS "column", count({v}) AS count, round(avg({v}), 2) AS mean, round(stddev_samp({v}), 2) AS std,
      round(min({v}), 2) AS min, {quartiles}, round(max({v}), 2) AS max FROM base"""


def _histogram(column: str, bins: int, upper: int | None, by: str | None = None) -> str:
    v = f"cast({column} AS double)" if upper is None else f"least(cast({column} AS double), {upper})"
    key, comma = (by or "0"), f"{by}, " if by else ""
    return f"""WITH base AS ({BASE_FEATURES}),
      v AS (SELECT {key} AS k, {v} AS x FROM base),
      span AS (SELECT k, lo - pad AS lo, hi + pad AS hi FROM (
        SELECT k, min(x) AS lo, max(x) AS hi, CASE WHEN min(x) = max(x) THEN 0.5 ELSE 0 END AS pad FROM v GROUP BY k)),
      filled AS (SELECT v.k, least(cast(floor((x - lo) * {bins} / (hi - lo)) AS bigint) + 1, {bins}) AS bin, count(*) AS n
        FROM v JOIN span ON v.k = span.k GROUP BY ALL),
      grid AS (SELECT k, lo, hi, unnest(range(1, {bins + 1})) AS bin FROM span)
      SELECT {"grid.k AS " + comma if by else ""} grid.bin, round(lo + (hi - lo) / {bins} * (grid.bin - 1), 6) AS bin_start,
        round(lo + (hi - lo) / {bins} * grid.bin, 6) AS bin_end, coalesce(n, 0) AS count
      FROM grid LEFT JOIN filled ON grid.k = filled.k AND grid.bin = filled.bin"""


_NULL_AS_ZERO = ", ".join(f"coalesce(cast({c} AS double), 0) AS {c}" for c in [*_KPI, "total_freight"])
_PUNCTUALITY = {"avg_delay_days": _mean("delay", 1), "late_pct": _share("late", 2), "on_time_pct": _share("punctual", 2)}
_BEST = "ORDER BY revenue DESC, {} LIMIT {}"

SQL = {
    "kpi_summary": f"SELECT {_NULL_AS_ZERO} FROM ({_rollup({}, {**_KPI, 'total_freight': _FREIGHT})})",
    "eda_kpis": _rollup({}, _KPI),
    "monthly_revenue": _growth(
        _rollup({"year": "order_year", "month": "order_month", "yyyymm": "yyyymm"}, {"revenue": _SALES, "freight": _FREIGHT, "orders": _ORDERS, "customers": _BUYERS}),
        "year, month", "mom_growth_pct",
    ),
    "yoy_comparison": _growth(
        _rollup({"year": "order_year"}, {"revenue": _SALES, "orders": _ORDERS, "customers": _BUYERS, "avg_review": _mean("stars", 2)}), "year", "yoy_growth"
    ),
    "category_performance": f"""WITH shares AS (SELECT category, sum(revenue) AS part, sum(sum(revenue)) OVER () AS whole FROM fact_orders GROUP BY category),
      report AS ({_rollup({"category": "category"}, {"orders": _ORDERS, "revenue": _SALES, "avg_price": _mean("price", 2), "avg_review": _mean("stars", 2)})})
      SELECT report.*, {rounded("cast(part AS double) * 100 / cast(whole AS double)", 2)} AS revenue_share_pct FROM report JOIN shares USING (category)""",
    "top_products": _through("product_id", "dim_products", ["product_id", "category"],
        {"orders": _LINES, "revenue": _SALES, "avg_price": _mean("price", 2), "avg_review": _mean("stars", 2)}, tail=_BEST.format("product_id", 10)),
    "seller_leaderboard": _through("seller_id", "dim_sellers", ["seller_id", "seller_state"],
        {"orders": "cast(sum(order_count) AS bigint)", "revenue": _SALES, "avg_review": _mean("stars", 2), "avg_delay_days": _mean("delay", 1)},
        tail=_BEST.format("seller_id", 10)),
    "state_performance": _through("customer_id", "dim_customers", ["state"],
        {"orders": "cast(sum(order_count) AS bigint)", "customers": "count(*)", "revenue": _SALES, "avg_review": _mean("stars", 2), "avg_delay_days": _mean("delay", 1)}),
    "top_states": _through("customer_id", "dim_customers", ["state"], {"orders": "cast(sum(order_count) AS bigint)", "revenue": _SALES}, tail=_BEST.format("state", 12)),
    "payment_analysis": _rollup({"payment_type": "payment_type"}, {**_PAYMENTS, "avg_order_value": _mean("price", 2)}, "payment_type IS NOT NULL"),
    "eda_payments": _rollup({"payment_type": "payment_type"}, _PAYMENTS, "payment_type IS NOT NULL"),
    "delivery_performance": f"SELECT {', '.join(f'coalesce({c}, 0) AS {c}' for c in _PUNCTUALITY)} FROM ({_rollup({}, _PUNCTUALITY, _DELIVERED)})",
    "delivery_counts": _rollup({}, {"avg_delay": _mean("delay", 1), "late": "cast(sum(late) AS bigint)", "ontime": "cast(sum(punctual) AS bigint)",
        "total": _LINES, "late_pct": _share("late", 1), "ontime_pct": _share("punctual", 1)}, _DELIVERED),
    "late_by_state": _through("customer_id", "dim_customers", ["state"],
        {"total_orders": _LINES, "late_orders": "cast(sum(late) AS bigint)", "avg_delay_days": _mean("delay", 1), "late_pct": _share("late", 1)},
        _DELIVERED, "ORDER BY late_pct DESC, state LIMIT 15"),
    "late_by_month": f"""SELECT *, ['Jan','Feb','Mar','Apr','May','Jun','Jul','Aug','Sep','Oct','Nov','Dec'][order_month] AS month_name
      FROM ({_rollup({"order_month": "order_month"}, {"avg_delay": _mean("delay", 1), "late_pct": _share("late", 1)}, _DELIVERED)})""",
    "eda_monthly": _rollup({"yyyymm": "yyyymm"}, {"revenue": _SALES, "orders": _ORDERS}),
    "peak_month": _rollup({"yyyymm": "yyyymm"}, {"revenue": _SALES}, tail=_BEST.format("yyyymm", 1)),
    "top_categories": f"""SELECT *, left(category, 12) AS label FROM ({_rollup({"category": "category"},
        {"revenue": _SALES, "avg_review": _mean("stars", 2), "orders": _ORDERS}, "category IS NOT NULL", _BEST.format("category", 15))})""",
    "review_distribution": _rollup({"review_score": "review_score"}, {"count": _LINES}),
    "sentiment_distribution": f"""SELECT sentiment, count, {rounded("cast(count AS double) * 100 / sum(count) OVER ()", 1)} AS share_pct
      FROM ({_rollup({"sentiment": _SENTIMENT}, {"count": _LINES}, "review_score IS NOT NULL")})""",
    "sentiment_vs_delay": _rollup({"sentiment": _SENTIMENT}, {"avg_delay": _mean("delay", 1), "avg_price": _mean("price", 2), "avg_freight": _mean("freight", 2)},
        "review_score IS NOT NULL AND delivery_delay_days IS NOT NULL"),
    "category_sentiment": f"""SELECT *, ['low', 'medium', 'high'][1 + cast(avg_score >= 3.5 AS integer) + cast(avg_score >= 4.2 AS integer)] AS band
      FROM ({_rollup({"category": "category"}, {"avg_score": _mean("stars", 2), "positive_pct": _share("liked", 1), "orders": _LINES},
        "review_score IS NOT NULL AND category IS NOT NULL", "ORDER BY avg_score, category LIMIT 15")})""",
    "monthly_series": _rollup({"ds": "strftime(order_date, '%Y-%m-01')"}, {"y": _SALES}),
    "to_records": _rollup({"state": "state"}, {"revenue": _SALES}, "state IS NOT NULL"),
    "rfm_customers": f"{RFM} SELECT * FROM base",
    "rfm_scores": f"{RFM} SELECT * FROM rfm",
    "rfm_segmentation": f"""{RFM}, labelled AS (SELECT *, {_segments('Loyal Customers', 'Potential Loyalists')} FROM rfm)
        SELECT segment, count(*) AS customers, {_of('cast(monetary AS decimal(20,10))')} AS avg_monetary,
        {_of('frequency')} AS avg_frequency, {_of('recency_days')} AS avg_recency FROM labelled GROUP BY segment""",
    "rfm_segment_summary": f"""{RFM}, labelled AS (SELECT *, {_segments('Loyal', 'Potential')} FROM rfm)
        SELECT segment, count(*) AS customers, {_of('cast(monetary AS decimal(20,10))')} AS avg_spend,
        {_of('recency_days')} AS avg_recency FROM labelled GROUP BY segment""",
    "rfm_base_features": BASE_FEATURES,
    "describe_features": f"WITH base AS ({BASE_FEATURES}) " + " UNION ALL ".join(_describe(c) for c in _FEATURES),
    "histogram": _histogram("recency_days", 50, None),
    "histogram_frequency": _histogram("frequency", 10, 10),
    "histogram_monetary": _histogram("monetary", 50, 2000000),
    "histogram_by_class": _histogram("monetary", 40, 2000000, "churned"),
    "correlation_matrix": f"WITH base AS ({BASE_FEATURES}) " + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM base" for a in _FEATURES for b in _FEATURES
    ),
}
