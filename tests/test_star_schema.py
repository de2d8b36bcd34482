"""ETL traps on hand-made raw tables, and invariants of the stored schema."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from storelens.plans import customers, dims, etl, fact, features, reports
from storelens.sources import warehouse as wh
from storelens.sources.binding import bind_test_tables
from storelens.sources.raw import RAW_SCHEMAS, RawTables, corrupt_counts, extract, scan_csv

ORDERS = [
    # order, customer, status, purchased, delivered, promised
    ("o1", "c1", "delivered", "2018-01-05 10:00:00", "2018-01-10 06:00:00", "2018-01-10 20:00:00"),
    ("o2", "c1", "delivered", "2018-02-05 10:00:00", "2018-02-21 00:00:00", "2018-02-20 00:00:00"),
    ("o3", "c2", "shipped", "2018-02-07 10:00:00", "", "2018-02-20 00:00:00"),
    ("o4", None, "delivered", "2018-02-07 10:00:00", None, None),
    ("o5", "ghost", "delivered", "not a date", "2018-03-01 00:00:00", "2018-03-01 00:00:00"),
]
ITEMS = [
    ("o1", 1, "p1", "s1", 10.0, 2.5), ("o1", 1, "p2", "s1", 99.0, 9.0), ("o1", 2, "p2", "s2", 20.0, 0.0),
    ("o2", 1, "p1", "s1", 10.0, 2.5), ("o3", 1, "p3", "s2", 5.0, 1.0), ("o4", 1, "p1", "s1", 1.0, 1.0),
    ("o5", 1, "p1", None, 1.0, 1.0), ("o5", 2, "p1", "s1", 7.0, 0.0), ("missing", 1, "p1", "s1", 1.0, 1.0),
]


@pytest.fixture(scope="module")
def raw(spark):
    def make(rows, schema):
        return spark.createDataFrame(rows, schema)

    return RawTables(
        orders=make(ORDERS, "order_id string, customer_id string, order_status string, order_purchase_timestamp string, "
                            "order_delivered_customer_date string, order_estimated_delivery_date string"),
        order_items=make(ITEMS, "order_id string, order_item_id int, product_id string, seller_id string, price double, freight_value double")
        .withColumns({c: F.col(c).cast("decimal(18,2)") for c in ("price", "freight_value")}).withColumn("_order", F.monotonically_increasing_id()),
        order_payments=make([("o1", 10.0, 3, None, 0), ("o1", 5.0, 1, "voucher", 1), ("o1", 1.0, 2, "boleto", 2), ("o2", 4.0, 1, "boleto", 0),
                             (None, 9.0, 9, "boleto", 0)],
                            "order_id string, payment_value double, payment_installments int, payment_type string, _order int"),
        order_reviews=make([("o1", 2), ("o1", 5), ("o2", None), ("o3", 1), ("o5", None)], "order_id string, review_score int"),
        customers=make([("c1", "u1", "rio", "RJ", "20000"), ("c1", "u9", "xxx", "SP", "1"), ("c2", "u2", "sao paulo", "SP", "01000")],
                       "customer_id string, customer_unique_id string, customer_city string, customer_state string, customer_zip_code_prefix string")
        .withColumn("_order", F.monotonically_increasing_id()),
        products=make([("p1", "cama_mesa_banho", 100.0, 10.0, 2.0, 3.0), ("p2", "toys-2nd_hand", None, 1.0, 0.0, 1.0), ("p3", None, 5.0, 1.0, 1.0, 1.0)],
                      "product_id string, product_category_name string, product_weight_g double, product_length_cm double, "
                      "product_height_cm double, product_width_cm double"),
        sellers=make([("s1", "rio", "RJ", "20000"), ("s2", "x", "SP", "99999")], "seller_id string, seller_city string, seller_state string, seller_zip_code_prefix string"),
        geolocation=make([("20000", -22.0, -43.0, None, "RJ"), ("20000", -23.0, -44.0, "rio", "RJ"), ("20000", -1.0, -1.0, "other", "AC"),
                          (None, 1.0, 1.0, "x", "RJ"), ("01000", -23.5, -46.6, "sao paulo", "SP")],
                         "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double, geolocation_city string, geolocation_state string")
        .withColumn("_order", F.monotonically_increasing_id()),
        category_translation=make([("cama_mesa_banho", "bed_bath_table")], "product_category_name string, product_category_name_english string"),
    )


@pytest.fixture(scope="module")
def tables(spark, raw):
    return etl.transform(spark, raw, "2016-01-01", "2018-12-31")


def test_geolocation_keeps_smallest_state(tables):
    rows = {r["zip_code_prefix"]: r for r in tables.dim_geolocation.collect()}
    assert set(rows) == {"20000", "01000"}
    assert (rows["20000"]["state"], rows["20000"]["lat"], rows["20000"]["city"]) == ("AC", -1.0, "other")


def test_first_known_city(raw):
    rows = {(r["zip_code_prefix"], r["state"]): r for r in dims.geolocation_groups(raw.geolocation).collect()}
    assert rows["20000", "RJ"]["city"] == "rio" and rows["20000", "RJ"]["lat"] == -22.5


def test_dimensions(tables):
    people = {r["customer_id"]: r for r in tables.dim_customers.collect()}
    assert people["c1"]["customer_unique_id"] == "u1" and people["c1"]["lat"] == -1.0
    assert {r["product_id"]: r["category"] for r in tables.dim_products.collect()} == {"p1": "Bed Bath Table", "p2": "Toys-2Nd Hand", "p3": None}
    assert {r["seller_id"]: r["seller_lat"] for r in tables.dim_sellers.collect()} == {"s1": -1.0, "s2": None}
    assert tables.dim_date.count() == 1096
    day = tables.dim_date.filter("date_id = 20160103").first()
    assert (day["week"], day["is_weekend"], day["day_name"], day["yyyymm"]) == (53, 1, "Sunday", "2016-01")


def test_fact_rows(tables):
    rows = {(r["order_id"], r["order_item_id"]): r for r in tables.fact_orders.collect()}
    assert set(rows) == {("o1", 1), ("o1", 2), ("o2", 1), ("o3", 1), ("o5", 2)}
    first = rows["o1", 1]
    assert (first["product_id"], float(first["revenue"]), first["review_score"]) == ("p1", 12.5, 5.0)
    assert (first["total_payment"], first["payment_installments"], first["payment_type"]) == (16.0, 3, "voucher")
    assert [rows[k]["delivery_delay_days"] for k in (("o1", 1), ("o2", 1), ("o3", 1))] == [-1, 1, None]
    assert rows["o3", 1]["is_delivered"] == 0 and rows["o5", 2]["yyyymm"] is None and rows["o5", 2]["state"] is None
    # scores after cleaning are 5, 5, 1: the median fills the two unscored orders
    assert rows["o2", 1]["review_score"] == 5.0 and rows["o5", 2]["review_score"] == 5.0
    assert sorted(r["fact_id"] for r in rows.values()) == [1, 2, 3, 4, 5]


def test_orphan_customer_counts_in_kpis_only(tables):
    assert reports.kpi_summary(tables.fact_orders).first()["unique_customers"] == 3
    assert sum(r["orders"] for r in reports.state_performance(tables.fact_orders, tables.dim_customers).collect()) == 3
    assert "ghost" not in [r["customer_id"] for r in customers.rfm_customers(tables.fact_orders, tables.dim_customers).collect()]


def test_unique_customer_rfm(tables):
    rows = customers.rfm_customers(tables.fact_orders, tables.dim_customers, customer_col="customer_unique_id").collect()
    assert [(r["customer_unique_id"], r["frequency"], r["monetary"]) for r in rows] == [("u1", 2, 45.0)]


def test_no_rows_give_zero_kpis(tables):
    assert reports.kpi_summary(tables.fact_orders.limit(0)).first().asDict()["total_revenue"] == 0.0
    assert reports.delivery_performance(tables.fact_orders.limit(0)).first()["late_pct"] == 0.0


def test_velocity_and_trend_count_item_rows(spark):
    def item(customer, order, item_id, day, revenue):
        return (customer, order, item_id, dt.date(2018, 1, 1) + dt.timedelta(days=day), revenue)

    rows = [item("one", "a", i, 0, 10.0) for i in (1, 2, 3)]
    rows += [item("two", "b", 1, 0, 5.0), item("two", "c", 1, 7, 5.0)]
    rows += [item("many", f"m{i}", 1, d, 10.0 * (i + 1)) for i, d in enumerate((0, 10, 20, 25))]
    df = spark.createDataFrame(rows, "customer_id string, order_id string, order_item_id int, order_date date, revenue double").withColumns({
        "revenue": F.col("revenue").cast("decimal(18,2)"), "price": F.col("revenue").cast("decimal(18,2)"), "freight_value": F.lit(0).cast("decimal(18,2)"),
        "review_score": F.lit(4.0), "payment_installments": F.lit(1), "delivery_delay_days": F.lit(0), "is_delivered": F.lit(1),
        "category": F.lit("x"), "product_id": F.lit("p"), "order_year": F.year("order_date"), "order_month": F.month("order_date"),
    })
    got = {r["customer_id"]: r for r in features.churn_features(df).collect()}
    assert got["one"]["velocity_change"] is None and got["one"]["revenue_trend"] == 2.0
    assert got["two"]["velocity_change"] == 1.0 and got["two"]["avg_days_between_orders"] == 7
    assert got["many"]["revenue_trend"] == 9.0 and got["many"]["velocity_change"] == 0.6
    assert got["many"]["avg_days_between_orders"] == 8 and got["many"]["active_months"] == 1 and got["many"]["active_years"] == 1
    assert got["two"]["days_since_second_last"] == (dt.date(2018, 9, 1) - dt.date(2018, 1, 1)).days


def test_stored_schema_invariants(stored):
    facts = stored.fact_orders
    assert facts.count() == facts.select("order_id", "order_item_id").distinct().count() == facts.agg(F.max("fact_id")).first()[0]
    assert facts.filter("order_id is null or customer_id is null or product_id is null or seller_id is null or review_score is null").count() == 0
    performance = reports.delivery_performance(facts).first()
    assert performance["late_pct"] + performance["on_time_pct"] == pytest.approx(100, abs=0.011)
    assert sum(r["revenue_share_pct"] for r in reports.category_performance(facts).collect()) <= 100.5


def test_csv_round_trip_keeps_file_order(spark, tmp_path):
    lines = ["order_id,payment_sequential,payment_type,payment_installments,payment_value"]
    lines += [f"o{i % 50},1,type{i},{i % 5},{i}.50" for i in range(2000)]
    (tmp_path / "order_payments.csv").write_text("\n".join(lines) + "\n")
    got = fact.payments_per_order(scan_csv(spark, str(tmp_path / "order_payments.csv"), "order_payments")).collect()
    assert {r["order_id"]: r["payment_type"] for r in got} == {f"o{i}": f"type{i}" for i in range(50)}
    assert float(next(r for r in got if r["order_id"] == "o0")["total_payment"]) == sum(i + 0.5 for i in range(0, 2000, 50))


def test_extract_reads_nine_files(spark, tmp_path):
    for name, schema in RAW_SCHEMAS.items():
        (tmp_path / f"{name}.csv").write_text(",".join(c.split()[0] for c in schema.split(", ")) + "\n")
    tables = extract(spark, str(tmp_path)).items()
    assert len(tables) == 9 and all(df.count() == 0 for _, df in tables)


def test_catalog_tables(spark, stored):
    wh.save_warehouse(spark, stored, "shop")
    assert wh.query(spark, "SELECT count(*) AS n FROM shop.fact_orders").first()["n"] == stored.fact_orders.count()


def test_bucketed_tables_join_without_shuffling_customers(spark, stored):
    wh.save_warehouse(spark, stored, "bucketed", buckets=4)
    tables = wh.open_database(spark, "bucketed")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        report = reports.state_performance(tables.fact_orders, tables.dim_customers)
        assert "Exchange hashpartitioning(customer_id" not in report._jdf.queryExecution().executedPlan().toString()
        assert report.exceptAll(reports.state_performance(stored.fact_orders, stored.dim_customers)).isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_csv_files_to_stored_tables(spark, raw, tables, tmp_path):
    """The hand-made inputs as CSV files, through extraction and the whole load."""
    for name, df in raw.items():
        columns = [c.split()[0] for c in RAW_SCHEMAS[name].split(", ")]
        ordered = df.orderBy("_order") if "_order" in df.columns else df
        ordered.toPandas().convert_dtypes().reindex(columns=columns).to_csv(tmp_path / f"{name}.csv", index=False)
    loaded = etl.run_etl(spark, extract(spark, str(tmp_path)), str(tmp_path / "out"), "2016-01-01", "2018-12-31")
    names = [c for c in tables.fact_orders.columns if c not in ("total_payment", "payment_installments")]
    want = sorted(map(str, tables.fact_orders.select(names).collect()))
    assert sorted(map(str, loaded.fact_orders.select(names).collect())) == want
    assert {r["table_name"]: r["row_count"] for r in loaded.row_counts().collect()} == {
        "fact_orders": 5, "dim_customers": 2, "dim_products": 3, "dim_sellers": 2, "dim_date": 1096, "dim_geolocation": 2,
    }


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "sellers.csv"
    path.write_text("seller_state,note,seller_id,seller_city,seller_zip_code_prefix\nSP,x,s1,a city,01234\nRJ,y,s2,b,20000\n")
    rows = scan_csv(spark, str(path), "sellers").orderBy("seller_id").collect()
    assert [(r.seller_id, r.seller_zip_code_prefix, r.seller_city, r.seller_state) for r in rows] == [("s1", "01234", "a city", "SP"), ("s2", "20000", "b", "RJ")]
    path.write_text("seller_state,seller_city,seller_zip_code_prefix\nSP,a,1\n")
    with pytest.raises(ValueError, match="seller_id"):
        scan_csv(spark, str(path), "sellers")


def test_broken_csv_lines_are_kept_and_counted(spark, tmp_path):
    path = tmp_path / "order_payments.csv"
    header = "order_id,payment_sequential,payment_type,payment_installments,payment_value"
    path.write_text(f"{header}\no1,1,boleto,1,10.50\no2,1,boleto,1,1.2.3\no3,1,boleto,1,5.00,extra\no4,1\n")
    scanned = scan_csv(spark, str(path), "order_payments")
    assert {r.order_id: (r.payment_value, r._corrupt is not None) for r in scanned.collect()} == {
        "o1": (Decimal("10.50"), False), "o2": (None, True), "o3": (Decimal("5.00"), True), "o4": (None, True),
    }
    assert {r.table_name: r.row_count for r in corrupt_counts([("order_payments", scanned), ("other", spark.range(3))]).collect()} == {"order_payments": 3}


def test_changed_files_are_loaded_again(spark, sf, tmp_path):
    import shutil

    from storelens.shared_warehouse import warehouse_for

    folder = tmp_path / "tables"
    shutil.copytree(sf, folder)
    before = warehouse_for(spark, str(folder)).dim_customers.count()
    assert warehouse_for(spark, str(folder)).dim_customers.count() == before
    customers = spark.read.parquet(f"{folder}/customer.parquet").filter("c_custkey % 2 = 0").toPandas()
    (folder / "customer.parquet").chmod(0o644)
    customers.to_parquet(folder / "customer.parquet")
    assert warehouse_for(spark, str(folder)).dim_customers.count() == len(customers)


def test_calendar_covers_the_years_of_the_orders(spark):
    orders = spark.createDataFrame([("2017-03-04 10:00:00",), ("nonsense",), ("2019-01-01 00:00:00",), (None,)], "order_purchase_timestamp string")
    days = dims.dim_date(dims.calendar_range(orders))
    assert (days.count(), days.agg({"date_id": "min"}).first()[0], days.agg({"date_id": "max"}).first()[0]) == (1095, 20170101, 20191231)
    assert dims.dim_date(dims.calendar_range(orders.limit(0))).count() == 0


def test_records_and_bounds(spark):
    df = spark.createDataFrame([("a", float("nan"), 1.5)], "k string, x double, y double")
    assert wh.to_records(df).first()["record"] == '{"k":"a","x":null,"y":1.5}'
    with pytest.raises(ValueError):
        wh.bounded_n(51, 1, 50)


def test_numbers_of_large_orders_equal_a_global_rank(spark, sf):
    """Orders beyond one task's rows are ranked over several; the numbers are the same, and no fact row is stored for them."""
    raw = bind_test_tables(spark, sf)
    dims = fact.customer_dim(raw), fact.product_dim(raw)
    plain = fact.fact_orders(raw, *dims)
    split = fact.fact_orders(raw, *dims, rows_per_task=5)
    columns = ["fact_id", *fact.ITEM_KEYS]
    expected = sorted((r.order_id, r.order_item_id) for r in plain.select(*fact.ITEM_KEYS).collect())
    for df in (plain, split):
        assert sorted(tuple(r) for r in df.select(*columns).collect()) == [(i + 1, *key) for i, key in enumerate(expected)]
    assert len(expected) > 1000
    scans = [line for line in plain._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Relation" in line]
    assert not any("delivery_delay_days" in line for line in scans)


def test_unowned_orders_take_no_numbers(spark, sf):
    from dataclasses import replace

    raw = bind_test_tables(spark, sf)
    some = F.col("order_id") % 3 == 0
    orders = raw.orders.withColumn("customer_id", F.when(~some, F.col("customer_id"))).filter("order_id % 7 != 0")
    raw = replace(raw, orders=orders)
    found = fact.fact_orders(raw, fact.customer_dim(raw), fact.product_dim(raw)).agg(F.min("fact_id"), F.max("fact_id"), F.countDistinct("fact_id"), F.count("*")).first()
    assert found[0] == 1 and found[1] == found[2] == found[3] > 0
    assert fact.fact_orders(replace(raw, orders=orders.limit(0)), fact.customer_dim(raw), fact.product_dim(raw)).count() == 0


def test_items_are_dealt_by_order_once_and_copies_are_dropped(spark, tmp_path):
    """Duplicates, numbers and the join with the header share one shuffle and one sort of the items; no map task sorts them, nor does the write shuffle them."""
    rows = [(1, 2, 7, 5, 3.0), (1, 2, 7, 4, 9.0), (1, 1, 8, 4, 1.0), (1, 1, 8, 4, 1.0), (2, None, 8, 4, 2.0), (2, None, 8, None, 1.0), (3, 1, 9, 9, 9.0)]
    items = spark.createDataFrame(rows, "order_id bigint, order_item_id int, product_id bigint, seller_id bigint, price double")
    sizes = items.groupBy("order_id").agg(F.count(F.lit(1)).alias("rows"))
    rest = ["product_id", "seller_id", "price"]
    expected = [(1, 1, 8, 4, 1.0, 1), (1, 2, 7, 4, 9.0, 2), (2, None, 8, None, 1.0, 1), (3, 1, 9, 9, 9.0, 1)]
    for limit in (1, 3, 100):  # all orders but one large, one large, none
        found = fact.numbered_items(items, sizes, rest, limit).select(*items.columns, "_item").collect()
        assert sorted(map(tuple, found), key=lambda r: (r[0], r[5])) == expected
    plan = fact.numbered_items(items, sizes, rest)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and plan.count("Sort [") == 1 and "SortAggregate" not in plan
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    years = spark.range(40).select((F.col("id") % 20).alias("order_year"), "id")
    assert wh.write_table(years, str(tmp_path), "fact_orders").agg(F.count("*"), F.sum("id")).first()[:] == (40, 780)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
