from __future__ import annotations

from datetime import date, datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions.columns import cents, haversine_km, money_sum
from marketlens.operators import sales, sellers


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        ("1", "a", "delivered", dt(2021, 1, 1, 9), 10.0, 2.0),
        ("2", "b", "shipped", dt(2021, 1, 1, 20), 5.5, None),
        ("3", "a", "delivered", dt(2021, 1, 4, 1), 1.0, 5.0),
        ("4", "a", "canceled", dt(2021, 1, 9), 99.0, 1.0),
    ]
    return spark.createDataFrame(
        rows, "order_id string, customer_id string, order_status string,"
              " order_purchase_timestamp timestamp_ntz, total_amount double, actual_delivery_days double")


@pytest.fixture(scope="module")
def customers(spark):
    return spark.createDataFrame(
        [("a", "person", "10", "SP"), ("b", "person", "11", "RJ")],
        "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_state string")


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [("1", "p", "s", 4.0, 1.0), ("1", "p", "s", 6.0, 1.0), ("2", "q", "s", 5.5, 0.0),
         ("3", "q", "t", 4.5, 1.0), ("4", "q", "t", 99.0, 1.0)],
        "order_id string, product_id string, seller_id string, price double, freight_value double")


def test_daily_sales_fill_gaps_and_count_people_once(facts, customers):
    out = sales.daily_sales(facts, customers).orderBy("date").collect()
    assert [tuple(r) for r in out] == [
        (date(2021, 1, 1), 15.5, 2, 1), (date(2021, 1, 2), 0.0, 0, 0),
        (date(2021, 1, 3), 0.0, 0, 0), (date(2021, 1, 4), 1.0, 1, 1),
    ]


def test_daily_sales_of_nothing(facts, customers):
    assert sales.daily_sales(facts.limit(0), customers).count() == 0


def test_products_with_equal_revenue_share_a_rank(facts, items):
    out = sales.product_performance(sales.product_totals(items, facts)).orderBy("product_id").collect()
    assert [tuple(r) for r in out] == [("p", 10.0, 2, 1, 1), ("q", 10.0, 2, 2, 1)]


def test_state_and_category(spark, facts, customers, items):
    states = {r.state: r for r in sales.state_performance(facts, customers).collect()}
    assert (states["SP"].revenue, states["SP"].orders, states["SP"].avg_delivery_days) == (11.0, 2, 3.5)
    assert states["RJ"].avg_delivery_days is None
    products = spark.createDataFrame([("p", "x"), ("q", "x")], "product_id string, category_english string")
    out = sales.category_performance(items, products, facts).first()
    assert tuple(out) == ("x", 20.0, 3, 5.0)


def test_evaluation_repeats_items_per_review(spark, items):
    stamps = ("order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
              "order_delivered_customer_date", "order_estimated_delivery_date")
    facts = spark.createDataFrame([("1", "delivered"), ("3", "delivered")], "order_id string, order_status string")
    facts = facts.withColumns({c: F.lit(None).cast("timestamp_ntz") for c in stamps})
    reviews = spark.createDataFrame(
        [("1", 5.0, "x"), ("1", 2.0, "y")],
        "order_id string, review_score double, review_comment_message string")
    dated = items.withColumn("shipping_limit_date", F.lit(None).cast("timestamp_ntz"))
    out = sellers.seller_evaluation(dated, facts, reviews)
    counts = {r.order_id: r["count"] for r in out.groupBy("order_id").count().collect()}
    assert counts == {"1": 4, "3": 1}
    assert len(out.columns) == 14


def test_money_is_rounded_as_decimals_and_summed_as_longs(spark):
    values = [0.0, 0.005, 0.015, 1.005, 2.675, -0.005, -1.115, 0.1 + 0.2, 19.99, 1e9 + 0.015, 123456789012.345, 1e13 + 0.25, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    amount = F.col("v")
    for r in df.select("v", cents(amount).alias("c"), amount.cast("decimal(18,2)").alias("d")).collect():
        assert r.c == (None if r.d is None else int(r.d * 100)), r.v
    for some in (df, df.where("abs(v) < 1e9"), df.where("v is null"), df.unionAll(df.select(F.lit(9e13)))):
        total = some.agg(money_sum(amount).alias("now"), F.sum(amount.cast("decimal(18,2)")).cast("double").alias("plain")).first()
        assert total.now == total.plain
    plan = df.groupBy().agg(money_sum(amount))._jdf.queryExecution().executedPlan().toString()
    assert "decimal(28,2)" not in plan and "partial_sum" in plan


def test_sellers_come_from_stored_items_where_there_are_some(spark, tmp_path):
    from marketlens.fixtures import driver_tables

    spark.createDataFrame([(1, "PERU")], "n_nationkey int, n_name string").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(7, 1)], "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    items = spark.createDataFrame([("7-1",), ("7-1",), ("7-p14",), ("8-1",), (None,)], "seller_id string")
    found = driver_tables.sellers(spark, str(tmp_path), items).orderBy("seller_id").collect()  # there are no lines to read
    assert [tuple(r) for r in found] == [("7-1", "10004", "city7", "PERU"), ("7-p14", "10004", "city7", "PERU")]


def test_haversine(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0), (0.0, 0.0, 0.0, 0.0), (None, 0.0, 0.0, 0.0)],
                               "a double, b double, c double, d double")
    out = [r[0] for r in df.select(haversine_km(*[F.col(c) for c in "abcd"])).collect()]
    assert out[0] == pytest.approx(3.141592653589793 * 6371.0088)
    assert out[1:] == [0.0, None]


def test_distance_takes_the_farthest_seller_per_order(spark, facts, customers, items):
    geo = spark.createDataFrame(
        [("10", 0.0, 0.0), ("10", 0.0, 2.0), ("20", 0.0, 3.0), ("21", 0.0, 5.0)],
        "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double")
    shops = spark.createDataFrame([("s", "20"), ("t", "21")], "seller_id string, seller_zip_code_prefix string")
    both = items.union(items.where("order_id = '1'").withColumn("seller_id", F.lit("t")).limit(1))
    out = {r.order_id: r.distance_km for r in
           sellers.logistics_distance(both, facts, customers, shops, geo).collect()}
    degree = 3.141592653589793 * 6371.0088 / 180
    assert out["1"] == pytest.approx(4 * degree)
    assert out["2"] is None


def test_segmentation_features(spark, facts, customers, items):
    distances = spark.createDataFrame([("1", 10.0), ("3", 30.0)], "order_id string, distance_km double")
    products = spark.createDataFrame(
        [("p", 100.0, "x"), ("q", 400.0, "y")],
        "product_id string, product_weight_g double, product_category_name string")
    free = items.withColumn("price", F.when(F.col("order_id") == "3", 0.0).otherwise(F.col("price")))
    out = {r.seller_id: r for r in sellers.seller_segmentation(
        sellers.seller_order_metrics(free, facts, customers, distances),
        sellers.seller_item_metrics(free, products)).collect()}
    s, t = out["s"], out["t"]
    assert (s.avg_weight_g, s.category_diversity, s.market_reach) == (200.0, 2, 1)
    assert (s.avg_order_value, s.avg_freight_ratio, s.avg_distance_km) == (10.0, 0.2, 10.0)
    # A value of zero gives no ratio; items of dropped orders still count as assortment.
    assert t.avg_freight_ratio is None and t.category_diversity == 1


def test_item_rows_do_not_move_to_their_customer(spark, facts, customers, items):
    geo = spark.createDataFrame(
        [("10", 0.0, 0.0)], "geolocation_zip_code_prefix string, geolocation_lat double, geolocation_lng double")
    shops = spark.createDataFrame([("s", "20")], "seller_id string, seller_zip_code_prefix string")
    distances = spark.createDataFrame([("1", 10.0)], "order_id string, distance_km double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plans = [df._jdf.queryExecution().executedPlan().toString().splitlines() for df in (
            sellers.logistics_distance(items, facts, customers, shops, geo),
            sellers.seller_order_metrics(items, facts, customers, distances))]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for lines in plans:
        depth = [len(line) - len(line.lstrip(" :+-*()0123456789")) for line in lines]
        moves = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(customer_id" in line]
        assert len(moves) == 2  # orders and customers
        for i in moves:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            assert not any("seller_id" in line for line in lines[i:end])
