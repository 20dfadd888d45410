from __future__ import annotations

from datetime import date, datetime as dt

import pytest

from marketlens.operators import warehouse

ORDER = ("order_id string, customer_id string, order_status string,"
         " order_purchase_timestamp timestamp_ntz, order_approved_at timestamp_ntz,"
         " order_delivered_carrier_date timestamp_ntz, order_delivered_customer_date timestamp_ntz,"
         " order_estimated_delivery_date timestamp_ntz")
ITEM = "order_id string, price double, freight_value double"
REVIEW = "order_id string, review_score double"


def orders(spark, *rows):
    return spark.createDataFrame(
        [(k, "c", s, p, None, None, d, e) for k, s, p, d, e in rows], ORDER)


def test_calendar_runs_to_last_delivery_or_estimate(spark):
    out = warehouse.dim_date(orders(
        spark,
        ("1", "delivered", dt(2021, 1, 1, 23), dt(2021, 1, 3, 1), dt(2021, 2, 1)),
        ("2", "shipped", dt(2021, 1, 2), None, dt(2021, 1, 4)),
    )).orderBy("date").collect()
    assert [r.date for r in out] == [date(2021, 1, d) for d in (1, 2, 3, 4)]
    first = out[0]
    assert (first.year, first.quarter, first.month, first.week, first.day) == (2021, 1, 1, 53, 1)
    assert (first.day_of_week, first.day_name, first.month_name) == (5, "Friday   ", "January  ")
    assert [r.is_weekend for r in out] == [0, 1, 1, 0]


def test_calendar_of_nothing_is_empty(spark):
    assert warehouse.dim_date(orders(spark)).count() == 0


@pytest.mark.parametrize("delivered, estimated, delay, on_time", [
    (dt(2021, 1, 1, 18), dt(2021, 1, 3), -1.0, 1),
    (dt(2021, 1, 4, 6), dt(2021, 1, 3), 1.0, 0),
    (dt(2021, 1, 3), dt(2021, 1, 3), 0.0, 1),
    (dt(2021, 1, 3), None, None, 0),
    (None, dt(2021, 1, 3), None, None),
])
def test_delay_is_cut_toward_zero(spark, delivered, estimated, delay, on_time):
    facts = warehouse.fact_orders(
        orders(spark, ("1", "shipped", dt(2021, 1, 1), delivered, estimated)),
        spark.createDataFrame([], ITEM), spark.createDataFrame([], REVIEW)).first()
    assert (facts.delivery_delay_days, facts.on_time_delivery) == (delay, on_time)
    assert (facts.total_amount, facts.item_count, facts.review_count) == (0.0, 0, 0)
    assert facts.avg_review_score is None


def test_facts_do_not_fan_out(spark):
    facts = warehouse.fact_orders(
        orders(spark, ("1", "shipped", dt(2021, 1, 1), None, None), ("2", "canceled", None, None, None)),
        spark.createDataFrame([("1", 0.1, 0.2), ("1", 0.2, 0.3)], ITEM),
        spark.createDataFrame([("1", 5.0), ("1", None), ("1", 2.0)], REVIEW)).collect()
    assert len(facts) == 1
    assert (facts[0].total_price, facts[0].total_freight, facts[0].total_amount) == (0.3, 0.5, 0.8)
    assert (facts[0].item_count, facts[0].avg_review_score, facts[0].review_count) == (2, 3.5, 3)


def test_product_category_falls_back_to_the_original(spark):
    sizes = ("product_name_lenght", "product_description_lenght", "product_photos_qty",
             "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm")
    schema = "product_id string, product_category_name string, " + ", ".join(f"{c} double" for c in sizes)
    rows = [(p, c, 1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0) for p, c in (("1", "toys"), ("2", "unknown"))]
    translation = spark.createDataFrame(
        [("toys", "en_toys")], "product_category_name string, product_category_name_english string")
    out = warehouse.dim_products(spark.createDataFrame(rows, schema), translation).orderBy("product_id").collect()
    assert [(r.category_english, r.product_volume_cm3) for r in out] == [("en_toys", 24.0), ("unknown", 24.0)]


def test_text_columns_are_clipped(spark):
    df = spark.createDataFrame([("s" * 120, "1" * 12, "c" * 200, "state-name-long")],
                               "seller_id string, seller_zip_code_prefix string, seller_city string, seller_state string")
    assert [len(v) for v in warehouse.dim_sellers(df).first()] == [100, 10, 200, 10]
