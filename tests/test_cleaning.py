from __future__ import annotations

from datetime import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlens.functions.columns import to_number, to_timestamp
from marketlens.operators.cleaning import (
    clean_order_items, clean_orders, clean_products, clean_reviews, removed_by_dedup,
)
from marketlens.sources.schemas import file_schema

REVIEW = ("review_id string, order_id string, review_score string, review_comment_title string,"
          " review_comment_message string, review_creation_date string, review_answer_timestamp string")


def reviews(spark, *rows):
    return spark.createDataFrame(list(rows), REVIEW)


def test_coercion_turns_garbage_and_nan_into_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), ("NaN",), (None,), (" 7 ",)], "v string")
    assert [r[0] for r in df.select(to_number(F.col("v"))).collect()] == [1.5, None, None, None, 7.0]
    dates = spark.createDataFrame([("2020-01-02 03:04:05",), ("soon",), (None,)], "v string")
    assert [r[0] for r in dates.select(to_timestamp(F.col("v"))).collect()] == [
        dt(2020, 1, 2, 3, 4, 5), None, None]


def test_latest_review_wins_and_open_answer_counts_as_latest(spark):
    out = clean_reviews(reviews(
        spark,
        ("a", "1", "5", None, "old", "2020-01-01", "2020-01-02"),
        ("a", "2", "1", None, None, "2020-01-01", "2020-01-05"),
        ("b", "3", "4", "t", "answered", "2020-02-01", "2020-02-09"),
        ("b", "4", "2", "t", "open", "2020-01-01", None),
        ("c", "5", "bad", None, "m", "2020-01-01", "2020-01-02"),
        ("c", "6", "3", None, "m", "2020-01-03", "2020-01-02"),
    ))
    rows = {r.review_id: r for r in out.collect()}
    assert rows["a"].order_id == "2" and rows["a"].review_comment_message == ""
    assert rows["a"].review_comment_title == ""
    assert rows["b"].review_comment_message == "open"
    assert rows["c"].order_id == "6"
    assert out.columns == file_schema("reviews").names


def test_null_review_ids_form_one_group(spark):
    df = reviews(spark, (None, "1", "5", None, "x", "2020-01-01", "2020-01-02"),
                 (None, "2", "4", None, "y", "2020-01-01", "2020-01-03"))
    assert [r.order_id for r in clean_reviews(df).collect()] == ["2"]
    assert tuple(removed_by_dedup(df).first()) == (2, 1, 1)


def test_review_cleaning_is_idempotent_and_order_independent(spark):
    rows = [("a", str(i), str(i % 6), None, f"m{i % 3}", "2020-01-01", "2020-01-02") for i in range(9)]
    once = clean_reviews(reviews(spark, *rows))
    again = clean_reviews(once)
    backwards = clean_reviews(reviews(spark, *rows[::-1]))
    assert once.collect() == again.collect() == backwards.collect()


ORDER = ("order_id string, customer_id string, order_status string, order_purchase_timestamp string,"
         " order_approved_at string, order_delivered_carrier_date string,"
         " order_delivered_customer_date string, order_estimated_delivery_date string")


def order(key, status, purchase, delivered, estimated):
    return (key, "c", status, purchase, None, None, delivered, estimated)


@pytest.mark.parametrize("row, kept", [
    (order("ok", "delivered", "2020-01-02", "2020-01-05", "2020-01-09"), True),
    (order("status", "canceled", "2020-01-02", "2020-01-05", "2020-01-09"), False),
    (order("no status", None, "2020-01-02", "2020-01-05", "2020-01-09"), False),
    (order("undated", "delivered", "2020-01-02", None, "2020-01-09"), False),
    (order("shipped undated", "shipped", "2020-01-02", None, "2020-01-09"), True),
    (order("backwards", "delivered", "2020-01-06", "2020-01-05", "2020-01-09"), False),
    (order("same time", "delivered", "2020-01-05", "2020-01-05", "2020-01-05"), True),
    (order("no purchase", "delivered", None, "2020-01-05", "2020-01-09"), True),
    (order("early estimate", "shipped", "2020-01-02", None, "2020-01-01"), False),
    (order("no estimate", "invoiced", "2020-01-02", None, None), True),
    (order("garbage estimate", "invoiced", "2020-01-02", None, "soon"), True),
])
def test_order_rules(spark, row, kept):
    assert (clean_orders(spark.createDataFrame([row], ORDER)).count() == 1) is kept


def test_order_cleaning_is_idempotent(spark):
    df = clean_orders(spark.createDataFrame(
        [order("ok", "delivered", "2020-01-02", "2020-01-05", "2020-01-09")], ORDER))
    assert clean_orders(df).collect() == df.collect()


def test_items_fill_amounts_with_zero(spark):
    df = spark.createDataFrame(
        [("1", 1, "p", "s", "2020-01-01", "9.5", "x"), ("1", 2, "p", "s", "later", None, "1")],
        "order_id string, order_item_id int, product_id string, seller_id string,"
        " shipping_limit_date string, price string, freight_value string")
    first, second = clean_order_items(df).collect()
    assert (first.price, first.freight_value) == (9.5, 0.0)
    assert (second.price, second.freight_value, second.shipping_limit_date) == (0.0, 1.0, None)


def products(spark, weights, columns="product_weight_g"):
    rows = [(str(i), None if i == 0 else "toys", w) for i, w in enumerate(weights)]
    return spark.createDataFrame(rows, f"product_id string, product_category_name string, {columns} string")


def test_product_median_counts_values_it_later_replaces(spark):
    out = clean_products(products(spark, ["-5", "10", "0", None, "20"]))
    # Median of -5, 0, 10, 20 is 5.
    assert [r.product_weight_g for r in out.orderBy("product_id").collect()] == [5.0, 10.0, 5.0, 5.0, 20.0]
    assert out.where("product_id = '0'").first().product_category_name == "unknown"


def test_product_median_of_nothing_is_zero(spark):
    out = clean_products(products(spark, [None, "x"]))
    assert [r.product_weight_g for r in out.collect()] == [0.0, 0.0]


def test_product_counts_fill_with_zero(spark):
    out = clean_products(products(spark, ["3", None], "product_photos_qty"))
    assert [r.product_photos_qty for r in out.orderBy("product_id").collect()] == [3.0, 0.0]
    assert out.columns == ["product_id", "product_category_name", "product_photos_qty"]
