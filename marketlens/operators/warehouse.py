"""Staging to the star schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import clipped, money_sum, whole_days
from marketlens.rules import VALID_STATUSES


def dim_date(orders: DataFrame) -> DataFrame:
    """One row per day from the first purchase to the last delivery date.

    Orders not delivered yet count with their estimate.
    """
    span = orders.agg(
        F.min(F.to_date("order_purchase_timestamp")).alias("first"),
        F.max(F.coalesce(F.to_date("order_delivered_customer_date"),
                         F.to_date("order_estimated_delivery_date"))).alias("last"),
    ).where(F.col("first") <= F.col("last"))
    day = F.col("date")
    weekday = F.weekday(day) + 1
    return span.select(F.explode(F.sequence("first", "last")).alias("date")).select(
        "date",
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.weekofyear(day).alias("week"),
        F.day(day).alias("day"),
        weekday.cast("int").alias("day_of_week"),
        # Names are padded to nine characters.
        F.rpad(F.date_format(day, "EEEE"), 9, " ").alias("day_name"),
        F.rpad(F.date_format(day, "MMMM"), 9, " ").alias("month_name"),
        F.when(weekday >= 6, 1).otherwise(0).alias("is_weekend"),
    )


def dim_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        clipped("customer_id", 100), clipped("customer_unique_id", 100),
        clipped("customer_zip_code_prefix", 10),
        F.col("customer_city").cast("string").alias("customer_city"),
        clipped("customer_state", 10),
    )


def dim_sellers(sellers: DataFrame) -> DataFrame:
    return sellers.select(
        clipped("seller_id", 100), clipped("seller_zip_code_prefix", 10),
        F.col("seller_city").cast("string").alias("seller_city"), clipped("seller_state", 10),
    )


def dim_products(products: DataFrame, translation: DataFrame) -> DataFrame:
    """Products with the English category where one is known, and the volume."""
    measures = (
        "product_name_lenght", "product_description_lenght", "product_photos_qty",
        "product_weight_g", "product_length_cm", "product_height_cm", "product_width_cm",
    )
    english = translation.select("product_category_name", "product_category_name_english")
    volume = F.col("product_length_cm") * F.col("product_height_cm") * F.col("product_width_cm")
    return products.join(english, "product_category_name", "left").select(
        clipped("product_id", 100),
        "product_category_name",
        F.coalesce("product_category_name_english", "product_category_name").alias("category_english"),
        *[F.col(c).cast("double").alias(c) for c in measures],
        volume.cast("double").alias("product_volume_cm3"),
    )


def fact_order_items(items: DataFrame) -> DataFrame:
    """All items, also those of orders that cleaning dropped."""
    return items.select(
        clipped("order_id", 100), F.col("order_item_id").cast("int").alias("order_item_id"),
        clipped("product_id", 100), clipped("seller_id", 100),
        F.col("shipping_limit_date").cast("timestamp_ntz").alias("shipping_limit_date"),
        F.col("price").cast("double").alias("price"),
        F.col("freight_value").cast("double").alias("freight_value"),
    )


def order_totals(items: DataFrame) -> DataFrame:
    """Amounts and item count per order."""
    return items.groupBy("order_id").agg(
        money_sum(F.col("price")).alias("total_price"),
        money_sum(F.col("freight_value")).alias("total_freight"),
        money_sum(F.col("price") + F.col("freight_value")).alias("total_amount"),
        F.count(F.lit(1)).alias("item_count"),
    )


def order_reviews(reviews: DataFrame) -> DataFrame:
    """Mean score and review count per order."""
    return reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count(F.lit(1)).alias("review_count"),
    )


def fact_orders(orders: DataFrame, items: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row per order with delivery measures, amounts and review figures.

    Items and reviews are reduced to one row per order first, so all three
    sides meet on the same partitioning by order.
    """
    purchased = F.col("order_purchase_timestamp")
    delivered = F.col("order_delivered_customer_date")
    estimated = F.col("order_estimated_delivery_date")
    on_time = F.when(delivered.isNotNull(), F.when(delivered <= estimated, 1).otherwise(0))
    zero = F.lit(0)
    return (
        orders.where(F.col("order_status").isin(*VALID_STATUSES))
        .join(order_totals(items), "order_id", "left")
        .join(order_reviews(reviews), "order_id", "left")
        .select(
            clipped("order_id", 100), clipped("customer_id", 100), clipped("order_status", 50),
            "order_purchase_timestamp", "order_approved_at", "order_delivered_carrier_date",
            "order_delivered_customer_date", "order_estimated_delivery_date",
            whole_days(delivered, estimated).alias("delivery_delay_days"),
            on_time.cast("int").alias("on_time_delivery"),
            whole_days(delivered, purchased).alias("actual_delivery_days"),
            F.coalesce("total_price", F.lit(0.0)).alias("total_price"),
            F.coalesce("total_freight", F.lit(0.0)).alias("total_freight"),
            F.coalesce("total_amount", F.lit(0.0)).alias("total_amount"),
            F.coalesce("item_count", zero).cast("int").alias("item_count"),
            "avg_review_score",
            F.coalesce("review_count", zero).cast("int").alias("review_count"),
        )
    )
