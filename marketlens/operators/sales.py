"""Sales aggregates by day, product, category and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.functions.columns import half_up, money_sum
from marketlens.functions.order_stats import rank_descending
from marketlens.rules import VALID_STATUSES


def counted_orders(fact_orders: DataFrame) -> DataFrame:
    return fact_orders.where(F.col("order_status").isin(*VALID_STATUSES))


def daily_sales(fact_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, orders and real customers per purchase day, without gaps.

    Orders are combined per day and customer first, which leaves one distinct
    count per step. An order belongs to one customer, so the counts add up.
    Gaps are filled by stretching each day to the next one; that window sees one
    row per calendar day.
    """
    per_customer = (
        counted_orders(fact_orders).select("customer_id", "order_id", "total_amount",
                                           F.to_date("order_purchase_timestamp").alias("date"))
        .join(customers.select("customer_id", "customer_unique_id"), "customer_id")
        .groupBy("date", "customer_unique_id")
        .agg(F.sum(F.col("total_amount").cast("decimal(18,2)")).alias("revenue"),
             F.count_distinct("order_id").alias("orders"))
    )
    daily = per_customer.groupBy("date").agg(
        F.sum("revenue").cast("double").alias("revenue"),
        F.sum("orders").alias("orders"),
        F.count("customer_unique_id").alias("customers"),
    ).where("date is not null")
    following = F.lead("date").over(Window.orderBy("date"))
    stretched = daily.withColumn("until", F.coalesce(F.date_sub(following, 1), F.col("date")))
    days = stretched.select("*", F.explode(F.sequence("date", "until")).alias("day"))
    traded = F.col("day") == F.col("date")
    return days.select(
        F.col("day").alias("date"),
        F.when(traded, F.col("revenue")).otherwise(0.0).alias("revenue"),
        F.when(traded, F.col("orders")).otherwise(0).alias("orders"),
        F.when(traded, F.col("customers")).otherwise(0).alias("customers"),
    )


def product_totals(items: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Revenue, quantity and orders per product, counted orders only."""
    return (
        items.select("order_id", "product_id", "price")
        .join(counted_orders(fact_orders).select("order_id"), "order_id")
        .groupBy("product_id")
        .agg(
            money_sum(F.col("price")).alias("revenue"),
            F.count(F.lit(1)).alias("quantity"),
            F.count_distinct("order_id").alias("order_count"),
        )
    )


def product_performance(totals: DataFrame) -> DataFrame:
    """Stored product totals with their revenue rank (ties share a rank)."""
    return rank_descending(totals, "revenue", "rank")


def category_performance(items: DataFrame, products: DataFrame, fact_orders: DataFrame) -> DataFrame:
    """Revenue, orders and mean price per English category.

    Items are combined per product and order before the category is looked up,
    so a bestseller does not pile up in the join.
    """
    sold = (
        items.select("order_id", "product_id", "price")
        .join(counted_orders(fact_orders).select("order_id"), "order_id")
        .groupBy("product_id", "order_id")
        .agg(F.sum(F.col("price").cast("decimal(18,2)")).alias("amount"),
             F.count("price").alias("pieces"))
    )
    return (
        sold.join(products.select("product_id", "category_english"), "product_id")
        .groupBy(F.col("category_english").alias("category"))
        .agg(
            F.sum("amount").cast("double").alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            F.sum("pieces").alias("pieces"),
        )
        .select("category", "revenue", "orders",
                half_up(F.try_divide("revenue", "pieces")).alias("avg_price"))
    )


def state_performance(fact_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Revenue, orders and mean delivery days per customer state."""
    return (
        counted_orders(fact_orders)
        .select("order_id", "customer_id", "total_amount", "actual_delivery_days")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy(F.col("customer_state").alias("state"))
        .agg(
            money_sum(F.col("total_amount")).alias("revenue"),
            F.count_distinct("order_id").alias("orders"),
            half_up(F.avg("actual_delivery_days")).alias("avg_delivery_days"),
        )
    )
