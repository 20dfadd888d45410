"""Seller inputs: evaluation rows, delivery distance and segmentation features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import haversine_km, money_sum


def seller_evaluation(items: DataFrame, fact_orders: DataFrame, reviews: DataFrame) -> DataFrame:
    """Items with their order's dates and review.

    Every review of an order repeats its items: an order with two reviews counts
    its items twice in whatever is built on this table.
    """
    item_side = items.select("order_id", "seller_id", "product_id", "shipping_limit_date",
                             "price", "freight_value")
    order_side = fact_orders.where("order_status is not null").select(
        "order_id", "order_status", "order_purchase_timestamp", "order_approved_at",
        "order_delivered_carrier_date", "order_delivered_customer_date",
        "order_estimated_delivery_date",
    )
    review_side = reviews.select("order_id", "review_score", "review_comment_message")
    return (
        item_side.join(order_side, "order_id").join(review_side, "order_id", "left")
        .select(
            "seller_id", "order_id", "product_id", "order_status", "order_purchase_timestamp",
            "order_approved_at", "order_delivered_carrier_date", "order_delivered_customer_date",
            "order_estimated_delivery_date", "shipping_limit_date", "review_score",
            "review_comment_message", "price", "freight_value",
        )
    )


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """Mean coordinates per zip prefix."""
    return geolocation.groupBy(F.col("geolocation_zip_code_prefix").alias("zip")).agg(
        F.avg("geolocation_lat").alias("lat"), F.avg("geolocation_lng").alias("lng")
    )


def logistics_distance(
    items: DataFrame, fact_orders: DataFrame, customers: DataFrame, sellers: DataFrame,
    geolocation: DataFrame,
) -> DataFrame:
    """Longest seller-to-customer distance per order, one row per order.

    Coordinates are attached to the two dimensions, and the customer's to the order, so
    that item rows move twice: to their seller and to their order. Orders without a
    known distance keep a null.
    """
    centroids = zip_centroids(geolocation)

    def located(dim: DataFrame, key: str, zip_column: str, prefix: str) -> DataFrame:
        return dim.select(key, F.col(zip_column).alias("zip")).join(centroids, "zip", "left").select(
            key, F.col("lat").alias(f"{prefix}_lat"), F.col("lng").alias(f"{prefix}_lng")
        )

    destinations = fact_orders.select("order_id", "customer_id").join(
        located(customers, "customer_id", "customer_zip_code_prefix", "customer"), "customer_id", "left"
    ).drop("customer_id")
    legs = (
        items.select("order_id", "seller_id")
        .join(located(sellers, "seller_id", "seller_zip_code_prefix", "seller"), "seller_id", "left")
        .join(destinations, "order_id")
    )
    distance = haversine_km(F.col("seller_lat"), F.col("seller_lng"),
                            F.col("customer_lat"), F.col("customer_lng"))
    return legs.groupBy("order_id").agg(F.max(distance).alias("distance_km"))


def seller_order_metrics(
    items: DataFrame, fact_orders: DataFrame, customers: DataFrame, distances: DataFrame,
) -> DataFrame:
    """Value, freight, distance and customer state per seller and delivered order.

    Items are summed per seller and order before the joins; orders, customers
    and distances have one row per key, so no second aggregation is needed. They
    meet each other first, as orders are fewer than baskets.
    """
    baskets = items.groupBy("seller_id", "order_id").agg(
        money_sum(F.col("price")).alias("order_value"),
        money_sum(F.col("freight_value")).alias("order_freight"),
    )
    delivered = (
        fact_orders.where("order_status = 'delivered'").select("order_id", "customer_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .join(distances.select("order_id", "distance_km"), "order_id", "left")
    )
    return baskets.join(delivered, "order_id").select(
        "seller_id", "order_id", "order_value", "order_freight", "distance_km", "customer_state")


def seller_item_metrics(items: DataFrame, products: DataFrame) -> DataFrame:
    """Mean item weight and number of categories per seller, over all items."""
    pieces = items.groupBy("seller_id", "product_id").agg(F.count(F.lit(1)).alias("pieces"))
    joined = pieces.join(
        products.select("product_id", "product_weight_g", "product_category_name"), "product_id"
    )
    weight = F.col("product_weight_g")
    return joined.groupBy("seller_id").agg(
        F.try_divide(F.sum(weight * F.col("pieces")),
                     F.sum(F.when(weight.isNotNull(), F.col("pieces")))).alias("avg_item_weight_g"),
        F.count_distinct("product_category_name").alias("distinct_categories"),
    )


def seller_segmentation(order_metrics: DataFrame, item_metrics: DataFrame) -> DataFrame:
    """The six descriptive features of every seller with a delivered order."""
    ratio = F.col("order_freight") / F.nullif(F.col("order_value"), F.lit(0.0))
    per_seller = order_metrics.groupBy("seller_id").agg(
        F.count_distinct("customer_state").alias("market_reach"),
        F.avg("distance_km").alias("avg_distance_km"),
        F.avg("order_value").alias("avg_order_value"),
        F.avg(ratio).alias("avg_freight_ratio"),
    )
    return per_seller.join(item_metrics, "seller_id", "left").select(
        "seller_id",
        F.coalesce("avg_item_weight_g", F.lit(0.0)).alias("avg_weight_g"),
        F.coalesce("distinct_categories", F.lit(1)).alias("category_diversity"),
        "market_reach", "avg_distance_km", "avg_order_value", "avg_freight_ratio",
    )
