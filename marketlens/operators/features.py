"""Seller features from evaluation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import elapsed_seconds, known, money_sum
from marketlens.functions.order_stats import quantiles
from marketlens.rules import SEGMENT_LOG_FEATURES

DEFAULT_PREP_HOURS = 24.0


def with_operations(rows: DataFrame) -> DataFrame:
    """Rows with a known preparation time, and whether they shipped late.

    Time from approval to carrier in hours; negative times count as zero. A
    missing shipping limit is not late.
    """
    handed, approved = F.col("order_delivered_carrier_date"), F.col("order_approved_at")
    hours = elapsed_seconds(handed, approved) / 3600.0
    late = known(handed > F.col("shipping_limit_date"))
    return rows.where(handed.isNotNull() & approved.isNotNull()).withColumns({
        "prep_time_hours": F.greatest(hours, F.lit(0.0)),
        "is_late_shipment": F.when(late, 1).otherwise(0),
    })


def seller_ops(operations: DataFrame) -> DataFrame:
    """Share of late shipments and median preparation time per seller."""
    rows = operations.where("seller_id is not null")
    late = rows.groupBy("seller_id").agg(F.avg("is_late_shipment").alias("late_shipment_rate"))
    # Fewer parts keep most sellers' part totals small.
    prep = quantiles(rows, "prep_time_hours", [0.5], by=["seller_id"], parts=64)
    return late.join(prep, "seller_id", "left").select(
        "seller_id",
        F.coalesce("late_shipment_rate", F.lit(0.0)).alias("late_shipment_rate"),
        F.coalesce("q0", F.lit(DEFAULT_PREP_HOURS)).alias("avg_prep_time_hours"),
    )


def scale_measures() -> dict[str, Column]:
    """Revenue and mean adjusted score, as aggregates of judged rows."""
    return {"gmv": money_sum(F.col("price")), "avg_rating": F.avg("adjusted_review_score")}


def seller_scale(judged: DataFrame, lifetime: DataFrame | None = None) -> DataFrame:
    """Revenue, orders and mean adjusted score per seller.

    A ``lifetime`` that was made of the judged rows with ``scale_measures`` holds them already: only its sellers
    count, and the rows are not read again.
    """
    if lifetime is not None:
        return lifetime.select("seller_id", "gmv", "total_orders", "avg_rating")
    gmv, rating = (measure.alias(name) for name, measure in scale_measures().items())
    return judged.where("seller_id is not null").groupBy("seller_id").agg(
        gmv, F.count_distinct("order_id").alias("total_orders"), rating)


def joined_features(scale: DataFrame, ops: DataFrame) -> DataFrame:
    """All sellers with their features; operations may be missing."""
    return scale.join(ops, "seller_id", "left")


def missing_operations(features: DataFrame) -> DataFrame:
    """How many sellers have no operations data."""
    gap = F.col("avg_prep_time_hours").isNull() | F.col("late_shipment_rate").isNull()
    return features.agg(F.count(F.lit(1)).alias("sellers"), F.count_if(gap).alias("missing_ops"))


def seller_features(features: DataFrame) -> DataFrame:
    """Sellers with operations data; unrated ones get the mean rating of those left."""
    complete = features.dropna(subset=["avg_prep_time_hours", "late_shipment_rate"])
    mean = complete.agg(F.avg("avg_rating")).scalar()
    return complete.withColumn("avg_rating", F.coalesce(F.col("avg_rating"), mean))


def log_features(features: DataFrame) -> DataFrame:
    """Add ln(x + 1) of revenue and orders."""
    return features.withColumns({
        "log_gmv": F.log1p("gmv"), "log_orders": F.log1p("total_orders"),
    })


def log_segment_features(segmentation: DataFrame) -> DataFrame:
    """Add ln(x + 1) of the five skewed segmentation features."""
    return segmentation.withColumns({f"log_{c}": F.log1p(c) for c in SEGMENT_LOG_FEATURES})
