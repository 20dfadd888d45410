"""Seller recency, frequency and lifetime, and the filter built on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import floor_days
from marketlens.functions.order_stats import quantiles
from marketlens.rules import CHURN_THRESHOLDS_DAYS, FREQUENCY_QUANTILES, ActivityRules


def seller_lifetime(rows: DataFrame, **more: Column) -> DataFrame:
    """First and last sale, orders, recency and tenure per seller, and ``more`` aggregates from the same pass.

    Days count back from the newest purchase of the whole table.
    """
    newest = rows.agg(F.max("order_purchase_timestamp")).scalar()
    return (
        rows.where("seller_id is not null").groupBy("seller_id").agg(
            F.min("order_purchase_timestamp").alias("first_sale_date"),
            F.max("order_purchase_timestamp").alias("last_sale_date"),
            F.count_distinct("order_id").alias("total_orders"),
            *[measure.alias(name) for name, measure in more.items()],
        ).withColumns({
            "days_since_last_sale": floor_days(newest, F.col("last_sale_date")),
            "days_since_first_sale": floor_days(newest, F.col("first_sale_date")),
        })
    )


def seller_recency(rows: DataFrame) -> DataFrame:
    """Last sale, orders and days since the last sale per seller."""
    return seller_lifetime(rows).select(
        "seller_id", "last_sale_date", "total_orders", "days_since_last_sale"
    )


def churn_thresholds(
    recency: DataFrame, thresholds: Sequence[int] = CHURN_THRESHOLDS_DAYS,
) -> DataFrame:
    """Sellers active within each number of days, all thresholds in one pass."""
    row = recency.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.col("days_since_last_sale") <= t).alias(f"active_{t}") for t in thresholds],
    )
    cells = [F.struct(F.lit(t).alias("threshold_days"), F.col(f"active_{t}").alias("active_sellers"))
             for t in thresholds]
    return row.select("total", F.explode(F.array(*cells)).alias("c")).select(
        "c.threshold_days", "c.active_sellers",
        F.try_divide(F.col("c.active_sellers") * 100.0, "total").alias("pct_active"),
        (F.col("total") - F.col("c.active_sellers")).alias("dropped_sellers"),
    )


def frequency_quantiles(
    recency: DataFrame, probs: Sequence[float] = FREQUENCY_QUANTILES,
) -> DataFrame:
    """Exact quantiles of orders per seller: (quantile, total_orders)."""
    wide = quantiles(recency, "total_orders", probs)
    cells = [F.struct(F.lit(float(p)).alias("quantile"), F.col(f"q{i}").alias("total_orders"))
             for i, p in enumerate(probs)]
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*").where(
        "total_orders is not null"
    )


def cutoff_impact(recency: DataFrame, cutoff: int = 2, warn_above_pct: float = 30.0) -> DataFrame:
    """How many sellers a minimum number of orders would remove."""
    share = F.try_divide(F.col("sellers_below") * 100.0, "total_sellers")
    return recency.agg(
        F.count(F.lit(1)).alias("total_sellers"),
        F.count_if(F.col("total_orders") < cutoff).alias("sellers_below"),
    ).select("total_sellers", "sellers_below", share.alias("pct_impact"),
             F.coalesce(share > warn_above_pct, F.lit(False)).alias("too_strict"))


def _quiet(rules: ActivityRules):
    settled = F.col("days_since_first_sale") > rules.newcomer_days
    inactive = F.col("days_since_last_sale") > rules.max_recency_days
    small = F.col("total_orders") < rules.min_orders
    return F.coalesce((inactive | small) & settled, F.lit(False))


def active_sellers(lifetime: DataFrame, rules: ActivityRules = ActivityRules()) -> DataFrame:
    """Sellers worth judging: selling lately and more than once, or newcomers."""
    return lifetime.where(~_quiet(rules))


def rows_of(rows: DataFrame, sellers: DataFrame) -> DataFrame:
    """Rows whose seller is in ``sellers``."""
    return rows.join(sellers.select("seller_id"), "seller_id", "left_semi")


def filter_report(lifetime: DataFrame, rules: ActivityRules = ActivityRules()) -> DataFrame:
    """Sellers in total, dropped and kept, with percentages."""
    counts = lifetime.agg(
        F.count(F.lit(1)).alias("total_sellers"),
        F.count_if(_quiet(rules)).alias("dropped_sellers"),
        F.count_if(~_quiet(rules)).alias("kept_sellers"),
    )
    return counts.select(
        "*",
        F.try_divide(F.col("dropped_sellers") * 100.0, "total_sellers").alias("pct_dropped"),
        F.try_divide(F.col("kept_sellers") * 100.0, "total_sellers").alias("pct_kept"),
    )
