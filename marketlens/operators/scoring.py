"""Weighted seller score and tiers."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.order_stats import histogram, quantiles
from marketlens.functions.scaling import minmax, with_statistics
from marketlens.rules import COST_FEATURES, SCORE_WEIGHTS, TIERS

QUARTERS = (0.0, 0.25, 0.5, 0.75, 1.0)


def seller_score(features: DataFrame, weights: Mapping[str, float] = SCORE_WEIGHTS) -> DataFrame:
    """Add 100 times the weighted sum of min-max scaled features.

    Cost features are inverted. The default weights sum to 1.0001, so the best
    possible score is 100.01.
    """
    scaled = minmax(features, list(weights), inverted=COST_FEATURES)
    total = reduce(add, [F.col(f"m_{c}") * w for c, w in weights.items()])
    return scaled.withColumn("final_score", total * 100.0).drop(*[f"m_{c}" for c in weights])


def weights_of(importances: DataFrame) -> dict[str, float]:
    """Score weights from (feature, importance): one number per feature comes to the driver."""
    return {r.feature: r.importance for r in importances.select("feature", "importance").collect()}


def with_quarter(df: DataFrame, column: str, into: str, digits: int = 6) -> DataFrame:
    """Add the quartile 0..3 of a column; intervals are closed above, the lowest also below.

    Equal edges are an error, because then no four groups exist. The column is
    rounded first, so that the cut does not hang on the last bits of a double.
    ``df`` is read twice: pass a stored table.
    """
    rounded = df.select(F.round(F.col(column), digits).alias("value"))
    edges = quantiles(rounded, "value", QUARTERS)
    known = with_statistics(df, edges, **{f"q{i}": F.max(f"q{i}") for i in range(len(QUARTERS))})
    q = [F.col(f"_stats.q{i}") for i in range(len(QUARTERS))]
    equal = reduce(or_, [low >= high for low, high in zip(q, q[1:])])
    value = F.round(F.col(column), digits)
    quarter = (
        F.when(equal, F.raise_error(F.lit(f"quartile edges of {column} are not unique")).cast("int"))
        .when(value <= q[1], 0).when(value <= q[2], 1).when(value <= q[3], 2)
        .when(value.isNotNull(), 3)
    )
    return known.withColumn(into, quarter).drop("_stats")


def score_tier(scored: DataFrame, column: str = "final_score") -> DataFrame:
    """Add the quartile tier (``segment``) and its rank; ties stay together."""
    tier = F.element_at(F.array(*[F.lit(t) for t in TIERS]), F.col("segment_rank") + 1)
    return with_quarter(scored, column, "segment_rank").withColumn("segment", tier)


def top_sellers(tiered: DataFrame, count: int = 10) -> DataFrame:
    """The best sellers by score."""
    return tiered.orderBy(F.desc("final_score"), "seller_id").limit(count).select(
        "seller_id", "gmv", "total_orders", "avg_rating", "late_shipment_rate", "final_score",
        "segment",
    )


def tier_counts(tiered: DataFrame) -> DataFrame:
    """Sellers per tier."""
    return tiered.groupBy("segment").agg(F.count(F.lit(1)).alias("count"))


def score_histogram(scored: DataFrame, bins: int = 30) -> DataFrame:
    """Score distribution in equal bins."""
    return histogram(scored, "final_score", bins)
