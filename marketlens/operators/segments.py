"""Seller segments: profiles, personas and how scores spread over them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens import rules
from marketlens.functions.order_stats import quantiles
from marketlens.functions.scaling import with_statistics
from marketlens.rules import SEGMENT_FEATURES


def segmentation_input(scored: DataFrame, segmentation: DataFrame) -> DataFrame:
    """Segmentation features of scored sellers with a known distance."""
    return scored.select("seller_id").join(
        segmentation.where("avg_distance_km is not null"), "seller_id"
    )


def cluster_profile(
    labelled: DataFrame, features: Sequence[str] = SEGMENT_FEATURES, cluster: str = "seller_cluster",
) -> DataFrame:
    """Mean raw features and sellers per cluster."""
    return labelled.groupBy(cluster).agg(
        *[F.avg(c).alias(c) for c in features], F.count(F.lit(1)).alias("count")
    )


def persona_label(profile: DataFrame) -> DataFrame:
    """Add a persona name to each cluster of a profile.

    A cluster stands out against the plain mean over clusters: above 1.5 times or
    below 0.7 times of it.
    """
    known = with_statistics(profile, **{
        c: F.avg(c) for c in ("avg_order_value", "avg_weight_g", "market_reach")
    })

    def against(column: str, high: str, low: str | None) -> Column:
        mean = F.col(f"_stats.{column}")
        name = F.when(F.col(column) > mean * 1.5, high)
        return name.when(F.col(column) < mean * 0.7, low) if low else name

    return known.withColumn("persona", F.concat_ws(
        " + ",
        against("avg_order_value", rules.PERSONA_HIGH_TICKET, rules.PERSONA_LOW_COST),
        against("avg_weight_g", rules.PERSONA_BULKY, rules.PERSONA_LIGHTWEIGHT),
        F.coalesce(against("market_reach", rules.PERSONA_NATIONAL, None),
                   F.lit(rules.PERSONA_LOCAL)),
    )).drop("_stats")


def seller_matrix(tiered: DataFrame, labelled: DataFrame) -> DataFrame:
    """Scored sellers with their segment."""
    return tiered.join(labelled.select("seller_id", "seller_cluster"), "seller_id")


def tier_cluster_crosstab(matrix: DataFrame, clusters: Sequence[int]) -> DataFrame:
    """Sellers per tier and cluster, one column ``c<cluster>`` each; absent pairs are 0.

    Naming the clusters saves the extra job that would look them up. Sellers of
    clusters that are not named are counted in ``other``.
    """
    cells = [
        F.count_if(F.col("seller_cluster") == c).alias(f"c{c}") for c in clusters
    ]
    other = F.count_if(~F.coalesce(F.col("seller_cluster").isin(*clusters), F.lit(False))).alias("other")
    return matrix.groupBy("segment").agg(*cells, other)


def score_spread(matrix: DataFrame, column: str = "final_score") -> DataFrame:
    """Box plot figures per cluster, with the overall mean.

    Whiskers end at the most extreme score within 1.5 interquartile ranges of
    the box; what lies beyond is counted as outliers.
    """
    boxes = quantiles(matrix, column, [0.25, 0.5, 0.75], by=["seller_cluster"]).select(
        "seller_cluster", F.col("q0").alias("q25"), F.col("q1").alias("median"),
        F.col("q2").alias("q75"),
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    value = F.col(column)
    inside = value.between(F.col("q25") - reach, F.col("q75") + reach)
    overall = matrix.agg(F.avg(column)).scalar()
    return (
        matrix.select("seller_cluster", column).join(boxes, "seller_cluster")
        .groupBy("seller_cluster", "q25", "median", "q75")
        .agg(
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.count_if(~inside).alias("outliers"),
            F.count(F.lit(1)).alias("sellers"),
        )
        .withColumn("overall_mean", overall)
    )
