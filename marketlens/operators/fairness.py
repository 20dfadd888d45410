"""Which poor reviews are the carrier's fault, and what removing them changes."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.columns import known
from marketlens.rules import DAMAGE_KEYWORDS, SHIPPING_KEYWORDS


def mentions(comment: Column, keywords: Sequence[str]) -> Column:
    """True where the text contains one of the keywords."""
    return reduce(or_, [comment.contains(k) for k in keywords])


def logistics_fault(
    shipping: Sequence[str] = SHIPPING_KEYWORDS, damage: Sequence[str] = DAMAGE_KEYWORDS,
) -> Column:
    """True where a review of at most three stars, or none, blames the carrier.

    The carrier is blamed for a late delivery the seller handed over in time when
    the customer complains about shipping or says nothing, and for damage always.
    Comparisons with a missing date are false.
    """
    comment = F.lower(F.coalesce("review_comment_message", F.lit("")))
    innocent = known(F.col("order_delivered_carrier_date") <= F.col("shipping_limit_date"))
    late = known(F.col("order_delivered_customer_date") > F.col("order_estimated_delivery_date"))
    grounds = mentions(comment, damage) | (
        innocent & late & ((comment == "") | mentions(comment, shipping))
    )
    return ~known(F.col("review_score") > 3) & grounds


def with_adjusted_score(rows: DataFrame) -> DataFrame:
    """Add the fault flag and the score with faulty reviews blanked."""
    return rows.withColumn("is_logistics_fault", logistics_fault()).withColumn(
        "adjusted_review_score", F.when(~F.col("is_logistics_fault"), F.col("review_score"))
    )


def bias_report(judged: DataFrame, sellers: DataFrame | None = None) -> DataFrame:
    """Rows, comments, poor scores and removed reviews, with three ratios.

    ``judged`` carries the fault flag. With ``sellers`` only their rows count:
    rows are combined per seller first, so the restriction joins small tables.
    """
    measures = {
        "total_reviews": F.count(F.lit(1)),
        "total_comments": F.count_if(known(F.col("review_comment_message").rlike(r"(?U)\S"))),
        "total_negative": F.count_if(known(F.col("review_score") <= 3)),
        "removed_count": F.count_if(F.col("is_logistics_fault")),
    }
    if sellers is not None:
        per_seller = judged.groupBy("seller_id").agg(*[m.alias(k) for k, m in measures.items()])
        judged = per_seller.join(sellers.select("seller_id"), "seller_id", "left_semi")
        measures = {k: F.coalesce(F.sum(k), F.lit(0)) for k in measures}
    counts = judged.agg(*[m.alias(k) for k, m in measures.items()])
    removed = F.col("removed_count")
    return counts.select(
        "*",
        F.try_divide(removed, "total_reviews").alias("share_of_reviews"),
        F.try_divide(removed, "total_comments").alias("share_of_comments"),
        F.try_divide(removed, "total_negative").alias("share_of_negative"),
    )
