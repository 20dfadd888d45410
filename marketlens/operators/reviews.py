"""Review subsets and their text preparation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.text import tokens

TEXT = "review_comment_message"


def reviews_scored(reviews: DataFrame, scores: Sequence[int]) -> DataFrame:
    """Score and message of reviews with one of the scores and a message.

    Cleaning turns a missing message into '', so empty ones stay in.
    """
    return reviews.where(F.col("review_score").isin(*scores) & F.col(TEXT).isNotNull()).select(
        "review_score", TEXT
    )


def bad_reviews(reviews: DataFrame) -> DataFrame:
    return reviews_scored(reviews, (1, 2))


def neutral_reviews(reviews: DataFrame) -> DataFrame:
    return reviews_scored(reviews, (3,))


def good_reviews(reviews: DataFrame) -> DataFrame:
    return reviews_scored(reviews, (4, 5))


def subset_share(reviews: DataFrame, scores: Sequence[int] = (1, 2)) -> DataFrame:
    """Size of a review subset and its share of all reviews in percent."""
    inside = F.col("review_score").isin(*scores) & F.col(TEXT).isNotNull()
    return reviews.agg(
        F.count(F.lit(1)).alias("total_reviews"), F.count_if(inside).alias("subset_reviews")
    ).withColumn("percentage", F.try_divide(F.col("subset_reviews") * 100.0, "total_reviews"))


def with_clean_text(
    df: DataFrame, text: Column, into: str = "cleaned", drop_empty: bool = False, min_words: int = 0,
) -> DataFrame:
    """Add prepared text; optionally drop rows that end up empty or short.

    Both filters are off by default: empty comments are analysed too.
    """
    out = df.withColumn(into, text)
    if drop_empty:
        out = out.where(F.col(into) != "")
    if min_words:
        out = out.where(F.size(tokens(F.col(into))) >= min_words)
    return out
