"""Consecutive numbers for the rows of a large table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import materialize


def numbered(df: DataFrame, order: Sequence[str | Column], into: str = "number") -> DataFrame:
    """Add 0, 1, 2... in an order; ``order`` should tell all rows apart.

    Rows are laid out by ranges of the order, each range is numbered by itself, and
    the ranges before it are counted: no task sees more than its range. Stored.
    """
    spark = df.sparkSession
    laid_out = materialize(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = laid_out.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect()  # a row per range
    before, offsets = 0, []
    for row in sorted(sizes, key=lambda r: r["_range"]):
        offsets.append((row["_range"], before))
        before += row["n"]
    places = spark.createDataFrame(offsets, "_range int, _before long")
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    # One row per range is broadcast.
    return laid_out.withColumn("_own", own).join(F.broadcast(places), "_range").select(
        *df.columns, (F.col("_before") + F.col("_own")).alias(into))
