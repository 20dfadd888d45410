"""Exact quantiles, ranks and histograms that never sort one group in one task.

Rows are first combined to (group, value, count). Split points taken from the
distinct values of each group cut it into parts of about equally many distinct
values, wherever the values lie; the part totals say how many rows lie before
each part, so an exact position is found inside the one part that holds it. The
split points are approximate quantiles, the results are exact.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F


# A part holds about 1 / 256 of the distinct values of its group. A multiple of 16.
PARTS = 256
# Groups of up to so many rows are sorted whole, each in one task.
MANY = 10_000


def part_of(value: Column, edges: Column) -> Column:
    """How many of the sorted ``edges`` are below ``value``, in two steps of sixteenths."""
    every_16th = F.filter(edges, lambda _, i: i % 16 == 15)
    ahead = 16 * F.size(F.filter(every_16th, lambda e: e < value))
    within = F.size(F.filter(F.slice(edges, ahead + 1, F.lit(16)), lambda e: e < value))
    return F.coalesce((ahead + within).cast("long"), F.lit(0))


def _running(*by: str, order: str) -> WindowSpec:
    return Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)


def _value_counts(df: DataFrame, value: Column, by: Sequence[str], parts: int) -> DataFrame:
    """(by..., _bucket, _value, _n); each distinct value of a group is one row."""
    present = df.select(*by, value.cast("double").alias("_value")).dropna()
    counts = present.groupBy(*by, "_value").agg(F.count(F.lit(1)).alias("_n"))
    cuts = F.percentile_approx("_value", [i / parts for i in range(1, parts)], 10_000).alias("_edges")
    if by:
        counts = counts.join(counts.groupBy(*by).agg(cuts), list(by))
    else:
        counts = counts.withColumn("_edges", counts.agg(cuts).scalar())
    return counts.withColumn("_bucket", part_of(F.col("_value"), F.col("_edges"))).drop("_edges")


def _bucket_spans(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per bucket: rows held, rows in earlier buckets, rows of the group.

    Without ``by`` the window runs over the part totals alone, at most PARTS rows.
    """
    totals = counts.groupBy(*by, "_bucket").agg(F.sum("_n").alias("_held"))
    ordered = _running(*by, order="_bucket")
    return totals.select(
        *by, "_bucket", "_held",
        (F.sum("_held").over(ordered) - F.col("_held")).alias("_before"),
        F.sum("_held").over(Window.partitionBy(*by)).alias("_total"),
    )


def quantiles(
    df: DataFrame, column: str, probs: Sequence[float], by: Sequence[str] = (),
    parts: int = PARTS,
) -> DataFrame:
    """Exact quantiles with linear interpolation, nulls skipped.

    Returns (by..., q0, q1, ...), one column per probability. Rows with a null
    group are left out, as are groups without any value.
    """
    by, value = list(by), F.col(column).cast("double")
    if not by:
        return _wide_quantiles(df, value, probs, by, parts)
    present = df.select(*by, value.alias("_value")).dropna()
    # At most a group per MANY rows is broadcast.
    large = F.broadcast(present.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > MANY).select(*by))
    return _small_quantiles(present.join(large, by, "left_anti"), probs, by).unionByName(
        _wide_quantiles(present.join(large, by, "left_semi"), F.col("_value"), probs, by, parts))


def _position(p: float) -> Column:
    return F.lit(float(p)) * (F.col("_total") - 1)


def _holds(target: Column, first: Column, size: Column) -> Column:
    return (target >= first) & (target < first + size)


def _small_quantiles(present: DataFrame, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles of groups of bounded size, each sorted by itself after one exchange."""
    group = Window.partitionBy(*by)
    placed = present.select(
        *by, "_value", (F.row_number().over(group.orderBy("_value")) - 1).alias("_first"),
        F.count(F.lit(1)).over(group).alias("_total"))
    return _interpolated(placed, F.lit(1), probs, by)


def _interpolated(placed: DataFrame, size: Column, probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Quantiles from values, the places they begin at (``_first``) and the rows of their group (``_total``)."""
    picks = []
    for i, p in enumerate(probs):
        for name, edge in (("lo", F.floor), ("hi", F.ceil)):
            hit = _holds(edge(_position(p)), F.col("_first"), size)
            picks.append(F.max(F.when(hit, F.col("_value"))).alias(f"_{name}{i}"))
    picked = placed.groupBy(*by).agg(F.max("_total").alias("_total"), *picks)
    return picked.select(*by, *[
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}"))
         * (_position(p) - F.floor(_position(p)))).alias(f"q{i}")
        for i, p in enumerate(probs)
    ])


def _wide_quantiles(
    df: DataFrame, value: Column, probs: Sequence[float], by: Sequence[str], parts: int,
) -> DataFrame:
    """Quantiles of groups of any size, which are cut into parts."""
    counts = _value_counts(df, value, by, parts)
    spans = _bucket_spans(counts, by)
    before, held = F.col("_before"), F.col("_held")
    needed = reduce(or_, [
        _holds(edge(_position(p)), before, held) for p in probs for edge in (F.floor, F.ceil)
    ])
    # Without groups at most two buckets per probability remain.
    wanted = spans.where(needed) if by else F.broadcast(spans.where(needed))

    within = _running(*by, "_bucket", order="_value")
    placed = counts.join(wanted, [*by, "_bucket"]).withColumn(
        "_first", before + F.sum("_n").over(within) - F.col("_n")
    )
    return _interpolated(placed, F.col("_n"), probs, by)


def column_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Quantiles of several columns in one job: (column_name, q0, q1, ...)."""
    tall = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    return quantiles(tall, "value", probs, by=["column_name"])


def rank_descending(df: DataFrame, column: str, name: str = "rank", parts: int = PARTS) -> DataFrame:
    """``rank()`` over the whole table by falling value, without one big sort.

    Ranks are worked out per distinct value, so a value shared by very many rows
    is one row here. ``df`` is read twice: pass a stored table. Null values get
    a null rank.
    """
    counts = _value_counts(df, -F.col(column), (), parts)
    spans = _bucket_spans(counts, ()).select("_bucket", "_before")
    within = _running("_bucket", order="_value")
    ranks = counts.join(spans, "_bucket").select(
        (-F.col("_value")).alias("_ranked"),
        (F.col("_before") + F.sum("_n").over(within) - F.col("_n") + 1).alias(name),
    )
    return df.join(ranks, df[column].cast("double") == ranks["_ranked"], "left").drop("_ranked")


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum: (bin, lower, upper, count).

    The last bin is closed. A constant column is centred in a range of width
    one. Empty bins are reported with count 0.
    """
    value = F.col(column).cast("double")
    flat = F.min(value) == F.max(value)
    bounds = df.agg(
        F.when(flat, F.min(value) - 0.5).otherwise(F.min(value)).alias("lo"),
        F.when(flat, F.max(value) + 0.5).otherwise(F.max(value)).alias("hi"),
    ).where("lo is not null")
    edge = bounds.select(F.struct("lo", "hi")).scalar()
    lo, hi = edge.getField("lo"), edge.getField("hi")
    counts = (
        df.where(value.isNotNull())
        .select(F.least(F.floor((value - lo) * bins / (hi - lo)) + 1, F.lit(bins)).cast("int").alias("bin"))
        .groupBy("bin").agg(F.count(F.lit(1)).alias("count"))
    )
    width = (F.col("hi") - F.col("lo")) / bins
    frame = bounds.select("lo", "hi", F.explode(F.sequence(F.lit(1), F.lit(bins))).alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("lower"),
        (F.col("lo") + F.col("bin") * width).alias("upper"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )
