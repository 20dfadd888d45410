"""Scalers and table summaries built on one-row statistics.

Statistics enter as one scalar subquery, carried as a struct column while it is
needed: Spark computes the one row once and no join is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.order_stats import column_quantiles


def with_statistics(df: DataFrame, source: DataFrame | None = None, **measures: Column) -> DataFrame:
    """Add ``_stats``, a struct of aggregates over ``source`` (``df`` itself by default)."""
    row = (df if source is None else source).agg(
        F.struct(*[m.alias(k) for k, m in measures.items()])
    )
    return df.withColumn("_stats", row.scalar())


def standardize(df: DataFrame, columns: Sequence[str], prefix: str = "z_") -> DataFrame:
    """Add (x - mean) / population deviation; constant columns become 0."""
    known = with_statistics(
        df,
        **{f"{c}_mean": F.avg(c) for c in columns},
        **{f"{c}_dev": F.stddev_pop(c) for c in columns},
    )

    def scaled(c: str) -> Column:
        dev = F.col(f"_stats.{c}_dev")
        shifted = F.col(c) - F.col(f"_stats.{c}_mean")
        return F.when(dev > 0, shifted / dev).otherwise(shifted * 0.0)

    return known.withColumns({f"{prefix}{c}": scaled(c) for c in columns}).drop("_stats")


def minmax(
    df: DataFrame, columns: Sequence[str], inverted: Sequence[str] = (), prefix: str = "m_",
) -> DataFrame:
    """Add (x - min) / (max - min), or one minus that for inverted columns.

    Constant columns become 0 before inversion.
    """
    known = with_statistics(
        df,
        **{f"{c}_min": F.min(c) for c in columns},
        **{f"{c}_max": F.max(c) for c in columns},
    )

    def scaled(c: str) -> Column:
        low, high = F.col(f"_stats.{c}_min"), F.col(f"_stats.{c}_max")
        unit = F.when(high > low, (F.col(c) - low) / (high - low)).otherwise(F.col(c) * 0.0)
        return 1.0 - unit if c in inverted else unit

    return known.withColumns({f"{prefix}{c}": scaled(c) for c in columns}).drop("_stats")


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of every pair, long form: (feature_a, feature_b, correlation).

    Each pair skips its own nulls; all pairs come from one pass. A constant
    feature has no correlation (null).
    """
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]

    def pearson(a: str, b: str) -> Column:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        dev_x = F.stddev_pop(F.when(y.isNotNull(), x))
        dev_y = F.stddev_pop(F.when(x.isNotNull(), y))
        return F.try_divide(F.covar_pop(x, y), dev_x * dev_y)

    row = df.agg(*[pearson(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cells = [
        F.struct(F.lit(x).alias("feature_a"), F.lit(y).alias("feature_b"),
                 F.col(f"`{a}|{b}`").alias("correlation"))
        for a, b in pairs for x, y in dict.fromkeys([(a, b), (b, a)])
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Type, non-null count and distribution of numeric columns, one row each."""
    types = dict(df.dtypes)
    tall = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )
    moments = tall.groupBy("column_name").agg(
        F.count("value").alias("non_null"),
        F.avg("value").alias("mean"),
        F.stddev("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quarters = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    kind = F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])
    return moments.join(quarters, "column_name", "left").select(
        "column_name", kind[F.col("column_name")].alias("data_type"), "non_null", "mean", "std",
        "min", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75"), "max",
    )


# What a text column may hold, narrowest first: all its values must match.
TEXT_TYPES = {
    "bigint": r"^[+-]?[0-9]{1,18}$",
    "double": r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$",
    "timestamp": r"^[0-9]{4}-[0-9]{2}-[0-9]{2}([T ][0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]+)?)?)?$",
    "boolean": r"^([tT]rue|[fF]alse|TRUE|FALSE)$",
}


def column_overview(df: DataFrame) -> DataFrame:
    """Of every column, in one pass: (column_name, data_type, inferred_type, rows, non_null).

    ``inferred_type`` is the narrowest type that holds all values of a text column, from
    counts that add up over parts of a table; ``void`` without values. Other columns
    keep their declared type.
    """
    def matched(c: str) -> Column:
        return F.struct(*[F.count_if(F.col(f"`{c}`").rlike(p)).alias(t) for t, p in TEXT_TYPES.items()])

    texts = [c for c, t in df.dtypes if t == "string"]
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns],
        *[matched(c).alias(f"_fits {c}") for c in texts])

    def inferred(c: str, declared: str) -> Column:
        held, kind = F.col(f"`{c}`"), F.lit("string")
        if declared != "string":
            return F.lit(declared)
        for name in reversed(TEXT_TYPES):
            kind = F.when(F.col(f"`_fits {c}`")[name] == held, name).otherwise(kind)
        return F.when(held == 0, "void").otherwise(kind)

    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("data_type"), inferred(c, t).alias("inferred_type"),
                 F.col("_rows").alias("rows"), F.col(f"`{c}`").alias("non_null"))
        for c, t in df.dtypes
    ]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")
