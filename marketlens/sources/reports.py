"""Constraint, row count and catalog reports."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.sources.schemas import LAYERS


def check_constraints(
    df: DataFrame, table: str, primary_key: Sequence[str], not_null: Sequence[str] = (),
) -> DataFrame:
    """Violations per rule: (table_name, rule, columns, violations).

    A repeated key counts once per surplus row; key columns must not be null
    either. One pass: rows are combined per key on the map side, so a key that
    repeats often reaches the shuffle as one row per task.
    """
    required = list(dict.fromkeys([*primary_key, *not_null]))
    missing = {f"_null{i}": c for i, c in enumerate(required)}
    if primary_key:
        per_key = df.groupBy(*[F.col(c).alias(f"_key{i}") for i, c in enumerate(primary_key)]).agg(
            F.count(F.lit(1)).alias("_copies"),
            *[F.count_if(F.col(c).isNull()).alias(n) for n, c in missing.items()],
        )
        row = per_key.agg(F.sum(F.col("_copies") - 1).alias("_surplus"),
                          *[F.sum(n).alias(n) for n in missing])
    else:
        row = df.agg(*[F.count_if(F.col(c).isNull()).alias(n) for n, c in missing.items()])

    def finding(rule: str, columns: str, violations: str):
        count = F.coalesce(F.col(violations), F.lit(0)).cast("long")
        return F.struct(F.lit(rule).alias("rule"), F.lit(columns).alias("columns"),
                        count.alias("violations"))

    findings = [finding("not_null", c, n) for n, c in missing.items()]
    if primary_key:
        findings.insert(0, finding("primary_key", ",".join(primary_key), "_surplus"))
    return row.select(F.lit(table).alias("table_name"), F.explode(F.array(*findings)).alias("f")).select(
        "table_name", "f.*"
    )


def row_count_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, rows)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def counts_to_report(spark: SparkSession, counts: Mapping[str, int]) -> DataFrame:
    """The counts that a load run returned, as a report."""
    return spark.createDataFrame(list(counts.items()), "table_name string, rows long")


def catalog_report(spark: SparkSession, layers: Sequence[str] = LAYERS) -> DataFrame:
    """Tables per layer, and whether the layer exists at all."""
    existing = {db.name for db in spark.catalog.listDatabases()}
    rows = [
        (layer, layer in existing,
         sum(not t.isTemporary for t in spark.catalog.listTables(layer)) if layer in existing else 0)
        for layer in layers
    ]
    return spark.createDataFrame(rows, "layer string, present boolean, tables int")
