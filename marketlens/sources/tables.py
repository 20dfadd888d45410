"""Layered Parquet tables with full-replace loads, and CSV extracts."""

from __future__ import annotations

import logging
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from marketlens.sources.quoted_csv import read_quoted_csv
from marketlens.sources.schemas import LAYERS, file_schema
from marketlens.sources.versions import RETENTION, VersionedTable

log = logging.getLogger(__name__)

EXPORTED_TABLES = (
    "fact_orders", "fact_order_items", "dim_sellers", "dim_customers", "dim_products",
)


def read_raw(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Read one raw CSV extract (header row) with its declared schema.

    Only reviews hold free text with line breaks; every file is read in splits.
    """
    if name == "reviews":
        return read_quoted_csv(spark, path, file_schema(name))
    return spark.read.schema(file_schema(name)).option("header", True).option("escape", '"').csv(path)


class Lake:
    """Three layers of Parquet tables below one root folder, each replaced version by version."""

    def __init__(self, spark: SparkSession, root: str, retention: float = RETENTION):
        self.spark = spark
        self.root = root.rstrip("/")
        self.retention = retention

    def path(self, layer: str, name: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}")
        return f"{self.root}/{layer}/{name}"

    def versions(self, layer: str, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(layer, name))

    def _current(self, layer: str, name: str) -> str:
        folder = self.versions(layer, name).current()
        if folder is None:
            raise FileNotFoundError(f"{layer}.{name} has no version below {self.root}")
        return folder

    def read(self, layer: str, name: str) -> DataFrame:
        """The newest version; it stays what it is while later ones are written."""
        return self.spark.read.parquet(self._current(layer, name))

    def write(self, df: DataFrame, layer: str, name: str) -> int:
        """Replace a table and return its row count.

        Rows are counted while they are written. The version takes effect with its
        manifest, at once and as a whole; a writer that dies before leaves the old one.
        An empty result is reported and discarded, so the old table stays.
        """
        table = self.versions(layer, name)
        folder, seen = table.new_folder(), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder, compression="zstd")
        rows = seen.get["rows"]
        if rows == 0:
            log.warning("%s.%s is empty, the previous table is kept", layer, name)
            table.discard(folder)
            return 0
        table.publish(folder, rows)
        if self.spark.catalog.tableExists(f"{layer}.{name}"):
            self.register(layer, name)
        table.clean(self.retention)
        return rows

    def register(self, layer: str, name: str) -> None:
        """Make a table visible in the catalog under ``layer.name``; later versions move the entry along."""
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer}")
        self.spark.sql(f"DROP TABLE IF EXISTS {layer}.{name}")
        self.spark.catalog.createTable(
            f"{layer}.{name}", path=self._current(layer, name), source="parquet"
        )


def stage_copy(lake: Lake, raw_name: str, staged_name: str) -> int:
    """Copy a raw table to staging unchanged."""
    return lake.write(lake.read("raw_data", raw_name), "staging", staged_name)


def export_csv(df: DataFrame, path: str) -> None:
    """Write a CSV extract with a header row, replacing an earlier one."""
    (
        df.write.mode("overwrite").option("header", True).option("escape", '"')
        .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]").csv(path)
    )


def export_warehouse(lake: Lake, folder: str) -> list[str]:
    """Write the five shared warehouse tables as CSV extracts."""
    paths = []
    for name in EXPORTED_TABLES:
        paths.append(f"{folder.rstrip('/')}/{name}.csv")
        export_csv(lake.read("warehouse", name), paths[-1])
    return paths


def load_csv(
    spark: SparkSession, path: str, schema: StructType | None = None, multiline: bool = False,
) -> DataFrame:
    """Read a CSV extract, skipping its header row.

    Column types are detected unless ``schema`` is given, which saves a pass
    over the files.
    """
    reader = spark.read.option("header", True).option("multiLine", multiline).option("escape", '"')
    reader = reader.option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(path)


def export_scorecard(lake: Lake, matrix: DataFrame, folder: str, day: date | None = None) -> int:
    """Write the seller matrix to a dated CSV and load it, with its types, as ``seller_scorecard``."""
    day = day or date.today()
    path = f"{folder.rstrip('/')}/seller_evaluation_{day:%Y%m%d}.csv"
    export_csv(matrix, path)
    return lake.write(load_csv(lake.spark, path, matrix.schema), "warehouse", "seller_scorecard")
