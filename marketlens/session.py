"""Session defaults and durable intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins are chained on the order id; split a hot order even where that costs
    # one more shuffle before the next join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Partitions stay small enough to be sorted or hashed in memory, however large the input:
    # many at first, joined up to a size that is well below a task's share of memory unpacked.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "2000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    "spark.sql.files.maxPartitionBytes": "32m",
    # A join hashes its smaller side, unsorted, where all partitions of it are small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "16m",
    # The JVM never compiles a method of over 8,000 bytes; such a stage runs as one method per operator.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # An exchange's files go when the step that made them ends, not when the driver happens to collect its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators are written against."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder for intermediate tables: the cluster's ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster that
    folder would live on one machine, so an unset value is an error there.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        base = spark.sparkContext.getCheckpointDir()
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="marketlens-")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/marketlens-{spark.sparkContext.applicationId}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Used where several later steps read the same result: lineage is cut, column
    pruning and size statistics work on the copy, and it outlives executors.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)
