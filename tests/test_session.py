from __future__ import annotations

import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marketlens.fixtures import driver_tables
from marketlens.session import configure, materialize


def test_partitions_of_an_exchange_do_not_hang_on_the_number_of_cores(spark):
    configure(spark)
    assert int(spark.conf.get("spark.sql.shuffle.partitions")) < 1_000
    plan = spark.range(10).groupBy((F.col("id") % 3).alias("k")).count()._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(" in plan and ", 2000)" in plan
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_stored_tables_are_packed_and_read_back(spark):
    out = materialize(spark.range(1000).select("id", F.lit("x").alias("x")), "test-packed")
    assert out.count() == 1000 and all(f.endswith(".zstd.parquet") for f in out.inputFiles())


def test_files_of_exchanges_go_with_their_step(spark, tmp_path):
    if not spark.sparkContext.master.startswith("local["):
        pytest.skip("the executors' folders are elsewhere")
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return {str(f.getName()) for f in spark.sparkContext._jvm.scala.jdk.javaapi.CollectionConverters.asJava(blocks.getAllFiles())
                if f.getName().startswith("shuffle_")}

    before = files()
    out = materialize(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "test-exchange")
    assert out.count() == 100
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before
    again = spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count()
    assert len(again.collect()) == len(again.collect()) == again.count() == 100  # a result can be asked for again


def test_times_of_raw_orders_by_hand_and_without_calendar_functions(spark, tmp_path):
    day = datetime(1995, 3, 1)
    keys = [1, 2, 37, 97, 101, 103, 211, None]
    spark.createDataFrame(
        [(k, 5, "F", 10.0, None if k == 2 else day) for k in keys],
        "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz",
    ).write.parquet(str(tmp_path / "orders.parquet"))
    out = driver_tables.orders(spark, str(tmp_path))
    assert "timestampadd" not in out._jdf.queryExecution().optimizedPlan().toString().lower()
    found = {r.order_id: r for r in out.collect()}
    for k in (1, 37, 97, 101, 103, 211):
        row, bought = found[str(k)], day + timedelta(seconds=k * 7919 % 86400)
        carried = None if k == 37 else bought + timedelta(hours=k * 37 % 240)
        assert row.order_purchase_timestamp == bought and row.order_delivered_carrier_date == carried
        assert row.order_approved_at == (None if k == 97 else bought + timedelta(hours=k * 31 % 48))
        due = bought - timedelta(days=1) if k == 211 else day + timedelta(days=k * 17 % 25 + 8)
        assert row.order_estimated_delivery_date == due
        at = None if k in (37, 101) else bought - timedelta(hours=5) if k == 103 else carried + timedelta(hours=k * 53 % 600)
        assert row.order_delivered_customer_date == at
    assert found["2"].order_purchase_timestamp is None and found["2"].order_estimated_delivery_date is None
    assert found[None].order_purchase_timestamp is None
