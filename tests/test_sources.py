from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime as dt
from threading import Event, Thread

import pytest
from pyspark.sql import functions as F

from marketlens import session
from marketlens.sources import quoted_csv, reports, tables
from marketlens.sources.schemas import RAW_SCHEMAS, file_schema
from marketlens.sources.versions import VersionedTable


@pytest.fixture
def lake(spark, tmp_path):
    return tables.Lake(spark, str(tmp_path / "lake"))


def frame(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "id string")


def test_writing_replaces_and_counts(spark, lake):
    assert lake.write(frame(spark, "a", "b"), "staging", "t") == 2
    assert lake.write(frame(spark, "c"), "staging", "t") == 1
    assert lake.read("staging", "t").collect() == [("c",)]


def test_a_writer_that_dies_leaves_the_old_version(spark, lake, monkeypatch):
    lake.write(frame(spark, "a"), "staging", "t")
    table = lake.versions("staging", "t")
    with monkeypatch.context() as broken:  # dies after the data, before the manifest
        broken.setattr(VersionedTable, "publish", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            lake.write(frame(spark, "b"), "staging", "t")
    assert lake.read("staging", "t").collect() == [("a",)]
    folder = table.root + "/_versions"
    for cut_off in ("", '{"version": 2, "fol'):  # dies while it writes the manifest
        with open(f"{folder}/0000000002.json", "w") as f:
            f.write(cut_off)
        assert lake.read("staging", "t").collect() == [("a",)]
    assert lake.write(frame(spark, "c"), "staging", "t") == 1
    assert lake.read("staging", "t").collect() == [("c",)]
    assert [v["version"] for v in table.versions()] == [3, 1]
    with pytest.raises(FileNotFoundError):
        lake.read("staging", "none")


def test_versions_are_numbered_once_and_cleaned(spark, tmp_path):
    lake = tables.Lake(spark, str(tmp_path / "lake"), retention=0)
    for value in "abc":
        before = lake.read("staging", "t") if value > "a" else None
        lake.write(frame(spark, value), "staging", "t")
    assert [v["version"] for v in lake.versions("staging", "t").versions()] == [3]
    assert len(list((tmp_path / "lake/staging/t").glob("data-*"))) == 1
    with pytest.raises(Exception):
        before.collect()  # its version is gone
    table = lake.versions("staging", "t")
    with ThreadPoolExecutor(4) as pool:
        numbers = list(pool.map(lambda i: table.publish(table.new_folder(), i), range(8)))
    assert sorted(numbers) == list(range(4, 12))


def test_readers_never_fail_while_a_writer_replaces(spark, lake):
    lake.write(frame(spark, *"0" * 50), "staging", "t")
    seen, failures, done = [], [], Event()

    def read():
        while not done.is_set():
            try:
                rows = [r.id for r in lake.read("staging", "t").collect()]
                assert len(rows) == 50 and len(set(rows)) == 1
                seen.append(rows[0])
            except Exception as e:  # noqa: BLE001
                failures.append(e)
    readers = [Thread(target=read) for _ in range(3)]
    for reader in readers:
        reader.start()
    for i in range(1, 7):
        lake.write(frame(spark, *str(i) * 50), "staging", "t")
    done.set()
    for reader in readers:
        reader.join()
    assert not failures and len(set(seen)) > 1 and seen[-1] <= "6"
    assert lake.read("staging", "t").first().id == "6"


def test_an_empty_result_keeps_the_old_table(spark, lake):
    lake.write(frame(spark, "a"), "staging", "t")
    assert lake.write(frame(spark), "staging", "t") == 0
    assert lake.read("staging", "t").collect() == [("a",)]
    with pytest.raises(ValueError):
        lake.write(frame(spark), "elsewhere", "t")


def test_a_table_can_be_rewritten_from_itself(spark, lake):
    lake.write(frame(spark, "a", "b"), "staging", "t")
    lake.write(lake.read("staging", "t").where("id = 'b'"), "staging", "t")
    assert lake.read("staging", "t").collect() == [("b",)]


def test_stage_copy(spark, lake):
    lake.write(frame(spark, "a", "b"), "raw_data", "sellers")
    assert tables.stage_copy(lake, "sellers", "sellers_cleaned") == 2
    assert lake.read("staging", "sellers_cleaned").count() == 2


def test_raw_files_keep_line_breaks_quotes_and_bad_numbers(spark, tmp_path):
    text = 'said "no"\nand left, twice'
    rows = [("r", "1", "n/a", None, text, "2020-01-01 00:00:00", None)]
    df = spark.createDataFrame(rows, file_schema("reviews"))
    tables.export_csv(df, str(tmp_path / "reviews"))
    back = tables.read_raw(spark, str(tmp_path / "reviews"), "reviews").first()
    assert back.review_comment_message == text
    assert back.review_score == "n/a" and back.review_answer_timestamp is None


def test_quoted_files_are_read_in_splits(spark, tmp_path):
    rng = random.Random(0)
    words = ["plain", 'said "no"', "a\nb", "\n\n", '"', "x,y", "", None, "é😀", "\r\n", '""\n""', "long " * 400, "line\n" * 300]
    rows = [(f"r{i}", str(i), rng.choice("12345"), rng.choice(words), rng.choice(words), "2020-01-01 00:00:00", None) for i in range(600)]
    df = spark.createDataFrame(rows, file_schema("reviews"))
    path = str(tmp_path / "reviews")
    tables.export_csv(df.coalesce(2), path)
    whole = spark.read.schema(file_schema("reviews")).option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    want = sorted(map(tuple, whole.collect()), key=str)
    assert len(want) == 600
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for size in (500, 3_000, 40_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 0)
            assert quoted_csv.lines(spark, path).rdd.getNumPartitions() > 2
            assert sorted(map(tuple, tables.read_raw(spark, path, "reviews").collect()), key=str) == want
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted(map(tuple, tables.read_raw(spark, path, "reviews").collect()), key=str) == want


def test_every_raw_schema_can_be_read(spark, tmp_path):
    for name, schema in RAW_SCHEMAS.items():
        path = str(tmp_path / name)
        tables.export_csv(spark.createDataFrame([tuple(None for _ in schema)], schema), path)
        assert tables.read_raw(spark, path, name).schema == file_schema(name)


def test_csv_load_detects_types_or_takes_a_schema(spark, tmp_path):
    path = str(tmp_path / "out.csv")
    df = spark.createDataFrame([(1, 2.5, dt(2020, 1, 2, 3, 4, 5))], "a int, b double, t timestamp_ntz")
    tables.export_csv(df, path)
    assert dict(tables.load_csv(spark, path).dtypes)["b"] == "double"
    assert tables.load_csv(spark, path, df.schema).collect() == df.collect()


def test_scorecard_goes_through_a_dated_file(spark, lake, tmp_path):
    matrix = spark.createDataFrame([("s1", 50.5, "Gold", 3)], "seller_id string, final_score double, segment string, seller_cluster int")
    assert tables.export_scorecard(lake, matrix, str(tmp_path), date(2021, 2, 3)) == 1
    assert (tmp_path / "seller_evaluation_20210203.csv").is_dir()
    assert lake.read("warehouse", "seller_scorecard").collect() == matrix.collect()


def test_constraint_violations(spark):
    df = spark.createDataFrame([("1", 1), ("1", 1), ("1", 1), ("2", 1), (None, 1)], "order_id string, n int")
    out = {(r.rule, r["columns"]): r.violations
           for r in reports.check_constraints(df, "t", ["order_id", "n"], ["n"]).collect()}
    assert out == {("primary_key", "order_id,n"): 2, ("not_null", "order_id"): 1, ("not_null", "n"): 0}
    empty = reports.check_constraints(df.limit(0), "t", ["order_id"]).collect()
    assert [r.violations for r in empty] == [0, 0]


def test_row_count_reports(spark):
    out = reports.row_count_report({"a": frame(spark, "x", "y"), "b": frame(spark)})
    assert {tuple(r) for r in out.collect()} == {("a", 2), ("b", 0)}
    assert reports.counts_to_report(spark, {"a": 2}).collect() == [("a", 2)]


def test_catalog_report(spark, lake):
    lake.write(frame(spark, "a"), "staging", "catalog_probe")
    lake.register("staging", "catalog_probe")
    try:
        out = {r.layer: (r.present, r.tables) for r in reports.catalog_report(spark).collect()}
        assert out["staging"] == (True, 1) and out["raw_data"] == (False, 0)
        assert spark.table("staging.catalog_probe").count() == 1
    finally:
        spark.sql("DROP DATABASE staging CASCADE")


def test_materialize_keeps_schema_and_rows(spark):
    df = spark.range(5).withColumn("t", F.lit(dt(2020, 1, 1)).cast("timestamp_ntz"))
    stored = session.materialize(df, "probe")
    assert stored.dtypes == df.dtypes and stored.count() == 5


def test_shared_folder_comes_from_the_session(spark):
    before = spark.conf.get("spark.checkpoint.dir", None)
    if before:
        assert session.shared_dir(spark).startswith(before.rstrip("/"))
    else:
        session.shared_dir(spark)  # sets the folder of a local session
        folder = session.shared_dir(spark)
        assert folder.startswith(spark.sparkContext.getCheckpointDir())
        assert folder.endswith(spark.sparkContext.applicationId)
