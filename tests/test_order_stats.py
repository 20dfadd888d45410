from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketlens.functions import order_stats
from marketlens.functions.order_stats import (
    PARTS, _value_counts, column_quantiles, histogram, part_of, quantiles, rank_descending,
)

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0]


def one_quantile_row(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    return list(quantiles(df, "v", PROBS).first())


@pytest.mark.parametrize("values", [
    [5.0],
    [1.0, 2.0],
    [3.0] * 50 + [1.0, 9.0],
    [-4.5, -1e-9, 0.0, 1e-9, 7.0, 7.0, None, 1e12],
    np.random.default_rng(1).normal(0, 100, 500).tolist(),
])
def test_quantiles_match_numpy(spark, values):
    known = [v for v in values if v is not None]
    assert one_quantile_row(spark, values) == pytest.approx(np.quantile(known, PROBS), abs=1e-9)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=30))
def test_quantiles_match_numpy_on_any_values(spark, values):
    assert one_quantile_row(spark, values) == pytest.approx(np.quantile(values, PROBS), abs=1e-6)


def test_quantiles_by_group_with_one_hot_group(spark):
    rng = np.random.default_rng(3)
    data = pd.DataFrame({
        "g": ["hot"] * 3000 + ["b"] * 7 + ["c"],
        "v": np.round(rng.exponential(50, 3008), 2),
    })
    out = quantiles(spark.createDataFrame(data), "v", [0.5, 0.9], by=["g"]).toPandas().set_index("g")
    expected = data.groupby("g")["v"].quantile([0.5, 0.9]).unstack()
    for g in ("hot", "b", "c"):
        assert list(out.loc[g]) == pytest.approx(list(expected.loc[g]))


@pytest.mark.parametrize("many", [0, 5, 10_000])
def test_small_groups_are_sorted_whole_and_large_ones_in_parts(spark, monkeypatch, many):
    monkeypatch.setattr(order_stats, "MANY", many)
    data = pd.DataFrame({"g": ["a"] * 40 + ["b"] * 5 + ["c"] * 2 + ["d"], "v": [float(i * 7 % 11) for i in range(48)]})
    rows = [*data.itertuples(index=False, name=None), ("e", None), (None, 1.0)]
    out = quantiles(spark.createDataFrame(rows, "g string, v double"), "v", [0.0, 0.3, 0.5, 1.0], by=["g"])
    found = {r.g: [r.q0, r.q1, r.q2, r.q3] for r in out.collect()}
    assert set(found) == {"a", "b", "c", "d"}
    for g, rows in data.groupby("g"):
        assert found[g] == pytest.approx(np.quantile(rows["v"], [0.0, 0.3, 0.5, 1.0]))


def test_quantiles_leave_out_null_groups_and_empty_input(spark):
    df = spark.createDataFrame([(None, 1.0), ("a", None), ("b", 2.0)], "g string, v double")
    assert [tuple(r) for r in quantiles(df, "v", [0.5], by=["g"]).collect()] == [("b", 2.0)]
    empty = quantiles(df.limit(0), "v", [0.5]).collect()
    assert [r.q0 for r in empty] == [None]


def test_column_quantiles(spark):
    df = spark.createDataFrame([(1.0, 10), (3.0, 30), (None, 20)], "a double, b int")
    rows = {r.column_name: r.q0 for r in column_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert rows == {"a": 2.0, "b": 20.0}


@pytest.mark.parametrize("values", [
    "1.7e9 + id * 10.0", "id * 3e-9", "-id * id * 1.0", "if(id < 900000, id * 1e-12, id * 1e6)"])
def test_no_part_holds_many_values_wherever_they_lie(spark, values):
    df = spark.range(1_000_000).selectExpr(f"cast({values} as double) as v")
    parts = _value_counts(df, F.col("v"), (), PARTS).groupBy("_bucket").count()
    assert parts.agg(F.max("count")).first()[0] < 3 * 1_000_000 / PARTS
    assert parts.count() <= PARTS


def test_part_is_the_number_of_lower_edges(spark):
    edges = sorted(np.random.default_rng(2).normal(size=255).tolist())
    values = [*edges[::20], -9.0, 9.0, 0.0]
    df = spark.createDataFrame([(v, edges) for v in values], "v double, e array<double>")
    got = {r.v: r.p for r in df.select("v", part_of(F.col("v"), F.col("e")).alias("p")).collect()}
    assert got == {v: int(np.searchsorted(edges, v)) for v in values}


def test_rank_matches_plain_rank_with_ties(spark):
    rng = np.random.default_rng(5)
    data = pd.DataFrame({"id": range(400), "v": np.round(rng.exponential(20, 400), 0)})
    ranked = rank_descending(spark.createDataFrame(data), "v").toPandas().set_index("id")["rank"]
    expected = data.set_index("id")["v"].rank(method="min", ascending=False).astype(int)
    assert ranked.sort_index().tolist() == expected.tolist()


def test_rank_keeps_rows_without_value(spark):
    df = spark.createDataFrame([(1, 5.0), (2, None), (3, 7.0)], "id int, v double")
    assert {r.id: r["rank"] for r in rank_descending(df, "v").collect()} == {1: 2, 2: None, 3: 1}


@pytest.mark.parametrize("values", [[0, 1, 2, 10, 10], [4, 4, 4], [-3, 0.5, 2.25]])
def test_histogram_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    out = histogram(df, "v", 5).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=5)
    assert [r["count"] for r in out] == counts.tolist()
    assert [r.lower for r in out] + [out[-1].upper] == pytest.approx(edges.tolist())


def test_histogram_of_nothing_is_empty(spark):
    assert histogram(spark.createDataFrame([], "v double"), "v", 5).count() == 0
