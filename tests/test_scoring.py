from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlens.functions import scaling
from marketlens.operators import clustering, scoring, segments, views
from marketlens.rules import MODEL_FEATURES, PERSONA_NATIONAL, SEGMENT_FEATURES
from marketlens.session import materialize


def frame(spark, **columns):
    return spark.createDataFrame(pd.DataFrame(columns))


def test_standardize_uses_the_population_deviation_and_zero_for_constants(spark):
    out = scaling.standardize(frame(spark, x=[1.0, 2.0, 3.0], c=[5.0] * 3), ["x", "c"]).orderBy("x").collect()
    assert [r.z_x for r in out] == pytest.approx([-1.224744871, 0, 1.224744871])
    assert [r.z_c for r in out] == [0.0] * 3


def test_minmax_and_inversion(spark):
    out = scaling.minmax(frame(spark, x=[1.0, 2.0, 5.0], c=[5.0] * 3), ["x", "c"], inverted=["c"]).orderBy("x").collect()
    assert [r.m_x for r in out] == [0.0, 0.25, 1.0]
    assert [r.m_c for r in out] == [1.0] * 3
    inverted = scaling.minmax(frame(spark, x=[1.0, 2.0, 5.0]), ["x"], inverted=["x"]).orderBy("x").collect()
    assert [r.m_x for r in inverted] == [1.0, 0.75, 0.0]


def test_correlation_and_profile_match_pandas(spark):
    rng = np.random.default_rng(2)
    data = pd.DataFrame({"a": rng.normal(size=60), "b": rng.integers(0, 9, 60), "flat": 1.0})
    df = spark.createDataFrame(data)
    cells = {(r.feature_a, r.feature_b): r.correlation
             for r in scaling.correlation_matrix(df, ["a", "b", "flat"]).collect()}
    assert cells["a", "b"] == cells["b", "a"] == pytest.approx(data["a"].corr(data["b"]))
    assert cells["a", "a"] == pytest.approx(1.0) and cells["a", "flat"] is None and len(cells) == 9
    rows = {r.column_name: r for r in scaling.profile(df, ["a", "b"]).collect()}
    expected = data.describe()
    for c in ("a", "b"):
        got = rows[c]
        assert [got.non_null, got["mean"], got["std"], got["min"], got.q25, got.q50, got.q75, got["max"]] == \
            pytest.approx(expected[c].tolist())
    overview = {r.column_name: r.non_null for r in scaling.column_overview(df).collect()}
    assert overview == {"a": 60, "b": 60, "flat": 60}


def test_types_of_text_columns(spark):
    columns = {"whole": ["1", "-20", None], "real": ["1", "2.5", "1e3"], "day": ["2020-01-02", "2020-01-02 03:04:05.6", None],
               "flag": ["true", "False", None], "mixed": ["1", "n/a", None], "none": [None] * 3, "blank": ["", "1", "2"]}
    df = spark.createDataFrame(list(zip(*columns.values())), ", ".join(f"{c} string" for c in columns)).withColumn("n", F.lit(1))
    out = {r.column_name: (r.data_type, r.inferred_type, r.rows, r.non_null) for r in scaling.column_overview(df).collect()}
    assert out == {
        "whole": ("string", "bigint", 3, 2), "real": ("string", "double", 3, 3), "day": ("string", "timestamp", 3, 2),
        "flag": ("string", "boolean", 3, 2), "mixed": ("string", "string", 3, 2), "none": ("string", "void", 3, 0),
        "blank": ("string", "string", 3, 3), "n": ("int", "int", 3, 3)}


def model_rows(spark, n=40, seed=4):
    rng = np.random.default_rng(seed)
    data = pd.DataFrame({c: rng.random(n) for c in MODEL_FEATURES})
    data["seller_id"] = [f"s{i}" for i in range(n)]
    data["gmv"], data["total_orders"] = np.expm1(data["log_gmv"]), 1
    return data, spark.createDataFrame(data)


def test_score_of_the_best_and_worst_seller(spark):
    best, worst = [1.0, 1.0, 1.0, 0.0, 0.0], [0.0, 0.0, 0.0, 1.0, 1.0]
    df = spark.createDataFrame([best, worst], ", ".join(f"{c} double" for c in MODEL_FEATURES))
    scores = sorted(r.final_score for r in scoring.seller_score(df).collect())
    assert scores == pytest.approx([0.0, 100.01])


def test_tiers_match_pandas_qcut(spark):
    rng = np.random.default_rng(8)
    data = pd.DataFrame({"id": range(101), "final_score": np.round(rng.random(101) * 100, 1)})
    expected = pd.qcut(data["final_score"], 4, labels=["Bronze", "Silver", "Gold", "Platinum"]).astype(str)
    out = scoring.score_tier(spark.createDataFrame(data)).toPandas().sort_values("id")
    assert out["segment"].tolist() == expected.tolist()
    counts = {r.segment: r["count"] for r in scoring.tier_counts(spark.createDataFrame(out)).collect()}
    assert counts == expected.value_counts().to_dict()


def test_equal_quartile_edges_are_an_error(spark):
    with pytest.raises(Exception, match="not unique"):
        scoring.score_tier(frame(spark, final_score=[1.0] * 9 + [2.0])).collect()


def test_top_sellers_break_ties_by_id(spark):
    _, df = model_rows(spark)
    flat = df.withColumns({"final_score": F.lit(1.0), "segment": F.lit("Gold")})
    assert [r.seller_id for r in scoring.top_sellers(flat, 3).collect()] == ["s0", "s1", "s10"]


def test_davies_bouldin_by_hand(spark):
    rng = np.random.default_rng(9)
    points, labels = rng.normal(size=(30, 2)), np.arange(30) % 3
    df = frame(spark, x=points[:, 0], y=points[:, 1], cluster=labels)
    centres = [points[labels == k].mean(axis=0) for k in range(3)]
    spread = [np.linalg.norm(points[labels == k] - centres[k], axis=1).mean() for k in range(3)]
    expected = np.mean([max((spread[i] + spread[j]) / np.linalg.norm(centres[i] - centres[j])
                            for j in range(3) if j != i) for i in range(3)])
    assert clustering.davies_bouldin(df, ["x", "y"]).first()[0] == pytest.approx(expected)


@pytest.fixture(scope="module")
def vectors(spark):
    _, df = model_rows(spark, 60)
    return materialize(clustering.standardized_vectors(df, MODEL_FEATURES), "test-vectors")


def test_kmeans_cost_equals_recomputed_cost_and_importances_sum_to_one(spark, vectors):
    columns = [f"z_{c}" for c in MODEL_FEATURES]
    labelled, model = clustering.kmeans_label(vectors, 4)
    rows = labelled.toPandas()
    centres = np.array(model.clusterCenters())[rows["cluster"]]
    cost = ((rows[columns].to_numpy() - centres) ** 2).sum()
    assert model.summary.trainingCost == pytest.approx(cost, rel=1e-6)
    assert rows["cluster"].nunique() == 4
    means = clustering.cluster_means(labelled, ["avg_rating"]).toPandas().set_index("cluster")["avg_rating"]
    assert means.sort_index().tolist() == pytest.approx(rows.groupby("cluster")["avg_rating"].mean().tolist())
    for bound in (10_000, 40):
        weights = [r.importance for r in clustering.feature_importance(labelled, trees=10, max_rows=bound).collect()]
        assert len(weights) == 5 and sum(weights) == pytest.approx(1.0)


def test_personas(spark):
    # Plain means over the three clusters: value 100, weight 100, reach 10.
    rows = [(0, 200.0, 20.0, 25.0), (1, 40.0, 180.0, 3.0), (2, 60.0, 100.0, 2.0)]
    profile = spark.createDataFrame(rows, "seller_cluster int, avg_order_value double, avg_weight_g double, market_reach double")
    out = {r.seller_cluster: r.persona.split(" + ") for r in segments.persona_label(profile).collect()}
    assert [[p.split(" (")[0] for p in out[c]] for c in range(3)] == [
        ["High-Ticket", "Lightweight", "National"],
        ["Low-Cost", "Bulky", "Local/Regional"],
        ["Low-Cost", "Local/Regional"]]


def test_matrix_crosstab_and_spread(spark):
    tiered = frame(spark, seller_id=list("abcdef"), final_score=[1.0, 2.0, 3.0, 4.0, 100.0, 7.0],
                   segment=["Bronze", "Bronze", "Silver", "Gold", "Platinum", "Gold"])
    labelled = frame(spark, seller_id=list("abcde"), seller_cluster=[0, 0, 0, 0, 0])
    matrix = materialize(segments.seller_matrix(tiered, labelled), "test-matrix")
    table = {r.segment: (r.c0, r.c1) for r in segments.tier_cluster_crosstab(matrix, [0, 1]).collect()}
    left = segments.tier_cluster_crosstab(matrix, [1]).agg({"other": "sum"}).first()[0]
    assert left == 5
    assert table == {"Bronze": (2, 0), "Silver": (1, 0), "Gold": (1, 0), "Platinum": (1, 0)}
    box = segments.score_spread(matrix).first()
    assert (box.q25, box.median, box.q75) == (2.0, 3.0, 4.0)
    assert (box.whisker_low, box.whisker_high, box.outliers, box.sellers) == (1.0, 4.0, 1, 5)
    assert box.overall_mean == 22.0


def test_segmentation_input_and_profile(spark):
    row = {c: 1.0 for c in SEGMENT_FEATURES}
    rows = [{"seller_id": s, **row, "avg_distance_km": d} for s, d in (("a", 1.0), ("b", None), ("x", 2.0))]
    segmentation = spark.createDataFrame(rows, "seller_id string, " + ", ".join(f"{c} double" for c in SEGMENT_FEATURES))
    scored = frame(spark, seller_id=["a", "b"])
    kept = segments.segmentation_input(scored, segmentation)
    assert [r.seller_id for r in kept.collect()] == ["a"]
    profile = segments.cluster_profile(kept.withColumn("seller_cluster", F.lit(3))).first()
    assert profile["count"] == 1 and profile.avg_order_value == 1.0


def test_views(spark):
    scored = frame(spark, seller_id=list("abcd"), final_score=[39.9, 40.0, 80.0, 90.0],
                   late_shipment_rate=[0.0, 0.3, 0.31, 0.0], gmv=[10.0, 20.0, 30.0, 40.0],
                   avg_rating=[1.0, 3.0, 2.9, 5.0], seller_cluster=[0, 0, 1, 1])
    assert {r.seller_id for r in views.risk_alert(scored).collect()} == {"a", "c"}
    assert {r.seller_id for r in views.training_focus(scored).collect()} == {"c"}
    personas = frame(spark, seller_cluster=[0, 1], persona=["Bulky + Local", f"Low + {PERSONA_NATIONAL}"])
    assert {r.seller_id for r in views.vip_program(scored, personas).collect()} == {"d"}
