from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from marketlens.operators import ward
from marketlens.session import materialize


def naive_ward(points, weights):
    """Merge heights by trying all pairs at every step."""
    clusters = [(np.array(p, float), float(w)) for p, w in zip(points, weights)]
    heights = []
    while len(clusters) > 1:
        best = min(
            (np.sqrt(2 * a[1] * b[1] / (a[1] + b[1])) * np.linalg.norm(a[0] - b[0]), i, j)
            for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j)
        height, i, j = best
        (ca, wa), (cb, wb) = clusters[i], clusters[j]
        clusters = [c for k, c in enumerate(clusters) if k not in (i, j)]
        clusters.append(((ca * wa + cb * wb) / (wa + wb), wa + wb))
        heights.append(height)
    return heights


def segment(spark, points, k):
    data = pd.DataFrame(points, columns=["x", "y"])
    data["seller_id"] = [f"s{i:06}" for i in range(len(data))]
    prepared = materialize(spark.createDataFrame(data), "test-ward")
    sellers, leaves = ward.ward_leaves(prepared, ["x", "y"])
    leaves = materialize(leaves, "test-leaves")
    merges = materialize(ward.ward_merges(leaves, cut_height=5.0), "test-merges")
    labelled = ward.label_sellers(sellers, ward.ward_labels(leaves, merges, k))
    return merges.orderBy("step").toPandas(), labelled.orderBy("seller_id").toPandas()


def test_merging_six_points_and_all_pairs_directly():
    points = np.array([(0, 0), (0, 1), (10, 0), (10, 2), (30, 0), (30, 4)], float)
    heights = sorted(h for _, _, h in ward._ward_pairs(points, np.ones(6)))
    assert heights[:3] == pytest.approx([1.0, 2.0, 4.0])
    points, weights = np.random.default_rng(4).normal(size=(60, 3)), np.arange(1.0, 61.0)
    heights = sorted(h for _, _, h in ward._ward_pairs(points, weights))
    assert heights == pytest.approx(naive_ward(points, weights))


def test_six_points_by_hand(spark):
    points = [(0, 0), (0, 1), (10, 0), (10, 2), (30, 0), (30, 4)]
    merges, labelled = segment(spark, np.array(points, float), 3)
    assert merges["height"].tolist()[:3] == pytest.approx([1.0, 2.0, 4.0])
    # Centres (0, .5) and (10, 1) with two points each: sqrt(2) * distance.
    assert merges["height"][3] == pytest.approx(np.sqrt(2 * (100 + 0.25)))
    assert merges["size"].tolist() == [2, 2, 2, 4, 6]
    assert merges["above_cut"].tolist() == [False, False, False, True, True]
    groups = labelled.groupby("seller_cluster")["seller_id"].apply(list).tolist()
    assert sorted(groups) == [["s000000", "s000001"], ["s000002", "s000003"], ["s000004", "s000005"]]


def test_heights_match_trying_all_pairs(spark):
    points = np.random.default_rng(0).normal(size=(40, 2))
    merges, labelled = segment(spark, points, 7)
    assert merges["height"].tolist() == pytest.approx(naive_ward(points, np.ones(40)))
    assert merges["height"].is_monotonic_increasing
    assert labelled["seller_cluster"].nunique() == 7 and len(labelled) == 40


def test_copies_of_a_point_are_one_weighted_leaf(spark):
    points = np.array([(0, 0)] * 50 + [(1, 1)] * 3 + [(5, 5)], float)
    merges, labelled = segment(spark, points, 2)
    assert merges["height"].tolist() == pytest.approx(naive_ward(points, np.ones(54))[-2:])
    assert merges["size"].tolist() == [53, 54]
    assert labelled["seller_cluster"].value_counts().tolist() == [53, 1]


def test_all_equal_sellers_share_one_cluster(spark):
    merges, labelled = segment(spark, np.ones((5, 2)), 3)
    assert merges.empty and labelled["seller_cluster"].tolist() == [0] * 5


def test_rounds_give_the_hierarchy_of_all_pairs(spark):
    rng = np.random.default_rng(1)
    centres = np.array([(0, 0), (50, 0), (0, 50)])
    points = np.concatenate([c + rng.normal(size=(1_200, 2)) for c in centres] + [rng.normal(size=(400, 2)) * 200])
    points = np.concatenate([points, points[:500]])  # copies
    merges, labelled = segment(spark, points, 12)
    leaves, weights = np.unique(points, axis=0, return_counts=True)
    want = sorted(ward._ward_pairs(leaves, weights), key=lambda m: m[2])
    assert merges["height"].tolist() == pytest.approx([h for _, _, h in want])
    assert merges["size"].iloc[-1] == len(points) and (merges["step"] == np.arange(len(leaves) - 1)).all()
    # The history builds up: each row joins two clusters that are there, of the stated sizes.
    size = dict(enumerate(weights.tolist()))
    for row in merges.itertuples():
        assert row.left < row.right < row.merged == len(leaves) + row.step
        size[row.merged] = size.pop(row.left) + size.pop(row.right)
        assert size[row.merged] == row.size
    # Cutting by hand gives the same groups.
    group = list(range(len(leaves)))

    def find(i):
        while group[i] != i:
            i = group[i]
        return i
    for a, b, _ in want[:len(leaves) - 12]:
        group[find(a)] = find(b)
    _, places = np.unique(points, axis=0, return_inverse=True)
    by_hand = [find(int(i)) for i in places]
    pairs = set(zip(by_hand, labelled["seller_cluster"]))
    assert len(pairs) == 12 == labelled["seller_cluster"].nunique()


def test_cells_ask_each_other(spark, monkeypatch):
    monkeypatch.setattr(ward, "CELL", 20)
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(size=(150, 2)), 3 + rng.exponential(size=(150, 2)) ** 2, np.round(rng.normal(size=(60, 2)))])
    merges, _ = segment(spark, points, 3)
    leaves, weights = np.unique(points, axis=0, return_counts=True)
    assert merges["height"].tolist() == pytest.approx(sorted(h for _, _, h in ward._ward_pairs(leaves, weights)))


def test_cells_of_a_round_are_not_joined_into_one_task(spark, monkeypatch):
    files = {}

    def stored(df, label):
        out = materialize(df, label)
        files.setdefault(label, len(out.inputFiles()))
        return out
    monkeypatch.setattr(ward, "CELL", 50)
    monkeypatch.setattr(ward, "materialize", stored)
    segment(spark, np.random.default_rng(5).normal(size=(400, 2)), 3)
    assert files["ward-own"] > 2 and files["ward-inside"] > 2


def test_nearest_clusters_equal_those_of_all_pairs_also_on_ties_and_far_away():
    rng = np.random.default_rng(6)
    lattice = np.stack(np.meshgrid(*[np.arange(5.0)] * 3), -1).reshape(-1, 3)
    for points, weights in [(lattice, np.ones(125)), (lattice + 1e6, rng.integers(1, 4, 125).astype(float)),
                            (rng.normal(size=(300, 3)) * 1e-3 + 50, np.exp(rng.normal(size=300) * 5)), (np.zeros((1, 3)), np.ones(1))]:
        gaps = ((points[:, None] - points[None]) ** 2).cumsum(2)[:, :, -1] * ward._factor(weights[:, None], weights[None])
        np.fill_diagonal(gaps, np.inf)
        near, gap = ward._best(points, weights, points, weights, np.arange(len(points)), np.arange(len(points)))
        assert (gap == gaps.min(1)).all()
        assert (near == np.where(np.isfinite(gap), gaps.argmin(1), -1)).all()


def test_a_search_looks_only_at_blocks_that_reach_near(monkeypatch):
    monkeypatch.setattr(ward, "BLOCK", 16)
    monkeypatch.setattr(ward, "FEW", 0)
    looked = []

    def counted(asking, weights, centres, *rest):
        looked.append(len(asking) * len(centres))
        return direct(asking, weights, centres, *rest)
    direct = ward._best_of_all
    monkeypatch.setattr(ward, "_best_of_all", counted)
    rng = np.random.default_rng(7)
    every = np.arange(2_000)
    for points, weights in [(rng.normal(size=(2_000, 2)), np.ones(2_000)), (np.round(rng.normal(size=(2_000, 2)), 1), np.ones(2_000)),
                            (rng.exponential(size=(2_000, 2)) ** 3, rng.integers(1, 50, 2_000).astype(float))]:
        near, gap = direct(points, weights, points, weights, 3 * every, every)
        looked.clear()
        found = ward._best(points, weights, points, weights, 3 * every, every)
        assert (found[0] == near).all() and (found[1] == gap).all()
        assert sum(looked) < 2_000 * 2_000 / 4
        outside, sizes = rng.normal(size=(500, 2)) * 2, rng.integers(1, 9, 500).astype(float)
        near, gap = direct(outside, sizes, points, weights, 3 * every)
        far = gap * rng.uniform(0, 2, 500)
        found = ward._best(outside, sizes, points, weights, 3 * every, within=far)
        inside = gap <= far
        assert (found[0][inside] == near[inside]).all() and (found[1][inside] == gap[inside]).all()
        # Beyond, nobody or the nearest is named, and no cluster comes below the height.
        assert np.isin(found[0][~inside], [-1, *near[~inside]]).all()
        assert (found[1][~inside] <= gap[~inside]).all() and (found[1][~inside] > far[~inside]).all()


def test_the_last_clusters_are_merged_in_one_round(spark, monkeypatch):
    counts = []

    def counted(*args):
        out = around(*args)
        counts.append(out[2])
        return out
    around = ward._round
    monkeypatch.setattr(ward, "_round", counted)
    monkeypatch.setattr(ward, "CELL", 200)
    points = np.random.default_rng(8).normal(size=(480, 2))
    merges, _ = segment(spark, points, 3)
    assert counts == [1]
    assert merges["height"].tolist() == pytest.approx(sorted(h for _, _, h in ward._ward_pairs(points, np.ones(480))))


def test_clusters_that_cannot_merge_in_their_cell_are_not_looked_at(monkeypatch):
    asked = []

    def best(asking, *rest):
        asked.append(len(asking))
        return found(asking, *rest)
    found = ward._best
    x = np.array([0.0, 1.0, 10.0, 12.0, 30.0, 34.0])
    every = np.arange(6)
    near, gap = found(x[:, None], np.ones(6), x[:, None], np.ones(6), every, every)
    monkeypatch.setattr(ward, "_best", best)
    rows = pd.DataFrame({"id": every, "node": -1 - every, "weight": 1, "s0": x, "mate": near, "own": gap, "gap": gap,
                         "low": np.minimum(every, near), "high": np.maximum(every, near)})
    none = ward._merge_inside(rows.assign(beyond=0.0), ["s0"])
    assert len(none) == 6 and none["left"].isna().all() and not asked
    one = ward._merge_inside(rows.assign(beyond=[2.0, 2.0, 0.0, 0.0, 0.0, 0.0]), ["s0"])
    assert one["left"].notna().sum() == 1 and asked == [1]  # the merged cluster alone
    asked.clear()
    every_one = ward._merge_inside(rows.assign(beyond=np.inf), ["s0"])
    assert sorted(np.sqrt(every_one["gap"][every_one["left"].notna()].astype(float))) == pytest.approx(
        sorted(h for _, _, h in ward._ward_pairs(x[:, None], np.ones(6))))


def test_undefined_feature_counts_as_average(spark):
    names = ward.SEGMENT_FEATURES
    rows = [(f"s{i}", *[float(i + j) for j in range(5)], None if i == 0 else float(i)) for i in range(4)]
    df = spark.createDataFrame(rows, "seller_id string, " + ", ".join(f"{c} double" for c in names))
    out = ward.ward_input(df).orderBy("seller_id").collect()
    assert out[0].z_avg_freight_ratio == 0.0
    assert len(out) == 4
