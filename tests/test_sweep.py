from __future__ import annotations

from pathlib import Path

import numpy as np
import pandas as pd
import pytest

from marketlens.fixtures.workspace import Workspace
from marketlens.operators import clustering, sweep
from marketlens.rules import MODEL_FEATURES
from marketlens.session import materialize


def brute_silhouette(x, label, squared=False):
    gap = ((x[:, None] - x[None]) ** 2).sum(2)
    gap = gap if squared else np.sqrt(gap)
    values = []
    for i in range(len(x)):
        own = label == label[i]
        if own.sum() == 1:
            values.append(0.0)
            continue
        a = gap[i, own].sum() / (own.sum() - 1)
        b = min(gap[i, label == c].mean() for c in set(label) - {label[i]})
        values.append((b - a) / max(a, b) if max(a, b) else 0.0)
    return float(np.mean(values))


def stored(spark, x, **labels):
    data = pd.DataFrame(x, columns=[f"x{i}" for i in range(x.shape[1])]).assign(**labels)
    return materialize(spark.createDataFrame(data).repartition(3), "test-points")


def test_bounds_hold_the_silhouette_of_all_pairs(spark, monkeypatch):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(size=(300, 3)), rng.normal(size=(200, 3)) + 2, rng.exponential(size=(200, 3)) * 3, np.ones((50, 3))])
    labels = {"a": rng.integers(0, 4, len(x)).astype(np.int32), "b": (x[:, 0] > 1).astype(np.int32),
              "c": np.r_[0, np.ones(len(x) - 1)].astype(np.int32)}
    points = stored(spark, x, **labels)
    for error, first in ((0.05, 8), (0.005, 64)):
        monkeypatch.setattr(sweep, "FIRST_CELLS", first)
        for (value, off), name in zip(sweep.silhouettes(points, ["x0", "x1", "x2"], labels, error), labels):
            assert off <= error and abs(value - brute_silhouette(x, labels[name])) <= off + 1e-9
    value, off = sweep.silhouettes(points, ["x0", "x1", "x2"], ["a"], 1e-12)[0]  # cells of single points
    assert off < 1e-6 and value == pytest.approx(brute_silhouette(x, labels["a"]))
    monkeypatch.setattr(sweep, "FIRST_CELLS", 64)
    coarse = sweep.silhouettes(points, ["x0", "x1", "x2"], ["a"], 1e-12, most_cells=128)[0]
    assert coarse[1] > 1e-6 and abs(coarse[0] - value) <= coarse[1]
    clusters = sweep.cluster_sums(points, ["x0", "x1", "x2"], list(labels))
    bouldin, squared = sweep.linear_indices(points, ["x0", "x1", "x2"], list(labels), clusters)
    for i, name in enumerate(labels):
        assert squared[i] == pytest.approx(brute_silhouette(x, labels[name], squared=True))
        assert bouldin[i] == pytest.approx(clustering.davies_bouldin(points, ["x0", "x1", "x2"], name).first()[0])


def test_family_costs_and_centres(spark):
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(size=(200, 2)) + c for c in ((0, 0), (8, 0), (0, 8))])
    ks = [1, 2, 3, 3, 4]
    fits = sweep.fit_family(stored(spark, x), ["x0", "x1"], ks)
    assert [f.k for f in fits] == ks
    for f in fits:
        gap = ((x[:, None] - f.centres[None]) ** 2).sum(2)
        label = gap.argmin(1)
        assert f.cost == pytest.approx(gap.min(1).sum())
        moved = np.array([x[label == c].mean(0) for c in range(f.k)])
        assert ((moved - f.centres) ** 2).sum() <= sweep.SHIFT  # at rest
    assert fits[0].centres[0] == pytest.approx(x.mean(0))
    assert min(f.cost for f in fits[2:4]) < 1.02 * sum(((x[i:i + 200] - x[i:i + 200].mean(0)) ** 2).sum() for i in (0, 200, 400))
    many = sweep.fit_family(stored(spark, x), ["x0", "x1"], [3], passes=1)
    assert many[0].cost > 0


def test_passes_take_no_distances_by_differences(spark, monkeypatch):
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(150, 3)) + c for c in (0, 5, 9)] + [np.ones((40, 3))])
    points, columns, ks = stored(spark, x), ["x0", "x1", "x2"], [2, 3, 2, 5, 1]
    dear, gaps = spark.sparkContext.accumulator(0), sweep._gaps

    def counted(x, centres):
        dear.add(len(x) * len(centres))
        return gaps(x, centres)

    def start(sample, k, seed):  # at some of the points, two of them alike
        return sample[[0, 0, 100, 200, 300][:k]]

    monkeypatch.setattr(sweep, "_start", start)
    monkeypatch.setattr(sweep, "_gaps", counted)
    fits = sweep.fit_family(points, columns, ks)
    assert dear.value == len(x) * sum(ks)  # the costs at the end, once
    for f in fits:
        # Plain Lloyd steps from the same centres.
        centres = start(sweep.sample_points(points, columns), f.k, 0)
        while True:
            label = ((x[:, None] - centres[None]) ** 2).sum(2).argmin(1)
            moved = np.array([x[label == c].mean(0) if (label == c).any() else centres[c] for c in range(f.k)])
            if ((moved - centres) ** 2).sum() <= sweep.SHIFT:
                break
            centres = moved
        assert f.centres == pytest.approx(centres, abs=1e-9)
        assert f.cost == pytest.approx(((x[:, None] - centres[None]) ** 2).sum(2).min(1).sum())


def test_fewer_points_than_clusters(spark):
    x = np.array([(0.0, 0.0)] * 3 + [(1.0, 1.0)])
    out = sweep.kmeans_sweep(stored(spark, x), ["x0", "x1"], ks=(2, 3), restarts=2).collect()
    assert [r.wcss for r in out] == [0.0, 0.0]
    assert [r.silhouette for r in out] == pytest.approx([0.75, 0.75])
    assert sweep.kmeans_sweep(stored(spark, x).limit(0), ["x0", "x1"], ks=(2,)).count() == 0


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.01"])
def test_sweep_of_sellers(spark, sf_dir):
    if not Path(sf_dir).exists():
        pytest.skip("test tables are absent")
    columns = [f"z_{c}" for c in MODEL_FEATURES]
    vectors = Workspace.of(spark, sf_dir).vectors
    x = vectors.select(*columns).toPandas().to_numpy()
    fits = sweep.fit_family(vectors, columns, [3] * 4 + [4] * 4)
    best = [min(fits[i:i + 4], key=lambda f: f.cost) for i in (0, 4)]
    out = sweep.kmeans_sweep(vectors, columns, ks=(3, 4), restarts=4).orderBy("k").collect()
    for r, f in zip(out, best):
        gap = ((x[:, None] - f.centres[None]) ** 2).sum(2)
        assert r.wcss == pytest.approx(gap.min(1).sum(), rel=1e-9)
        assert r.silhouette_error <= sweep.ERROR
        some = np.random.default_rng(0).choice(len(x), min(len(x), 1_500), replace=False)
        if len(some) == len(x):
            assert abs(r.silhouette - brute_silhouette(x, gap.argmin(1))) <= r.silhouette_error
        model = clustering.kmeans_label(vectors, r.k)[1]
        assert r.wcss <= model.summary.trainingCost * 1.01
