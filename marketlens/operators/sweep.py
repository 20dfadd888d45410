"""K-means for many numbers of clusters at once, and how good each is.

All fits (every k, several restarts) are one family: a pass over the points assigns
each point under every fit and adds up the new centres of all of them, so the number of
jobs is that of the longest fit. Matrix products tell which centre is nearest while centres
move; costs and labels of the centres they come to are worked out by differences. Starts come
from a sample of fixed size.

Quality needs few more passes: sums per cluster give the Davies-Bouldin index and the
silhouette on squared distances; the plain silhouette is bounded from both sides by
cells of points, which are made smaller until the bounds are close enough.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.cells import cells_of, plan_tight_cells
from marketlens.session import materialize

SAMPLE = 1 << 14         # points that starts and cells are made from
WARM = 300               # steps on the sample at most
PASSES, SHIFT = 300, 1e-4  # passes over all points at most; a fit is done when its centres move less (squared, in all)
ROWS = 1 << 20           # distances a task looks at together
FIRST_CELLS, MOST_CELLS = 2_048, 1 << 14
ERROR = 0.02


def sample_points(points: DataFrame, columns: Sequence[str], rows: int = SAMPLE) -> np.ndarray:
    """Points of the smallest hashes: the same ones however the table lies."""
    picked = points.select(*columns).orderBy(F.xxhash64(*columns), *columns).limit(rows)
    return picked.toPandas().to_numpy(float).reshape(-1, len(columns))


def _chunks(batches: Iterator[pa.RecordBatch], columns: Sequence[str], width: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Batches with their points, few enough for ``width`` distances each."""
    step = max(1, ROWS // max(width, 1))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield part, np.column_stack([part.column(c).to_numpy(zero_copy_only=False) for c in columns]).astype(float)


def _gaps(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances, by differences: exact for points on a centre."""
    out = np.zeros((len(x), len(centres)))
    for axis in range(x.shape[1]):
        out += (x[:, axis, None] - centres[None, :, axis]) ** 2
    return out


def _products(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances by a matrix product, off by its rounding; not below zero."""
    gap = np.column_stack([x, (x * x).sum(1), np.ones(len(x))]) @ np.column_stack(
        [-2 * centres, np.ones(len(centres)), (centres * centres).sum(1)]).T
    return np.maximum(gap, 0, out=gap)


def _start(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Centres far apart, by weighted draws, then moved until they rest on the sample."""
    rng = np.random.default_rng(seed)
    centres = sample[[rng.integers(len(sample))]]
    while len(centres) < k:
        gap = _gaps(sample, centres).min(1)
        total = gap.sum()
        drawn = rng.choice(len(sample), p=gap / total) if total > 0 else rng.integers(len(sample))
        centres = np.vstack([centres, sample[drawn]])
    for _ in range(WARM):
        label = _gaps(sample, centres).argmin(1)
        n = np.bincount(label, minlength=k)[:, None]
        sums = np.column_stack([np.bincount(label, axis, minlength=k) for axis in sample.T])
        moved = np.where(n > 0, sums / np.maximum(n, 1), centres)
        done = ((moved - centres) ** 2).sum() <= SHIFT / 100
        centres = moved
        if done:
            break
    return centres


@dataclass(frozen=True)
class Fit:
    k: int
    centres: np.ndarray
    cost: float


def fit_family(points: DataFrame, columns: Sequence[str], ks: Sequence[int], seed: int = 42,
               passes: int = PASSES) -> list[Fit]:
    """One k-means fit per entry of ``ks``, all in the same passes over the points.

    An emptied cluster keeps its centre. Costs are those of the returned centres.
    ``points`` is read once per pass: pass a stored table.
    """
    columns, width = list(columns), len(columns)
    sample = sample_points(points, columns)
    if not len(sample):
        return [Fit(k, np.zeros((k, width)), 0.0) for k in ks]
    spark = points.sparkSession

    def begin(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for i in batch["id"]:
                centres = _start(sample, ks[i], seed + int(i))
                yield pd.DataFrame({"fit": i, "centre": np.arange(len(centres)), "at": list(centres)})

    started = spark.range(len(ks), numPartitions=len(ks)).mapInPandas(begin, "fit long, centre long, at array<double>")
    centres = [np.zeros((k, width)) for k in ks]
    for row in started.collect():  # a row per centre
        centres[row.fit][row.centre] = row.at

    sums = ", ".join(f"s{i} double" for i in range(width))

    def step(fits: list[int]) -> pd.DataFrame:
        """(fit, centre, n, sums) of the points under some fits."""
        alike = [(k, [f for f in fits if ks[f] == k]) for k in sorted({ks[f] for f in fits})]
        every = [np.array([centres[f] for f in own]).swapaxes(0, 1) for _, own in alike]  # centre, fit, axis
        fit_of = np.concatenate([np.tile(own, k) for k, own in alike])
        number = np.concatenate([np.repeat(np.arange(k), len(own)) for k, own in alike])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = [np.zeros((k * len(own), width + 1)) for k, own in alike]
            for _, x in _chunks(batches, columns, len(fit_of)):
                held = np.column_stack([x, np.ones(len(x))])
                for into, own in zip(total, every):
                    k, some, _ = own.shape
                    flat = own.reshape(-1, width)
                    # Squared distances but for the point's own length, which is the same for all centres.
                    gap = (np.column_stack([-2 * flat, (flat * flat).sum(1)]) @ held.T).reshape(k, some, -1)
                    mine = gap == gap.min(0)
                    if np.count_nonzero(mine) > some * len(x):  # the first on ties
                        mine = np.arange(k)[:, None, None] == gap.argmin(0)
                    into += mine.reshape(k * some, -1).astype(float) @ held
            yield pa.RecordBatch.from_arrays(
                [pa.array(fit_of), pa.array(number), *[pa.array(v) for v in np.concatenate(total).T]],
                names=["fit", "centre", *[f"s{i}" for i in range(width)], "n"])

        added = points.select(*columns).mapInArrow(add, f"fit long, centre long, {sums}, n double")
        return added.groupBy("fit", "centre").agg(
            F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(width)]).toPandas()

    def cost(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(ks))
        for _, x in _chunks(batches, columns, max(ks)):
            total += [_gaps(x, c).min(1).sum() for c in centres]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(ks))), pa.array(total)], names=["fit", "cost"])

    active = list(range(len(ks)))
    for _ in range(passes - 1):  # the last one is that of the costs
        found = step(active)
        resting = []
        for f, own in found.groupby("fit"):
            own = own.sort_values("centre")
            n = own["n"].to_numpy()[:, None]
            moved = np.where(n > 0, own[[f"s{i}" for i in range(width)]].to_numpy() / np.maximum(n, 1), centres[f])
            if ((moved - centres[f]) ** 2).sum() <= SHIFT:
                resting.append(f)
            else:
                centres[f] = moved
        active = [f for f in active if f not in resting]
        if not active:
            break
    costs = points.select(*columns).mapInArrow(cost, "fit long, cost double").groupBy("fit").agg(F.sum("cost").alias("cost")).toPandas()
    return [Fit(k, c, float(v)) for k, c, v in zip(ks, centres, costs.sort_values("fit")["cost"])]


def with_labels(points: DataFrame, columns: Sequence[str], fits: Sequence[Fit]) -> DataFrame:
    """The points with a cluster number per fit: label_0, label_1..."""
    columns = list(columns)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in _chunks(batches, columns, max(f.k for f in fits)):
            labels = [pa.array(_gaps(x, f.centres).argmin(1).astype(np.int32)) for f in fits]
            yield pa.RecordBatch.from_arrays([*part.columns, *labels], names=[*columns, *names])

    names = [f"label_{i}" for i in range(len(fits))]
    schema = ", ".join([f"{c} double" for c in columns] + [f"{n} int" for n in names])
    return points.select(*[F.col(c).cast("double").alias(c) for c in columns]).mapInArrow(label, schema)


def _tally(points: DataFrame, columns: list[str], labels: list[str], width: int,
           add: Callable[[np.ndarray, np.ndarray, int, dict], None], keys: Sequence[str], values: Sequence[str]) -> pd.DataFrame:
    """Sums per key over all points; ``add(x, label, index, sums)`` adds a chunk under one labelling to a task's sums."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        for part, x in _chunks(batches, columns, width):
            for i, name in enumerate(labels):
                add(x, part.column(name).to_numpy(zero_copy_only=False), i, sums)
        if sums:
            found = np.array(list(sums), np.int64).reshape(len(sums), len(keys))
            totals = np.array(list(sums.values())).reshape(len(sums), len(values))
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in (*found.T, *totals.T)], names=[*keys, *values])

    schema = ", ".join([f"{k} long" for k in keys] + [f"{v} double" for v in values])
    return points.select(*columns, *labels).mapInArrow(run, schema).groupBy(*keys).agg(
        *[F.sum(v).alias(v) for v in values]).toPandas()


def _add(sums: dict, key: tuple, values: np.ndarray) -> None:
    if key in sums:
        sums[key] += values
    else:
        sums[key] = values


def _group_sums(groups: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(groups, kind="stable")
    found, first = np.unique(groups[order], return_index=True)
    return found, np.add.reduceat(values[order], first) if len(found) else values[:0]


@dataclass
class Clusters:
    """Figures of the clusters of one labelling, by cluster number."""

    n: np.ndarray
    mean: np.ndarray
    square: np.ndarray  # mean squared length


def cluster_sums(points: DataFrame, columns: list[str], labels: list[str]) -> list[Clusters]:
    width = len(columns)

    def add(x, label, i, sums):
        found, totals = _group_sums(label, np.column_stack([np.ones(len(x)), (x * x).sum(1), x]))
        for c, t in zip(found.tolist(), totals):
            _add(sums, (i, c), t)

    rows = _tally(points, columns, labels, 1, add, ["fit", "cluster"], ["n", "square", *[f"s{j}" for j in range(width)]])
    out = []
    for i in range(len(labels)):
        own = rows[rows["fit"] == i].sort_values("cluster")
        n = own["n"].to_numpy()
        out.append(Clusters(n, own[[f"s{j}" for j in range(width)]].to_numpy() / n[:, None], own["square"].to_numpy() / n))
    return out


def _silhouette(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    top = np.maximum(own, other)
    return np.divide(other - own, top, out=np.zeros(len(own)), where=top > 0)


def linear_indices(points: DataFrame, columns: list[str], labels: list[str], clusters: list[Clusters]) -> tuple[list[float], list[float]]:
    """Davies-Bouldin index and mean silhouette on squared distances of each labelling, in one pass."""
    def add(x, label, i, sums):
        own = clusters[i]
        gap = _gaps(x, own.mean)
        rows = np.arange(len(x))
        near = gap[rows, label]
        # Mean squared distance to a cluster: to its mean, and the cluster's own spread.
        spread = np.maximum(own.square - (own.mean ** 2).sum(1), 0)
        n = own.n[label]
        mine = np.divide((near + spread[label]) * n, n - 1, out=np.zeros(len(x)), where=n > 1)
        others = gap + spread[None]
        others[rows, label] = np.inf
        value = np.where(n > 1, _silhouette(mine, others.min(1)), 0.0) if len(own.n) > 1 else np.zeros(len(x))
        found, totals = _group_sums(label, np.column_stack([np.sqrt(near), value]))
        for c, t in zip(found.tolist(), totals):
            _add(sums, (i, c), t)

    rows = _tally(points, columns, labels, max(len(c.n) for c in clusters), add, ["fit", "cluster"], ["away", "value"])
    bouldin, squared = [], []
    for i, own in enumerate(clusters):
        mine = rows[rows["fit"] == i].sort_values("cluster")
        away = mine["away"].to_numpy() / own.n
        gap = np.sqrt(_gaps(own.mean, own.mean))
        np.fill_diagonal(gap, np.nan)
        with np.errstate(invalid="ignore", divide="ignore"):
            ratio = (away[:, None] + away[None]) / gap
        ratio[~np.isfinite(ratio)] = 0
        bouldin.append(float(ratio.max(1).mean()) if len(own.n) > 1 else None)
        squared.append(float(mine["value"].sum() / own.n.sum()))
    return bouldin, squared


def silhouettes(points: DataFrame, columns: Sequence[str], labels: Sequence[str], error: float = ERROR,
                most_cells: int = MOST_CELLS) -> list[tuple[float, float]]:
    """(mean silhouette on plain distances, how far off it may be) of each labelling 0, 1...

    The mean distance from a point to the points of a cell lies between the distance d
    to their mean and sqrt(d * d + their variance). Sums over a cluster's cells bound a
    point's silhouette, and the points' bounds the mean. Cells are made smaller until no
    labelling is off by more than ``error``, or there are ``most_cells``: the figure
    returned says what was reached. A cluster of one point counts as 0.
    """
    columns, labels = list(columns), list(labels)
    clusters = cluster_sums(points, columns, labels)
    sample = sample_points(points, columns)
    out: dict[int, tuple[float, float]] = {}
    cells = FIRST_CELLS
    while True:
        if 8 * cells > SAMPLE:
            sample = sample_points(points, columns, 8 * cells)
        plan = plan_tight_cells(sample, cells)
        open_ = [i for i in range(len(labels)) if i not in out or out[i][1] > error]
        for i, found in zip(open_, _bounded(points, columns, [labels[i] for i in open_], plan, [clusters[i] for i in open_])):
            out[i] = found
        if cells >= most_cells or all(e <= error for _, e in out.values()):
            return [out[i] for i in range(len(labels))]
        cells = min(2 * cells, most_cells)


def _bounded(points: DataFrame, columns: list[str], labels: list[str], plan: tuple, clusters: list[Clusters]) -> list[tuple[float, float]]:
    width = len(columns)

    def add_cells(x, label, i, sums):
        group = cells_of(plan, x).astype(np.int64) << 20 | label
        found, totals = _group_sums(group, np.column_stack([np.ones(len(x)), (x * x).sum(1), x]))
        for g, t in zip(found.tolist(), totals):
            _add(sums, (i, g >> 20, g & (1 << 20) - 1), t)

    rows = _tally(points, columns, labels, 1, add_cells, ["fit", "cell", "cluster"], ["n", "square", *[f"s{j}" for j in range(width)]])
    parts = []
    for i in range(len(labels)):
        own = rows[rows["fit"] == i].sort_values(["cluster", "cell"])
        n = own["n"].to_numpy()
        mean = own[[f"s{j}" for j in range(width)]].to_numpy() / n[:, None]
        spread = np.maximum(own["square"].to_numpy() / n - (mean ** 2).sum(1), 0)
        held = np.where(own["cluster"].to_numpy()[:, None] == np.arange(len(clusters[i].n)), n[:, None], 0.0)  # by cluster
        parts.append((mean, np.where(n > 1, spread, 0.0), held))

    def add_bounds(x, label, i, sums):
        mean, spread, held = parts[i]
        size = clusters[i].n
        gap = _products(x, mean)
        high = np.sqrt(gap + spread) @ held
        low = np.sqrt(gap, out=gap) @ held
        rows = np.arange(len(x))
        mine = size[label]
        own_low, own_high = (v[rows, label] / np.maximum(mine - 1, 1) for v in (low, high))
        bounds = []
        for v in (low, high):
            other = v / size
            other[rows, label] = np.inf
            bounds.append(other.min(1))
        lower, upper = _silhouette(own_high, bounds[0]), _silhouette(own_low, bounds[1])
        alone = mine < 2
        _add(sums, (i,), np.array([np.where(alone, 0, lower).sum(), np.where(alone, 0, upper).sum(), len(x)], float))

    widest = max(len(p[1]) for p in parts)
    found = _tally(points, columns, labels, widest, add_bounds, ["fit"], ["lower", "upper", "n"]).sort_values("fit")
    out = []
    for (_, row), own in zip(found.iterrows(), clusters):
        if len(own.n) < 2:
            out.append((0.0, 0.0))
        else:
            out.append((float(row.lower + row.upper) / 2 / float(row.n), float(row.upper - row.lower) / 2 / float(row.n)))
    return out


def kmeans_sweep(points: DataFrame, columns: Sequence[str], ks: Sequence[int] = tuple(range(2, 11)), restarts: int = 10,
                 seed: int = 42, error: float = ERROR) -> DataFrame:
    """Quality per number of clusters: (k, wcss, silhouette, silhouette_error, silhouette_squared, davies_bouldin).

    Each k keeps the cheapest of ``restarts`` fits. ``silhouette`` is off by at most
    ``silhouette_error``. ``columns`` are standardized and without nulls; an empty table
    gives no rows.
    """
    spark, columns = points.sparkSession, list(columns)
    stored = materialize(points.select(*[F.col(c).cast("double").alias(c) for c in columns])
                         .repartition(int(spark.conf.get("spark.sql.shuffle.partitions"))), "sweep-points")
    schema = "k int, wcss double, silhouette double, silhouette_error double, silhouette_squared double, davies_bouldin double"
    if stored.isEmpty():
        return spark.createDataFrame([], schema)
    fits = fit_family(stored, columns, [k for k in ks for _ in range(restarts)], seed)
    best = [min(fits[i * restarts:(i + 1) * restarts], key=lambda f: f.cost) for i in range(len(ks))]
    labels = [f"label_{i}" for i in range(len(best))]
    labelled = materialize(with_labels(stored, columns, best), "sweep-labels")
    numbered = _without_gaps(labelled, columns, labels)
    clusters = cluster_sums(numbered, columns, labels)
    bouldin, squared = linear_indices(numbered, columns, labels, clusters)
    plain = silhouettes(numbered, columns, labels, error)
    return spark.createDataFrame(
        [(f.k, f.cost, *s, q, b) for f, s, q, b in zip(best, plain, squared, bouldin)], schema)


def _without_gaps(labelled: DataFrame, columns: list[str], labels: list[str]) -> DataFrame:
    """Labels as 0, 1... of the clusters that have points; an emptied one has none."""
    present = labelled.agg(*[F.sort_array(F.collect_set(name)).alias(name) for name in labels]).first()
    if all(present[name] == list(range(len(present[name]))) for name in labels):
        return labelled
    return labelled.withColumns({
        name: (F.array_position(F.array(*[F.lit(v) for v in present[name]]), F.col(name)) - 1).cast("int") for name in labels})
