"""Hierarchical clustering by Ward's criterion, of all sellers.

Two clusters that are each other's nearest may be merged at any time without changing
the hierarchy. So the work goes in rounds over cells of bounded size. A cluster is its
number of sellers and the sums of their features.

Every cluster first finds its nearest one in its cell, then asks the cells whose boxes
reach near it for the nearest one there. Within a cell, mutual pairs then merge again and
again as long as nothing outside can be nearer: a merged cluster is no nearer to others
than the nearer of its parts was, whatever merges elsewhere. Mutual pairs across cells
merge once. The last ``ONE_CELL * CELL`` clusters, the top of the hierarchy, form one cell, whose merges are all of
theirs; up to ``LAST_CELLS * CELL`` are merged without a round. A search in a cell looks at blocks of clusters, and
only at those whose boxes reach near enough.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.functions.cells import cells_of, plan_cells
from marketlens.functions.columns import to_number
from marketlens.functions.numbering import numbered
from marketlens.functions.scaling import standardize
from marketlens.operators.features import log_segment_features
from marketlens.rules import SEGMENT_FEATURES, SEGMENT_LOG_FEATURES
from marketlens.session import materialize

CELL = 8_000            # clusters of a cell, about
ONE_CELL = 2.5          # up to so many cells' clusters form one cell, which merges all of them
LAST_CELLS = 0.5        # so many cells' clusters at the end are merged in one task
BLOCK = 128             # clusters of a cell that are looked at together, about
FEW = 1 << 17           # up to so many distances of a search are worked out without blocks
MOST_CELLS = 20_000     # boxes of cells that every task knows; beyond, cells grow
SAMPLE = 20_000         # clusters the cells are cut by; no result depends on them
PAIRS = 1 << 18         # distances a task looks at together
REACH = 1.5             # other cells are asked as far as so many times the nearest height (squared) in the own cell
ROUNDING = 1e-14        # what a matrix product may be off, of the squared lengths
CUT_HEIGHT = 20.0
Z_COLUMNS = tuple(
    f"z_log_{c}" if c in SEGMENT_LOG_FEATURES else f"z_{c}" for c in SEGMENT_FEATURES
)


def ward_input(segmentation: DataFrame) -> DataFrame:
    """Add the standardized features; an undefined one counts as average (0)."""
    scaled = standardize(log_segment_features(segmentation), [c[2:] for c in Z_COLUMNS])
    return scaled.withColumns({c: F.coalesce(to_number(F.col(c)), F.lit(0.0)) for c in Z_COLUMNS})


def ward_leaves(prepared: DataFrame, columns: Sequence[str] = Z_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Sellers with their leaf, and the leaves (leaf, weight, columns...).

    Leaves are the distinct points, numbered from 0 in the order of their values;
    sellers at one point share a leaf of that weight. ``prepared`` is read twice: pass
    a stored table without nulls in ``columns``.
    """
    columns = list(columns)
    points = prepared.groupBy(*columns).agg(F.count(F.lit(1)).alias("weight"))
    leaves = numbered(points, columns, "leaf").select("leaf", "weight", *columns)
    return prepared.join(leaves.select("leaf", *columns), columns), leaves


def _factor(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """What squared distances of centres count, for clusters of two sizes; it grows with both."""
    return 2.0 * (a * b) / (a + b)


def _centres(rows: pd.DataFrame, sums: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    weight = rows["weight"].to_numpy(float)
    return rows[list(sums)].to_numpy(float) / weight[:, None], weight


def _best(asking: np.ndarray, weights: np.ndarray, centres: np.ndarray, sizes: np.ndarray,
          names: np.ndarray, places: np.ndarray | None = None, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Nearest of ``names`` (ascending) and its squared height for each asking cluster; the first on ties.

    Where those that ask are among the named ones, at ``places``, they do not count for themselves; -1 is nobody.
    With ``within``, an answer beyond that squared height may be -1 with what no named one comes below.
    Many named ones are cut into blocks, and only blocks whose boxes reach nearer than the best so far are looked at.
    """
    if len(asking) * len(names) <= FEW or len(names) < 2 * BLOCK:
        return _best_of_all(asking, weights, centres, sizes, names, places)
    spots = np.column_stack([centres, np.log2(sizes)])
    owner = cells_of(plan_cells(spots, -(-len(names) // BLOCK))[0], spots)
    order = np.argsort(owner, kind="stable")  # names stay ascending within a block
    blocks = np.split(order, np.flatnonzero(np.diff(owner[order])) + 1)
    boxes = Boxes(np.arange(len(blocks)), np.array([sizes[r].min() for r in blocks]),
                  np.array([centres[r].min(0) for r in blocks]), np.array([centres[r].max(0) for r in blocks]))
    home, inside = np.empty((2, len(names)), np.int64)  # block, and place within it
    for k, rows in enumerate(blocks):
        home[rows], inside[rows] = k, np.arange(len(rows))
    near, gap = np.full(len(asking), -1, np.int64), np.full(len(asking), np.inf)

    def look(k: int, which: np.ndarray) -> None:
        rows = blocks[k]
        found, height = _best_of_all(asking[which], weights[which], centres[rows], sizes[rows], names[rows],
                                     None if places is None else np.where(home[places[which]] == k, inside[places[which]], -1))
        nearer = (height < gap[which]) | ((height == gap[which]) & (found < near[which]) & (found >= 0))
        near[which[nearer]], gap[which[nearer]] = found[nearer], height[nearer]

    step = max(1, 4 * PAIRS // len(blocks))
    for at in range(0, len(asking), step):
        part = np.arange(at, min(at + step, len(asking)))
        bound = _bounds(asking[part], weights[part], boxes)
        first = bound.argmin(1)
        far = np.full(len(part), np.inf) if within is None else within[part]
        least = bound.min(1)
        for k in np.unique(first):
            look(k, part[(first == k) & (least <= far)])
        bound[np.arange(len(part)), first] = np.where(least <= far, np.inf, least)
        for k in range(len(blocks)):
            reached = bound[:, k] <= np.minimum(gap[part], far)
            if reached.any():
                look(k, part[reached])
                bound[reached, k] = np.inf
        rest = bound.min(1)
        beyond = rest < gap[part]  # only where ``within`` kept blocks from being looked at
        near[part[beyond]], gap[part[beyond]] = -1, rest[beyond]
    return near, gap


def _best_of_all(asking: np.ndarray, weights: np.ndarray, centres: np.ndarray, sizes: np.ndarray,
                 names: np.ndarray, places: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``_best`` by every distance; a place below zero is not among the named ones.

    A matrix product finds who may be nearest, within its rounding; their heights are then worked out one by one.
    """
    near, gap = np.empty(len(asking), np.int64), np.empty(len(asking))
    origin = centres.mean(0)
    a, b = asking - origin, centres - origin
    long_a, long_b = (a * a).sum(1), (b * b).sum(1)
    parts, others = 1.0 / weights, 1.0 / sizes  # a factor is 2 / (1 / a + 1 / b)
    slack = ROUNDING / (parts + others.min()) * (long_a + long_b.max())
    step = max(1, PAIRS // max(len(names), 1))
    for at in range(0, len(asking), step):
        part = slice(at, at + step)
        total = a[part] @ (-2.0 * b.T)
        total += long_a[part, None]
        total += long_b
        total /= parts[part, None] + others
        if places is not None:
            among = np.flatnonzero(places[part] >= 0)
            total[among, places[part][among]] = np.inf
        least = total.min(1)
        i, j = np.nonzero(total <= (least + slack[part])[:, None])
        exact = ((asking[at + i] - centres[j]) ** 2).cumsum(1)[:, -1] * _factor(weights[at + i], sizes[j])
        if places is not None:
            exact[places[at + i] == j] = np.inf
        order = np.lexsort((j, exact, i))
        first = order[np.flatnonzero(np.diff(i[order], prepend=-1))]  # every asking one has a row
        gap[part] = exact[first]
        near[part] = np.where(np.isfinite(gap[part]), names[j[first]], -1)
    return near, gap


def _bounds(centres: np.ndarray, weight: np.ndarray, boxes: Boxes) -> np.ndarray:
    """What squared heights with clusters of each box are not below."""
    away = np.zeros((len(centres), len(boxes.least)))
    for axis in range(centres.shape[1]):
        x = centres[:, axis, None]
        away += np.maximum(np.maximum(boxes.low[None, :, axis] - x, x - boxes.high[None, :, axis]), 0) ** 2
    return away * _factor(weight[:, None], boxes.least[None]) * (1 - 1e-9)


@dataclass(frozen=True)
class Boxes:
    """Per cell: its number, smallest cluster, and the range of its centres."""

    cells: np.ndarray
    least: np.ndarray
    low: np.ndarray
    high: np.ndarray

    @classmethod
    def of(cls, placed: DataFrame, sums: Sequence[str]) -> Boxes:
        rows = placed.groupBy("cell").agg(F.min("weight").alias("weight"), *[
            f(F.col(s) / F.col("weight")).alias(f"{name}_{s}") for s in sums for name, f in (("low", F.min), ("high", F.max))])
        found = rows.toPandas()  # a row per cell
        low, high = (found[[f"{name}_{s}" for s in sums]].to_numpy(float) for name in ("low", "high"))
        return cls(found["cell"].to_numpy(), found["weight"].to_numpy(float), low, high)


def _merge_inside(rows: pd.DataFrame, sums: Sequence[str]) -> pd.DataFrame:
    """A cell's clusters after its own merges, with the pair they wish for, and those merges (with ``left``).

    ``beyond`` is what no cluster outside the cell comes below, ``mate`` the nearest one inside (-1: none) and
    ``own`` its squared height.
    """
    rows = rows.sort_values("id")
    ids, node = rows["id"].to_numpy().copy(), rows["node"].to_numpy().copy()
    size, total = rows["weight"].to_numpy(float), rows[list(sums)].to_numpy(float).copy()
    beyond, best = rows["beyond"].to_numpy(float).copy(), rows["own"].to_numpy(float).copy()
    every = np.arange(len(ids))
    near = np.where(rows["mate"] >= 0, np.searchsorted(ids, rows["mate"]), every)
    alive, touched = np.ones(len(ids), bool), np.zeros(len(ids), bool)
    merges = []
    while True:
        open_ = alive & (best < beyond)  # others stay as they are: no merge brings another one nearer
        low = np.flatnonzero(open_ & (near[near] == every) & open_[near] & (every < near))  # rows are by id
        if not len(low):
            break
        high = near[low]
        both = size[low] + size[high]
        merges.append((ids[high], node[low], node[high], both, best[low]))
        node[low], size[low] = ids[high], both
        total[low] += total[high]
        beyond[low] = np.minimum(beyond[low], beyond[high])
        alive[high], touched[low] = False, True
        # Only those whose nearest one changed look again.
        changed = np.zeros(len(ids), bool)
        changed[low] = changed[high] = True
        again = np.flatnonzero(alive & (changed | (open_ & changed[near])))
        kept = np.flatnonzero(alive)
        centres = total[kept] / size[kept, None]
        places = np.searchsorted(kept, again)
        found, best[again] = _best(centres[places], size[again], centres, size[kept], kept, places)
        near[again] = np.where(found >= 0, found, again)
    wish = ~touched[:, None] & rows["low"].notna().to_numpy()[:, None]
    pair = np.where(wish, rows[["low", "high"]].fillna(-1).to_numpy(np.int64), ids[:, None])
    left = pd.DataFrame({"id": ids, "node": node, "weight": size, "low": pair[:, 0], "high": pair[:, 1],
                         "gap": rows["gap"].to_numpy(), **{s: total[:, i] for i, s in enumerate(sums)}})[alive]
    if not merges:
        return left.assign(left=pd.NA, right=pd.NA).astype({"left": "Int64", "right": "Int64"})
    done = pd.DataFrame(dict(zip(("node", "left", "right", "weight", "gap"), map(np.concatenate, zip(*merges)))))
    return pd.concat([left, done]).astype({c: "Int64" for c in ("id", "node", "weight", "low", "high", "left", "right")})


def _round(state: DataFrame, sums: Sequence[str], count: int) -> tuple[DataFrame, DataFrame, int]:
    """Merges of one round, the clusters after it and their number."""
    sums = list(sums)
    known = ["id", "node", "weight", *sums]
    figures = ", ".join(f"{s} double" for s in sums)
    # The size is one more axis, as small and large clusters have different reach.
    sample = state.filter(F.pmod(F.xxhash64("id"), F.lit(max(1, count // SAMPLE))) == 0).select("weight", *sums).toPandas()
    centres, weight = _centres(sample, sums)
    # Cells are few bytes and much work, so each gets a task and is not joined with others by its size.
    tasks = 1 if count <= ONE_CELL * CELL else -(-count // CELL)
    plan, _ = plan_cells(np.column_stack([centres, np.log2(weight)]), min(tasks, MOST_CELLS))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            centres, weight = _centres(batch.to_pandas(), sums)
            cell = pa.array(cells_of(plan, np.column_stack([centres, np.log2(weight)])))
            yield pa.RecordBatch.from_arrays([cell, *batch.columns], names=["cell", *known])

    def own(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("id")
        centres, weight = _centres(rows, sums)
        near, gap = _best(centres, weight, centres, weight, rows["id"].to_numpy(), np.arange(len(rows)))
        return rows.assign(near=near, gap=gap)

    schema = f"cell int, id long, node long, weight long, {figures}"
    found = materialize(state.select(*known).mapInArrow(place, schema).repartition(tasks, "cell").groupBy("cell").applyInPandas(
        own, schema + ", near long, gap double"), "ward-own")
    boxes = Boxes.of(found, sums)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pandas()
            centres, weight = _centres(rows, sums)
            home, far = rows["cell"].to_numpy(), rows["gap"].to_numpy() * REACH
            step = max(1, PAIRS // len(boxes.cells))
            for at in range(0, len(rows), step):
                part = slice(at, at + step)
                bound = _bounds(centres[part], weight[part], boxes)
                own = home[part, None] == boxes.cells[None]
                asked = (bound <= far[part, None]) & ~own
                rest = np.where(asked | own, np.inf, bound).min(1)
                # The own cell gets a row too: it says how near the cells that are not asked may be.
                i, j = np.nonzero(asked | own)
                asking = batch.slice(at, step).take(pa.array(i)).select(["id", "weight", *sums])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(boxes.cells[j].astype(np.int32)), *asking.columns, pa.array(far[part][i]),
                     pa.array(np.where(own[i, j], rest[i], -1.0))],
                    names=["target", "id", "weight", *sums, "far", "rest"])

    def answer(asking: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        if not len(asking):
            return pd.DataFrame(columns=["id", "near", "gap"], dtype=object)
        rows = rows.sort_values("id")
        own = asking["rest"].to_numpy() >= 0
        told, asking = asking[own], asking[~own]
        near, gap = _best(*_centres(asking, sums), *_centres(rows, sums), rows["id"].to_numpy(), within=asking["far"].to_numpy())
        return pd.concat([pd.DataFrame({"id": asking["id"], "near": near, "gap": gap}),
                          pd.DataFrame({"id": told["id"], "near": -1, "gap": told["rest"]})])

    def ends():
        return F.struct("gap", F.least("id", "near").alias("low"), F.greatest("id", "near").alias("high"))

    elsewhere = found.select("cell", "id", "weight", *sums, "gap").mapInArrow(
        ask, f"target int, id long, weight long, {figures}, far double, rest double").repartition(tasks, "target").groupBy("target").cogroup(
        found.select("cell", "id", "weight", *sums).repartition(tasks, "cell").groupBy("cell")).applyInPandas(answer, "id long, near long, gap double")
    answered = F.col("near") >= 0
    outside = elsewhere.groupBy("id").agg(
        F.min(F.when(answered, ends())).alias("out"), F.min(F.when(~answered, F.col("gap"))).alias("rest"))
    here = F.when(F.col("near") >= 0, ends())
    known_far = found.join(outside, "id", "left").select(
        "cell", *known, F.least("out.gap", "rest").alias("beyond"), F.col("near").alias("mate"), F.col("gap").alias("own"),
        F.least(here, "out").alias("best")).select("cell", *known, "beyond", "mate", "own", "best.*")
    merged_inside = materialize(known_far.repartition(tasks, "cell").groupBy("cell").applyInPandas(
        lambda rows: _merge_inside(rows, sums),
        f"id long, node long, weight long, low long, high long, gap double, {figures}, left long, right long"), "ward-inside")
    inside = merged_inside.filter("left is not null").select(
        "node", "left", "right", F.sqrt("gap").alias("height"), F.col("weight").alias("size"))
    nearest = merged_inside.filter("left is null").withColumn("best", F.struct("low", "high", "gap"))
    paired = materialize(nearest.groupBy("best.low", "best.high").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("id"), F.min_by("node", "id").alias("left"),
        F.max_by("node", "id").alias("right"), *[F.sum(c).alias(c) for c in ("weight", *sums)], F.min("best.gap").alias("gap")),
        "ward-round")
    merged = F.col("n") == 2  # both ends named the pair
    across = paired.filter(merged).select(
        F.col("high").alias("node"), "left", "right", F.sqrt("gap").alias("height"), F.col("weight").alias("size"))
    state = paired.select("id", F.when(merged, F.col("high")).otherwise(F.col("left")).alias("node"), "weight", *sums)
    return inside.unionByName(across), state, paired.count()


def _ward_pairs(points: np.ndarray, weights: np.ndarray) -> list[tuple[int, int, float]]:
    """Merges (slot, slot, height) by following chains of nearest neighbours.

    A merged cluster takes the second slot of the pair.
    """
    centre, weight = points.astype(float).copy(), weights.astype(float).copy()
    alive = np.ones(len(weight), dtype=bool)
    merges: list[tuple[int, int, float]] = []
    chain: list[int] = []
    while len(merges) < len(weight) - 1:
        if not chain:
            chain.append(int(np.flatnonzero(alive)[0]))
        tip = chain[-1]
        gap = ((centre - centre[tip]) ** 2).sum(axis=1) * _factor(weight, weight[tip])
        gap[~alive] = np.inf
        gap[tip] = np.inf
        nearest = int(gap.argmin())
        if len(chain) > 1 and gap[chain[-2]] <= gap[nearest]:
            nearest = chain[-2]
            del chain[-2:]
            merges.append((tip, nearest, float(np.sqrt(gap[nearest]))))
            both = weight[tip] + weight[nearest]
            centre[nearest] = (centre[tip] * weight[tip] + centre[nearest] * weight[nearest]) / both
            weight[nearest] = both
            alive[tip] = False
        else:
            chain.append(nearest)
    return merges


MERGES = "node long, left long, right long, height double, size long"


def _finish(rows: pd.DataFrame, sums: Sequence[str]) -> pd.DataFrame:
    """Merges of the last clusters: the absorbed cluster's id names a merge, as in the rounds."""
    centres, weight = _centres(rows, sums)
    ids, node, size = rows["id"].tolist(), rows["node"].tolist(), rows["weight"].tolist()
    out = []
    for a, b, height in _ward_pairs(centres, weight):
        low, high = sorted((a, b), key=lambda slot: ids[slot])
        out.append((ids[high], node[low], node[high], height, size[a] + size[b]))
        node[b], size[b], ids[b] = ids[high], size[a] + size[b], ids[low]
    return pd.DataFrame(out, columns=["node", "left", "right", "height", "size"])


def ward_merges(leaves: DataFrame, cut_height: float = CUT_HEIGHT) -> DataFrame:
    """Merge history: (step, left, right, merged, height, size, above_cut), lowest first.

    Leaves keep their numbers, the cluster of step s is (number of leaves + s), and
    ``left`` is the smaller of the two. ``leaves`` must come from ``ward_leaves`` and be
    stored. No rows for fewer than two leaves.
    """
    columns = [c for c in leaves.columns if c not in ("leaf", "weight")]
    sums = [f"s{i}" for i in range(len(columns))]
    # A cluster is named by its smallest leaf; its node by that leaf (below zero), or by the leaf name that its
    # merge took out of use.
    state = leaves.select(
        F.col("leaf").alias("id"), (-1 - F.col("leaf")).alias("node"), "weight",
        *[(F.col(c) * F.col("weight")).alias(s) for c, s in zip(columns, sums)])
    total = count = leaves.count()
    rounds = []
    while count > LAST_CELLS * CELL:
        merged, state, count = _round(state, sums, count)
        rounds.append(merged)
    rounds.append(state.groupBy(F.lit(0).alias("all")).applyInPandas(
        lambda pdf: _finish(pdf, sums), MERGES))
    merges = numbered(reduce(DataFrame.unionByName, rounds), ["height", "size", "node"], "step")
    merges = materialize(merges, "ward-steps")
    names = merges.select("node", (F.col("step") + total).alias("number"))

    def number(side: str) -> DataFrame:
        return names.select(F.col("node").alias(side), F.col("number").alias(f"{side}_number"))

    def numbered_side(side: str):
        return F.when(F.col(side) < 0, -1 - F.col(side)).otherwise(F.col(f"{side}_number"))

    left, right = numbered_side("left"), numbered_side("right")
    return merges.join(number("left"), "left", "left").join(number("right"), "right", "left").select(
        "step", F.least(left, right).alias("left"), F.greatest(left, right).alias("right"),
        (F.col("step") + total).alias("merged"), "height", "size", (F.col("height") > cut_height).alias("above_cut"))


def ward_labels(leaves: DataFrame, merges: DataFrame, k: int = 7) -> DataFrame:
    """Cluster of every leaf when the hierarchy is cut into ``k``: (leaf, seller_cluster).

    Clusters are numbered by their smallest leaf. ``leaves`` and ``merges`` are the
    stored results of ``ward_leaves`` and ``ward_merges``. Every node points to the
    cluster it was merged into, and pointers are doubled until none moves.
    """
    kept = max(leaves.count() - k, 0)
    low = merges.filter(F.col("step") < kept)
    parents = low.select(F.explode(F.array("left", "right")).alias("child"), F.col("merged").alias("top"))
    pointers, moved = materialize(parents, "ward-pointers"), True
    while moved:
        onward = pointers.select(F.col("child").alias("top"), F.col("top").alias("next"))
        pointers = materialize(pointers.join(onward, "top", "left").select(
            "child", F.coalesce("next", "top").alias("top"), F.col("next").isNotNull().alias("moved")), "ward-pointers")
        moved = not pointers.filter("moved").isEmpty()
    found = leaves.select("leaf").join(pointers.select(F.col("child").alias("leaf"), "top"), "leaf", "left").select(
        "leaf", F.coalesce("top", "leaf").alias("top"))
    clusters = found.groupBy("top").agg(F.min("leaf").alias("first"))  # k rows
    order = clusters.agg(F.sort_array(F.collect_list("first")).alias("order"))
    places = clusters.withColumn("order", order.scalar()).select(
        "top", (F.array_position("order", F.col("first")) - 1).cast("int").alias("seller_cluster"))
    return found.join(F.broadcast(places), "top").select("leaf", "seller_cluster")


def label_sellers(sellers: DataFrame, labels: DataFrame) -> DataFrame:
    """Sellers with the cluster of their leaf; every leaf has one."""
    return sellers.join(labels, "leaf")
