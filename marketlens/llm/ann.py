"""Approximate nearest neighbours by a hash-prefix forest.

Rows are dealt into shards of bounded size, and each shard grows a forest over
its vectors: per tree every vector has a long string of hash bits (sides of
random hyperplanes), kept as a sorted array. A query descends all trees to its
longest matching prefixes, then ascends them together, a bit at a time, until
the prefix ranges hold a given share of the shard; what lies in the ranges is
compared exactly. The share, not a count, is fixed, so recall does not fall as
the table grows. Equal vectors are indexed once.

The query set meets the shards in blocks: a block of queries and a shard are one
task's input, whatever the size of the table.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.words import configure
from marketlens.session import materialize

TREES, BITS = 48, 32
SHARE = 0.6               # candidates over all trees, as a share of the shard's rows
SHARD_ROWS = 8_192        # vectors in a shard, about
QUERY_ROWS = 2_048        # queries in a block, about


class Forest:
    """Sorted hash strings of some vectors, one array per tree."""

    def __init__(self, vectors: np.ndarray, trees: int = TREES, seed: int = 7):
        planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * BITS))
        self.planes, self.trees = planes, trees
        self.vectors = vectors
        strings = self.strings(vectors)
        self.order = np.argsort(strings, axis=1, kind="stable")
        self.sorted = np.take_along_axis(strings, self.order, axis=1)

    def strings(self, vectors: np.ndarray) -> np.ndarray:
        """(tree, vector): hash strings as unsigned numbers, first bit highest."""
        sides = (vectors @ self.planes > 0).reshape(len(vectors), self.trees, BITS)
        weights = np.uint64(1) << np.arange(BITS - 1, -1, -1, dtype=np.uint64)
        return np.ascontiguousarray((sides * weights).sum(axis=2, dtype=np.uint64).T)

    def candidates(self, queries: np.ndarray, wanted: float):
        """For each query, a mask of the vectors in its prefix ranges."""
        own = self.strings(queries)
        n = self.sorted.shape[1]
        low = np.zeros((self.trees, len(queries)), np.int64)
        high = np.full((self.trees, len(queries)), n, np.int64)
        open_ = np.ones(len(queries), bool)
        ranges = (low.copy(), high.copy())
        for depth in range(BITS, -1, -1):  # the deepest ranges first, then up in all trees at once
            todo = np.flatnonzero(open_)
            if not len(todo):
                break
            shift = np.uint64(BITS - depth)
            for t in range(self.trees):
                prefix = own[t, todo] >> shift
                low[t, todo] = np.searchsorted(self.sorted[t], prefix << shift, "left")
                high[t, todo] = np.searchsorted(self.sorted[t], (prefix + np.uint64(1)) << shift, "left")
            enough = todo[((high - low)[:, todo].sum(axis=0) >= wanted) | (depth == 0)]
            ranges[0][:, enough], ranges[1][:, enough] = low[:, enough], high[:, enough]
            open_[enough] = False
        for i in range(len(queries)):
            mask = np.zeros(n, bool)
            for t in range(self.trees):
                mask[self.order[t, ranges[0][t, i]:ranges[1][t, i]]] = True
            yield mask


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = pa.concat_arrays([c.flatten() for c in column.chunks]) if column.num_chunks else pa.array([], pa.float64())
    return flat.to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def nearest(df: DataFrame, is_query: str, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            trees: int = TREES, share: float = SHARE) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of each row that satisfies ``is_query``.

    ``is_query`` is SQL over ``vec_id``. Nearness is the cosine in double precision;
    ties go to the smaller id. A row is no neighbour of itself, equal vectors of
    other ids are. Null vectors, empty and zero ones, those with null or
    non-finite components, and rows without id take no part, nor do vectors of
    another dimension as neighbours. Repeated rows count once. Other columns are not read.
    """
    configure(df.sparkSession)
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"),
                     F.col(f"`{vector_col}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).filter(
        finite & F.exists("v", lambda x: x != 0)).withColumn("v", F.transform("v", lambda x: x + 0.0))
    rows = rows.withColumn("a", F.xxhash64("v")).withColumn("b", F.xxhash64(F.lit(7), F.col("v")))
    ids = materialize(rows.select("vec_id", "a", "b").distinct(), "vector-ids")
    # an equal vector can be among the k nearest only by one of its k + 1 smallest ids
    first = ids.withColumn("place", F.row_number().over(Window.partitionBy("a", "b").orderBy("vec_id"))).filter(
        F.col("place") <= k + 1)
    classes = first.groupBy("a", "b").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    vectors = materialize(
        rows.join(classes.select(F.col("ids")[0].alias("vec_id"), "ids"), "vec_id")
        .select(F.col("vec_id").alias("rep"), "ids", "v", F.size("v").alias("d")).dropDuplicates(["rep"]), "vectors")
    asked = ids.filter(F.expr(is_query))
    query_ids = asked.join(classes, ["a", "b"]).select(F.col("vec_id").alias("query_id"), F.col("ids")[0].alias("q"))
    query_ids = materialize(query_ids, "query-ids")
    queries = materialize(vectors.join(query_ids.select(F.col("q").alias("rep")).distinct(), "rep", "left_semi"), "queries")
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // QUERY_ROWS))

    def dealt(x: DataFrame, own: str, n: int, other: str, m: int) -> DataFrame:
        return (x.withColumn(own, F.pmod(F.xxhash64("rep"), F.lit(n)).cast("int"))
                .withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(m - 1)))))

    index = dealt(vectors, "shard", shards, "block", blocks)
    sent = dealt(queries.drop("ids"), "block", blocks, "shard", shards)

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {"q": [], "rep": [], "score": []}
        if len(left) and len(right):
            order = np.argsort(left["rep"].to_numpy())
            reps, x = left["rep"].to_numpy()[order], _matrix(left["v"])[order]
            asked_for, y = right["rep"].to_numpy(), _matrix(right["v"])
            x_norm, y_norm = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
            forest = Forest(x / x_norm[:, None], trees)
            for i, mask in enumerate(forest.candidates(y / y_norm[:, None], share * len(x))):
                at = np.flatnonzero(mask)
                score = np.einsum("ij,j->i", x[at], y[i]) / (x_norm[at] * y_norm[i])
                best = np.argsort(-score, kind="stable")[:k + 1]  # ids ascend, so ties keep the smaller
                out["q"] += [asked_for[i]] * len(best)
                out["rep"] += reps[at[best]].tolist()
                out["score"] += score[best].tolist()
        return pa.table({"q": pa.array(out["q"], pa.int64()), "rep": pa.array(out["rep"], pa.int64()),
                         "score": pa.array(out["score"], pa.float64())})

    keys = ["d", "shard", "block"]
    found = index.groupBy(*keys).cogroup(sent.groupBy(*keys)).applyInArrow(search, "q long, rep long, score double")
    by_class = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    found = found.withColumn("place", F.row_number().over(by_class)).filter(F.col("place") <= k + 1)
    members = found.join(vectors.select("rep", "ids"), "rep").select("q", "score", F.explode("ids").alias("vec_id"))
    by_id = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    members = members.withColumn("place", F.row_number().over(by_id)).filter(F.col("place") <= k + 1).drop("place")
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (query_ids.join(members, "q").filter("query_id != vec_id")
            .withColumn("rank", F.row_number().over(by_query)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
