"""Topic model by batch variational Bayes over bags of words.

Documents lie in blocks of bounded size, laid out once, each packed into one row that no
round sorts or numbers again. In every round the word weights
of a block's own terms come to it (a row per block and term, not per occurrence), the
block settles its documents' topic weights, and returns sums per term; sums of all
blocks are the next word weights. Neither the vocabulary nor the documents pass through
the driver. The evidence bound rises from round to round and says when to stop.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.session import materialize

BLOCK_ROWS = 500_000    # (document, term) rows of a block, about
CHUNK_ROWS = 1 << 17    # of these, so many are settled together, about
ROUNDS, RISE = 20, 1e-4  # at most; stop when the bound rises by less, relatively
STEPS, SETTLED = 100, 1e-3  # of a document's weights; done when they change less, on average
TINY = 1e-100


def digamma(x: np.ndarray) -> np.ndarray:
    """Derivative of the logarithm of the gamma function, for x > 0."""
    x, out = np.array(x, float), np.zeros(np.shape(x))
    low = x < 10
    small = x[low]
    out[low] = -sum(1 / (small + i) for i in range(10))
    x[low] += 10
    y = 1 / (x * x)
    return out + np.log(x) - 0.5 / x - y * (1 / 12 - y * (1 / 120 - y * (1 / 252 - y * (1 / 240 - y / 132))))


def log_gamma(x: np.ndarray) -> np.ndarray:
    x, out = np.array(x, float), np.zeros(np.shape(x))
    for _ in range(12):
        low = x < 12
        out[low] -= np.log(x[low])
        x[low] += 1
    y = 1 / (x * x)
    return out + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + (1 / 12 - y * (1 / 360 - y * (1 / 1260 - y / 1680))) / x


def expected_logs(weights: np.ndarray) -> np.ndarray:
    """Expected logarithms of proportions, a row per document."""
    return digamma(weights) - digamma(weights.sum(1))[:, None]


def settle(doc: np.ndarray, count: np.ndarray, words: np.ndarray, prior: float, steps: int = STEPS) -> np.ndarray:
    """Topic weights of documents 0, 1..., given ``words``: each row's word weight per topic; rows by document.

    Documents do not depend on each other, so they are settled a few at a time.
    """
    first = np.flatnonzero(np.diff(doc, prepend=-1))
    edges = np.append(first, len(doc))
    weights = np.ones((len(first), words.shape[1]))
    cuts = np.unique(np.searchsorted(first, np.arange(0, len(doc), CHUNK_ROWS)))
    for low, high in zip(cuts, np.append(cuts[1:], len(first))):
        rows = slice(edges[low], edges[high])
        weights[low:high] = _settle(np.diff(edges[low:high + 1]), count[rows], list(words[rows].T.copy()), prior, steps)
    return weights


def _settle(sizes: np.ndarray, count: np.ndarray, words: list[np.ndarray], prior: float, steps: int) -> np.ndarray:
    """``settle`` of documents with so many rows each, a column of ``words`` per topic."""
    weights = np.ones((len(sizes), len(words)))
    active, moving = np.arange(len(sizes)), np.ones(len(sizes), bool)
    first, place = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    for _ in range(steps):
        share = np.exp(expected_logs(weights[active]))
        normal = np.full(len(count), TINY)
        for column, own in zip(share.T, words):
            normal += column[place] * own
        ratio = count / normal
        new = prior + share * np.column_stack([np.add.reduceat(ratio * own, first) for own in words])
        still = moving & (np.abs(new - weights[active]).mean(1) > SETTLED)
        weights[active[moving]] = new[moving]
        moving = still
        if not moving.any():
            break
        if sizes[moving].sum() < 0.8 * len(count):  # those at rest are passed over until they are worth leaving out
            kept = moving[place]
            count, words = count[kept], [own[kept] for own in words]
            sizes, active, moving = sizes[moving], active[moving], moving[moving]
            first, place = np.cumsum(sizes) - sizes, np.repeat(np.arange(len(sizes)), sizes)
    return weights


@dataclass(frozen=True)
class TopicModel:
    """Word weights (term_id, w0, w1...), their totals per topic, and the bound after each round."""

    words: DataFrame
    totals: list[float]
    prior: float
    bounds: list[float]

    @property
    def topics(self) -> int:
        return len(self.totals)


def _columns(topics: int) -> list[str]:
    return [f"w{i}" for i in range(topics)]


def _totals(words: DataFrame, topics: int) -> list[float]:
    return list(words.agg(*[F.sum(c) for c in _columns(topics)]).first())


@dataclass(frozen=True)
class Blocks:
    """Bags by block of documents: a packed row per block, and the terms of every block with their place in it."""

    packed: DataFrame
    terms: DataFrame
    count: int

    def laid_out(self) -> DataFrame:
        return self.packed.repartition(self.count, "block").persist()


def in_blocks(bags: DataFrame) -> Blocks:
    """Stored blocks of bags (document, term_id, count); ``bags`` is read twice."""
    spark = bags.sparkSession
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-bags.count() // BLOCK_ROWS))
    block = F.pmod(F.xxhash64("document"), F.lit(blocks)).cast("int")

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("document", "ascending"), ("term_id", "ascending")])
        ids, nulls = rows["document"].fill_null(0).to_numpy(), rows["document"].is_null().to_numpy()
        first = np.flatnonzero((np.diff(ids, prepend=ids[:1] - 1) != 0) | (np.diff(nulls.astype(np.int8), prepend=-1) != 0))
        terms, places = np.unique(rows["term_id"].to_numpy(), return_inverse=True)
        return pa.table({
            "block": pa.array([key[0].as_py()], pa.int32()),
            "documents": pa.array([rows["document"].take(pa.array(first)).to_pylist()], pa.list_(pa.int64())),
            "sizes": pa.array([np.diff(first, append=len(ids)).astype(np.int64).tobytes()], pa.binary()),
            "places": pa.array([places.astype(np.int32).tobytes()], pa.binary()),
            "counts": pa.array([rows["count"].to_numpy().astype(np.int64).tobytes()], pa.binary()),
            "terms": pa.array([terms], pa.list_(pa.int64()))})

    packed = materialize(bags.select("document", "term_id", "count").withColumn("block", block).repartition(blocks, "block").groupBy(
        "block").applyInArrow(pack, "block int, documents array<long>, sizes binary, places binary, counts binary, terms array<long>"),
        "topic-blocks")
    terms = materialize(packed.select("block", F.posexplode("terms").alias("place", "term_id")), "block-terms")
    return Blocks(packed.drop("terms"), terms, blocks)


def _block_rows(packed: pa.Table, words: pa.Table, topics: int, totals: list[float]):
    """(document number, count, term's place, term numbers, proportions per term and topic) of a block."""
    sizes = np.frombuffer(packed["sizes"][0].as_buffer(), np.int64)
    count = np.frombuffer(packed["counts"][0].as_buffer(), np.int64).astype(float)
    term = np.frombuffer(packed["places"][0].as_buffer(), np.int32)
    order = np.argsort(words["place"].to_numpy())
    weights = np.column_stack([words[c].to_numpy() for c in _columns(topics)])[order]
    known = np.exp(digamma(weights) - digamma(np.array(totals))[None])
    return np.repeat(np.arange(len(sizes)), sizes), count, term, words["term_id"].to_numpy()[order], known


def fit_topics(bags: DataFrame | Blocks, topics: int, seed: int = 42, rounds: int = ROUNDS) -> TopicModel:
    """Topic model of all bags (document, term_id, count), from seeded weights near one.

    Priors are symmetric: 1 / topics for documents and for words. Documents without
    terms take no part. ``bags`` is read twice: pass a stored table, or its blocks.
    """
    prior = 1.0 / topics
    columns = _columns(topics)
    blocks = bags if isinstance(bags, Blocks) else in_blocks(bags)
    laid_out = blocks.laid_out()
    # Uniform with a deviation of 0.1, by hash: the same however the terms lie.
    draw = [1 + 0.35 * (F.pmod(F.xxhash64("term_id", F.lit(seed), F.lit(i)), F.lit(1 << 20)) / float(1 << 20) - 0.5)
            for i in range(topics)]
    words = materialize(blocks.terms.select("term_id").distinct().withColumns(dict(zip(columns, draw))), "topic-words")
    totals = _totals(words, topics)
    bounds: list[float] = []
    try:
        for _ in range(rounds):

            def expect(packed: pa.Table, own: pa.Table) -> pa.Table:
                doc, count, term, ids, known = _block_rows(packed, own, topics, totals)
                seen = known[term]
                weights = settle(doc, count, seen, prior)
                logs = expected_logs(weights)
                share = np.exp(logs)
                normal = np.full(len(count), TINY)
                for i in range(topics):
                    normal += share[doc, i] * seen[:, i]
                ratio = count / normal
                sums = [np.bincount(term, ratio * share[doc, i], minlength=len(ids)) * known[:, i] for i in range(topics)]
                # The documents' part of the bound.
                bound = (count * np.log(normal)).sum() + ((prior - weights) * logs + log_gamma(weights)).sum()
                bound += len(weights) * (log_gamma(np.array([prior * topics]))[0] - topics * log_gamma(np.array([prior]))[0])
                bound -= log_gamma(weights.sum(1)).sum()
                every = np.zeros(len(ids))
                every[:1] = bound
                return pa.table([pa.array(ids), *map(pa.array, sums), pa.array(every)], names=["term_id", *columns, "bound"])

            schema = "term_id long, " + ", ".join(f"{c} double" for c in columns) + ", bound double"
            known = blocks.terms.join(words, "term_id").select("block", "place", "term_id", *columns)
            answered = laid_out.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(expect, schema)
            added = materialize(answered.groupBy("term_id").agg(
                *[(F.sum(c) + prior).alias(c) for c in columns], F.sum("bound").alias("bound")), "topic-words")
            bound, *following = added.agg(F.sum("bound"), *[F.sum(c) for c in columns]).first()
            bounds.append(bound + _words_bound(words, topics, totals, prior))
            if len(bounds) > 1 and bounds[-1] - bounds[-2] < RISE * abs(bounds[-2]):
                break
            words, totals = added.drop("bound"), following
    finally:
        laid_out.unpersist()
    return TopicModel(words, totals, prior, bounds)


def _words_bound(words: DataFrame, topics: int, totals: list[float], prior: float) -> float:
    """The word weights' part of the bound."""
    columns = _columns(topics)

    def add(batches):
        for batch in batches:
            weights = batch[columns].to_numpy(float)
            logs = digamma(weights) - digamma(np.array(totals))[None]
            yield pd.DataFrame({"n": [float(len(weights))], "bound": [((prior - weights) * logs + log_gamma(weights)).sum()]})

    row = words.mapInPandas(add, "n double, bound double").agg(F.sum("n").alias("n"), F.sum("bound").alias("bound")).first()
    terms = row.n
    return float(row.bound + topics * (log_gamma(np.array([prior * terms]))[0] - terms * log_gamma(np.array([prior]))[0])
                 - log_gamma(np.array(totals)).sum())


def document_weights(bags: DataFrame | Blocks, model: TopicModel, steps: int = STEPS) -> DataFrame:
    """(document, topic_weights) of the documents with terms: shares of the topics, from 1 on."""
    topics, totals, prior = model.topics, model.totals, model.prior
    blocks = bags if isinstance(bags, Blocks) else in_blocks(bags)

    def answer(packed: pa.Table, own: pa.Table) -> pa.Table:
        doc, count, term, _, known = _block_rows(packed, own, topics, totals)
        weights = settle(doc, count, known[term], prior, steps)
        shares = weights / weights.sum(1)[:, None]
        return pa.table({"document": packed["documents"].combine_chunks().flatten(),
                         "topic_weights": pa.array(list(shares), pa.list_(pa.float64()))})

    known = blocks.terms.join(model.words, "term_id").select("block", "place", "term_id", *_columns(topics))
    laid_out = blocks.packed.repartition(blocks.count, "block")
    return materialize(laid_out.groupBy("block").cogroup(known.groupBy("block")).applyInArrow(
        answer, "document long, topic_weights array<double>"), "topic-weights")


def top_words(model: TopicModel, index: DataFrame, count: int = 10) -> DataFrame:
    """Heaviest words per topic: (topic, position, term, weight), topics from 1; weights are shares of the topic."""
    columns = _columns(model.topics)
    shares = [F.struct(F.lit(i + 1).alias("topic"), (F.col(c) / total).alias("weight"))
              for i, (c, total) in enumerate(zip(columns, model.totals))]
    tall = model.words.select("term_id", F.explode(F.array(*shares)).alias("at")).select("term_id", "at.*")
    place = F.row_number().over(Window.partitionBy("topic").orderBy(F.desc("weight"), "term_id"))
    heavy = tall.withColumn("position", place).filter(F.col("position") <= count)
    return heavy.join(index.select("term_id", "term"), "term_id").select("topic", "position", "term", "weight").orderBy("topic", "position")
