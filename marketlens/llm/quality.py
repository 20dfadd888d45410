"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from the bytes of whole texts. Trees are grown on binned
statistics, one histogram of gradients per node and bin, and kept as flat arrays
of complete binary trees, which a batch of rows walks down together.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.toxicity import labelled_sample
from marketlens.llm.words import Words, blocks, configure, keyed_texts, map_batches, words

MAX_LABELLED_ROWS = 20_000  # rows that fit the trees, at most
BINS, DEPTH, TREES, RATE = 32, 4, 60, 0.2
RIDGE, MIN_WEIGHT = 1.0, 1.0

_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789",
    "stop": b".,;:?", "bang": b"!", "bar": b"|", "mark": b"#$%&*+<=>@^_~\\/[]{}", "quote": b"\"'()-",
    "line": b"\n", "blank": b" \t", "beyond": bytes(range(128, 256)),
}
FEATURES = [f"share_{c}" for c in _CLASSES] + [
    "bytes", "words", "word_bytes", "word_bytes_spread", "distinct_words", "top_word", "repeated_word",
    "distinct_pairs", "end_mark", "lines", "line_words"]
_CLASS_OF = np.full(256, len(_CLASSES), np.uint8)
for _k, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _k
_MARK = np.isin(_CLASS_OF, [list(_CLASSES).index(c) for c in ("bang", "bar", "mark")])


def _sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.r_[0, np.cumsum(values)]
    return (total[bounds[1:]] - total[bounds[:-1]]).astype(float)


def statistics(offsets: np.ndarray, found: Words) -> np.ndarray:
    """One row of FEATURES per text of a block."""
    n = len(offsets) - 1
    size = np.diff(offsets).astype(float)
    doc_of_byte = np.repeat(np.arange(n), np.diff(offsets))
    kinds = len(_CLASSES) + 1
    shares = np.bincount(doc_of_byte * kinds + _CLASS_OF[found.data], minlength=n * kinds).reshape(n, kinds)
    count = np.diff(found.bounds).astype(float)
    some, any_word = np.maximum(size, 1), np.maximum(count, 1)
    length = found.end - found.start
    mean = _sums(length, found.bounds) / any_word
    spread = np.sqrt(np.maximum(_sums(length ** 2, found.bounds) / any_word - mean ** 2, 0))
    hashes = found.hashes()
    repeated = np.r_[False, hashes[1:] == hashes[:-1]]
    repeated[found.bounds[:-1][found.bounds[:-1] < len(hashes)]] = False
    marked = _MARK[found.data[found.end - 1]] if len(length) else np.zeros(0, bool)
    distinct, top, pairs = np.zeros(n), np.zeros(n), np.zeros(n)
    for i in range(n):
        own = hashes[found.bounds[i]:found.bounds[i + 1]]
        if len(own):
            _, times = np.unique(own, return_counts=True)
            distinct[i], top[i] = len(times), times.max()
            pairs[i] = len(np.unique(own[1:] * np.uint64(3) + own[:-1]))
    lines = shares[:, list(_CLASSES).index("line")] + 1.0
    return np.column_stack([
        shares[:, :-1] / some[:, None], np.log1p(size), np.log1p(count), mean, spread, distinct / any_word,
        top / any_word, _sums(repeated, found.bounds) / any_word, pairs / np.maximum(count - 1, 1),
        _sums(marked, found.bounds) / any_word, np.log(lines), np.log1p(count / lines)])


def features(texts: pa.Array) -> np.ndarray:
    parts = [statistics(b.offsets, words(b)) for b in blocks(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


@dataclass
class Forest:
    """Complete binary trees: node i has children 2i+1 and 2i+2; a row goes right above the threshold."""

    feature: np.ndarray
    threshold: np.ndarray
    leaf: np.ndarray
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        if not len(self.leaf):
            return np.full(len(x), self.base)
        trees, rows = np.arange(len(self.leaf))[None, :], np.arange(len(x))[:, None]
        node = np.zeros((len(x), len(self.leaf)), np.int64)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (x[rows, self.feature[trees, node]] > self.threshold[trees, node])
        return self.base + self.leaf[trees, node - (2 ** DEPTH - 1)].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Boost log-loss trees on quantile bins of ``x``; a node without a useful split passes all rows left."""
    inner = 2 ** DEPTH - 1
    rate = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
    base = float(np.log(rate / (1 - rate)))
    forest = Forest(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    if len(y) < 2 or y.min() == y.max():
        return forest
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower"))
             for f in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, f], "left") for f, e in enumerate(edges)])
    margin, parts = np.full(len(y), base), []
    for _ in range(TREES):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first, width = 2 ** level - 1, 2 ** level
            best = np.full(width, 1e-9)
            cut = np.full(width, BINS)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cell = (node - first) * BINS + binned[:, f]
                gs = np.bincount(cell, g, width * BINS).reshape(width, BINS).cumsum(axis=1)
                hs = np.bincount(cell, h, width * BINS).reshape(width, BINS).cumsum(axis=1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs ** 2 / (hs + RIDGE) + (gt - gs) ** 2 / (ht - hs + RIDGE) - gt ** 2 / (ht + RIDGE)
                gain[(hs < MIN_WEIGHT) | (ht - hs < MIN_WEIGHT)] = 0
                at = gain[:, :len(e)].argmax(axis=1)
                better = np.flatnonzero(gain[np.arange(width), at] > best)
                best[better] = gain[better, at[better]]
                feature[first + better], cut[better] = f, at[better]
                threshold[first + better] = e[at[better]]
            own = node - first
            node = 2 * node + 1 + (binned[np.arange(len(y)), feature[node]] > cut[own])
        own = node - inner
        gs, hs = np.bincount(own, g, inner + 1), np.bincount(own, h, inner + 1)
        leaf = -RATE * gs / (hs + RIDGE)
        margin = margin + leaf[own]
        parts.append((feature, threshold, leaf))
    return Forest(*[np.stack(a) for a in zip(*parts)], base)


def fit(documents: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED_ROWS) -> Forest:
    """Fit on at most ``bound`` labelled rows (doc_id, quality).

    Statistics are computed where the texts are; the driver gets one row of
    numbers per labelled text. Without labels every score is 0.5, with one kind
    of label it is close to that kind.
    """
    sample = labelled_sample(documents, labels, "quality", bound)

    def build(batch: pa.RecordBatch) -> dict:
        return {"label": batch.column(0), "x": list(features(batch.column(1)))}

    rows = map_batches(sample.select("label", "text"), build, "label int, x array<double>").collect()
    x = np.array([r.x for r in rows], float).reshape(-1, len(FEATURES))
    return grow(x, np.array([r.label for r in rows], float))


def score_quality(df: DataFrame, forest: Forest, threshold: float = 0.5,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted per row: probability of label 1 and whether it reaches ``threshold``.

    Null reads as the empty text, whose statistics are zero. Repeated rows and a
    null id get a result each; other columns are not read.
    """
    configure(df.sparkSession)

    def build(batch: pa.RecordBatch) -> dict:
        score = forest.score(features(batch.column(1)))
        return {"doc_id": batch.column(0), "score": score, "predicted": (score >= threshold).astype(np.int32)}

    return map_batches(keyed_texts(df, id_col, text_col), build, "doc_id long, score double, predicted int")
