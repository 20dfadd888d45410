"""Toxicity by compression distance between two zstandard dictionaries.

Both dictionaries share the frequent words of ordinary text and are equally
long. One ends with further ordinary words, the other with the segments that
mark toxic text: the stretches of words whose five-character runs occur in far
more toxic than ordinary texts. A text is cut into windows of words; a window
that compresses shorter with the toxic dictionary gives a gain in bytes, at two
settings of the compressor. How many windows of a text reach each threshold of
gain, as a number and as a share, is calibrated to a probability on the labels.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import configure, keyed_texts, map_batches

MAX_LABELLED_ROWS = 12_000   # rows that fit dictionaries and calibration, at most
WINDOW_WORDS = 8
ORDINARY_BYTES = 65_536      # size of the shared part of the dictionaries
MAX_SEGMENTS = 2_000
RUN = 5                      # characters of a marking run
MIN_TOXIC_TEXTS, MIN_RATIO = 4, 20.0
SETTINGS = ((6, 1), (5, 3))  # least match and level: shorter matches are chance more often
GAINS = 9                    # thresholds of gain: 1, 2, ... bytes
_WORD = re.compile(r"[^\W\d_]{3,40}")
_SPACED = re.compile(r"[^\x20\x09-\x0D]+")


def _runs(words: set[str]) -> set[str]:
    spaced = (f" {w} " for w in words)
    return {w[i:i + RUN] for w in spaced for i in range(max(1, len(w) - RUN + 1))}


def _marked(word: str, marks: set[str]) -> list[str]:
    """The stretches of ``word`` covered by marking runs."""
    spaced = f" {word} "
    covered = np.zeros(len(spaced) + 1, bool)
    for i in range(len(spaced) - RUN + 1):
        if spaced[i:i + RUN] in marks:
            covered[i:i + RUN] = True
    edges = np.flatnonzero(np.diff(np.r_[False, covered].astype(int)))
    return [spaced[a:b] for a, b in zip(edges[::2], edges[1::2])]


def train_dictionaries(texts: list[str], toxic: np.ndarray) -> tuple[bytes, bytes]:
    """(ordinary, toxic) dictionary contents of equal length; equal texts count once."""
    seen: dict[str, bool] = {}
    for text, bad in zip(texts, toxic):
        seen.setdefault(text.lower(), bool(bad))
    counts = {False: Counter(), True: Counter()}
    words = {False: Counter(), True: Counter()}
    sizes = Counter(seen.values())
    for text, bad in seen.items():
        own = set(_WORD.findall(text))
        words[bad].update(own)
        counts[bad].update(_runs(own))
    marks = {run for run, n in counts[True].items() if n >= MIN_TOXIC_TEXTS
             and n / (sizes[True] + 1) > MIN_RATIO * (counts[False][run] + 0.5) / (sizes[False] + 1)}
    segments: Counter = Counter()
    for word, n in words[True].items():
        for part in _marked(word, marks):
            segments[part] += n
    ranked = sorted(segments.items(), key=lambda x: (-x[1], x[0]))
    toxic_end = "\n".join(part for part, n in reversed(ranked[:MAX_SEGMENTS]) if n >= 4).encode() + b"\n"
    common = [w.encode() for w, _ in sorted(words[False].items(), key=lambda x: (-x[1], x[0]))]
    shared, used, size = [], 0, 0
    while used < len(common) and size < ORDINARY_BYTES:
        shared.append(common[used])
        size += len(common[used]) + 1
        used += 1
    rest, at = b"", used
    while len(rest) < len(toxic_end) and at < len(common):
        rest += b" " + common[at] + b" \n"
        at += 1
    rest = rest[:len(toxic_end)].ljust(len(toxic_end), b"\n")
    start = b" " + b" ".join(reversed(shared)) + b" "
    return start + rest, start + toxic_end


def compressor(content: bytes, least_match: int, level: int) -> zstandard.ZstdCompressor:
    parameters = zstandard.ZstdCompressionParameters.from_level(
        level, min_match=least_match, window_log=18, hash_log=17, chain_log=17, write_content_size=False,
        write_checksum=False, write_dict_id=False)
    words = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(dict_data=words, compression_params=parameters)


class WindowGains:
    """How many windows of a text gain so many bytes, and the number of windows."""

    def __init__(self, ordinary: bytes, toxic: bytes):
        self.pairs = [(compressor(ordinary, *s).compress, compressor(toxic, *s).compress) for s in SETTINGS]

    def __call__(self, text: str | None) -> list[int]:
        """For each setting GAINS counts (gains of 1, 2, ... bytes, the last also of more), then the windows."""
        words = _SPACED.findall(text.lower()) if text else []
        windows = [f" {' '.join(words[i:i + WINDOW_WORDS])} ".encode() for i in range(0, len(words), WINDOW_WORDS)]
        out = []
        for ordinary, toxic in self.pairs:
            counts = [0] * GAINS
            for window in windows:
                gain = len(ordinary(window)) - len(toxic(window))
                if gain > 0:
                    counts[min(gain, GAINS) - 1] += 1
            out += counts
        return [*out, len(windows)]


def design(counts: np.ndarray) -> np.ndarray:
    """What the calibration sees: windows that reach each threshold, as yes or no, logarithm and share."""
    counts = counts.reshape(-1, len(SETTINGS) * GAINS + 1).astype(float)
    windows, parts = counts[:, -1:], [np.ones((len(counts), 1)), np.log1p(counts[:, -1:])]
    for k in range(len(SETTINGS)):
        reach = counts[:, k * GAINS:(k + 1) * GAINS][:, ::-1].cumsum(axis=1)[:, ::-1]
        parts += [reach > 0, np.log1p(reach), 10 * reach / np.maximum(windows, 1)]
    return np.hstack(parts)


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 2e-3, steps: int = 30) -> np.ndarray:
    """Logistic regression by Newton steps."""
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (p - y) / len(y) + ridge * w
        curve = (x * (p * (1 - p))[:, None]).T @ x / len(y) + ridge * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return w


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: bytes
    weights: np.ndarray

    def score(self, texts: list[str | None], gains: WindowGains) -> np.ndarray:
        counts = np.array([gains(t) for t in texts])
        return 1 / (1 + np.exp(-np.clip(design(counts) @ self.weights, -30, 30)))


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, bound: int) -> DataFrame:
    """(doc_id, text, label) of at most ``bound`` labelled rows, chosen by a hash of the id."""
    chosen = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
              .groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
              .orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id").limit(bound))
    # at most ``bound`` pairs of numbers
    return documents.select("doc_id", "text").filter("text is not null").join(F.broadcast(chosen), "doc_id")


def fit(documents: DataFrame, labels: DataFrame, bound: int = MAX_LABELLED_ROWS) -> ToxicityModel:
    """Fit on labelled rows (doc_id, toxic); their texts are the only ones the driver sees.

    Half of the sample makes the dictionaries, the other half the calibration, so
    that the latter meets unseen texts. Without rows of both kinds the score is
    the share of toxic labels, 0 if there are none.
    """
    rows = labelled_sample(documents, labels, "toxic", bound)
    rows = rows.select("label", "text").collect()
    texts, y = [r.text for r in rows], np.array([r.label for r in rows], float)
    half = np.arange(len(rows)) % 2 == 0
    if not len(y) or min(y[half].sum(), (1 - y[half]).sum(), y[~half].sum(), (1 - y[~half]).sum()) < 1:
        rate = float(np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6))
        weights = np.zeros(2 + 3 * GAINS * len(SETTINGS))
        weights[0] = np.log(rate / (1 - rate))
        return ToxicityModel(b"\n" * 16, b"\n" * 16, weights)
    ordinary, toxic = train_dictionaries([t for t, h in zip(texts, half) if h], y[half])
    gains = WindowGains(ordinary, toxic)
    counts = np.array([gains(t) for t, h in zip(texts, half) if not h])
    return ToxicityModel(ordinary, toxic, fit_logistic(design(counts), y[~half]))


def score_toxicity(df: DataFrame, model: ToxicityModel, threshold: float = 0.7,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted per row: probability of toxic text and whether it reaches ``threshold``.

    Null and empty texts have no window and get the score of zero gain. Windows
    cover the whole text. Repeated rows and a null id get a result each; other
    columns are not read.
    """
    configure(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model.ordinary, model.toxic, model.weights))
    held: dict[str, object] = {}

    def build(batch: pa.RecordBatch) -> dict:
        if not held:
            held["model"] = ToxicityModel(*shared.value)
            held["gains"] = WindowGains(*shared.value[:2])
        score = held["model"].score(batch.column(1).to_pylist(), held["gains"])
        return {"doc_id": batch.column(0), "score": score, "predicted": (score >= threshold).astype(np.int32)}

    return map_batches(keyed_texts(df, id_col, text_col), build, "doc_id long, score double, predicted int")
