"""Removal of repeated passages, found by recompression.

A text's words are compressed in rounds. A run round names each maximal run of
one symbol; each pair round deals all symbols into left and right ones and names
every adjacent (left, right) pair. A name is a hash of what it stands for, so all
tasks give equal content equal names, and the rounds need no exchange.

Whether a symbol arises depends only on the words it stands for and a few next
to them, its context. A window of W words holds every symbol whose context lies
within it, wherever the window occurs. Its anchor is the longest of these
symbols (ties: the larger name), so equal windows have equal anchors, and a
sliding window keeps its anchor for a while. One exchange over the distinct
anchors of each text shows which occur in several texts. Only windows at such
anchors are then compared, by a 128-bit hash of their words.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import blocks, configure, keyed_texts, map_batches, mix, windows, words
from marketlens.session import materialize

WINDOW = 13
PAIR_ROUNDS = 4
_LENGTH_BITS = np.uint64(60)


def _side(names: np.ndarray, turn: int) -> np.ndarray:
    """Whether a symbol is a left one in this round."""
    return (mix(names + np.uint64(0x1000 + turn)) >> np.uint64(63)).astype(bool)


def symbols(hashes: np.ndarray, text_of: np.ndarray, window: int):
    """(name, first word, last word, context start, context end) of each level.

    Contexts reach beyond the text at its ends: there a window elsewhere may have
    a neighbour. Words of different texts never pair and end each other's runs.
    """
    n = len(hashes)
    at = np.arange(n)
    edge_left = np.r_[True, text_of[1:] != text_of[:-1]] if n else np.zeros(0, bool)
    edge_right = np.r_[text_of[1:] != text_of[:-1], True] if n else np.zeros(0, bool)
    far = np.int64(4 * window)
    yield hashes, at, at, at, at
    # runs: a run ends where the next word differs, so it depends on both neighbours
    first = np.flatnonzero(edge_left | np.r_[True, hashes[1:] != hashes[:-1]])
    last = np.r_[first[1:] - 1, n - 1][:len(first)] if n else first
    length = last - first + 1
    name = np.where(length > 1, mix(hashes[first] + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)),
                    hashes[first])
    low = np.where(edge_left[first], first - far, first - 1)
    high = np.where(edge_right[last], last + far, last + 1)
    yield name, first, last, low, high
    text = text_of[first]
    for turn in range(PAIR_ROUNDS):
        m = len(name)
        if m < 2:
            return
        left = _side(name, turn)
        joined = left[:-1] & ~left[1:] & (text[1:] == text[:-1])
        opens, closes = np.r_[joined, False], np.r_[False, joined]
        single = ~opens & ~closes
        # a left symbol stays single because of its right neighbour, a right one because of its left
        to_right, to_left = single & left, single & ~left
        ends = np.r_[text[1:] != text[:-1], True]
        begins = np.r_[True, text[1:] != text[:-1]]
        next_high = np.where(ends, high + far, np.r_[high[1:], 0])
        back_low = np.where(begins, low - far, np.r_[0, low[:-1]])
        low_one = np.where(to_left, np.minimum(low, back_low), low)
        high_one = np.where(to_right, np.maximum(high, next_high), high)
        keep = ~closes
        after = np.minimum(np.arange(m) + opens, m - 1)[keep]
        pair = opens[keep]
        name = np.where(pair, mix(mix(name[keep]) + name[after]), name[keep])
        low = np.where(pair, np.minimum(low[keep], low[after]), low_one[keep])
        high = np.where(pair, np.maximum(high[keep], high[after]), high_one[keep])
        first, last, text = first[keep], last[after], text[keep]
        yield name, first, last, low, high


def anchors(hashes: np.ndarray, text_of: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """(start word, anchor) of every window of ``window`` words within one text."""
    n = len(hashes)
    if n < window:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    best = [np.zeros(n, np.uint64) for _ in range(window)]  # by context width, at the context's start
    for name, first, last, low, high in symbols(hashes, text_of, window):
        width = high - low
        fits = np.flatnonzero(width < window)
        size = np.minimum(last - first + 1, 15)[fits].astype(np.uint64)
        score = size << _LENGTH_BITS | name[fits] >> np.uint64(4)
        width, start = width[fits], low[fits]
        for w in np.unique(width):
            own = width == w
            np.maximum.at(best[w], start[own], score[own])
    top = best[0]
    for w in range(1, window):
        top = np.maximum(np.maximum(top[:-1], top[1:]), best[w][:n - w])
    start = np.flatnonzero(text_of[:n - window + 1] == text_of[window - 1:])
    return start, top[start]


def _first_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of equal rows starts, in sorted columns."""
    return np.r_[True, np.any([c[1:] != c[:-1] for c in columns], axis=0)] if len(columns[0]) else np.zeros(0, bool)


def anchor_rows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(settled, key, multi, class_a) from (class_a, text): the distinct anchors of each text.

    An anchor that several texts of one block have is settled for them at once;
    one row that says so stands for all of them in the exchange.
    """

    def build(batch: pa.RecordBatch) -> dict:
        classes = batch.column(0).to_numpy()
        out = [np.zeros(0, np.int64)] * 4
        for block in blocks(batch.column(1)):
            found = words(block)
            start, anchor = anchors(found.hashes(), found.doc, window)
            own = classes[block.first + found.doc[start]]
            order = np.lexsort((own, anchor))
            key, own = anchor[order].view(np.int64), own[order]
            fresh = _first_of_runs(key, own)
            key, own = key[fresh], own[fresh]
            run = np.cumsum(_first_of_runs(key)) - 1
            several = np.bincount(run)[run] > 1 if len(run) else np.zeros(0, bool)
            lead = several & _first_of_runs(key)
            rows = [np.r_[several.astype(np.int64), np.zeros(lead.sum(), np.int64)], np.r_[key, key[lead]],
                    np.r_[np.zeros(len(key), np.int64), np.ones(lead.sum(), np.int64)], np.r_[own, own[lead]]]
            out = [np.r_[x, y] for x, y in zip(out, rows)]
        return dict(zip(("settled", "key", "multi", "class_a"), out))

    return map_batches(texts, build, "settled long, key long, multi long, class_a long")


def shared_anchors(rows: DataFrame) -> DataFrame:
    """(class_a, key): anchors that occur in several texts; one row is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple[int, int] | None = None   # key and class of the last row
        waiting: tuple[int, int] | None = None  # a key's first text, until another one shows up
        for batch in batches:
            settled, key, multi, own = (c.to_numpy() for c in batch.columns)
            take = settled == 1
            open_rows = np.flatnonzero(~take)
            k, m, c = key[open_rows], multi[open_rows], own[open_rows]
            extra = []
            if len(k):
                fresh = _first_of_runs(k)
                fresh[0] = before is None or before[0] != k[0]
                run_of = np.cumsum(fresh)              # 0 continues the run of the last batch
                flags = np.zeros(run_of[-1] + 1, bool)
                flags[run_of[m == 1]] = True
                changes = ~fresh & np.r_[before is not None and before[1] != c[0], c[1:] != c[:-1]]
                flags[run_of[changes]] = True
                if before is not None and waiting is None and not fresh[0]:
                    flags[0] = True                    # the run had several texts before
                if waiting is not None and flags[0]:
                    extra.append(waiting)
                distinct = np.r_[before is None or (before != (k[0], c[0])), (k[1:] != k[:-1]) | (c[1:] != c[:-1])]
                take[open_rows] = flags[run_of] & distinct & (m == 0)
                before = (int(k[-1]), int(c[-1]))
                if not flags[run_of[-1]]:
                    waiting = before
                else:
                    waiting = None
            classes, keys = own[take], key[take]
            if extra:
                classes, keys = np.r_[classes, extra[0][1]], np.r_[keys, extra[0][0]]
            yield pa.RecordBatch.from_arrays([pa.array(classes), pa.array(keys)], names=["class_a", "key"])

    place = F.when(F.col("settled") == 1, F.xxhash64("class_a")).otherwise(F.xxhash64("key"))
    return (rows.repartition(place)
            .sortWithinPartitions("settled", "key", F.desc("multi"), "class_a")
            .mapInArrow(run, "class_a long, key long").distinct())


def window_rows(texts: DataFrame, window: int = WINDOW) -> DataFrame:
    """(settled, a, b, doc_id, at) from (doc_id, keys, text): windows at shared anchors.

    Of equal windows in one block only the one of the smallest id is left open; the
    others are settled as repeats.
    """

    def build(batch: pa.RecordBatch) -> dict:
        ids = batch.column(0).to_numpy()
        out = [np.zeros(0, np.int64)] * 5
        for block in blocks(batch.column(2)):
            found = words(block)
            hashes = found.hashes()
            start, anchor = anchors(hashes, found.doc, window)
            doc = found.doc[start]
            cut = np.searchsorted(doc, np.arange(block.size + 1))
            keep = np.zeros(len(start), bool)
            for i in range(block.size):
                keys = np.array(batch.column(1)[block.first + i].values, np.int64).view(np.uint64)
                keep[cut[i]:cut[i + 1]] = np.isin(anchor[cut[i]:cut[i + 1]], keys)
            start, doc = start[keep], doc[keep]
            a = windows(hashes, window)[start].view(np.int64)
            b = windows(hashes, window, seed=1)[start].view(np.int64)
            at, own = start - found.bounds[doc], ids[block.first + doc]
            order = np.lexsort((at, own, b, a))
            a, b, own, at = a[order], b[order], own[order], at[order]
            lead = _first_of_runs(a, b)
            least = own[np.flatnonzero(lead)[np.cumsum(lead) - 1]] if len(lead) else own
            settled = (own > least).astype(np.int64)
            keep = (settled == 1) | lead | (own == least)
            out = [np.r_[x, y[keep]] for x, y in zip(out, (settled, a, b, own, at))]
        return dict(zip(("settled", "a", "b", "doc_id", "at"), out))

    return map_batches(texts, build, "settled long, a long, b long, doc_id long, at long")


def repeated_windows(rows: DataFrame) -> DataFrame:
    """(doc_id, at): windows that also start in a document of a smaller id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int, int, int] | None = None  # window and its smallest id
        for batch in batches:
            settled, a, b, own, at = (c.to_numpy() for c in batch.columns)
            take = settled == 1
            rest = np.flatnonzero(~take)
            if len(rest):
                x, y, d = a[rest], b[rest], own[rest]
                lead = _first_of_runs(x, y)
                least = d[np.flatnonzero(lead)[np.cumsum(lead) - 1]]
                if last is not None and last[:2] == (x[0], y[0]):
                    least[np.cumsum(lead) == 1] = last[2]
                take[rest] = d > least
                last = (int(x[-1]), int(y[-1]), int(least[-1]))
            yield pa.RecordBatch.from_arrays([pa.array(own[take]), pa.array(at[take])], names=["doc_id", "at"])

    place = F.when(F.col("settled") == 1, F.xxhash64("doc_id")).otherwise(F.xxhash64("a", "b"))
    return (rows.repartition(place)
            .sortWithinPartitions("settled", "a", "b", "doc_id").mapInArrow(run, "doc_id long, at long"))


def _left_of(raw: bytes, starts: np.ndarray, stay: np.ndarray) -> str:
    """A text without some of its words and the white space after each of them."""
    ends = np.append(starts[1:], len(raw))
    runs = np.split(stay, np.flatnonzero(np.diff(stay) > 1) + 1) if len(stay) else []
    return b"".join([raw[:starts[0]], *[raw[starts[r[0]]:ends[r[-1]]] for r in runs]]).decode()


def kept_words(df: DataFrame, window: int, original: bool = False) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, further columns) from (doc_id, copied, starts, text, further columns)."""
    carried = df.schema.fields[4:]

    def build(batch: pa.RecordBatch) -> dict:
        count, gone, kept = [], [], []
        for block in blocks(batch.column(3)):
            found = words(block)
            for i in range(block.size):
                first, last = found.bounds[i], found.bounds[i + 1]
                n = int(last - first)
                cover = np.zeros(n + 1, np.int64)
                row = block.first + i
                if batch.column(1)[row].as_py():
                    cover[:1] = n >= window
                elif batch.column(2)[row].is_valid:
                    starts = np.array(batch.column(2)[row].values, np.int64)
                    np.add.at(cover, starts, 1)
                    np.add.at(cover, np.minimum(starts + window, n), -1)
                stay = np.flatnonzero(np.cumsum(cover)[:n] == 0)
                raw = found.data[block.offsets[i]:block.offsets[i + 1]].tobytes()
                base = block.offsets[i]
                spans = zip((found.start[first + stay] - base).tolist(), (found.end[first + stay] - base).tolist())
                count.append(n)
                gone.append(n - len(stay))
                if not original:
                    kept.append(b" ".join([raw[s:e] for s, e in spans]).decode())
                elif len(stay) == n:
                    kept.append(raw.decode() if batch.column(3)[row].is_valid else None)
                else:
                    kept.append(_left_of(raw, found.start[first:last] - base, stay))
        return {"doc_id": batch.column(0), "n_words": count, "n_removed": gone, "kept": kept,
                **{f.name: batch.column(4 + i) for i, f in enumerate(carried)}}

    more = "".join(f", `{f.name}` {f.dataType.simpleString()}" for f in carried)
    return map_batches(df, build, "doc_id long, n_words long, n_removed long, kept string" + more)


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   carry: Sequence[str] = (), original: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (words left, joined by one space), ``carry``.

    With ``original``, ``kept`` is the text itself without the removed words and the white
    space after each: one that loses nothing stays as it is, null stays null.

    Words are runs other than white space, unchanged. A word goes if a window of
    ``window`` words that covers it also starts in a document with a smaller id;
    windows are judged on the input. Repeated rows share an id and its text and
    keep the same words: a document is not compared with itself. An id names one
    text. A null text has no words. A row without id is neither changed nor
    compared. Texts of fewer words than a window stay whole. Columns named in
    ``carry`` are handed on, others are not read.
    """
    configure(df.sparkSession)
    texts = keyed_texts(df, id_col, text_col).withColumn("class_a", F.xxhash64("text")).withColumn(
        "class_b", F.xxhash64(F.lit(7), F.col("text")))
    named = texts.filter("doc_id is not null and text is not null")
    rows = materialize(named.select("doc_id", "class_a", "class_b"), "text-classes")
    first = materialize(rows.groupBy("class_a", "class_b").agg(F.min("doc_id").alias("first")), "first-of-class")
    shared = materialize(
        shared_anchors(anchor_rows(named.select("class_a", "text"), window))
        .groupBy("class_a").agg(F.collect_list("key").alias("keys")), "shared-anchors")
    wanted = shared.join(first, "class_a").select(F.col("first").alias("doc_id"), "keys")
    chosen = named.select("doc_id", "text").join(wanted, "doc_id").select("doc_id", "keys", "text")
    starts = materialize(repeated_windows(window_rows(chosen, window)).distinct().groupBy("doc_id").agg(
        F.collect_list("at").alias("starts")), "repeated-windows")
    copies = rows.join(first, ["class_a", "class_b"]).filter(F.col("doc_id") > F.col("first")).select(
        "doc_id", F.lit(True).alias("copied")).distinct()
    marks = materialize(starts.join(copies, "doc_id", "full_outer"), "marks")
    whole = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.col(f"`{text_col}`").cast("string").alias("text"), *[F.col(f"`{c}`") for c in carry])
    joined = whole.join(marks, "doc_id", "left").select("doc_id", "copied", "starts", "text", *[f"`{c}`" for c in carry])
    return kept_words(joined, window, original)
