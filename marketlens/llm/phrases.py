"""Phrase collocations from a weighted de Bruijn graph of word runs.

Nodes are runs of four words, an edge between two overlapping nodes is the run of
five that spans them. Every word of a piece is the start of one longest run: five
words, or fewer where the piece ends. Equal runs are summed into weighted edges;
the flow out of a node, plus the runs that end there with their piece, is how often
the node occurs, and so on down to single words: no shorter run is counted by itself.

Edges are laid out over tasks by ranges of their bytes and sorted, so that the flow of
a node is a run of neighbouring edges and a frequent node may lie in several tasks; what
touches a task's first or last edge is summed afterwards. They travel packed, a row per
block of text and range. A node whose whole flow leaves
by one edge is compacted into that path: one row stands for all its prefixes of equal
count. A path also tells which phrases always lie in a longer one.

Words that cannot be frequent end a run, as no frequent phrase holds them. They are
found by a table of hashed counts of fixed size: a word may pass it in error, never fail.

In an edge, words of a bounded dictionary are one or two bytes, all others are spelled
out. The dictionary comes from a sample of texts; it decides on the size of edges, not on
results.
"""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from urllib.parse import quote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marketlens.llm.words import Block, Words, blocks, configure, mix
from marketlens.session import materialize

LONGEST = 5
MIN_COUNT = 100
TOP = 2_000
UNDETERMINED = "und"
BUCKETS = 1 << 22            # of hashed word counts: half a megabyte of bits
EDGES_PER_TASK = 2_000_000
MOST_TASKS, SAMPLES = 100_000, 1_000_000  # beyond, tasks hold more edges
SAMPLE_TEXTS = 5_000         # texts that tell frequent words and where ranges begin; no result depends on them
ENTRIES = 1 << 17            # dictionary words of all languages
BLOCK_BYTES = 4 << 20
RANGE_BYTES = 48             # of an edge that choose its range
ROWS = 1 << 16               # edges that a task looks at together

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
_APART = _BREAK.copy()
_APART[[0x20, 0x09]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# None is part of a word: end of a spelled word, end of the language, start of either.
_BLANK, _LINE, _SPELLED = 0x20, 0x0A, 0x0D
# A code is one byte from _ONE on, or one from _TWO on and one of _SECOND.
_ONE, _TWO = 0x80, 0x88
_SECOND = np.array([b for b in range(0x80) if b not in (_BLANK, _LINE, _SPELLED)], np.uint8)
CODES = _TWO - _ONE + (0x100 - _TWO) * len(_SECOND)  # dictionary words of a language


@dataclass
class Pieces:
    """Words of a block, each followed by a blank; ``linked`` tells that the next word is of the same piece."""

    words: Words
    linked: np.ndarray


def pieces(block: Block) -> Pieces:
    data, offsets = block.data, block.offsets
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_APART[data]
    starts, ends = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] |= inside[1:-1][cuts]
    ends[cuts - 1] |= inside[1:-1][cuts - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    bounds = np.searchsorted(start, offsets)
    broken = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_BREAK[data], out=broken[1:])
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(bounds))
    linked = np.zeros(len(start), bool)
    linked[:-1] = (broken[start[1:]] == broken[end[:-1]]) & (doc[1:] == doc[:-1])
    sizes = end - start
    own = np.repeat(np.arange(len(start)), sizes)
    spaced = np.full(len(own) + len(start), _BLANK, np.uint8)
    spaced[np.arange(len(own)) + own] = _LOWER[data[inside[1:-1]]]
    first = np.cumsum(sizes + 1) - sizes - 1
    return Pieces(Words(spaced, first, first + sizes, bounds), linked)


def _prefixes(langs: pa.Array) -> list[bytes]:
    """What starts every edge of a text: its language, percent-encoded, between two marks."""
    return [b"\r" + quote(x if x is not None else UNDETERMINED, safe="").encode() + b"\n" for x in langs.to_pylist()]


def _seed(prefix: bytes) -> int:
    return int.from_bytes(hashlib.blake2b(prefix, digest_size=8).digest(), "little")


def _keys(found: Pieces, prefixes: list[bytes]) -> np.ndarray:
    """Hash of each word together with its language."""
    seeds = {p: _seed(p) for p in set(prefixes)}
    by_text = np.array([seeds[p] for p in prefixes], np.uint64)
    return mix(found.words.hashes() ^ by_text[found.words.doc])


def _buckets(keys: np.ndarray) -> np.ndarray:
    return (keys % np.uint64(BUCKETS)).astype(np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[Block, list[bytes]]]:
    prefixes = _prefixes(batch.column("lang"))
    for block in blocks(batch.column("text"), BLOCK_BYTES):
        yield block, prefixes[block.first:block.first + block.size]


def word_totals(texts: DataFrame) -> DataFrame:
    """(prefix, bucket, n): words per hashed bucket (null prefix), and all words per language (null bucket)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros(BUCKETS, np.int64), {}
        for batch in batches:
            for block, prefixes in _texts(batch):
                found = pieces(block)
                counts += np.bincount(_buckets(_keys(found, prefixes)), minlength=BUCKETS)
                for prefix, n in zip(prefixes, np.diff(found.words.bounds).tolist()):
                    totals[prefix] = totals.get(prefix, 0) + n
        seen = np.flatnonzero(counts)
        for at in range(0, len(seen), ROWS):
            part = seen[at:at + ROWS]
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(part), pa.binary()), pa.array(part, pa.int32()), pa.array(counts[part])],
                names=["prefix", "bucket", "n"])
        if totals:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(totals), pa.binary()), pa.nulls(len(totals), pa.int32()), pa.array(list(totals.values()), pa.int64())],
                names=["prefix", "bucket", "n"])

    tallied = texts.mapInArrow(run, "prefix binary, bucket int, n long")
    return tallied.groupBy("prefix", "bucket").agg(F.sum("n").alias("n"))


def frequent_buckets(totals: DataFrame, least: int) -> np.ndarray:
    """Bits of the buckets whose words may be frequent; at most BUCKETS / 8 bytes reach the driver."""
    place = F.col("bucket").cast("long") + 1
    rows = (totals.filter(F.col("bucket").isNotNull() & (F.col("n") >= least))
            .groupBy(F.bitmap_bucket_number(place).alias("part"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect())
    bits = np.zeros(BUCKETS // 8, np.uint8)
    for row in rows:
        own = np.frombuffer(row.bits, np.uint8)
        at = (row.part - 1) * len(own)
        bits[at:at + len(own)] = own[:len(bits) - at]
    return bits


def _slices(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of some spans, one after the other."""
    total = np.cumsum(size)
    return data[np.arange(int(total[-1]) if len(total) else 0) + np.repeat(start - (total - size), size)]


class Dictionary:
    """Codes of some words of each language, the first ones shorter."""

    def __init__(self, entries: list[tuple[bytes, bytes]]):
        self.words: dict[bytes, list[bytes]] = {}
        codes = []
        for prefix, word in entries:
            own = self.words.setdefault(prefix, [])
            codes.append(len(own))
            own.append(word)
        self.codes = np.array(codes, np.int64)
        self.sizes = np.array([len(w) for _, w in entries], np.int64)
        self.data = np.frombuffer(b"".join(w + b" " for _, w in entries), np.uint8)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.keys = np.zeros(len(entries), np.uint64)
        if entries:
            every = Words(self.data, self.starts, self.starts + self.sizes, np.array([0, len(entries)])).hashes()
            seeds = {p: _seed(p) for p in self.words}
            self.keys = mix(every ^ np.array([seeds[p] for p, _ in entries], np.uint64))
        self.order = np.argsort(self.keys)
        self.sorted = self.keys[self.order]

    def lookup(self, keys: np.ndarray, words: Words) -> np.ndarray:
        """Code of each word, or -1. Hashes propose, bytes decide."""
        out = np.full(len(keys), -1, np.int64)
        if not len(self.sorted):
            return out
        entry = self.order[np.minimum(np.searchsorted(self.sorted, keys), len(self.sorted) - 1)]
        size = words.end - words.start
        known = np.flatnonzero((self.keys[entry] == keys) & (self.sizes[entry] == size))
        if len(known):
            own, size = entry[known], size[known]
            unlike = _slices(words.data, words.start[known], size) != _slices(self.data, self.starts[own], size)
            good = ~np.logical_or.reduceat(unlike, np.cumsum(size) - size)
            out[known[good]] = self.codes[own[good]]
        return out

    def said(self, edge: bytes) -> bytes:
        """An edge in words, each followed by a blank, after its language."""
        at = edge.index(_LINE) + 1
        prefix, out = edge[:at], []
        own = self.words.get(prefix, [])
        while at < len(edge):
            if edge[at] == _SPELLED:
                end = edge.index(_BLANK, at)
                out.append(edge[at + 1:end])
                at = end + 1
            elif edge[at] < _TWO:
                out.append(own[edge[at] - _ONE])
                at += 1
            else:
                place = int(np.searchsorted(_SECOND, edge[at + 1]))
                out.append(own[_TWO - _ONE + (edge[at] - _TWO) * len(_SECOND) + place])
                at += 2
        return prefix[1:] + b"".join(w + b" " for w in out)


def word_ends(data: np.ndarray) -> np.ndarray:
    """Last byte of the language and of every word of some edges, one after the other."""
    ends = (data == _BLANK) | (data == _LINE)
    spelled = np.cumsum((data == _SPELLED).astype(np.int8) - ends, dtype=np.int32) > 0
    return np.flatnonzero(ends | ~spelled & (data < _TWO))


def _encoded(words: Words, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words as an edge holds them, one after the other: bytes and offsets."""
    size = words.end - words.start
    short = _TWO - _ONE
    held = np.where(codes < 0, size + 2, np.where(codes < short, 1, 2))
    offsets = np.concatenate([[0], np.cumsum(held)])
    out = np.empty(int(offsets[-1]), np.uint8)
    one = (codes >= 0) & (codes < short)
    out[offsets[:-1][one]] = _ONE + codes[one]
    two = np.flatnonzero(codes >= short)
    at, rest = offsets[two], codes[two] - short
    out[at], out[at + 1] = _TWO + rest // len(_SECOND), _SECOND[rest % len(_SECOND)]
    spelled = np.flatnonzero(codes < 0)
    at, size = offsets[spelled], size[spelled]
    out[at], out[at + 1 + size] = _SPELLED, _BLANK
    total = np.cumsum(size)
    place = np.arange(int(total[-1]) if len(total) else 0) + np.repeat(at + 1 - (total - size), size)
    out[place] = _slices(words.data, words.start[spelled], size)
    return out, offsets


def _edges(block: Block, prefixes: list[bytes], bits: np.ndarray, known: Dictionary) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per language of a block: (prefix, bytes, start, size, weight) of its distinct edges."""
    found = pieces(block)
    if not len(found.linked):
        return
    keys = _keys(found, prefixes)
    kept = bits[_buckets(keys)]
    linked = found.linked & kept
    linked[:-1] &= kept[1:]
    length, reach = np.ones(len(kept), np.int64), linked.copy()
    for step in range(1, LONGEST):
        length += reach
        reach[:-step] &= linked[step:]
        reach[-step:] = False
    data, offsets = _encoded(found.words, known.lookup(keys, found.words))
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    codes: dict[bytes, int] = {}
    lang = np.array([codes.setdefault(p, len(codes)) for p in prefixes])[found.words.doc]
    for prefix, code in codes.items():
        own = np.flatnonzero(kept & (lang == code))
        if not len(own):
            continue
        start, words = offsets[own], length[own]
        size = offsets[own + words] - start
        name = np.zeros(len(own), np.uint64)
        for k in range(LONGEST):
            there = words > k
            name[there] = mix(name[there] * np.uint64(3) ^ keys[own[there] + k])
        head = padded[start[:, None] + np.arange(8)]
        head[np.arange(8) >= size[:, None]] = 0
        order = np.lexsort((name, head.view(">u8").ravel()))
        start, size, name = start[order], size[order], name[order]
        same = np.zeros(len(order), bool)
        same[1:] = (name[1:] == name[:-1]) & (size[1:] == size[:-1])
        again = np.flatnonzero(same)
        if len(again):  # hashes propose, bytes decide
            unlike = _slices(data, start[again], size[again]) != _slices(data, start[again - 1], size[again - 1])
            places = np.cumsum(size[again]) - size[again]
            same[again[np.logical_or.reduceat(unlike, places)]] = False
        distinct = np.flatnonzero(~same)
        yield prefix, data, start[distinct], size[distinct], np.diff(np.append(distinct, len(order)))


def dictionary(sample: DataFrame) -> Dictionary:
    """The most frequent words of some texts: at most CODES of a language, ENTRIES in all."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter = Counter()
            for block, prefixes in _texts(batch):
                found = pieces(block).words
                for prefix, start, end in zip(prefixes, found.bounds[:-1], found.bounds[1:]):
                    if start < end:
                        text = found.data[found.start[start]:found.end[end - 1]].tobytes()
                        counts.update((prefix, w) for w in text.split(b" "))
            if counts:
                prefix, word = zip(*counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(prefix, pa.binary()), pa.array(word, pa.binary()), pa.array(list(counts.values()), pa.int64())],
                    names=["prefix", "word", "n"])

    counted = sample.mapInArrow(run, "prefix binary, word binary, n long").groupBy("prefix", "word").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("prefix").orderBy(F.desc("n"), "word"))
    most = counted.withColumn("place", place).filter(F.col("place") <= CODES).orderBy(F.desc("n"), "prefix", "word").limit(ENTRIES)
    return Dictionary([(bytes(r.prefix), bytes(r.word)) for r in most.collect()])


PACKED = "part int, prefix binary, n int, edges binary, sizes binary, weights binary"


def _whole(values: np.ndarray) -> bytes:
    """Whole numbers in as few bytes each as the largest needs."""
    return values.astype(np.min_scalar_type(int(values.max()))).tobytes()


def _numbers(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"u{len(data) // n}").astype(np.int64)


def edges(texts: DataFrame, bits: np.ndarray, known: Dictionary, cuts: dict[bytes, list[bytes]]) -> DataFrame:
    """The edges of all texts, those of a block, language and range of ``cuts`` together in a row."""
    parts, total = {}, 0
    for prefix, own in cuts.items():
        parts[prefix] = (np.array(own, f"S{RANGE_BYTES}"), total)
        total += len(own)

    def range_of(prefix: bytes) -> tuple[np.ndarray, int]:
        return parts.get(prefix) or (np.zeros(0, f"S{RANGE_BYTES}"), zlib.crc32(prefix) % max(total, 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent = np.unpackbits(bits, bitorder="little").astype(bool)
        for batch in batches:
            for block, prefixes in _texts(batch):
                for prefix, data, start, size, weight in _edges(block, prefixes, frequent, known):
                    yield _packed(prefix, data, start, size, weight, *range_of(prefix))

    return texts.mapInArrow(run, PACKED)


def _packed(prefix: bytes, data: np.ndarray, start: np.ndarray, size: np.ndarray, weight: np.ndarray,
            starts: np.ndarray, first: int) -> pa.RecordBatch:
    part = np.zeros(len(size), np.int64)
    if len(starts):
        for at in range(0, len(size), ROWS):
            head = _heads(data, start[at:at + ROWS], size[at:at + ROWS], RANGE_BYTES)
            # Edges before the first start of a language are in its first range, too.
            part[at:at + ROWS] = np.maximum(np.searchsorted(starts, head.view(f"S{RANGE_BYTES}").ravel(), "right") - 1, 0)
    order = np.argsort(part, kind="stable")
    part, start, size, weight = part[order], start[order], size[order], weight[order]
    bounds = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part))
    rows = []
    for low, high in zip(bounds[:-1], bounds[1:]):
        own = slice(low, high)
        rows.append((first + int(part[low]), prefix, high - low, _slices(data, start[own], size[own]).tobytes(),
                     _whole(size[own]), _whole(weight[own])))
    kinds = [pa.int32(), pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)],
                                      names=["part", "prefix", "n", "edges", "sizes", "weights"])


def _heads(data: np.ndarray, start: np.ndarray, size: np.ndarray, width: int) -> np.ndarray:
    """The first bytes of some spans, a row each, filled up with zeros."""
    padded = np.append(data, np.zeros(width, np.uint8))
    head = padded[start[:, None] + np.arange(width)]
    head[np.arange(width) >= size[:, None]] = 0
    return head


def byte_order(data: np.ndarray, size: np.ndarray, width: int = 24) -> np.ndarray:
    """Order of some edges, one after the other, by their bytes."""
    start = np.cumsum(size) - size
    head = np.empty((len(size), width), np.uint8)
    for at in range(0, len(size), ROWS):
        head[at:at + ROWS] = _heads(data, start[at:at + ROWS], size[at:at + ROWS], width)
    keys = head.view(">u8").astype(np.uint64)
    order = np.lexsort((size, *keys.T[::-1]))
    keys = keys[order]
    run = np.append(np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1))), len(order))
    longer = np.logical_or.reduceat(size[order] > width, run[:-1]) & (np.diff(run) > 1)
    for i in np.flatnonzero(longer):  # alike as far as that
        rows = order[run[i]:run[i + 1]]
        order[run[i]:run[i + 1]] = sorted(rows, key=lambda r: data[start[r]:start[r] + size[r]].tobytes())
    return order


class Flow:
    """Sums the flow of every node over the sorted edges of a language, some at a time.

    The open node of each length is carried to the next call: its edge and, per
    length, its flow so far and whether it holds the first edge of all.
    """

    def __init__(self, least: int):
        self.least = least
        self.edge: np.ndarray | None = None
        self.sums = np.zeros(LONGEST, np.int64)
        self.outer = np.ones(LONGEST, bool)

    def add(self, data: np.ndarray, sizes: np.ndarray, weight: np.ndarray) -> list[tuple[bytes, int, int, bool]]:
        """Nodes that are complete, as rows (path, shortest, n, outer)."""
        opening = self.edge is None
        if not opening:
            data, sizes = np.concatenate([self.edge, data]), np.append(len(self.edge), sizes)
        rows = len(sizes)
        offsets = np.concatenate([[0], np.cumsum(sizes)])
        # Words shared with the row before: those that end within the common bytes.
        within = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
        before = np.repeat(np.append(0, sizes[:-1]), sizes)
        unlike = np.ones(len(data), bool)
        spot = np.flatnonzero(within < before)
        unlike[spot] = data[spot] != data[spot - before[spot]]
        alike = np.minimum.reduceat(np.where(unlike, within, np.iinfo(np.int64).max), offsets[:-1])
        alike = np.minimum(alike, sizes)
        apart = word_ends(data)
        first = np.searchsorted(apart, offsets)
        shared = np.searchsorted(apart, offsets[:-1] + alike) - first[:-1]
        words = np.diff(first)
        sums = np.zeros((LONGEST + 1, rows), np.int64)
        outer = np.zeros((LONGEST, rows), bool)
        ended = np.zeros((LONGEST, rows), bool)
        for k in range(1, LONGEST + 1):
            own = weight if opening else np.append(self.sums[k - 1], weight)
            starts = shared < k
            starts[0] = True
            heads = np.flatnonzero(starts)
            total = np.add.reduceat(own, heads)
            real = words[heads] >= k
            sums[k, heads[real]] = total[real]
            outer[k - 1, 0] = self.outer[k - 1] or opening
            ended[k - 1, heads[:-1]] = True
            self.outer[k - 1] = outer[k - 1, heads[-1]]
            self.sums[k - 1] = total[-1] if words[heads[-1]] >= k else 0
        self.edge = data[offsets[-2]:]
        out = []

        def said(i: int, k: int) -> bytes:
            return data[offsets[i]:apart[first[i] + k - 1] + 1].tobytes()

        run = np.zeros(rows, np.int64)
        for k in range(1, LONGEST + 1):
            # A run of lengths of equal flow at a row is one path.
            whole = ended[k - 1] & (sums[k] >= self.least) & ~outer[k - 1]
            run = np.where(whole, np.where((sums[k] == sums[k - 1]) & (run > 0), run + 1, 1), 0)
            on = np.zeros(rows, bool)
            if k < LONGEST:
                on = ended[k] & (sums[k + 1] == sums[k]) & ~outer[k]
            out += [(said(i, k), int(k - run[i] + 1), int(sums[k, i]), False) for i in np.flatnonzero(whole & ~on)]
            out += [(said(i, k), k, int(sums[k, i]), True) for i in np.flatnonzero(ended[k - 1] & outer[k - 1] & (sums[k] > 0))]
        return out

    def rest(self) -> list[tuple[bytes, int, int, bool]]:
        """The nodes of the last edge."""
        if self.edge is None:
            return []
        ends = word_ends(self.edge) + 1
        return [(self.edge[:end].tobytes(), k, int(self.sums[k - 1]), True) for k, end in enumerate(ends.tolist(), 1)]


def paths(laid_out: DataFrame, known: Dictionary, least: int) -> DataFrame:
    """(path, shortest, n, outer) of the nodes that occur ``least`` times in a task, or touch its ends; paths in words.

    A task has the edges of one range, about EDGES_PER_TASK, and sorts them.
    """
    def batch(prefix: bytes, rows: list) -> pa.RecordBatch:
        path, shortest, n, outer = zip(*rows)
        return pa.RecordBatch.from_arrays([
            pa.array([known.said(prefix + p) for p in path], pa.binary()),
            pa.array(shortest, pa.int32()), pa.array(n, pa.int64()), pa.array(outer)],
            names=["path", "shortest", "n", "outer"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, list] = {}
        for one in batches:
            for row in one.to_pylist():
                held.setdefault(row["prefix"], []).append((
                    np.frombuffer(row["edges"], np.uint8), _numbers(row["sizes"], row["n"]), _numbers(row["weights"], row["n"])))
        for prefix in list(held):
            data, size, weight = (np.concatenate(v) for v in zip(*held.pop(prefix)))
            order, start = byte_order(data, size), np.cumsum(size) - size
            flow = Flow(least)
            for at in range(0, len(order), ROWS):
                own = order[at:at + ROWS]
                out = flow.add(_slices(data, start[own], size[own]), size[own], weight[own])
                if out:
                    yield batch(prefix, out)
            yield batch(prefix, flow.rest())

    return laid_out.mapInArrow(run, "path binary, shortest int, n long, outer boolean")


def range_starts(sample: DataFrame, bits: np.ndarray, known: Dictionary, tasks: int) -> dict[bytes, list[bytes]]:
    """Where the ranges of edges start, by language; about ``tasks`` in all, of about equally many edges.

    From a sample of edges, at most SAMPLES. A language that it does not hold is in one of the ranges.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for one in batches:
            for row in one.to_pylist():
                size = _numbers(row["sizes"], row["n"])
                ends = np.cumsum(size).tolist()
                found = [row["edges"][e - s:e][:RANGE_BYTES] for s, e in zip(size.tolist(), ends)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["prefix"]] * len(found), pa.binary()), pa.array(found, pa.binary())], names=["prefix", "edge"])

    drawn = edges(sample, bits, known, {}).mapInArrow(run, "prefix binary, edge binary").orderBy(
        F.rand(seed=1)).limit(min(64 * tasks, SAMPLES)).collect()
    by_lang: dict[bytes, list[bytes]] = {}
    for prefix, edge in sorted((bytes(r.prefix), bytes(r.edge)) for r in drawn):
        by_lang.setdefault(prefix, []).append(edge)
    starts = {}
    for prefix, own in by_lang.items():
        parts = max(1, round(tasks * len(own) / len(drawn)))
        starts[prefix] = sorted({own[len(own) * i // parts].rstrip(b"\0") for i in range(parts)})
    return starts


def phrase_counts(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT) -> tuple[DataFrame, DataFrame]:
    """Counts of the phrases of 1 to 5 words that occur ``least`` times, and of all words per language.

    (lang, phrase, words, n) and (lang, n). Null texts read as empty, a null language as ``und``.
    """
    spark = configure(df.sparkSession)
    texts = df.select(F.col(f"`{lang_col}`").cast("string").alias("lang"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    totals = materialize(word_totals(texts), "word-totals")
    bits = frequent_buckets(totals, least)
    words = totals.filter("bucket is null").agg(F.sum("n").alias("n")).first().n or 0
    tasks = min(max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words // EDGES_PER_TASK)), MOST_TASKS)
    sample = materialize(texts.sample(min(1.0, SAMPLE_TEXTS / max(texts.count(), 1)), seed=1), "sample-texts")
    known = dictionary(sample)
    cuts = range_starts(sample, bits, known, tasks)
    parts = max(1, sum(len(own) for own in cuts.values()))
    laid_out = edges(texts, bits, known, cuts).repartitionById(parts, F.col("part"))
    found = materialize(paths(laid_out, known, least), "phrase-paths")
    inner = found.filter(~F.col("outer")).select("path", "shortest", "n")
    outer = found.filter("outer").groupBy("path", "shortest").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)
    said = F.col("path").cast("string")
    split = inner.unionByName(outer).select(
        F.url_decode(F.substring_index(said, "\n", 1)).alias("lang"), F.substring_index(said, "\n", -1).alias("said"), "shortest", "n")
    longest = F.size(F.split("said", " ")) - 1
    counts = split.select("lang", "said", "n", F.explode(F.sequence("shortest", longest)).alias("words")).select(
        "lang", F.array_join(F.slice(F.split("said", " "), F.lit(1), F.col("words")), " ").alias("phrase"), "words", "n")
    per_lang = totals.filter("bucket is null").select(
        F.url_decode(F.regexp_extract(F.col("prefix").cast("string"), "\\r(.*)\n", 1)).alias("lang"), "n")
    return counts, per_lang


def collocations(df: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """The best phrases of every language: (lang, rank, phrase, a, l, r, n, score).

    A phrase of 2 to 5 words that occurs ``a >= least`` times is scored at its weakest
    cut: floor(1000 * a * n / (l * r)), in exact decimals. Phrases that lie in a longer
    one as often as they occur are left out: one word longer suffices, as counts never
    rise along the way to a longer one, so it is a path of the graph.

    Texts without words add nothing; empty tables give no rows; repeated rows count as
    often as they are there; other columns are not read.
    """
    counts, per_lang = phrase_counts(df, text_col, lang_col, least)
    counts = materialize(counts, "phrase-counts")
    longer = counts.filter("words >= 3")
    inside = longer.select("lang", "n", F.explode(F.array(*[
        F.array_join(F.slice(F.split("phrase", " "), F.lit(first), F.col("words") - 1), " ") for first in (1, 2)])).alias("phrase"))
    candidates = counts.filter("words >= 2").join(inside, ["lang", "phrase", "n"], "left_anti")
    words = F.split("phrase", " ")
    cut = candidates.select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"),
        F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    for name, side in (("l", "first"), ("r", "rest")):
        cut = cut.join(counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(name)), ["lang", side])
    cut = cut.join(per_lang, "lang")

    def wide(*names: str):
        return reduce(lambda x, y: (x * y).cast("decimal(38,0)"), [F.col(c).cast("decimal(19,0)") for c in names])

    over, under = (wide("a", "n") * F.lit(1000).cast("decimal(4,0)")).cast("decimal(38,0)"), wide("l", "r")
    scored = cut.withColumn("score", ((over - over % under) / under).cast("long"))
    weakest = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    ranked = weakest.withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")))
    return ranked.filter(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
