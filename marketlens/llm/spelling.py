"""Spelling variants by k-d trees over the letter counts of words.

One edit moves the vector of a word's letter counts by at most two: a replaced letter
takes one count up and one down, an inserted letter takes one up. So near words lie
in a small box around a word's vector, in the tree of its own length or of the next.

The upper levels of each length's tree are split on a sample of words and cut them into
cells of bounded bytes. A word lies in one cell and asks every cell whose box is within
reach, pruned level by level. A cell is one group: its own tree is built down to small
leaves, all words that ask descend together, and who reaches a leaf with the right
difference of counts is verified letter by letter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import configure
from marketlens.session import materialize

LEAST_LETTERS, LEAST_COUNT, FACTOR = 6, 5, 5
SLIPS = 199                     # one in so many distinct runs of a text loses a letter
RUN = re.compile("[a-zÀ-ÿ]+")
CHUNK = 1 << 20                 # characters looked at together
DISTINCT = 200_000              # words a task counts before it hands them on
CELL_BYTES = 1 << 17
SAMPLE_BYTES = 4 << 20          # of words that the upper levels are split on
LEAF = 16
PAIRS = 1 << 18                 # looked at together
_LETTER = np.full(256, -1)
_LETTER[[*range(0x61, 0x7B), *range(0xC0, 0x100)]] = np.arange(26 + 64)
LETTERS = 26 + 64


def _chunks(text: str) -> Iterator[list[str]]:
    """Runs of letters of a lower-cased text, some at a time; no run is cut."""
    at = 0
    while at < len(text):
        end = min(at + CHUNK, len(text))
        more = RUN.match(text, end)
        end = more.end() if more else end
        yield RUN.findall(text, at, end)
        at = end


def count_words(texts: DataFrame) -> DataFrame:
    """(word, n) of runs of letters, ASCII lower-cased, with a letter less where the text's slip falls on them."""
    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                text = text.as_py()
                if not text:
                    continue
                own = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                for found in _chunks(text.encode().lower().decode()):
                    for word, n in Counter(found).items():
                        slip = zlib.crc32(word.encode(), own)
                        if slip % SLIPS == 0:
                            place = slip % len(word)
                            word = word[:place] + word[place + 1:]
                        if len(word) >= LEAST_LETTERS:
                            counts[word] += n
                    if len(counts) >= DISTINCT:
                        yield flush(counts)
                        counts = Counter()
        if counts:
            yield flush(counts)

    return texts.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def letters(words: list[bytes], length: int) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(-1, length)


def vectors(codes: np.ndarray) -> np.ndarray:
    """Letter counts, a row per word."""
    rows, length = codes.shape
    kind = np.int8 if length < 64 else np.int32
    out = np.empty((rows, LETTERS), kind)
    step = max(1, PAIRS // LETTERS)
    for at in range(0, rows, step):
        part = codes[at:at + step]
        place = _LETTER[part] + np.arange(len(part))[:, None] * LETTERS
        out[at:at + step] = np.bincount(place.ravel(), minlength=len(part) * LETTERS).reshape(-1, LETTERS)
    return out


def _split(points: np.ndarray) -> tuple[int, int] | None:
    """The letter whose counts spread most and the count to split at; None if all points are one."""
    low, high = points.min(0), points.max(0)
    if (low == high).all():
        return None
    letter = int(np.where(high > low, points.var(0), -1).argmax())
    middle = int(np.median(points[:, letter]))
    counts = [int((points[:, letter] <= t).sum()) for t in (middle - 1, middle)]
    cut = min((abs(2 * n - len(points)), t) for n, t in zip(counts, (middle - 1, middle)) if 0 < n < len(points))[1]
    return letter, cut


@dataclass(frozen=True)
class Node:
    """Words with at most ``cut`` of a letter are in ``low``; a leaf has a cell number."""

    cell: int = 0
    letter: int = -1
    cut: int = 0
    low: Node | None = None
    high: Node | None = None


def upper_levels(points: np.ndarray, cells: int, first: int = 0) -> tuple[Node, int]:
    """A tree of about ``cells`` leaves over sample points, and the next free cell number."""
    found = _split(points) if cells > 1 and len(points) > 1 else None
    if found is None:
        return Node(first), first + 1
    letter, cut = found
    below = points[:, letter] <= cut
    share = min(max(1, round(cells * below.mean())), cells - 1)
    low, first = upper_levels(points[below], share, first)
    high, first = upper_levels(points[~below], cells - share, first)
    return Node(letter=letter, cut=cut, low=low, high=high), first


class Box:
    """Words that ask, with what their counts lack or exceed of a node's box."""

    def __init__(self, asking: np.ndarray, up: int, down: int):
        self.asking, self.up, self.down = asking, up, down

    def start(self):
        n = len(self.asking)
        return np.arange(n), np.zeros(n, int), np.zeros(n, int), {}

    def below(self, state, letter: int, cut: int):
        """Those that reach the part with at most ``cut`` of a letter."""
        rows, lack, excess, box = state
        low, high = box.get(letter, (0, 1 << 30))
        own = self.asking[rows, letter].astype(int)
        more = excess + np.maximum(own - cut, 0) - np.maximum(own - high, 0)
        near = more <= self.down
        return rows[near], lack[near], more[near], {**box, letter: (low, cut)}

    def above(self, state, letter: int, cut: int):
        rows, lack, excess, box = state
        low, high = box.get(letter, (0, 1 << 30))
        own = self.asking[rows, letter].astype(int)
        more = lack + np.maximum(cut + 1 - own, 0) - np.maximum(low - own, 0)
        near = more <= self.up
        return rows[near], more[near], excess[near], {**box, letter: (cut + 1, high)}


def cells_within(tree: Node, asking: np.ndarray, up: int, down: int) -> Iterator[tuple[int, np.ndarray]]:
    """(cell, rows of ``asking`` whose reach touches it)."""
    box = Box(asking, up, down)
    stack = [(tree, box.start())]
    while stack:
        node, state = stack.pop()
        if not len(state[0]):
            continue
        if node.low is None:
            yield node.cell, state[0]
        else:
            stack += [(node.low, box.below(state, node.letter, node.cut)), (node.high, box.above(state, node.letter, node.cut))]


def pairs_within(points: np.ndarray, asking: np.ndarray, up: int, down: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(rows of ``asking``, rows of ``points``, all with all): counts differ by exactly ``up`` and ``down``.

    Where many points are one, all that ask for it come at once, not as pairs.
    """
    used = np.flatnonzero((points.max(0) > 0) | (asking.max(0) > 0))  # letters that any word has
    points, asking = np.ascontiguousarray(points[:, used]), np.ascontiguousarray(asking[:, used])
    box = Box(asking, up, down)
    stack = [(np.arange(len(points)), box.start())]
    while stack:
        own, state = stack.pop()
        rows = state[0]
        if not len(rows):
            continue
        found = _split(points[own]) if len(own) > LEAF else None
        if found is not None:
            letter, cut = found
            under = points[own, letter] <= cut
            stack += [(own[under], box.below(state, letter, cut)), (own[~under], box.above(state, letter, cut))]
            continue
        one = len(own) > LEAF
        against = own[:1] if one else own
        step = max(1, PAIRS // len(against))
        for at in range(0, len(rows), step):
            part = rows[at:at + step]
            gap = points[against][None] - asking[part][:, None]
            fits = ((gap.clip(min=0).sum(2) == up) & (-gap.clip(max=0).sum(2) == down))
            i, j = np.nonzero(fits)
            if one and len(i):
                yield part[i], own, True
            elif len(i):
                yield part[i], own[j], False


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether words (rows of codes) differ by exactly one replaced letter, or by one that ``b`` has more."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    length = a.shape[1]
    ahead = np.cumprod(a == b[:, :length], axis=1).sum(1)
    behind = np.cumprod((a == b[:, 1:])[:, ::-1], axis=1).sum(1)
    return ahead + behind >= length


def _one_edit_of_many(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) of near words among many of equal counts: joined on the word without one letter."""
    known: dict[tuple[int, bytes], list[int]] = defaultdict(list)
    longer = b.shape[1] > a.shape[1]
    for j, word in enumerate(b):
        word = word.tobytes()
        for i in range(len(word)):
            if not (longer and i and word[i] == word[i - 1]):  # a run of one letter gives one shorter word
                known[0 if longer else i, word[:i] + word[i + 1:]].append(j)
    rows, others = [], []
    for k, word in enumerate(a):
        word = word.tobytes()
        for place, part in [(0, word)] if longer else [(i, word[:i] + word[i + 1:]) for i in range(len(word))]:
            for j in known.get((place, part), ()):
                if longer or b[j].tobytes() != word:
                    rows.append(k)
                    others.append(j)
    return np.array(rows, int), np.array(others, int)


def near_rows(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows (i, j) of words ``a`` and ``b`` at one edit; ``b`` as long as ``a`` or one letter longer."""
    if not len(a) or not len(b):
        return
    for i, j, all_with_all in pairs_within(vectors(b), vectors(a), 1, int(a.shape[1] == b.shape[1])):
        if all_with_all:
            x, y = _one_edit_of_many(a[i], b[j])
            yield i[x], j[y]
            continue
        step = max(1, PAIRS // b.shape[1])
        for at in range(0, len(i), step):
            x, y = i[at:at + step], j[at:at + step]
            same = one_edit(a[x], b[y])
            yield x[same], y[same]


OWN, SAME, SHORTER = 0, 1, 2  # a cell's own word, one that asks, one of a letter less that asks


def to_cells(words: DataFrame, trees: dict[int, Node]) -> DataFrame:
    """(length, cell, kind, word, n): every word in its cell and in those it asks; lengths without a tree are one cell."""
    whole = Node()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_length = defaultdict(list)
            for i, word in enumerate(batch.column("word").to_pylist()):
                by_length[len(word)].append((i, word.encode("latin-1")))
            for length, own in by_length.items():
                place = np.array([i for i, _ in own])
                counts = vectors(letters([w for _, w in own], length))
                tree = trees.get(length, whole)
                home = np.zeros(len(own), int)
                for cell, rows in cells_within(tree, counts, 0, 0):
                    home[rows] = cell
                    yield _cell_batch(batch, place[rows], length, cell, OWN)
                for cell, rows in cells_within(tree, counts, 1, 1):
                    yield _cell_batch(batch, place[rows[home[rows] != cell]], length, cell, SAME)
                for cell, rows in cells_within(trees.get(length + 1, whole), counts, 1, 0):
                    yield _cell_batch(batch, place[rows], length + 1, cell, SHORTER)

    return words.mapInArrow(run, "length int, cell int, kind int, word string, n long")


def _cell_batch(batch: pa.RecordBatch, rows: np.ndarray, length: int, cell: int, kind: int) -> pa.RecordBatch:
    own = batch.take(pa.array(rows))
    same = [pa.array(np.full(len(rows), x, np.int32)) for x in (length, cell, kind)]
    return pa.RecordBatch.from_arrays([*same, own.column("word"), own.column("n")], names=["length", "cell", "kind", "word", "n"])


def _near_of_cell(cell: pd.DataFrame) -> pd.DataFrame:
    """Per word of a cell, or that asks it: how many near words it has here, and the best one."""
    out = []
    for asking in ((OWN, SAME), (SHORTER,)):
        a, b = cell[cell.kind.isin(asking)], cell[cell.kind == OWN]
        if not len(a) or not len(b):
            continue
        x, y = a.word.to_numpy(), b.word.to_numpy()
        found = list(near_rows(*[letters([w.encode("latin-1") for w in v], len(v[0])) for v in (x, y)]))
        if not found:
            continue
        i, j = (np.concatenate(part) for part in zip(*found))
        out.append(pd.DataFrame({"word": x[i], "near": y[j], "n": b.n.to_numpy()[j]}))
        if asking == (SHORTER,):
            out.append(pd.DataFrame({"word": y[j], "near": x[i], "n": a.n.to_numpy()[i]}))
    if not out:
        return pd.DataFrame(columns=["word", "near", "n", "n_near"], dtype=object)
    pairs = pd.concat(out).sort_values(["word", "n", "near"], ascending=[True, False, True])
    grouped = pairs.groupby("word", sort=False)
    return grouped.first().assign(n_near=grouped.size()).reset_index()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best, best_n) of words that have near ones; best is the most frequent, ties by code points."""
    sizes = words.groupBy(F.length("word").alias("length")).agg(F.count("*").alias("words")).collect()  # a row per length
    cells = {r.length: -(-r.words * r.length // CELL_BYTES) for r in sizes}
    wide = sorted(x for x, n in cells.items() if n > 1)
    in_wide = sum(cells[x] for x in wide) * CELL_BYTES
    trees = {}
    if wide:
        thin = max(1, -(-in_wide // SAMPLE_BYTES))
        sample = words.filter(F.length("word").isin(wide) & (F.pmod(F.xxhash64("word"), F.lit(thin)) == 0)).select("word").collect()
        for length in wide:
            own = [r.word.encode("latin-1") for r in sample if len(r.word) == length]
            if own:
                trees[length], _ = upper_levels(vectors(letters(own, length)), cells[length])
    found = to_cells(words, trees).groupBy("length", "cell").applyInPandas(
        lambda pdf: _near_of_cell(pdf), "word string, near string, n long, n_near long")
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), "near")).alias("best")).select(
        "word", "n_near", F.col("best.near").alias("best"), (-F.col("best.less")).alias("best_n"))


def follow(links: DataFrame, steps: int) -> DataFrame:
    """(word, root) from (word, form): the last word after at most ``steps`` links, by doubling the links."""
    roots = links.select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(steps)) if steps > 1 else 0):
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "roots")
    return roots


def spelling_variants(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, form, root, n, n_near, form_n) of all words of 6 letters and 5 occurrences or more.

    Null and empty texts have no words; a null id reads as empty where it decides on a
    lost letter; repeated rows count as often as they are there; an empty table gives no
    rows; other columns are not read. Words of any length take part.
    """
    configure(df.sparkSession)
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    words = materialize(count_words(texts).filter(F.col("n") >= LEAST_COUNT), "words")
    known = words.join(near_words(words), "word", "left")
    taken = F.col("best_n") >= FACTOR * F.col("n")
    judged = materialize(known.select(
        "word", F.when(taken, F.col("best")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(taken, F.col("best_n")).alias("form_n")), "forms")
    most = words.agg(F.max("n")).first()[0] or LEAST_COUNT
    steps = 1 + int(math.log(most / LEAST_COUNT, FACTOR))  # counts rise by the factor at every link
    roots = follow(judged.filter("form is not null"), steps)
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
