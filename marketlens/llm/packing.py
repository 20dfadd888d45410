"""Packing token pieces into sequences: best fit, then local search by swaps.

Pieces of a full sequence stand alone. The others are dealt into groups of
bounded size; a group is packed by best fit in descending order and then
improved: a document moves from one underfull bin to another, or is exchanged
for one or two, whenever that increases the sum of squared fills, until bins run
empty. Bins that stay far from full are packed once more, across groups.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.bpe import coder, tokenizer_path
from marketlens.llm.words import configure, keyed_texts, map_batches
from marketlens.session import materialize

SEQUENCE = 1_024
END = 2                    # id after each document
GROUP_PIECES = 20_000      # pieces packed together
SOURCES = 48               # emptiest bins that give documents away in one pass
PASSES = 12                # passes of the local search, at most
OPEN_FILL = 0.97           # bins below are packed again across groups


def pieces(df: DataFrame, size: int = SEQUENCE, end: int = END, id_col: str = "doc_id", text_col: str = "text",
           path: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each text's ids with ``end``, cut if longer than ``size``."""
    path = tokenizer_path(path)
    tail = np.array([end], "<u4").tobytes()

    def build(batch: pa.RecordBatch) -> dict:
        ids = batch.column(0).to_pylist()
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc, raw in zip(ids, coder(path).encode_all([t or "" for t in batch.column(1).to_pylist()])):
            raw += tail
            n, at, k = len(raw) // 4, 0, 0
            while at < n:
                stop = at + ((n - at) % size or size)
                for name, value in zip(out, (doc, k, at, stop - at, zlib.crc32(raw[4 * at:4 * stop]))):
                    out[name].append(value)
                at, k = stop, k + 1
        return out

    return map_batches(keyed_texts(df, id_col, text_col), build,
                       "doc_id long, piece int, start long, length long, ids_crc32 long")


def best_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of item numbers: longest items first, each into the fullest bin that has room."""
    bins: list[list[int]] = []
    with_room: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0  # bit r is set if some bin has room r
    for i in np.argsort(-lengths, kind="stable").tolist():
        n = int(lengths[i])
        fits = rooms >> n
        if fits:
            room = n + (fits & -fits).bit_length() - 1
            own = with_room[room].pop()
            if not with_room[room]:
                rooms ^= 1 << room
            bins[own].append(i)
        else:
            own, room = len(bins), size
            bins.append([i])
        if room > n:
            with_room[room - n].append(own)
            rooms |= 1 << room - n
    return bins


def improve(bins: list[list[int]], lengths: np.ndarray, size: int) -> list[list[int]]:
    """Local search over the underfull bins; every step increases the sum of squared fills."""
    size_of = lengths.tolist()
    fill = [sum(size_of[i] for i in b) for b in bins]

    def offers(sources: list[int]) -> tuple[list[int], list[tuple[int, tuple[int, ...]]]]:
        """What the sources can give, by length: one document or two of the same bin."""
        found = []
        for x in sources:
            docs = bins[x][:24]
            found += [(size_of[i], (x, (i,))) for i in docs]
            found += [(size_of[i] + size_of[j], (x, (i, j))) for k, i in enumerate(docs) for j in docs[:k]]
        found.sort(key=lambda o: o[0])
        return [o[0] for o in found], [o[1] for o in found]

    for _ in range(PASSES):
        under = sorted((x for x in range(len(bins)) if 0 < fill[x] < size), key=lambda x: fill[x])
        sources = under[:SOURCES]
        if len(under) < 2:
            break
        steps = 0
        sizes, given = offers(sources)
        for y in reversed(under):
            moved = True
            while moved and 0 < fill[y] < size:
                moved, best = False, None
                room = size - fill[y]
                docs = bins[y][:24]
                wants = [(0, ())] + [(size_of[j], (j,)) for j in docs]
                wants += [(size_of[i] + size_of[j], (i, j)) for k, i in enumerate(docs) for j in docs[:k]]
                for out, back in wants:
                    at = bisect_right(sizes, out + room) - 1
                    while at >= 0 and sizes[at] > out:
                        x, take = given[at]
                        gain = sizes[at] - out
                        if x != y and len(take) + len(back) <= 3 and fill[y] + gain > fill[x]:
                            if best is None or gain > best[0]:
                                best = (gain, x, take, back)
                            break
                        at -= 1
                    if best and best[0] == room:
                        break
                if best:
                    gain, x, take, back = best
                    bins[x] = [i for i in bins[x] if i not in take] + list(back)
                    bins[y] = [i for i in bins[y] if i not in back] + list(take)
                    fill[x] -= gain
                    fill[y] += gain
                    steps += 1
                    moved = True
                    sizes, given = offers(sources)
        if not steps:
            break
    return [b for b in bins if b]


def pack_lengths(lengths: np.ndarray, size: int = SEQUENCE) -> list[list[int]]:
    return improve(best_fit(lengths, size), lengths, size)


def _packed(rows: DataFrame, group: str, size: int) -> DataFrame:
    """Bins of each group: (row, length, bin, offset, fill)."""

    def run(table: pa.Table) -> pa.Table:
        row, length = table["row"].to_numpy(), table["length"].to_numpy()
        order = np.lexsort((row, length))  # the same bins however the rows arrive
        row, length = row[order], length[order]
        where, offset, fill = (np.zeros(len(row), np.int64) for _ in range(3))
        for number, items in enumerate(pack_lengths(length, size)):
            items = np.array(items)
            where[items] = row[items].min()  # a bin is named by one of its rows
            offset[items] = np.r_[0, np.cumsum(length[items])[:-1]]
            fill[items] = length[items].sum()
        return pa.table({"row": row, "length": length, "bin": where, "offset": offset, "fill": fill})

    return rows.groupBy(group).applyInArrow(run, "row long, length long, bin long, offset long, fill long")


def pack(df: DataFrame, size: int = SEQUENCE, end: int = END, id_col: str = "doc_id", text_col: str = "text",
         path: str | None = None) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A document is its ids and ``end``; only one longer than ``size`` is cut, into
    pieces of ``size`` of which the first may be shorter. Null reads as the empty
    text, whose one piece is ``end``. Repeated rows are packed each; a null id
    stays null. Other columns are not read. An empty table gives no rows.
    """
    configure(df.sparkSession)
    every = materialize(pieces(df, size, end, id_col, text_col, path).withColumn(
        "row", F.monotonically_increasing_id()), "pieces")
    partial = every.filter(F.col("length") < size).select("row", "length")
    groups = max(1, -(-partial.count() // GROUP_PIECES))
    first = materialize(_packed(partial.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(groups))), "g", size), "bins")
    loose = first.filter(F.col("fill") < OPEN_FILL * size).select("row", "length")
    again = max(1, -(-loose.count() // GROUP_PIECES))
    second = _packed(loose.withColumn("g", F.pmod(F.xxhash64("row"), F.lit(again))), "g", size)
    bins = first.filter(F.col("fill") >= OPEN_FILL * size).unionByName(second).select("row", "bin", "offset")
    alone = every.filter(F.col("length") == size).select("row", F.col("row").alias("bin"), F.lit(0).cast("long").alias("offset"))
    return every.join(bins.unionByName(alone), "row").select(
        "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")
