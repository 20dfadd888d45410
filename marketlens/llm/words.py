"""Words of a block of texts as numpy arrays, and the pass that feeds texts to tasks.

A word is a maximal run of bytes other than 0x20 and 0x09-0x0D. UTF-8 never uses
those bytes inside a character, so words of bytes are words of characters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK_BYTES = 2 << 20
BATCH_ROWS, BATCH_BYTES = 1_000, 8 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def configure(spark: SparkSession) -> SparkSession:
    """Bound the Arrow batches by bytes: a batch of very long texts stays small."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def keyed_texts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Only the two columns an operator reads, under its own names."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"))


def map_batches(df: DataFrame, build: Callable[[pa.RecordBatch], pa.RecordBatch | dict | None],
                schema: str) -> DataFrame:
    """``mapInArrow`` with one function per batch; a dict of arrays becomes a batch."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = build(batch)
            if out is not None:
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type)
                     for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64: spreads every input bit over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base & (1 << 64) - 1, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


@dataclass
class Block:
    """Some texts of a batch, as bytes: text i is ``data[offsets[i]:offsets[i + 1]]``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def size(self) -> int:
        return len(self.offsets) - 1


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null reads as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, kind)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def blocks(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Cut a batch into runs of texts of about ``limit`` bytes; a text is never cut."""
    if not len(texts):
        return
    data, offsets = utf8(texts)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(texts))
        yield Block(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Byte spans of the words of a block; text i has words ``bounds[i]`` to ``bounds[i + 1]``."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    bounds: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word: polynomial over its bytes, then mixed."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, np.uint64)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, n), out=total[1:])
        spans = total[self.end] - total[self.start]
        return mix(spans * powers(_INVERSE, n)[self.start])


def words(block: Block, lower: bool = False) -> Words:
    data = _LOWER[block.data] if lower else block.data
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~_SPACE[data]
    starts = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    cuts = block.offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    starts[cuts] |= inside[1:-1][cuts]
    ends[cuts - 1] |= inside[1:-1][cuts - 1]
    start = np.flatnonzero(starts)
    return Words(data, start, np.flatnonzero(ends) + 1, np.searchsorted(start, block.offsets))


def windows(word_hashes: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """Hash of each run of ``width`` words that starts at a word; runs may cross texts."""
    n = len(word_hashes) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, seed, np.uint64)
    for k in range(width):
        out = (out ^ word_hashes[k:k + n]) * np.uint64(0xD6E8FEB86659FD93)
        out ^= out >> np.uint64(32)
    return mix(out)
