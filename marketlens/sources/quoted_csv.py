"""CSV whose quoted fields hold line breaks, read in splits.

Whether a line break ends a record depends on the quotes before it. So a first pass
counts the quotes of every split of a file; sums over the splits before tell whether a
split starts inside a quoted field. Then every split is cut into records by itself, and
what crosses a border is put together: at most two pieces per split.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

WHOLE, HEAD, MIDDLE, TAIL = 0, 1, 2, 3


def lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, split, value): lines between line feeds, with the place of their split."""
    return spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"), "value")


def records(read: DataFrame) -> DataFrame:
    """(file, first, value): whole records; ``first`` marks a file's first one, its header."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    counted = read.groupBy("file", "split").agg(F.sum(quotes).alias("quotes"))
    starts, inside, last = {}, 0, None
    for row in sorted(counted.collect()):  # a row per split
        inside = inside if row.file == last else 0
        starts[row.file, row.split] = inside
        inside, last = (inside + row.quotes) % 2, row.file

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[str] = []
        place, within, opened, first = None, 0, False, False
        out: list[tuple] = []

        def flush() -> None:
            if held:  # the split ends inside a record
                out.append((*place, MIDDLE if opened else TAIL, first, "\n".join(held)))
                held.clear()

        for batch in batches:
            for file, split, value in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if (file, split) != place:
                    flush()
                    place = (file, split)
                    within = starts[place]
                    opened, first = within == 1, split == 0
                held.append(value)
                within = (within + value.count('"')) % 2
                if not within:
                    out.append((*place, HEAD if opened else WHOLE, first, "\n".join(held)))
                    held.clear()
                    opened = first = False
            if out:
                yield _batch(out)
                out = []
        flush()
        if out:
            yield _batch(out)

    pieces = read.mapInArrow(cut, "file string, split long, kind int, first boolean, value string")
    # Pieces of one record: a tail, whole splits, a head. Few, so one file's lie together.
    number = F.count_if(F.col("kind") == TAIL).over(
        Window.partitionBy("file").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, 0))
    parts = F.sort_array(F.collect_list(F.struct("split", "kind", "value")))
    joined = pieces.filter(F.col("kind") != WHOLE).withColumn("number", number).groupBy("file", "number").agg(
        F.max("first").alias("first"), F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("value"))
    return pieces.filter(F.col("kind") == WHOLE).select("file", "first", "value").unionByName(joined.drop("number"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(zip(*rows), kinds)],
                                      names=["file", "split", "kind", "first", "value"])


def read_quoted_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """Rows of CSV files with a header, quotes doubled inside quoted fields; any file is read by several tasks.

    A quote may only stand around or, doubled, inside a quoted field, as every CSV writer
    does it. Blank lines between records are skipped.
    """
    found = records(lines(spark, path)).filter(~F.col("first"))
    value = F.regexp_replace("value", "\r$", "")
    row = F.from_csv(value, schema.simpleString()[len("struct<"):-1].replace(":", " "), {"escape": '"'})
    return found.filter(F.trim(value) != "").select(row.alias("row")).select("row.*")
