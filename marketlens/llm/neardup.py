"""Near-duplicate groups by MinHash and a multi-index Hamming join.

A text's signature has 64 values of 16 bits, one minimum hash each. Two texts of
Jaccard similarity s differ in about 64 * (1 - s) values: 16 at 0.75, and more
than 31 with probability about 2e-5. Pairs that differ in at most 31 of 64 values
are found without exception: the signature is split into 16 chunks of 4 values,
so by pigeonhole some chunk differs in at most one value, and each chunk is
entered four times, each time with one value left open. Every link is then
confirmed on the full shingle sets.

Nothing emits the pairs of a bucket. Equal texts are one class from the start.
A text is first held against one centre of its buckets; what that connects needs
no further pairs. Where a bucket still holds several components, near signatures
between them name the families in which a link may be missing, and a family is
settled on full sets, in blocks of bounded size. A block hands on only as many
pairs as join its components.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import blocks, configure, keyed_texts, map_batches, mix, windows, words
from marketlens.session import materialize

SLOTS, CHUNKS = 64, 16
MAX_DIFFERING = 31
BLOCK_ROWS = 1_500       # members of a bucket in one block
BLOCK_BYTES = 4 << 20    # bytes of sets of a family in one block
CHUNK_COLUMNS = [f"s{c}" for c in range(CHUNKS)]
SCHEMA = "doc_id long, class_a long, class_b long, n_shingles long, " + ", ".join(
    f"{c} long" for c in CHUNK_COLUMNS)

_XOR = mix(np.arange(1, SLOTS + 1, dtype=np.uint64))
_ODD = mix(np.arange(1001, SLOTS + 1001, dtype=np.uint64)) | np.uint64(1)


def shingle_set(hashes: np.ndarray, shingle: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text; a short text is one shingle."""
    if not len(hashes):
        return hashes
    return np.unique(windows(hashes, min(shingle, len(hashes))))


def minima(items: np.ndarray) -> np.ndarray:
    """The 64 minimum hashes of a set, as 16 longs of 4 values of 16 bits."""
    low = np.full(SLOTS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(items), 2048):
        part = items[at:at + 2048, None]
        np.minimum(low, ((part ^ _XOR) * _ODD).min(axis=0), out=low)
    return (mix(low) >> np.uint64(48)).astype("<u2").view("<i8")


def signatures(df: DataFrame, shingle: int = 5) -> DataFrame:
    """Class (128-bit hash of the word sequence), set size and signature per row."""

    def build(batch: pa.RecordBatch) -> dict:
        n = batch.num_rows
        size, classes = np.zeros(n, np.int64), np.zeros((n, 2), np.int64)
        sig = np.zeros((n, CHUNKS), np.int64)
        for block in blocks(batch.column(1)):
            found = words(block, lower=True)
            hashes = found.hashes()
            for i in range(block.size):
                own = hashes[found.bounds[i]:found.bounds[i + 1]]
                if len(own):
                    row = block.first + i
                    place = np.arange(1, len(own) + 1, dtype=np.uint64)
                    classes[row, 0] = mix(own ^ mix(place)).sum().astype(np.int64)
                    classes[row, 1] = mix(own + mix(~place)).sum().astype(np.int64)
                    items = shingle_set(own, shingle)
                    size[row], sig[row] = len(items), minima(items)
        return {"doc_id": batch.column(0), "class_a": classes[:, 0], "class_b": classes[:, 1],
                "n_shingles": size, **{c: np.ascontiguousarray(sig[:, k]) for k, c in enumerate(CHUNK_COLUMNS)}}

    return map_batches(df, build, SCHEMA)


def shingle_sets(df: DataFrame, shingle: int = 5) -> DataFrame:
    """The full set of each text, as sorted little-endian hashes in one binary value."""

    def build(batch: pa.RecordBatch) -> dict:
        out = []
        for block in blocks(batch.column(1)):
            found = words(block, lower=True)
            hashes = found.hashes()
            out += [shingle_set(hashes[found.bounds[i]:found.bounds[i + 1]], shingle).tobytes()
                    for i in range(block.size)]
        return {"doc_id": batch.column(0), "items": out}

    return map_batches(df, build, "doc_id long, items binary")


def chunk_keys(reps: DataFrame) -> DataFrame:
    """(slot, key, doc_id): every chunk with each of its four values left open in turn."""
    masks = np.array([0xFFFF << 16 * w for w in range(4)], np.uint64)
    lanes = [F.lit(int(m)) for m in (~masks).view(np.int64)]
    entries = [F.struct(F.lit(4 * c + w).cast("int").alias("slot"),
                        F.col(name).bitwiseAND(lanes[w]).alias("key"))
               for c, name in enumerate(CHUNK_COLUMNS) for w in range(4)]
    return reps.select("doc_id", F.explode(F.array(*entries)).alias("e")).select("e.slot", "e.key", "doc_id")


def differing(left: str, right: str) -> Column:
    """In how many of the 64 values two signatures differ."""
    def lanes(x: Column) -> Column:
        return reduce(Column.__add__, [
            (F.shiftrightunsigned(x, 16 * k).bitwiseAND(F.lit(0xFFFF)) != 0).cast("int") for k in range(4)])
    return reduce(Column.__add__, [
        lanes(F.col(f"{left}.{c}").bitwiseXOR(F.col(f"{right}.{c}"))) for c in CHUNK_COLUMNS])


def near_signatures(pairs: DataFrame, reps: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures are near enough, with their distance."""
    sig = F.struct(*CHUNK_COLUMNS)
    left = reps.select(F.col("doc_id").alias("a"), sig.alias("x"))
    right = reps.select(F.col("doc_id").alias("b"), sig.alias("y"))
    return (pairs.join(left, "a").join(right, "b")
            .select("a", "b", differing("x", "y").alias("apart"))
            .filter(F.col("apart") <= MAX_DIFFERING))


def confirmed(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Pairs whose full sets have 100 * intersection >= percent * union."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sets = materialize(shingle_sets(texts.join(wanted, "doc_id", "left_semi"), shingle)
                       .dropDuplicates(["doc_id"]), "shingle-sets")

    def build(batch: pa.RecordBatch) -> dict:
        keep = np.zeros(batch.num_rows, bool)
        left, right = batch.column(2), batch.column(3)
        for i in range(batch.num_rows):
            x = np.frombuffer(left[i].as_buffer(), "<u8")
            y = np.frombuffer(right[i].as_buffer(), "<u8")
            both = len(x) + len(y) - len(np.union1d(x, y))
            keep[i] = 100 * both >= percent * (len(x) + len(y) - both)
        mask = pa.array(keep)
        return {"a": batch.column(0).filter(mask), "b": batch.column(1).filter(mask)}

    both = (pairs.select("a", "b")
            .join(sets.select(F.col("doc_id").alias("a"), F.col("items").alias("x")), "a")
            .join(sets.select(F.col("doc_id").alias("b"), F.col("items").alias("y")), "b")
            .select("a", "b", "x", "y"))
    return map_batches(both, build, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc_id, component_id): the smallest id reachable over ``links`` (a, b).

    Each round takes the smallest label among the neighbours and then that
    label's own label, so chains halve; every round is a written table.
    """
    both = materialize(links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = materialize(both.groupBy(F.col("a").alias("doc_id")).agg(
        F.least(F.min("b"), F.col("a")).alias("component_id")), "labels")
    while True:
        offered = (both.join(labels.select(F.col("doc_id").alias("b"), "component_id"), "b")
                   .groupBy(F.col("a").alias("doc_id")).agg(F.min("component_id").alias("offer")))
        nearer = labels.join(offered, "doc_id").select(
            "doc_id", F.col("component_id").alias("old"), F.least("component_id", "offer").alias("new"))
        roots = labels.select(F.col("doc_id").alias("new"), F.col("component_id").alias("root"))
        step = materialize(nearer.join(roots, "new", "left").select(
            "doc_id", "old", F.least("new", "root").alias("component_id")), "labels")
        moved = step.filter(F.col("old") != F.col("component_id")).limit(1).count()
        labels = step.select("doc_id", "component_id")
        if not moved:
            return labels


def _whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Cut sorted batches so that every one handed on ends with the end of a group."""
    held = None
    for batch in batches:
        if held is not None:
            batch = pa.concat_batches([held, batch])
        if not batch.num_rows:
            continue
        marks = np.stack([batch[k].to_numpy() for k in keys])
        last = int(np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)])[-1])
        held = batch.slice(last)
        if last:
            yield batch.slice(0, last)
    if held is not None:
        yield held


def _starts(batch: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    marks = np.stack([batch[k].to_numpy() for k in keys])
    return np.r_[np.flatnonzero(np.r_[True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)]), batch.num_rows]


def _forest(rows: np.ndarray, label: np.ndarray, near) -> list[tuple[int, int]]:
    """Pairs of ``near`` that join different labels, none twice; ``label`` is merged along."""
    out = []
    for i in rows:
        other = near(i)
        other = other[label[other] != label[i]]
        if len(other):
            met, first = np.unique(label[other], return_index=True)
            out += [(i, j) for j in other[first]]
            label[np.isin(label, met)] = label[i]
    return out


def _pairs(ids: np.ndarray, pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    at = np.array(pairs, np.int64).reshape(-1, 2)
    x, y = ids[at[:, 0]], ids[at[:, 1]]
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


def open_pairs(members: DataFrame) -> DataFrame:
    """Pairs of near signatures that join the different components of a bucket.

    All pairs of a bucket are looked at, but only as many leave it as join its
    components: no pair of near signatures is outside the groups they form.
    A bucket is dealt into blocks of BLOCK_ROWS; each pair of blocks is one group.
    """
    keys = ["slot", "key", "p", "q"]
    dealt = (members.withColumn("blocks", F.ceil(F.col("n") / BLOCK_ROWS).cast("int"))
             .withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks").cast("long")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))
             .select(*keys, "own", "doc_id", "component_id", *CHUNK_COLUMNS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches, keys):
            ids, comp = batch["doc_id"].to_numpy(), batch["component_id"].to_numpy()
            sig = np.ascontiguousarray(np.stack([batch[c].to_numpy() for c in CHUNK_COLUMNS], axis=1)).view("<u2")
            own, p, q = (batch[c].to_numpy() for c in ("own", "p", "q"))
            pairs = []
            starts = _starts(batch, keys)
            for start, end in zip(starts[:-1], starts[1:]):
                label, sigs = comp[start:end].copy(), sig[start:end]
                right = np.flatnonzero(own[start:end] == q[start])

                def near(i: int, label=label, sigs=sigs, right=right) -> np.ndarray:
                    rest = right[label[right] != label[i]]
                    return rest[(sigs[rest] != sigs[i]).sum(axis=1) <= MAX_DIFFERING]

                left = np.flatnonzero(own[start:end] == p[start])
                pairs += [(start + i, start + j) for i, j in _forest(left, label, near)]
            yield _pairs(ids, pairs)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def family_links(members: DataFrame, percent: int) -> DataFrame:
    """Links between the components of a family: (family, component_id, doc_id, items), exactly.

    Every text outside the largest component is compared with the whole family on
    full sets. Families are dealt into blocks of about BLOCK_BYTES of sets, and as
    many links leave a pair of blocks as join its components.
    """
    keys = ["family", "p", "q"]
    size = F.sum(F.octet_length("items"))
    parts = members.groupBy("family", "component_id").agg(size.alias("bytes"))
    plan = parts.groupBy("family").agg(
        F.sum("bytes").alias("total"), F.max(F.struct("bytes", "component_id")).alias("main"))

    def count(x: Column) -> Column:
        return F.greatest(F.lit(1), F.ceil(x / BLOCK_BYTES)).cast("int")

    dealt = (members.join(plan, "family")
             .withColumn("others", count(F.col("total") - F.col("main.bytes")))
             .withColumn("mains", count(F.col("main.bytes")))
             .withColumn("is_main", F.col("component_id") == F.col("main.component_id"))
             .withColumn("h", F.xxhash64("doc_id"))
             .withColumn("own", F.when(F.col("is_main"), F.col("others") + F.expr("pmod(h, mains)"))
                         .otherwise(F.expr("pmod(h, others)")).cast("int"))
             .withColumn("last", F.when(F.col("is_main"), F.col("others"))
                         .otherwise(F.col("others") + F.col("mains")) - 1)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
             .withColumn("p", F.least("own", "other")).withColumn("q", F.greatest("own", "other"))
             .select(*keys, "own", "doc_id", "component_id", "items"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_groups(batches, keys):
            ids, comp = batch["doc_id"].to_numpy(), batch["component_id"].to_numpy()
            own, p, q = (batch[c].to_numpy() for c in ("own", "p", "q"))
            sets, pairs = batch["items"], []
            starts = _starts(batch, keys)
            for start, end in zip(starts[:-1], starts[1:]):
                label = comp[start:end].copy()
                items = [np.frombuffer(sets[i].as_buffer(), "<u8") for i in range(start, end)]
                right = np.flatnonzero(own[start:end] == q[start])
                if not len(right):
                    continue
                sizes = np.array([len(x) for x in items])
                every = np.concatenate([items[j] for j in right])
                holder = np.repeat(right, sizes[right])
                order = np.argsort(every, kind="stable")
                every, holder = every[order], holder[order]

                def near(i: int, items=items, sizes=sizes, every=every, holder=holder, right=right) -> np.ndarray:
                    low, high = np.searchsorted(every, items[i], "left"), np.searchsorted(every, items[i], "right")
                    width = high - low
                    at = np.repeat(low - np.r_[0, np.cumsum(width)[:-1]], width) + np.arange(width.sum())
                    both = np.bincount(holder[at], minlength=len(items))
                    return np.flatnonzero((both > 0) & (100 * both >= percent * (sizes + sizes[i] - both)))

                left = np.flatnonzero(own[start:end] == p[start])
                pairs += [(start + i, start + j) for i, j in _forest(left, label, near)]
            yield _pairs(ids, pairs)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 5, percent: int = 75) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Texts count by their words after A-Z are lower-cased. Two texts are linked when
    their sets of distinct ``shingle``-word runs have a Jaccard similarity of
    ``percent`` / 100 or more; ``component_id`` is the smallest id reachable, and
    ``kept`` marks the row that has it. A text of fewer words is one shingle.
    A text without words, and null, has no shingle, no link and itself as component.
    Repeated rows get equal results. A row without id takes no part in links:
    its component is null and it is kept. Other columns are not read.
    """
    spark = configure(df.sparkSession)
    texts = keyed_texts(df, id_col, text_col)
    rows = materialize(signatures(texts, shingle), "signatures")
    linked = rows.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    reps = materialize(linked.groupBy("class_a", "class_b").agg(
        F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in CHUNK_COLUMNS]), "representatives")

    keys = chunk_keys(reps)
    buckets = keys.groupBy("slot", "key").agg(
        F.min("doc_id").alias("centre"), F.count("*").alias("n")).filter("n > 1")
    members = materialize(keys.join(buckets, ["slot", "key"]), "buckets")
    # a text first tries the smallest member that it meets in most of its buckets
    stars = (members.filter("doc_id != centre").groupBy("doc_id", "centre").agg(F.count("*").alias("met"))
             .groupBy("doc_id").agg(F.max(F.struct("met", (-F.col("centre")).alias("minus"))).alias("best"))
             .select((-F.col("best.minus")).alias("a"), F.col("doc_id").alias("b")))
    nearest = materialize(near_signatures(stars, reps), "stars")
    links = materialize(confirmed(nearest, texts, shingle, percent), "links")
    first = components(links)

    labelled = members.join(first, "doc_id", "left").withColumn(
        "component_id", F.coalesce("component_id", "doc_id"))
    mixed = labelled.groupBy("slot", "key").agg(
        F.min("component_id").alias("low"), F.max("component_id").alias("high")).filter("low != high")
    open_members = labelled.join(mixed.select("slot", "key"), ["slot", "key"], "left_semi").join(reps, "doc_id")
    joins = materialize(open_pairs(open_members), "open-pairs")
    families = components(materialize(joins.unionByName(links), "family-links")).withColumnRenamed(
        "component_id", "family")
    unsettled = families.join(joins.select(F.col("a").alias("doc_id")), "doc_id", "left_semi").select("family").distinct()
    related = (families.join(unsettled, "family").join(first, "doc_id", "left")
               .select("family", F.coalesce("component_id", "doc_id").alias("component_id"), "doc_id"))
    sets = shingle_sets(texts.join(related.select("doc_id"), "doc_id", "left_semi"), shingle).dropDuplicates(["doc_id"])
    members_of = materialize(related.join(sets, "doc_id"), "families")
    more = materialize(family_links(members_of, percent), "links-across")
    groups = components(materialize(links.unionByName(more), "links"))

    classes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("class_a", "class_b").agg(
        F.min("doc_id").alias("rep"))
    named = classes.join(groups.select(F.col("doc_id").alias("rep"), "component_id"), "rep", "left").select(
        "class_a", "class_b", F.coalesce("component_id", "rep").alias("component_id"))
    return (rows.join(named, ["class_a", "class_b"], "left")
            .select("doc_id", "n_shingles",
                    F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component_id"))
                    .otherwise(F.col("doc_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
