"""Document fingerprints by I-Match, in DataFrame functions only.

Terms count by the share of texts that hold them. The lexicon keeps the terms
whose inverse document frequency lies in a band; its upper end bounds the
lexicon: as a text has d distinct terms on average, at most d / MIN_SHARE terms
occur in a share of MIN_SHARE of the texts. Terms are known by their 64-bit hash.

Each of several randomised lexicon subsets keeps a fixed, hash-chosen part of the
lexicon, the parts getting thinner, so that short and long texts each have
subsets that hold a handful of their terms. Only those speak for a text: a
subset's hash covers the text's 1 to MOST terms in it, sorted. A text for which no
subset speaks has the hash of all its terms instead, so that only texts without
terms are silent. The likeness of two fingerprints is the share of equal hashes
among the subsets that speak for either.

A fingerprint has these hashes twice, of the terms in the lexicon and of all terms.
The latter are compared where a text has at most MOST lexicon terms, as texts of a
rare language or source have, the former elsewhere.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.words import configure
from marketlens.session import materialize

MIN_SHARE, MAX_SHARE = 1 / 128, 1 / 4   # of texts that hold a lexicon term
# One in so many lexicon terms belongs to each subset.
SUBSETS = (1, 2, 2, 4, 4, 4, 8, 8, 8, 16, 16, 16)
# Thinner subsets are drawn from PARTS parts of one in PART terms, so that the long list of terms is read less often.
PARTS, PART = 3, 16
THINNER = tuple(1 << i for i in range(5, 17))
HASHES = len(SUBSETS) + PARTS * len(THINNER) + 1
MOST = 4
EMPTY = "-" * 16
SPLITS = 64                             # runs of ids per 64 shuffle partitions, at least


def terms(text: Column) -> Column:
    """Hashes of the distinct terms, sorted: runs of letters and digits, lower-cased."""
    found = F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.xxhash64(t))
    return F.sort_array(F.array_distinct(F.array_remove(found, F.xxhash64(F.lit("")))))


def lexicon(texts: DataFrame, low: float = MIN_SHARE, high: float = MAX_SHARE) -> DataFrame:
    """One row: the sorted array of term hashes in the band, over all texts with a term."""
    held = texts.select(F.explode(terms(F.col("text"))).alias("term"))
    total = texts.filter(F.col("text").rlike(r"[\p{L}\p{N}]")).agg(F.count("*").alias("total"))
    counted = held.groupBy("term").agg(F.count("*").alias("n"))
    share = F.col("n") / F.col("total")
    kept = counted.withColumn("total", total.scalar()).filter((share >= low) & (share <= high))
    return kept.agg(F.sort_array(F.collect_list("term")).alias("lexicon"))


def subset_hashes(found: Column, every: Column) -> Column:
    """Array of one hash per subset, and of the one for texts for which no subset speaks."""
    def digits(part: Column) -> Column:
        return F.lpad(F.lower(F.hex(part)), 16, "0")

    def drawn(terms: Column, i: int, thin: int) -> Column:
        return F.filter(terms, lambda t: F.pmod(F.xxhash64(t, F.lit(i)), F.lit(thin)) == 0)

    def bound(value: Column, use) -> Column:
        """``use(value)``, the value made once."""
        return F.transform(F.array(value), use)[0]

    def own(terms: Column, i: int, thin: int) -> Column:
        return bound(drawn(terms, i, thin), lambda x: F.when(
            F.size(x).between(1, MOST), digits(F.xxhash64(x))).otherwise(F.lit(EMPTY)))

    def thinner(j: int) -> Column:
        first = len(SUBSETS) + PARTS + j * len(THINNER)
        return bound(drawn(found, len(SUBSETS) + j, PART), lambda part: F.array(*[
            own(part, first + i, thin // PART) for i, thin in enumerate(THINNER)]))

    hashes = F.concat(F.array(*[own(found, i, thin) for i, thin in enumerate(SUBSETS)]), *map(thinner, range(PARTS)))
    return bound(hashes, lambda said: F.concat(said, F.array(F.when(
        F.forall(said, lambda h: h == EMPTY) & every.isNotNull(), digits(every)).otherwise(F.lit(EMPTY)))))


def few(hashes: Column) -> Column:
    """Whether the lexicon subsets say too little: 0 to MOST lexicon terms, or so many that none speaks."""
    return (hashes[0] != EMPTY) | F.forall(F.slice(hashes, 1, HASHES - 1), lambda h: h == EMPTY)


def likeness(x: Column, y: Column) -> Column:
    """Share of equal hashes among the subsets that speak for either text; two silent ones are alike."""
    def share(start: int) -> Column:
        pairs = F.arrays_zip(F.slice(x, start, HASHES).alias("x"), F.slice(y, start, HASHES).alias("y"))
        said = F.filter(pairs, lambda p: (p["x"] != EMPTY) | (p["y"] != EMPTY))
        same = F.filter(said, lambda p: p["x"] == p["y"])
        return F.when(F.size(said) == 0, F.lit(1.0)).otherwise(F.size(same) / F.size(said))
    return F.when(few(x) | few(y), share(HASHES + 1)).otherwise(share(1))


def with_next(df: DataFrame) -> DataFrame:
    """(doc_id, text, text_hashes) with next_text and next_text_hashes: those of the next id, and of the first after the last.

    Ids are dealt into runs between sampled ids, so that each run is sorted by
    itself; a run's first row is also sent to the run before, to follow its last.
    Rows of one id follow by text; rows without id come after all others.
    """
    spark = df.sparkSession
    keyed = df.withColumn("order", F.coalesce(F.col("doc_id"), F.lit((1 << 63) - 1)))
    runs = max(SPLITS, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    edges = keyed.select("order").agg(F.min("order").alias("low"), F.percentile_approx(
        "order", [i / runs for i in range(1, runs)], 10_000).alias("cuts")).first()
    cuts = sorted({edges.low, *edges.cuts}) if edges.low is not None else [0]

    def among(starts: list[int]) -> Column:
        return F.size(F.filter(F.array(*[F.lit(s) for s in starts]), lambda s: s <= F.col("order")))

    # Cuts are doubles within: each run begins with its smallest id, and runs without rows go. At most ``runs`` ids.
    lows = keyed.groupBy(among(cuts).alias("run")).agg(F.min("order").alias("low")).collect()
    starts = sorted(r.low for r in lows) or [0]
    run = among(starts)
    own = keyed.withColumn("run", run).withColumn("guest", F.lit(0))
    columns = ["order", "text", "text_hashes"]
    heads = (own.filter(F.col("order").isin(starts)).groupBy("run").agg(F.min(F.struct(*columns)).alias("head"))
             .select("head.*", "run").select(
                 F.lit(None).cast("long").alias("doc_id"), *columns,
                 F.when(F.col("run") == 1, len(starts)).otherwise(F.col("run") - 1).alias("run"),
                 F.lit(1).alias("guest")))
    following = Window.partitionBy("run").orderBy("guest", "order", "text")
    return (own.select("doc_id", *columns, "run", "guest").unionByName(heads)
            .withColumns({f"next_{c}": F.lead(c).over(following) for c in ("text", "text_hashes")})
            .filter("guest = 0").drop("order", "run", "guest"))


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_chars, edited, fingerprint, edited_fingerprint, near_edited, near_next.

    ``edited`` is the text whose last quarter of characters is replaced by the
    first as many of the next document. Null reads as the empty text; its
    fingerprint has no hash, and two such are alike. Equal texts have equal
    fingerprints. Repeated rows get a result each; rows without id come last.
    Other columns are not read. The lexicon is counted over all texts.
    """
    configure(df.sparkSession)
    texts = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                      F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    kept = materialize(lexicon(texts), "lexicon")

    def hashed(df: DataFrame, name: str) -> DataFrame:
        every = F.when(F.size("terms") > 0, F.xxhash64("terms"))
        return (df.withColumn("lexicon", kept.scalar()).withColumn("terms", terms(F.col(name)))
                .withColumn("every", every)
                .withColumn("found", F.array_intersect("terms", "lexicon"))
                .withColumn(f"{name}_hashes", F.concat(*[
                    subset_hashes(F.col(part), F.col("every")) for part in ("found", "terms")]))
                .drop("lexicon", "terms", "every", "found"))

    texts = hashed(texts, "text")
    rows = with_next(texts).withColumn("n_chars", F.length("text").cast("long"))
    quarter = F.floor(F.col("n_chars") / 4).cast("int")
    rows = rows.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - quarter),
        F.substring(F.coalesce(F.col("next_text"), F.lit("")), F.lit(1), quarter)))
    silent = F.array(*[F.lit(EMPTY)] * (2 * HASHES))
    rows = hashed(rows, "edited").withColumn("next_hashes", F.coalesce("next_text_hashes", silent))
    return rows.select(
        "doc_id", "n_chars", "edited",
        F.array_join("text_hashes", ".").alias("fingerprint"),
        F.array_join("edited_hashes", ".").alias("edited_fingerprint"),
        likeness(F.col("text_hashes"), F.col("edited_hashes")).alias("near_edited"),
        likeness(F.col("text_hashes"), F.col("next_hashes")).alias("near_next"))
