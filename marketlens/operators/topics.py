"""Word counts, bags of words and topic shares over prepared text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType

from marketlens.functions.numbering import numbered
from marketlens.functions.text import model_tokens, tokens, without
from marketlens.rules import SHOPPING_STOP_WORDS


def portuguese_stop_words(extra: Sequence[str] = ()) -> list[str]:
    """Spark's Portuguese stop words plus ``extra`` (needs a running session)."""
    return [*StopWordsRemover.loadDefaultStopWords("portuguese"), *extra]


def shopping_stop_words() -> list[str]:
    return portuguese_stop_words(SHOPPING_STOP_WORDS)


def term_frequency(df: DataFrame, text: str) -> DataFrame:
    """Occurrences of every word in the corpus: (term, frequency)."""
    words = df.select(F.explode(tokens(F.col(text))).alias("term"))
    return words.groupBy("term").agg(F.count(F.lit(1)).alias("frequency"))


def top_terms(frequencies: DataFrame, count: int = 200) -> DataFrame:
    """The most frequent words, what a word cloud shows."""
    return frequencies.orderBy(F.desc("frequency"), "term").limit(count)


def vocabulary(
    df: DataFrame, text: str, min_df: float = 1, max_df: float = 1.0,
    stop_words: Sequence[str] = (), max_features: int | None = None,
) -> DataFrame:
    """Terms the model uses: (term, document_frequency, term_frequency).

    ``min_df`` and ``max_df`` are document counts from 1 upward when integers,
    shares of all documents when fractions. With ``max_features`` the most
    frequent terms are kept, ties in alphabetical order.
    """
    total = df.agg(F.count(F.lit(1))).scalar()

    def documents(bound: float):
        return F.lit(bound) if isinstance(bound, int) else F.lit(float(bound)) * total

    # In a document's sorted words, a word that differs from the one before it
    # is a first occurrence: one pass counts occurrences and documents.
    words = F.sort_array(without(model_tokens(F.col(text)), stop_words))
    marked = F.zip_with(
        words, F.concat(F.array(F.lit("")), words),
        lambda word, previous: F.struct(word.alias("term"), (word != previous).alias("first")),
    )
    terms = df.select(F.explode(marked).alias("w")).where("w.term is not null").groupBy("w.term").agg(
        F.count_if("w.first").alias("document_frequency"),
        F.count(F.lit(1)).alias("term_frequency"),
    ).where((F.col("document_frequency") >= documents(min_df))
            & (F.col("document_frequency") <= documents(max_df)))
    if max_features is not None:
        terms = terms.orderBy(F.desc("term_frequency"), "term").limit(max_features)
    return terms


def term_index(terms: DataFrame) -> DataFrame:
    """Terms with their number from 0, in alphabetical order: (term, ..., term_id)."""
    return numbered(terms, ["term"], "term_id")


def bag_of_words(
    df: DataFrame, text: str, index: DataFrame, stop_words: Sequence[str] = (), document: str = "document",
) -> DataFrame:
    """Occurrences of the indexed terms in every document: (document, term_id, count).

    A document without indexed terms has no rows. Words are counted before they meet the
    index, so a frequent word is one row per document.
    """
    words = df.select(document, F.explode(without(model_tokens(F.col(text)), stop_words)).alias("term"))
    counted = words.groupBy(document, "term").agg(F.count(F.lit(1)).alias("count"))
    return counted.join(index.select("term", "term_id"), "term").select(document, "term_id", "count")


def vectorize(df: DataFrame, bags: DataFrame, document: str = "document") -> DataFrame:
    """Add the sparse vector of each document: ``term_ids``, rising, and ``term_counts``; empty without terms."""
    entries = F.sort_array(F.collect_list(F.struct("term_id", "count")))
    found = bags.groupBy(document).agg(entries.alias("_entries"))

    def part(name: str, kind: str):
        return F.coalesce(F.col(f"_entries.{name}"), F.array().cast(f"array<{kind}>"))

    return df.join(found, document, "left").withColumns(
        {"term_ids": part("term_id", "bigint"), "term_counts": part("count", "bigint")}).drop("_entries")


def dominant_topic(weighted: DataFrame, weights: str = "topic_weights") -> DataFrame:
    """Add the heaviest topic, from 1; the first one on ties and for empty text. Weights are an array or a vector."""
    kind = weighted.schema[weights].dataType
    array = F.col(weights) if isinstance(kind, ArrayType) else vector_to_array(F.col(weights))
    return weighted.withColumn(
        "dominant_topic", F.array_position(array, F.array_max(array)).cast("int")
    )


def topic_distribution(
    df: DataFrame, names: Mapping[int, str], topic: str = "dominant_topic",
) -> DataFrame:
    """Documents and percentage per topic, with its name where one is known."""
    counts = df.groupBy(F.col(topic).cast("int").alias("topic_number")).agg(
        F.count(F.lit(1)).alias("count")
    )
    total = df.agg(F.count(F.lit(1))).scalar()
    named = F.lit(None).cast("string")
    for number, name in names.items():
        named = F.when(F.col("topic_number") == number, name).otherwise(named)
    share = F.round((F.col("count") * 100.0 / total).cast("decimal(18,6)"), 2).cast("double")
    return counts.select("topic_number", "count", share.alias("percentage"),
                         named.alias("topic_name"))


def topic_ranking(distribution: DataFrame) -> DataFrame:
    """Topics by falling share, with their place."""
    return distribution.orderBy(F.desc("percentage"), "topic_number")
