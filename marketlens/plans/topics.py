"""Review subset to topics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.functions.text import normalize_ascii, normalize_unicode, remove_stopwords
from marketlens.operators import reviews, topic_model, topics
from marketlens.rules import BAD_TOPICS, GOOD_TOPICS, NEUTRAL_TOPICS, TopicRules
from marketlens.session import materialize
from marketlens.sources.tables import Lake


@dataclass(frozen=True)
class TopicResult:
    """Documents with their topic, and the words and shares of the topics."""

    documents: DataFrame
    top_words: DataFrame
    distribution: DataFrame


def complaint_text(stop_words: Sequence[str], text: str = reviews.TEXT) -> Column:
    """Text preparation of bad and neutral reviews."""
    return remove_stopwords(normalize_ascii(F.col(text)), stop_words)


def praise_text(text: str = reviews.TEXT) -> Column:
    """Text preparation of good reviews; stop words go at the vectorizer."""
    return normalize_unicode(F.col(text))


def find_topics(comments: DataFrame, text: Column, rules: TopicRules, seed: int = 42) -> TopicResult:
    """Fit a topic model on prepared comments and label every comment."""
    prepared = materialize(reviews.with_clean_text(comments, text).withColumn(
        "_document", F.monotonically_increasing_id()), "topic-text")
    index = topics.term_index(topics.vocabulary(
        prepared, "cleaned", rules.min_df, rules.max_df, rules.stop_words, rules.max_features))
    index = materialize(index, "topic-terms")
    if index.isEmpty():
        raise ValueError("no terms remain, lower min_df or raise max_df")
    bags = materialize(topics.bag_of_words(
        prepared, "cleaned", index, rules.stop_words, "_document").withColumnRenamed("_document", "document"), "topic-bags")
    blocks = topic_model.in_blocks(bags)
    model = topic_model.fit_topics(blocks, rules.topics, seed)
    weights = topic_model.document_weights(blocks, model).withColumnRenamed("document", "_document")
    even = F.array(*[F.lit(1.0 / rules.topics)] * rules.topics)  # a comment without terms leans to no topic
    weighted = prepared.join(weights, "_document", "left").drop("_document").withColumn(
        "topic_weights", F.coalesce("topic_weights", even))
    documents = materialize(topics.dominant_topic(weighted), "topic-documents")
    return TopicResult(
        documents,
        topic_model.top_words(model, index),
        topics.topic_distribution(documents, rules.names),
    )


def run_topics(lake: Lake, seed: int = 42) -> dict[str, int]:
    """Fit one model per stored review subset; store documents, top words and shares of each."""
    staged = lake.read("staging", "reviews_cleaned")
    stop_words = topics.portuguese_stop_words()
    praise = replace(GOOD_TOPICS, stop_words=tuple(topics.shopping_stop_words()))
    jobs = {
        "bad": (lake.read("warehouse", "nlp_bad_review"), complaint_text(stop_words), BAD_TOPICS),
        "neutral": (reviews.neutral_reviews(staged), complaint_text(stop_words), NEUTRAL_TOPICS),
        "good": (lake.read("warehouse", "nlp_good_review"), praise_text(), praise),
    }
    counts = {}
    for subset, (comments, text, rules) in jobs.items():
        found = find_topics(comments, text, rules, seed)
        parts = {"documents": found.documents.drop("topic_weights"), "words": found.top_words,
                 "shares": topics.topic_ranking(found.distribution)}
        for part, df in parts.items():
            counts[f"topics_{subset}_{part}"] = lake.write(df, "warehouse", f"topics_{subset}_{part}")
    return counts
