"""From raw documents to packed training sequences.

Five stages, each on all that the one before kept. A stage takes and returns the
columns of ``documents``; the last one returns packed pieces. Models are fitted
on the rows of a stage's own input that the held-out rule leaves for learning.

Rejected ids are taken out by an anti-join, so a row without id is never
rejected. Rows that repeat an id count as one document from the third stage on.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import language, packing, quality
from marketlens.llm.neardup import near_duplicates
from marketlens.llm.queries import language_model, quality_model
from marketlens.llm.substrings import remove_repeats
from marketlens.llm.words import table
from marketlens.session import shared_dir

MIN_LANGUAGE_SCORE = 0.4  # a text whose best language is less likely is undetermined


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    return docs.join(rejected.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without letters and those of no likely language go."""
    found = language.identify(docs, language_model(docs))
    return _without(docs, found.filter(
        (F.col("lang_pred") == language.UNDETERMINED) | (F.col("score") < MIN_LANGUAGE_SCORE)))


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts that the classifier takes for label 0 go."""
    scored = quality.score_quality(docs, quality_model(docs, table(spark, sf_dir, "labels")))
    return _without(docs, scored.filter("predicted = 0"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group the document of the smallest id stays."""
    left = _without(docs, near_duplicates(docs).filter(~F.col("kept")))
    return left.filter("doc_id is not null").dropDuplicates(["doc_id"]).unionByName(left.filter("doc_id is null"))


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that a document of a smaller id has; an emptied one stays, empty.

    White space outside of the passages stays, and a text without any is untouched.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    changed = remove_repeats(docs.select("doc_id", "text", F.struct(*others).alias("rest")), carry=["rest"], original=True)
    found = {"doc_id": F.col("doc_id"), "text": F.col("kept"), "n_chars": F.when(
        F.col("n_removed") > 0, F.length("kept").cast("long")).otherwise(F.col("rest.n_chars"))}
    return changed.select(*[found.get(c, F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("language", identify_languages),
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("repeated_passages", remove_repeated_passages),
    ("packing", pack_sequences),
]

ORACLE_SQL = None  # no stage is expressible in SQL; tests compare them with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark)}/pipeline-{uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
