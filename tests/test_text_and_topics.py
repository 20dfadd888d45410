from __future__ import annotations

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from marketlens.functions import text
from marketlens.operators import reviews, topics
from marketlens.plans.topics import complaint_text, find_topics, praise_text
from marketlens.rules import TopicRules


def applied(spark, fn, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(fn(F.col("v"))).collect()]


def test_ascii_text_loses_accents_digits_and_punctuation(spark):
    assert applied(spark, text.normalize_ascii, "Não chegou!! 2x\tVeio já", None, "") == [
        "no chegou x\tveio j", "", ""]
    # Text of any length is cleaned to its end.
    assert applied(spark, text.normalize_ascii, "1" * 5000 + "a") == ["a"]


def test_unicode_text_keeps_accents_and_underscores(spark):
    assert applied(spark, text.normalize_unicode, "Não_é BOM, nota 10!", None) == ["não_é bom nota ", ""]


def test_stop_words_go_and_blanks_collapse(spark):
    fn = lambda c: text.remove_stopwords(c, ["o", "a"])
    assert applied(spark, fn, "  o produto \n a  caixa o ", "", "o a") == ["produto caixa", "", ""]
    many = lambda c: text.remove_stopwords(c, [f"w{i}" for i in range(300)])
    assert applied(spark, many, "w1 keep w299 w300") == ["keep w300"]


def test_model_tokens(spark):
    assert applied(spark, text.model_tokens, "A não é o x1 foo_bar, ok") == [["não", "x1", "foo_bar", "ok"]]


def test_review_subsets_keep_empty_messages(spark):
    df = spark.createDataFrame([(1.0, ""), (2.0, None), (3.0, "x"), (5.0, "y"), (None, "z")],
                               "review_score double, review_comment_message string")
    assert reviews.bad_reviews(df).collect() == [(1.0, "")]
    assert reviews.neutral_reviews(df).count() == reviews.good_reviews(df).count() == 1
    assert tuple(reviews.subset_share(df).first()) == (5, 1, 20.0)
    kept = reviews.with_clean_text(df, F.col("review_comment_message"), drop_empty=True)
    assert kept.count() == 3


def test_vocabulary_counts_documents_and_occurrences(spark):
    df = spark.createDataFrame([("aa aa bb",), ("aa cc",), ("bb aa zz",), ("zz",)], "t string")
    out = {r.term: (r.document_frequency, r.term_frequency) for r in topics.vocabulary(df, "t").collect()}
    assert out == {"aa": (3, 4), "bb": (2, 2), "cc": (1, 1), "zz": (2, 2)}
    assert {r.term for r in topics.vocabulary(df, "t", min_df=2, max_df=0.5).collect()} == {"bb", "zz"}
    top = topics.vocabulary(df, "t", stop_words=["aa"], max_features=2).collect()
    assert [r.term for r in top] == ["bb", "zz"]


def test_term_frequency_and_top_terms(spark):
    df = spark.createDataFrame([("b a",), ("a  c",), ("",)], "t string")
    counts = topics.term_frequency(df, "t")
    assert [tuple(r) for r in topics.top_terms(counts, 2).collect()] == [("a", 2), ("b", 1)]


def test_dominant_topic_takes_the_first_on_ties(spark):
    df = spark.createDataFrame(
        [(1, Vectors.dense(0.2, 0.5, 0.3)), (2, Vectors.dense(0.0, 0.0, 0.0)), (3, Vectors.dense(0.1, 0.45, 0.45))],
        ["id", "topic_weights"])
    assert [r.dominant_topic for r in topics.dominant_topic(df).orderBy("id").collect()] == [2, 1, 2]


def test_topic_distribution_rounds_half_up_and_names_topics(spark):
    df = spark.createDataFrame([(1,)] * 5 + [(3,)] * 3, "dominant_topic int")
    out = topics.topic_distribution(df, {1: "late"})
    assert [tuple(r) for r in topics.topic_ranking(out).collect()] == [(1, 5, 62.5, "late"), (3, 3, 37.5, None)]


@pytest.fixture(scope="module")
def comments(spark):
    lines = ["produto quebrado caixa rasgada", "entrega atrasada prazo vencido", "", "qualidade muito ruim"]
    rows = [(float(i % 2 + 1), lines[i % 4]) for i in range(80)]
    return spark.createDataFrame(rows, "review_score double, review_comment_message string")


def test_topic_model_invariants(spark, comments):
    rules = TopicRules(topics=3, min_df=5, names={1: "one"})
    result = find_topics(comments, complaint_text(topics.portuguese_stop_words()), rules)
    docs = result.documents.collect()
    assert len(docs) == 80
    for row in docs:
        assert 1 <= row.dominant_topic <= 3
        assert sum(row.topic_weights) == pytest.approx(1.0)
        assert row.cleaned or row.dominant_topic == 1
    heavy = result.top_words.collect()
    assert {r.topic for r in heavy} == {1, 2, 3}
    for t in (1, 2, 3):
        weights = [r.weight for r in sorted(heavy, key=lambda r: r.position) if r.topic == t]
        assert weights == sorted(weights, reverse=True) and len(weights) == 10
    shares = result.distribution.collect()
    assert sum(r["count"] for r in shares) == 80
    assert {r.topic_name for r in shares if r.topic_number != 1} <= {None}


def test_praise_model_drops_shopping_words(spark):
    df = spark.createDataFrame([(5.0, f"produto lindo número {i}") for i in range(20)],
                               "review_score double, review_comment_message string")
    rules = TopicRules(topics=2, min_df=5, max_df=1.0, stop_words=tuple(topics.shopping_stop_words()),
                       max_features=2)
    words = {r.term for r in find_topics(df, praise_text(), rules).top_words.collect()}
    assert words == {"lindo", "número"}


def test_empty_vocabulary_is_an_error(spark, comments):
    with pytest.raises(ValueError, match="min_df"):
        find_topics(comments, praise_text(), TopicRules(topics=2, min_df=500))
