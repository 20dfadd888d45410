from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pytest

from marketlens.operators import topic_model, topics
from marketlens.session import materialize


def test_gamma_functions():
    x = np.array([0.01, 0.25, 0.5, 1.0, 1.7, 5.9, 6.0, 6.1, 40.0, 1e4, 1e8])
    assert topic_model.log_gamma(x) == pytest.approx([math.lgamma(v) for v in x], rel=1e-11, abs=1e-11)
    step = 1e-5 * np.maximum(x, 1) * np.minimum(x, 1)
    slope = [(math.lgamma(v + h) - math.lgamma(v - h)) / (2 * h) for v, h in zip(x, step)]
    assert topic_model.digamma(x) == pytest.approx(slope, rel=1e-4, abs=1e-6)
    harmonic = [-0.5772156649015329 + sum(1 / i for i in range(1, n)) for n in (1, 2, 7, 30)]
    assert topic_model.digamma(np.array([1.0, 2, 7, 30])) == pytest.approx(harmonic, abs=1e-12)


def naive_settle(counts, known, prior, steps=topic_model.STEPS):
    """Document by document, on a dense row of counts."""
    out = []
    for row in counts:
        weights = np.ones(known.shape[1])
        for _ in range(steps):
            share = np.exp(topic_model.expected_logs(weights[None])[0])
            new = prior + share * ((row / (known @ share + topic_model.TINY)) @ known)
            settled = np.abs(new - weights).mean() <= topic_model.SETTLED
            weights = new
            if settled:
                break
        out.append(weights)
    return np.array(out)


def corpus(rng, documents=120, terms=30, topics_=3):
    mixture = rng.dirichlet([0.2] * topics_, documents)
    words = np.zeros((topics_, terms))
    for k in range(topics_):
        words[k, k * 10:(k + 1) * 10] = rng.dirichlet([1.0] * 10)
    counts = np.array([rng.multinomial(rng.integers(5, 60), m @ words) for m in mixture])
    return mixture, counts[:, counts.sum(0) > 0]


def bags(spark, counts):
    doc, term = np.nonzero(counts)
    data = pd.DataFrame({"document": doc * 10, "term_id": term, "count": counts[doc, term]})
    return materialize(spark.createDataFrame(data.sample(frac=1, random_state=1)), "test-bags")


def test_rounds_equal_a_dense_computation_and_the_bound_rises(spark):
    mixture, counts = corpus(np.random.default_rng(0))
    table, prior = bags(spark, counts), 1 / 3
    start = topic_model.fit_topics(table, 3, rounds=1)
    assert len(start.bounds) == 1
    # The first round's weights, from the seeded ones.
    model = topic_model.fit_topics(table, 3, rounds=8)
    assert len(model.bounds) >= 5 and all(b >= a for a, b in zip(model.bounds, model.bounds[1:]))

    def matrix(m):
        return m.words.orderBy("term_id").toPandas()[["w0", "w1", "w2"]].to_numpy()
    words = matrix(start)
    two = topic_model.fit_topics(table, 3, rounds=2)
    known = np.exp(topic_model.digamma(words) - topic_model.digamma(words.sum(0))[None])
    weights = naive_settle(counts, known, prior)
    share = np.exp(topic_model.expected_logs(weights))
    normal = share @ known.T + topic_model.TINY
    assert matrix(two) == pytest.approx(prior + known * ((counts / normal).T @ share), rel=1e-9)
    got = topic_model.document_weights(table, start).orderBy("document").toPandas()
    assert np.array(got["topic_weights"].tolist()) == pytest.approx(weights / weights.sum(1)[:, None], rel=1e-9)
    # Planted topics are found: each topic's words, and most documents' main topic.
    model = topic_model.fit_topics(table, 3)
    heavy = matrix(model).argmax(1)
    groups = [set(heavy[i * 10:(i + 1) * 10]) for i in range(3)]
    assert sum(len(g) for g in groups) <= 5
    names = [max(g, key=list(heavy[i * 10:(i + 1) * 10]).count) for i, g in enumerate(groups)]
    got = np.array(topic_model.document_weights(table, model).orderBy("document").toPandas()["topic_weights"].tolist())
    agreed = got.argmax(1) == np.array(names)[mixture.argmax(1)]
    assert sorted(names) == [0, 1, 2] and agreed.mean() > 0.85


def test_documents_are_settled_alike_in_chunks_of_any_size(monkeypatch):
    _, counts = corpus(np.random.default_rng(3), documents=90)
    known = np.random.default_rng(4).dirichlet([0.3] * counts.shape[1], 3).T
    doc, term = np.nonzero(counts)
    expected = naive_settle(counts, known, 1 / 3)
    for rows in (1, 7, 100, 1 << 17):
        monkeypatch.setattr(topic_model, "CHUNK_ROWS", rows)
        assert topic_model.settle(doc, counts[doc, term].astype(float), known[term], 1 / 3) == pytest.approx(expected, rel=1e-9)


def test_a_block_is_one_row_that_fit_and_weights_share(spark):
    _, counts = corpus(np.random.default_rng(5))
    table = bags(spark, counts)
    blocks = topic_model.in_blocks(table)
    rows = blocks.packed.collect()
    assert len(rows) == len({r.block for r in rows}) <= blocks.count
    assert sorted(d for r in rows for d in r.documents) == [i * 10 for i in range(len(counts)) if counts[i].any()]
    assert sum(np.frombuffer(r.counts, np.int64).sum() for r in rows) == counts.sum()
    model, same = topic_model.fit_topics(blocks, 3, rounds=3), topic_model.fit_topics(table, 3, rounds=3)
    assert model.bounds == pytest.approx(same.bounds, rel=1e-12)
    got, expected = (topic_model.document_weights(b, model).orderBy("document").collect() for b in (blocks, table))
    assert [r.document for r in got] == [r.document for r in expected]
    assert np.array([r.topic_weights for r in got]) == pytest.approx(np.array([r.topic_weights for r in expected]), rel=1e-9)


def test_index_and_vectors(spark):
    df = spark.createDataFrame([(1, "bb aa bb"), (2, "cc"), (3, ""), (4, None), (5, "aa zz")], "document long, t string")
    index = topics.term_index(topics.vocabulary(df, "t", max_df=1.0).filter("term <> 'zz'"))
    assert {r.term: r.term_id for r in index.collect()} == {"aa": 0, "bb": 1, "cc": 2}
    bags_ = topics.bag_of_words(df, "t", index)
    assert sorted(tuple(r) for r in bags_.collect()) == [(1, 0, 1), (1, 1, 2), (2, 2, 1), (5, 0, 1)]
    vectors = {r.document: (r.term_ids, r.term_counts) for r in topics.vectorize(df, bags_).collect()}
    assert vectors == {1: ([0, 1], [1, 2]), 2: ([2], [1]), 3: ([], []), 4: ([], []), 5: ([0], [1])}
