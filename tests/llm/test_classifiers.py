from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest

from marketlens.llm import language, quality, toxicity
from marketlens.llm.words import Block, blocks, words

EDGES = [(900, None), (901, ""), (902, "12 !!"), (903, "word " * 40_000), (904, "x" * 30_000), (None, "no id")]


def labels(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = ["▁", "▁a", "a", "b", "ab", "▁ab", "ba", "bab"]
    model = language.LanguageModel(["x", "y"], pieces, rng.uniform(0.01, 0.5, (len(pieces) + 1, 2)))
    for word in ("a", "ab", "abab", "bbba", "azb"):
        marked, total = "▁" + word, np.zeros(2)
        for cut in itertools.product([False, True], repeat=len(marked) - 1):
            ends = [i + 1 for i, c in enumerate(cut) if c] + [len(marked)]
            parts = [marked[a:b] for a, b in zip([0, *ends], ends)]
            p = np.ones(2)
            for part in parts:
                known = model.ids.get(part)
                p = p * (model.probs[known] if known is not None else model.probs[-1] if len(part) == 1 else 0)
            total += p
        assert model.log_likelihood([word])[0] == pytest.approx(np.log(total))
    twice = model.log_likelihood(["ab AB, a"])[0]
    assert twice == pytest.approx(2 * model.log_likelihood(["ab"])[0] + model.log_likelihood(["a"])[0])


def test_words_are_read_only_as_far_as_a_piece_goes_on(monkeypatch):
    asked, step = [], language.Trie.step

    def counted(self, nodes, letters):
        asked.append(len(nodes))
        return step(self, nodes, letters)
    monkeypatch.setattr(language.Trie, "step", counted)
    pieces = ["▁", "a", "▁a", "ab", "abab", "b" * 30, "é"]
    words = ["abab", "a" * 40, "zé\U00020000a", "ba"]
    lattice = language.Lattice(words, language.Trie(pieces), len(pieces))
    places = sum(map(len, words)) + len(words)
    assert asked[0] == places and sum(asked) < 3 * places  # and not once for every length up to 30
    want = []
    for row, word in enumerate("▁" + w for w in words):
        for start in range(len(word)):
            for end in range(start + 1, len(word) + 1):
                if word[start:end] in pieces:
                    want.append((end, row, start, pieces.index(word[start:end])))
                elif end == start + 1:
                    want.append((end, row, start, len(pieces)))
    assert list(zip(lattice.end, lattice.row, lattice.start, lattice.piece)) == sorted(want)


def test_forgetting_words_changes_nothing(monkeypatch):
    pieces = language.vocabulary()
    probs = np.random.default_rng(1).dirichlet(np.ones(len(pieces) + 1), 2).T
    texts = [" ".join(random.Random(i).choices("ab cd efg hij klm nop".split(), k=50)) for i in range(20)] + [None, ""]
    want = language.LanguageModel(["x", "y"], pieces, probs).log_likelihood(texts)
    monkeypatch.setattr(language, "MAX_KNOWN_WORDS", 2)
    monkeypatch.setattr(language, "WORDS_AT_ONCE", 7)
    assert language.LanguageModel(["x", "y"], pieces, probs).log_likelihood(texts) == pytest.approx(want)


def test_languages_are_told_apart(spark, documents):
    words_of = {"aa": "the and with house river water stone".split(), "bb": "der und mit haus fluss wasser stein".split()}
    rows = [(i, " ".join(random.Random(i).choices(words_of[k], k=8)), k) for i in range(80) for k in ("aa", "bb")]
    model = language.fit(spark.createDataFrame([(2 * i + (k == "bb"), t, k) for i, t, k in rows] + [(999, "x", None)],
                                               "doc_id long, text string, lang string"))
    assert model.languages == ["aa", "bb"]
    out = {r.doc_id: r for r in language.identify(documents(
        *EDGES, (1, "THE WATER and Stone"), (2, "der fluss und wasser")), model).collect()}
    assert out[1].lang_pred == "aa" and out[2].lang_pred == "bb" and len(out) == 8
    for i in (900, 901, 902):
        assert (out[i].lang_pred, out[i].score) == ("und", 0.0)
    assert all(0 <= r.score <= 1 for r in out.values())


def test_nothing_to_learn_from(spark, documents):
    none = documents((1, "x")).limit(0)
    model = language.fit(none)
    assert [r.lang_pred for r in language.identify(documents((1, "some text")), model).collect()] == ["und"]
    forest = quality.fit(none, labels(spark, [], "quality"))
    assert [r.score for r in quality.score_quality(documents((1, "some text"), (2, None)), forest).collect()] == [0.5, 0.5]
    model = toxicity.fit(none, labels(spark, [], "toxic"))
    assert all(r.score < 0.01 for r in toxicity.score_toxicity(documents((1, "some text"), (2, None)), model).collect())
    assert language.identify(none, language.LanguageModel([], ["a"], np.ones((2, 1)))).count() == 0
    assert quality.score_quality(none, forest).count() == 0 and toxicity.score_toxicity(none, model).count() == 0


def test_flat_trees_fit_a_rule_and_match_a_plain_walk():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3_000, 5))
    y = ((x[:, 0] > 0.3) ^ (x[:, 3] < -0.2)).astype(float)
    forest = quality.grow(x, y)
    fresh = rng.normal(size=(1_000, 5))
    truth = (fresh[:, 0] > 0.3) ^ (fresh[:, 3] < -0.2)
    assert ((forest.score(fresh) >= 0.5) == truth).mean() > 0.97
    for row, margin in zip(fresh[:50], forest.margin(fresh[:50])):
        total = forest.base
        for feature, threshold, leaf in zip(forest.feature, forest.threshold, forest.leaf):
            node = 0
            while node < len(feature):
                node = 2 * node + 1 + int(row[feature[node]] > threshold[node])
            total += leaf[node - len(feature)]
        assert margin == pytest.approx(total)


def test_statistics_by_hand():
    import pyarrow as pa

    block: Block = next(blocks(pa.array(["Aa aa Aa!\nx", None, "é é é"])))
    x = dict(zip(quality.FEATURES, quality.statistics(block.offsets, words(block)).T))
    assert x["share_upper"].tolist() == [2 / 11, 0, 0] and x["share_beyond"].tolist() == [0, 0, 6 / 8]
    assert x["distinct_words"].tolist() == [1.0, 0.0, 1 / 3] and x["top_word"].tolist() == [0.25, 0.0, 1.0]
    assert x["repeated_word"].tolist() == [0, 0, 2 / 3] and x["end_mark"].tolist() == [0.25, 0, 0]
    assert x["lines"].tolist() == [math.log(2), 0, 0]


def test_quality_and_toxicity_of_unseen_texts(spark, documents):
    rng = random.Random(0)
    plain = ["".join(rng.choice("abcdeiou") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    bad = ["wretched", "vermin", "halfwit", "lowlife"]
    rows, good, toxic = [], [], []
    for i in range(600):
        w = rng.choices(plain, k=rng.randint(5, 60))
        if i % 3 == 0:
            w[rng.randrange(len(w))] = rng.choice(bad)
        text = " ".join(w)
        rows.append((i, text.upper() + "!!" if i % 4 == 0 else text))
        good.append((i, int(i % 4 != 0)))
        toxic.append((i, int(i % 3 == 0)))
    docs = documents(*rows, *EDGES)
    forest = quality.fit(docs, labels(spark, [x for x in good if x[0] % 5], "quality"))
    model = toxicity.fit(docs, labels(spark, [x for x in toxic if x[0] % 5], "toxic"))
    assert len(model.ordinary) == len(model.toxic)
    for out, truth, limit in ((quality.score_quality(docs, forest), dict(good), 0.95),
                              (toxicity.score_toxicity(docs, model), dict(toxic), 0.9)):
        got = {r.doc_id: r for r in out.collect()}
        assert len(got) == len(rows) + len(EDGES) and all(0 <= r.score <= 1 for r in got.values())
        fresh = [i for i in truth if i % 5 == 0]
        assert np.mean([got[i].predicted == truth[i] for i in fresh]) >= limit
