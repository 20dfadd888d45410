from __future__ import annotations

import random
import re

import numpy as np
import pytest

from marketlens.llm import neardup, substrings
from marketlens.llm.words import mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_list(text, lower):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "") if lower else text or ""
    return WORD.findall(text)


def shingles(text):
    w = word_list(text, True)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(rows):
    """Brute force over all pairs."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for k, i in enumerate(ids):
        for j in ids[:k]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 75 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in ids}


def corpus(seed=0):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4)))
    base = [[word() for _ in range(rng.randint(30, 120))] for _ in range(6)]
    passage = [word() for _ in range(40)]
    rows = [(1, None), (2, ""), (3, "one two"), (4, "ONE  two"), (5, "one\ttwo\nthree four five"), (6, " \n "),
            (None, "no id at all"), (7, "ÀÉ ONE two"), (8, "àé one two")]
    for i in range(10, 170):
        w = list(rng.choice(base))
        for _ in range(rng.randint(0, 9)):
            w[rng.randrange(len(w))] = word()
        if i % 5 == 0:
            w = [word() for _ in range(30)] + passage + [word() for _ in range(20)]
        if i % 11 == 0:
            w = ["ha"] * rng.randint(5, 60)
        if i % 13 == 0:
            w = ["na", "no"] * rng.randint(5, 40)
        rows.append((i, " ".join(w)))
    rows += [(i + 500, t) for i, t in rows[20:30]] + [rows[40]] * 3
    rows.append((999, " ".join(word() for _ in range(30_000))))
    return rows


@pytest.mark.parametrize("block_rows, block_bytes", [(neardup.BLOCK_ROWS, neardup.BLOCK_BYTES), (3, 600)])
def test_groups_equal_all_pairs(documents, monkeypatch, block_rows, block_bytes):
    monkeypatch.setattr(neardup, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(neardup, "BLOCK_BYTES", block_bytes)
    rows = corpus()
    out = neardup.near_duplicates(documents(*rows)).collect()
    assert len(out) == len(rows)
    want = components(rows)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)


def test_signatures_of_near_sets_are_near():
    rng = np.random.default_rng(0)
    for _ in range(40):
        items = mix(rng.integers(0, 1 << 60, 700).astype(np.uint64))
        x, y = items[:600], np.r_[items[:515], items[600:685]]  # Jaccard 515 / 685 = 0.752
        apart = (neardup.minima(np.sort(x)).view("<u2") != neardup.minima(np.sort(y)).view("<u2")).sum()
        assert apart <= neardup.MAX_DIFFERING


def test_empty_tables(documents):
    empty = documents((1, "x")).limit(0)
    assert neardup.near_duplicates(empty).count() == 0
    assert substrings.remove_repeats(empty).count() == 0


def removed(rows, width):
    first = {}
    for i, t in rows:
        if i is not None:
            w = word_list(t, False)
            for k in range(len(w) - width + 1):
                key = tuple(w[k:k + width])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = word_list(t, False)
        gone = set()
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k:k + width])] < i:
                gone.update(range(k, k + width))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("width", [13, 5])
def test_repeats_equal_brute_force(documents, width):
    rows = corpus(1)
    out = substrings.remove_repeats(documents(*rows), window=width, carry=["source", "key"])
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in out.collect()), key=repr) == removed(rows, width)
    assert out.columns[4:] == ["source", "key"]


@pytest.mark.parametrize("vocabulary", [1, 2, 3, 40])
def test_equal_windows_have_equal_anchors(vocabulary):
    rng, seen = np.random.default_rng(vocabulary), {}
    for _ in range(30):
        shared = rng.integers(0, vocabulary, 40)
        texts = [np.r_[rng.integers(0, vocabulary, rng.integers(0, 30)), shared[:rng.integers(13, 40)],
                       rng.integers(0, vocabulary, rng.integers(0, 30))] for _ in range(4)]
        hashes = mix(np.concatenate(texts).astype(np.uint64) + np.uint64(5))
        text_of = np.repeat(np.arange(4), [len(t) for t in texts])
        start, anchor = substrings.anchors(hashes, text_of)
        assert len(start) == sum(max(0, len(t) - 12) for t in texts)
        for s, a in zip(start, anchor):
            assert a > 0 and seen.setdefault(hashes[s:s + 13].tobytes(), a) == a
