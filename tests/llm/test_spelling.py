from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np

from marketlens.llm import spelling

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def edits(a, b):
    """Whether two words differ by exactly one inserted, deleted or replaced character."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def counted(rows):
    out = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(ASCII)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def brute(rows):
    words = counted(rows)
    near = {w: [v for v in words if abs(len(v) - len(w)) <= 1 and edits(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return sorted(((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()), key=str)


def changed(rng, word):
    i, c = rng.randrange(len(word)), rng.choice("aeiounrtsàéÀÿ")
    return rng.choice([word[:i] + c + word[i:], word[:i] + word[i + 1:], word[:i] + c + word[i + 1:]])


def texts(rng):
    base = ["".join(rng.choices("etaoinshrdlué", k=rng.randrange(5, 12))) for _ in range(150)]
    known = {w: 10 ** rng.uniform(0.5, 3.2) for w in base}
    for _ in range(600):
        w = rng.choice(list(known))
        known[changed(rng, w)] = known[w] / rng.choice([1, 2, 5, 6, 30])
    words, weights = list(known), list(known.values())
    rows = [(i, " ".join(w.title() if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=400)) + rng.choice([".", "×÷", "_x"]))
            for i in range(80)]
    long = "ab" * 5_000
    rows += [(100 + i, f"{long} {long}c1{'z' * 70} 2{'z' * 69}a Straße straße") for i in range(6)]
    return rows + [(None, "nothing " * 9), (None, None), (200, ""), (201, "1 2 3")] + rows[:4] * 2


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "doc_id long, text string, word string, n int, form string")
    return sorted((tuple(r) for r in spelling.spelling_variants(df).collect()), key=str)


def test_against_brute_force(spark):
    rows = texts(random.Random(3))
    want = brute(rows)
    assert len({root for _, _, root, *_ in want}) > 20
    assert any(form and root != form for _, form, root, *_ in want)
    assert run(spark, rows) == want


def test_no_words(spark):
    assert run(spark, []) == []
    assert run(spark, [(1, None), (2, "short"), (3, "seldom found")]) == []


def test_cells_and_leaves_lose_no_pair(monkeypatch):
    rng = random.Random(4)
    words = {"".join(rng.choices("abcé", k=8)) for _ in range(1_500)}
    words |= {"".join(rng.sample("aabbccdd", 8)) for _ in range(300)}  # many of equal counts
    longer = {changed(rng, w) for w in words} | {"aabbccdde"[i:] + "aabbccdde"[:i] for i in range(9)}
    a = sorted(w for w in words if len(w) == 8)
    b = sorted(w for w in longer if len(w) == 9)
    codes_a, codes_b = (spelling.letters([w.encode("latin-1") for w in v], len(v[0])) for v in (a, b))
    for x, y, v, w in ((codes_a, codes_a, a, a), (codes_a, codes_b, a, b)):
        want = {(i, j) for i, p in enumerate(v) for j, q in enumerate(w) if edits(p, q)}
        assert len(want) > 300
        found = [p for i, j in spelling.near_rows(x, y) for p in zip(i.tolist(), j.tolist())]
        assert len(found) == len(set(found)) and set(found) == want
        # The same through the upper levels of a tree.
        points, asking = spelling.vectors(y), spelling.vectors(x)
        tree, cells = spelling.upper_levels(points[::3], 12)
        assert cells > 8
        home = np.full(len(w), -1)
        for cell, rows in spelling.cells_within(tree, points, 0, 0):
            assert (home[rows] == -1).all()
            home[rows] = cell
        got = []
        down = int(x.shape[1] == y.shape[1])
        for cell, rows in spelling.cells_within(tree, asking, 1, down):
            own = np.flatnonzero(home == cell)
            got += [(int(rows[i]), int(own[j])) for r, s in spelling.near_rows(x[rows], y[own]) for i, j in zip(r, s)]
        assert len(got) == len(set(got)) and set(got) == want


def test_long_texts_are_read_in_chunks():
    text = "abc " + "x" * (spelling.CHUNK + 5) + " def" * spelling.CHUNK
    assert Counter(w for part in spelling._chunks(text) for w in part) == Counter(re.findall("[a-z]+", text))


def test_follow(spark):
    links = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(13)] + [("x", "w3")], "word string, form string")
    assert {tuple(r) for r in spelling.follow(links, 13).collect()} == {(w, "w13") for w in [*(f"w{i}" for i in range(13)), "x"]}
