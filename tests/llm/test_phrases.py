from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa

from marketlens.llm import phrases
from marketlens.llm.words import Words, blocks

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top=phrases.TOP):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(UPPER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i:i + k])] += 1
    out = []
    for lang, known in counts.items():
        kept = {p: a for p, a in known.items() if a >= least and len(p) > 1}

        def inside(p):
            return any(len(q) > len(p) and known[q] >= known[p] and any(q[i:i + len(p)] == p for i in range(len(q))) for q in kept)
        found = []
        for p, a in kept.items():
            if not inside(p):
                cut = min((1000 * a * total[lang] // (known[p[:k]] * known[p[k:]]), k) for k in range(1, len(p)))
                found.append((-cut[0], -a, " ".join(p).encode(), known[p[:cut[1]]], known[p[cut[1]:]]))
        out += [(lang, rank, p.decode(), -a, x, y, total[lang], -s)
                for rank, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def texts(rng):
    words = ["of", "The", "the", "é", "É", "a\x01b", "a", "a\x7f", "%", "n o", "😀"] + [f"w{i}" for i in range(30)]
    weights = [40, 20, 30, 10, 10, 6, 9, 5, 5, 5, 5] + [2] * 30
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randrange(1, 60)):
            parts.append(rng.choices(words, weights)[0] if rng.random() < 0.8 else "New york  stock\tEXCHANGE rules")
            parts.append(rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\v"]))
        rows.append((rng.choice(["en", "en", "de", None, "und", "x y%\n"]), "".join(parts)))
    rows += [("en", None), (None, ""), ("de", " . ,"), ("en", "of the " * 400), ("lone", "a b")] + rows[:5] * 3
    return rows


def run(spark, rows, least, **options):
    df = spark.createDataFrame([(*r, "x", 1, "e") for r in rows], "lang string, text string, phrase string, n int, edge string")
    return sorted(tuple(r) for r in phrases.collocations(df, least=least, **options).collect())


def test_against_brute_force(spark):
    rows = texts(random.Random(1))
    for least, top in ((4, 2_000), (15, 7)):
        want = brute(rows, least, top)
        assert len(want) > 20
        assert run(spark, rows, least, top=top) == want


def test_empty_and_small_tables(spark):
    assert run(spark, [], 2) == []
    assert run(spark, [("en", None), ("en", "one")], 1) == []
    assert run(spark, [("en", "one two")] * 3, 3) == [("en", 1, "one two", 3, 3, 3, 6, 2000)]


def test_flow_is_the_same_however_edges_are_split():
    rng = random.Random(2)
    words = [b"a", b"b", b"a\x01", b"of", "é".encode(), b"the", b"\x7f"]
    fill = [(b"\ren\n", b"f%d" % i) for i in range(45)]
    known = phrases.Dictionary([(b"\ren\n", b"the"), (b"\rde\n", b"a"), *fill, (b"\ren\n", b"a"), (b"\ren\n", "é".encode())])

    def coded(lang, said):
        own = known.words[lang]
        codes = np.array([own.index(w) if w in own else -1 for w in said])
        joined = np.frombuffer(b"".join(w + b" " for w in said), np.uint8)
        ends = np.cumsum([len(w) + 1 for w in said]) - 1
        starts = ends - [len(w) for w in said]
        data, offsets = phrases._encoded(Words(joined, starts, ends, np.array([0, len(said)])), codes)
        assert (phrases.word_ends(data) + 1 == offsets[1:]).all()
        return lang + data.tobytes()
    rows, want = Counter(), Counter()
    for _ in range(4_000):
        lang = rng.choice([b"\ren\n", b"\rde\n"])
        said, n = tuple(rng.choices(words, [4, 1, 1, 3, 2, 2, 1], k=rng.choice([1, 2, 5, 5, 5]))), rng.randrange(1, 4)
        assert known.said(coded(lang, said)) == lang[1:] + b"".join(w + b" " for w in said)
        rows[coded(lang, said)] += n
        for k in range(1, len(said) + 1):
            want[lang, said[:k]] += n
    least = 30
    want = {p: n for p, n in want.items() if n >= least}
    for lang in (b"\ren\n", b"\rde\n"):
        edges = [e for e in rows if e.startswith(lang)]
        data = np.frombuffer(b"".join(e[len(lang):] for e in edges), np.uint8)
        size = np.array([len(e) - len(lang) for e in edges])
        order = phrases.byte_order(data, size, 8)
        ordered = sorted(edges)
        assert [edges[i] for i in order] == ordered
        own_want = {p: n for (name, p), n in want.items() if name == lang}
        for split in (1, 7, 100, len(ordered)):
            for tasks in (1, 3):
                got, outer = {}, Counter()
                for t in range(tasks):
                    own = [(e[len(lang):], rows[e]) for e in ordered[len(ordered) * t // tasks:len(ordered) * (t + 1) // tasks]]
                    flow, found = phrases.Flow(least), []
                    for at in range(0, len(own), split):
                        edge, n = zip(*own[at:at + split])
                        found += flow.add(np.frombuffer(b"".join(edge), np.uint8), np.array([len(e) for e in edge]), np.array(n))
                    for path, shortest, n, edge_of_task in found + flow.rest():
                        parts = tuple(known.said(lang + path).split(b"\n")[1].split(b" ")[:-1])
                        if edge_of_task:
                            assert shortest == len(parts)
                            outer[parts] += n
                            continue
                        for k in range(shortest, len(parts) + 1):
                            assert parts[:k] not in got
                            got[parts[:k]] = n
                assert not set(got) & set(outer)
                assert got | {p: n for p, n in outer.items() if n >= least} == own_want


def test_pieces_of_a_block():
    found = [phrases.pieces(b) for b in blocks(pa.array(["Ab  c,d\té", "", None, "x", "y. "]), 8)]
    words = [p.words.data[s:e].tobytes().decode() for p in found for s, e in zip(p.words.start, p.words.end)]
    assert words == ["ab", "c", "d", "é", "x", "y"]
    assert [bool(x) for p in found for x in p.linked] == [True, False, True, False, False, False]
