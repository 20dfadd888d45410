from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marketlens.llm import bpe, packing

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["a", "ab", "the", " ", "\n", "é", "'s", "'re", "'", "1", "!!", "<|endoftext|>", "<|", "  ", "\t", "漢", "🙂", " "]
EDGES = [(1, "plain words here"), (2, None), (3, ""), (4, "x" * 9_000), (5, "a b " * 4_000), (6, "<|endoftext|>"),
         (7, "plain words here"), (7, "plain words here"), (None, "no id"), (8, "漢字 🙂\t\u0085"), (9, " " * 5_000)]


def library(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=60), st.sampled_from([3, 8, 40]))
def test_tree_equals_library(parts, leaf):
    text, own = "".join(parts), bpe.Coder(PATH, leaf)
    assert own.encode(text).tolist() == library(text)
    if text:
        assert own.tree(text)[0].tolist() == library(text)
    assert own.decode_bytes(np.array(library(text), "<u4")).decode() == text


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, "=-" * 9_000, "abc1" * 5_000])
def test_long_unsplit_text_is_joined_exactly(text):
    assert bpe.Coder(PATH).encode(text).tolist() == library(text)


def test_incomplete_characters_decode_as_the_library_does():
    ids = library("漢🙂")[1:]
    assert bpe.Coder(PATH).decode_bytes(np.array(ids, "<u4")).decode() == LIBRARY.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("long_chars", [1 << 20, 700])
def test_encode_and_decode_rows(documents, long_chars):
    out = bpe.decode(bpe.encode(documents(*EDGES), long_chars=long_chars, leaf_chars=64)).collect()
    got = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.text).decode()) for r in out), key=repr)
    assert got == sorted(((i, library(t), t or "") for i, t in EDGES), key=repr)


def test_empty_table(documents):
    empty = documents((1, "x")).limit(0)
    assert bpe.encode(empty).count() == 0 and packing.pack(empty).count() == 0


def test_local_search_empties_bins():
    lengths = np.array([600, 500, 424, 500, 24, 600, 424])
    bad = [[0], [1, 2], [3, 4], [5, 6]]
    better = packing.improve([list(b) for b in bad], lengths, 1024)
    assert sorted(i for b in better for i in b) == list(range(7))
    assert max(lengths[b].sum() for b in better) <= 1024
    assert sum(lengths[b].sum() ** 2 for b in better) > sum(lengths[b].sum() ** 2 for b in bad)
    assert len(better) < len(bad)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 63), max_size=120))
def test_packing_keeps_every_item_and_size(lengths):
    bins = packing.pack_lengths(np.array(lengths, np.int64), 64)
    assert sorted(i for b in bins for i in b) == list(range(len(lengths)))
    assert all(sum(lengths[i] for i in b) <= 64 for b in bins)
    assert len(bins) <= len(packing.best_fit(np.array(lengths, np.int64), 64))


def test_pack_rows(documents):
    rows = [*EDGES, *[(100 + i, "word " * random.Random(i).randint(1, 700)) for i in range(80)]]
    out = packing.pack(documents(*rows)).collect()
    want = []
    for i, t in rows:
        ids, at, k = np.array([*library(t), 2], "<u4"), 0, 0
        while at < len(ids):
            n = (len(ids) - at) % 1024 or 1024
            want.append((i, k, at, n, zlib.crc32(ids[at:at + n].tobytes())))
            at, k = at + n, k + 1
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in out), key=repr) == sorted(want, key=repr)
    places = {}
    for r in out:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in places.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(n for _, n in spans) <= 1024
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:]))
    assert len(places) <= -(-sum(r.length for r in out) // 1024) + 1


def test_distinct_pieces_are_encoded_once_a_batch_without_an_entry_each():
    own = bpe.Coder(bpe.tokenizer_path())
    texts = ["", " ", "\n\n", "one two  three\n\n four ", " two two don't 12 34 !!\n", "a<|endoftext|>b <|endoftext|> <p> two",
             "x" * 5_000 + " y", "y" + " " * 3_000, "é ñ¡ \nü", "日本 two", "a b\tc"]
    texts += [f"one w{i} w{i % 7} two\nw{i}" for i in range(500)]
    want = [e.ids for e in own.tokenizer.encode_batch(texts, add_special_tokens=False)]
    for batch in (texts, texts[3:4], texts[:1], texts[9:10]):
        got = [np.frombuffer(raw, "<u4").tolist() for raw in own.encode_all(batch)]
        assert got == want[texts.index(batch[0]):][:len(batch)]
    assert own.encode_all([]) == []
    # Only pieces at the start or end of a text, overlong ones and those with "<" are remembered one by one.
    assert not [p for p in own._known if p in (" two", " w7", "\nw7")] and len(own._known) < 30
