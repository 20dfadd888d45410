"""Byte-level BPE encoding by tree concatenation, and decoding.

Text is cut where that changes nothing: at white space after a word. The pieces
are short and repeat, so a batch encodes each distinct one once. Longer text without such a
place is halved into leaves, the leaves are encoded in parallel, and neighbours
are joined in a tree. At each join a window of tokens around the seam is encoded
anew and grows until it agrees with both sides: one token to the left and one to
the right have the same bytes at the same place and the same position within
their pre-token. From an agreeing token on, both encodings continue alike,
because pre-tokens are cut without looking back and a sequence of tokens is the
encoding of its text if every two neighbours are the encoding of theirs.
"""

from __future__ import annotations

import json
import os
import re
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import configure, keyed_texts, map_batches, utf8

LEAF_CHARS = 2_048        # longest text encoded in one go
LONG_CHARS = 1 << 20      # a longer text is spread over tasks in parts of this size
FIRST_WINDOW = 16         # tokens on each side of a seam at first
MAX_KNOWN = 250_000       # pieces a task remembers, of those that stand alone

# Texts of these characters only: blank and line feed are their only white space.
_PLAIN = re.compile(r"[\x21-\x7e \n¡-ɏ]*")
# Fixed value: how byte-level vocabularies cut text into pre-tokens.
_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def tokenizer_path(path: str | None = None) -> str:
    if path is not None:
        return path
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_of_symbol() -> dict[str, int]:
    """The printable symbol that byte-level vocabularies write for each byte, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Coder:
    """Encodes and decodes whole texts with one vocabulary file."""

    def __init__(self, path: str, leaf_chars: int = LEAF_CHARS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.leaf_chars = leaf_chars
        symbols = byte_of_symbol()
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        added = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = list(added.values())
        self.pieces: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            self.pieces[i] = token.encode() if token in added else bytes(symbols[c] for c in token)
        self.widths = np.array([len(p) for p in self.pieces])
        self._known: dict[str, bytes] = {}
        self.path = path

    @cached_property
    def quick(self):
        """A faster coder for plain pieces, where the file is the kind that it equals.

        It merges by rank of the merged token, so ids have to follow the merges.
        """
        import tiktoken

        with open(self.path, encoding="utf-8") as f:
            file = json.load(f)
        model, cutter = file["model"], file["pre_tokenizer"] or {}
        ids = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model.get("merges", ())]
        if (model["type"] != "BPE" or file["normalizer"] is not None or ids != sorted(ids)
                or model.get("dropout") or model.get("ignore_merges") or cutter.get("type") != "ByteLevel"
                or cutter.get("add_prefix_space") or not cutter.get("use_regex")):
            return None
        ranks = {piece: i for i, piece in enumerate(self.pieces) if piece and i not in self.special}
        return tiktoken.Encoding("quick", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens={})

    # Short texts.
    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, text: str) -> np.ndarray:
        """Token ids of a whole text, as little-endian unsigned 32-bit integers."""
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def encode_bytes(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text; pieces are told apart without a Python object each, and each distinct one is encoded once."""
        plain = [bool(_PLAIN.fullmatch(t)) for t in texts]
        found = iter(self._encode_plain([t for t, own in zip(texts, plain) if own]))
        return [next(found) if own else self._encode_any(t) for t, own in zip(texts, plain)]

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        data, offsets = utf8(pa.array(texts, pa.large_string()))
        data = data[:offsets[-1]]
        if not len(data):
            return [b""] * len(texts)
        blank = (data == 32) | (data == 10)
        begins = blank.copy()
        begins[1:] &= ~blank[:-1]
        begins[offsets[:-1][np.diff(offsets) > 0]] = True
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        pieces = pa.Array.from_buffers(pa.large_binary(), len(starts), [
            None, pa.py_buffer(np.append(starts, len(data))), pa.py_buffer(data)]).dictionary_encode()
        distinct = pieces.dictionary
        # Pieces that begin with white space and end without may stand in one text.
        lengths = np.zeros(len(distinct), np.int64)
        chained = np.zeros(len(distinct), bool)
        if self.quick:
            which = pieces.indices.to_numpy()
            fits = blank[starts] & ~blank[ends - 1] & (ends - starts <= self.leaf_chars)
            fits[np.searchsorted(starts, np.flatnonzero(data == ord("<")), "right") - 1] = False
            chained[which] = fits
            lengths[which] = ends - starts
        chain = distinct.filter(pa.array(chained))
        text = b"".join(chain.to_pylist()).decode()
        ids = self.quick.encode_to_numpy(text, disallowed_special=()).astype("<u4") if text else np.zeros(0, "<u4")
        stops = 4 * (np.searchsorted(np.cumsum(self.widths[ids]), np.cumsum(lengths[chained])) + 1)
        rest = self._encode_rest([p.decode() for p in distinct.filter(pa.array(~chained)).to_pylist()])
        stops = np.append(stops, len(ids) * 4 + np.cumsum([len(r) for r in rest], dtype=np.int64)).astype(np.int64)
        coded = pa.Array.from_buffers(pa.large_binary(), len(distinct), [
            None, pa.py_buffer(np.append(0, stops)), pa.py_buffer(ids.tobytes() + b"".join(rest))])
        place = np.empty(len(distinct), np.int64)
        place[np.append(np.flatnonzero(chained), np.flatnonzero(~chained))] = np.arange(len(distinct))
        every = coded.take(pa.array(place[pieces.indices.to_numpy()]))
        _, bounds, raw = every.buffers()
        bounds = np.frombuffer(bounds, np.int64)[every.offset:every.offset + len(every) + 1]
        at = bounds[np.searchsorted(starts, offsets)].tolist()
        raw = memoryview(raw) if raw is not None else b""
        return [bytes(raw[a:b]) for a, b in zip(at, at[1:])]

    def _encode_rest(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces that stand alone; the task remembers them."""
        new = [p for p in pieces if p not in self._known]
        if len(self._known) + len(new) > MAX_KNOWN:
            self._known, new = {}, pieces
        short = [p for p in new if len(p) <= self.leaf_chars]
        for piece, ids in zip(short, self._direct(short)):
            self._known[piece] = ids.tobytes()
        for piece in new:
            if len(piece) > self.leaf_chars:
                self._known[piece] = self._encode_any(piece)
        return [self._known[p] for p in pieces]

    # Long texts without a place to cut, and texts of other characters.
    def _encode_any(self, text: str) -> bytes:
        if len(text) <= self.leaf_chars:
            return self._direct([text])[0].tobytes()
        return self.tree(text)[0].tobytes()

    def _marked(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids, and whether each token is the first of its pre-token."""
        out = []
        for e in self.tokenizer.encode_batch(texts, add_special_tokens=False):
            word = np.array([-1 if w is None else w for w in e.word_ids], np.int64)
            special = np.isin(np.array(e.ids, np.int64), self.special)
            first = special | (word < 0)
            first[1:] |= (word[1:] != word[:-1]) | special[:-1]
            first[:1] = True
            out.append((np.array(e.ids, "<u4"), first))
        return out

    def tree(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Encode halves of halves, then join neighbours level by level."""
        parts = [text[i:i + self.leaf_chars] for i in range(0, len(text), self.leaf_chars)]
        return self.join_all(parts, self._marked(parts))

    def join_all(self, texts: list[str], done: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.zeros(0, "<u4"), np.zeros(0, bool)
        while len(done) > 1:
            joined = [self.join(done[i], done[i + 1], texts[i], texts[i + 1]) for i in range(0, len(done) - 1, 2)]
            merged = [texts[i] + texts[i + 1] for i in range(0, len(done) - 1, 2)]
            if len(done) % 2:
                joined.append(done[-1])
                merged.append(texts[-1])
            done, texts = joined, merged
        return done[0]

    def join(self, left, right, left_text: str, right_text: str) -> tuple[np.ndarray, np.ndarray]:
        """Encoding of ``left_text + right_text`` from those of its two parts."""
        (a, a_first), (b, b_first) = left, right
        k = FIRST_WINDOW
        while k < max(len(a), len(b)):
            i, j = max(0, len(a) - k), min(len(b), k)
            raw = [b"".join([self.pieces[t] for t in part]) for part in (a[i:], b[:j])]
            try:
                text = (raw[0] + raw[1]).decode()
            except UnicodeDecodeError:  # the window cuts a character
                k += 1
                continue
            w, w_first = self._marked([text])[0]
            ends = np.cumsum(self.widths[w])
            starts = ends - self.widths[w]
            seam = len(raw[0])
            x = self._agree(a[i:], a_first[i:], 0, w, w_first, starts, False)
            y = self._agree(b[:j], b_first[:j], seam, w, w_first, starts, j == len(b))
            if x is not None and y is not None and starts[x[1]] <= seam <= starts[y[1]] and x[1] <= y[1]:
                ids = np.concatenate([a[:i + x[0]], w[x[1]:y[1]], b[y[0]:]])
                first = np.concatenate([a_first[:i + x[0]], w_first[x[1]:y[1]], b_first[y[0]:]])
                return ids, first
            k *= 2
        return self._marked([left_text + right_text])[0]

    def _agree(self, side, side_first, shift, w, w_first, starts, whole_right: bool):
        """(index in side, index in window) of the agreeing token nearest to the far end of ``side``."""
        own = shift + np.cumsum(self.widths[side]) - self.widths[side]
        at = np.searchsorted(starts, own)
        ok = at < len(starts)
        at = np.minimum(at, max(0, len(starts) - 1))
        ok &= (starts[at] == own) & (w[at] == side) & (w_first[at] == side_first)
        if shift == 0:  # left side: the window starts a pre-token of its own, so its first token proves
            ok[:1] &= side_first[:1]  # nothing unless the side starts one there too
            hits = np.flatnonzero(ok)
            return (int(hits[0]), int(at[hits[0]])) if len(hits) else None
        # right side: the window's end cuts its last pre-tokens, so agreement must lie before
        limit = len(w) if whole_right else len(w) - 4
        hits = np.flatnonzero(ok & (at < limit))
        return (int(hits[-1]), int(at[hits[-1]])) if len(hits) else None

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text of ``ids``; an incomplete character becomes U+FFFD, as the library has it."""
        pieces = self.pieces
        raw = b"".join([pieces[i] for i in ids.tolist()])
        try:
            raw.decode()
            return raw
        except UnicodeDecodeError:
            return self.tokenizer.decode(ids.tolist(), skip_special_tokens=False).encode()


@lru_cache(maxsize=4)
def coder(path: str, leaf_chars: int = LEAF_CHARS) -> Coder:
    """The coder of this process; Spark runs the tasks, so the library stays on one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Coder(path, leaf_chars)


def encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
           leaf_chars: int = LEAF_CHARS, long_chars: int = LONG_CHARS) -> DataFrame:
    """doc_id and ids (binary, little-endian unsigned 32-bit) per row.

    Special tokens are only those that the text spells out. Null reads as the
    empty text, which has no ids. A text of more than ``long_chars`` characters is
    encoded in parts by several tasks, whose results are joined like any halves.
    Repeated rows and a null id get a result each; other columns are not read.
    """
    configure(df.sparkSession)
    path = tokenizer_path(path)
    texts = keyed_texts(df, id_col, text_col)
    is_long = F.coalesce(F.length("text") > long_chars, F.lit(False))

    def short(batch: pa.RecordBatch) -> dict:
        own = coder(path, leaf_chars)
        return {"doc_id": batch.column(0),
                "ids": own.encode_all([t or "" for t in batch.column(1).to_pylist()])}

    def part(batch: pa.RecordBatch) -> dict:
        own = coder(path, leaf_chars)
        done = [own.tree(t) for t in batch.column(3).to_pylist()]
        return {"doc_id": batch.column(0), "row": batch.column(1), "part": batch.column(2), "text": batch.column(3),
                "ids": [d[0].tobytes() for d in done], "first": [d[1].tobytes() for d in done]}

    def whole(group: pa.Table) -> pa.Table:
        own = coder(path, leaf_chars)
        group = group.sort_by("part")
        done = [(np.frombuffer(i, "<u4"), np.frombuffer(f, bool))
                for i, f in zip(group["ids"].to_pylist(), group["first"].to_pylist())]
        ids = own.join_all(group["text"].to_pylist(), done)[0]
        return pa.table({"doc_id": group["doc_id"][:1], "ids": pa.array([ids.tobytes()], pa.binary())})

    parts = (texts.filter(is_long).withColumn("row", F.monotonically_increasing_id())
             .withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.length("text") - 1) / long_chars).cast("int"))))
             .withColumn("text", F.substring(F.col("text"), F.col("part") * long_chars + 1, F.lit(long_chars)))
             .select("doc_id", "row", "part", "text"))
    coded = map_batches(parts.repartition("row", "part"), part,
                        "doc_id long, row long, part int, text string, ids binary, first binary")
    return map_batches(texts.filter(~is_long), short, "doc_id long, ids binary").unionByName(
        coded.groupBy("row").applyInArrow(whole, "doc_id long, ids binary"))


def decode(df: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """All columns, with ``text`` (UTF-8 as binary) added; null ids decode to null.

    A text's tokens decode by concatenation of their bytes, and so do any pieces
    of a sequence, in any grouping.
    """
    path = tokenizer_path(path)
    at, names = df.columns.index(ids_col), df.columns

    def build(batch: pa.RecordBatch) -> dict:
        own = coder(path)
        texts = [None if ids is None else own.decode_bytes(np.frombuffer(ids, "<u4"))
                 for ids in batch.column(at).to_pylist()]
        return dict(zip(names, batch.columns)) | {"text": pa.array(texts, pa.binary())}

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", text binary"
    return map_batches(df, build, schema)
