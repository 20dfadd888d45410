"""Language identification by unigrams over pieces, summed over all segmentations.

A language gives each piece of a fixed public vocabulary a probability. The
probability of a word is the sum over all ways to cut it into pieces, found by
the forward algorithm; pieces never cross words, so a text is the product of
its words, and each distinct word is computed once per task. Words are runs of
letters (at most 40; a longer run is read as several words), lower-cased.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import configure, keyed_texts, map_batches
from marketlens.session import materialize

UNDETERMINED = "und"
MAX_DOCS_PER_LANGUAGE = 2_000  # expected size of the sample that fits a language
ROUNDS = 2                     # re-estimations of the piece probabilities
MAX_KNOWN_WORDS = 300_000      # words a task remembers
WORDS_AT_ONCE = 100_000
UNKNOWN = 1e-9                 # probability of a letter outside the vocabulary
_WORD = regex.compile(r"\p{L}{1,40}")
_LETTER = regex.compile(r"\p{L}")


def vocabulary(path: str | None = None) -> list[str]:
    """Pieces of a sentencepiece model, lower-cased; markers and bytes left out."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(
        model_file=path or public_tokenizers.path("piece_bpe_32k.model"))
    pieces = (model.id_to_piece(i).lower() for i in range(model.get_piece_size())
              if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i)))
    return list(dict.fromkeys(p for p in pieces if re.fullmatch(r"▁?[^\W\d_]+", p)))


def word_list(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


class Trie:
    """Beginnings of pieces as numbered nodes (0: nothing read), stepped through for many places at once."""

    def __init__(self, pieces: list[str]):
        letters = sorted({ord(x) for p in pieces for x in p})
        self.letter = np.zeros(max(letters, default=0) + 2, np.int64)  # 0: in no piece
        self.letter[letters] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        steps: dict[tuple[int, int], int] = {}
        piece = [-1]
        for number, text in enumerate(pieces):
            node = 0
            for x in self.letter[[ord(x) for x in text]].tolist():
                onward = steps.setdefault((node, x), len(piece))
                if onward == len(piece):
                    piece.append(-1)
                node = onward
            piece[node] = number
        piece[0] = -1
        self.piece = np.array(piece)  # that ends at the node, -1: none
        keys = np.array([node * self.width + x for node, x in steps], np.int64)
        order = np.argsort(keys)
        self.keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.onward = np.append(np.fromiter(steps.values(), np.int64, len(steps))[order], 0)

    def letters(self, text: str) -> np.ndarray:
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return self.letter[np.minimum(codes, len(self.letter) - 1)]

    def step(self, nodes: np.ndarray, letters: np.ndarray) -> np.ndarray:
        """The next node of each; 0 where no piece goes on like that."""
        asked = nodes * self.width + letters
        at = np.searchsorted(self.keys, asked)
        return np.where(self.keys[at] == asked, self.onward[at], 0)


class Lattice:
    """All piece occurrences in a list of words, ordered by where they end, by word and by where they start.

    All places of all words are read together, a letter at a time, as long as a piece goes on like that. A letter
    that is no piece counts as piece ``unknown``.
    """

    def __init__(self, words: list[str], trie: Trie, unknown: int):
        self.marked = ["▁" + w for w in words]
        self.length = np.array([len(w) for w in self.marked], np.int64)
        letters = trie.letters("".join(self.marked))
        place = np.arange(len(letters))
        row = np.repeat(np.arange(len(self.marked)), self.length)
        start = place - np.repeat(np.cumsum(self.length) - self.length, self.length)
        node, size, found = trie.step(np.zeros(len(place), np.int64), letters), 1, []
        single = trie.piece[node]
        found.append((row, start, start + 1, np.where(single < 0, unknown, single)))
        while len(place):
            size += 1
            on = (node > 0) & (start + size <= self.length[row])
            place, row, start = place[on], row[on], start[on]
            node = trie.step(node[on], letters[place + size - 1])
            piece = trie.piece[node]
            hit = piece >= 0
            found.append((row[hit], start[hit], start[hit] + size, piece[hit]))
        row, start, end, piece = map(np.concatenate, zip(*found))
        order = np.lexsort((start, row, end))
        self.end, self.row, self.start, self.piece = end[order], row[order], start[order], piece[order]
        ends = np.arange(1, int(self.length.max(initial=0)) + 2)
        self.at = np.searchsorted(self.end, ends)

    def forward(self, probs: np.ndarray) -> np.ndarray:
        """(word, position, language): probability of each prefix."""
        alpha = np.zeros((len(self.marked), len(self.at), probs.shape[1]))
        alpha[:, 0] = 1
        for j in range(len(self.at) - 1):
            part = slice(self.at[j], self.at[j + 1])
            rows = self.row[part]
            if len(rows):
                first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
                flow = alpha[rows, self.start[part]] * probs[self.piece[part]]
                alpha[rows[first], j + 1] = np.add.reduceat(flow, first)
        return alpha

    def likelihood(self, probs: np.ndarray) -> np.ndarray:
        alpha = self.forward(probs)
        return alpha[np.arange(len(self.marked)), self.length]

    def expected(self, probs: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """Expected number of uses of each piece, over words weighted by ``weights``."""
        alpha = self.forward(probs)
        beta = np.zeros_like(alpha)
        every = np.arange(len(self.marked))
        beta[every, self.length] = 1
        for j in range(len(self.at) - 2, -1, -1):
            part = slice(self.at[j], self.at[j + 1])
            rows = self.row[part]
            flow = beta[rows, self.end[part]] * probs[self.piece[part]]
            np.add.at(beta, (rows, self.start[part]), flow)
        total = alpha[every, self.length]
        used = alpha[self.row, self.start] * probs[self.piece] * beta[self.row, self.end]
        used *= (weights[:, None] / np.maximum(total, 1e-300))[self.row]
        out = np.zeros(probs.shape)
        np.add.at(out, self.piece, used)
        return out


@dataclass
class LanguageModel:
    """Piece probabilities: one row per piece and one for unknown letters."""

    languages: list[str]
    pieces: list[str]
    probs: np.ndarray

    def __post_init__(self) -> None:
        self.ids = {p: i for i, p in enumerate(self.pieces)}
        self.trie = Trie(self.pieces)
        self._known: dict[str, int] = {}
        self._scores = np.zeros((0, len(self.languages)))

    def _learn(self, words: list[str]) -> None:
        """Remember the scores of ``words``; beyond the limit, forget the others."""
        new = [w for w in words if w not in self._known]
        if len(self._known) + len(new) > MAX_KNOWN_WORDS:
            self._known, new = {}, words
        if len(self._scores) < len(self._known) + len(new):
            grown = np.zeros((2 * (len(self._known) + len(new)), len(self.languages)))
            grown[:len(self._known)] = self._scores[:len(self._known)]
            self._scores = grown
        for at in range(0, len(new), 4096):
            part = new[at:at + 4096]
            first = len(self._known)
            likelihood = Lattice(part, self.trie, len(self.pieces)).likelihood(self.probs)
            self._scores[first:first + len(part)] = np.log(np.maximum(likelihood, 1e-300))
            self._known.update(zip(part, range(first, first + len(part))))

    def log_likelihood(self, texts: list[str | None]) -> np.ndarray:
        """Log probability of each text in each language, a bounded number of words at a time."""
        out = np.zeros((len(texts), len(self.languages)))
        parts: list[tuple[int, list[str]]] = []
        size = 0

        def add() -> None:
            self._learn(list(dict.fromkeys(w for _, part in parts for w in part)))
            known = self._known
            for i, part in parts:
                if part:
                    out[i] += self._scores[[known[w] for w in part]].sum(axis=0)
            parts.clear()

        for i, text in enumerate(texts):
            found = word_list(text)
            for at in range(0, len(found), WORDS_AT_ONCE):
                parts.append((i, found[at:at + WORDS_AT_ONCE]))
                size += len(parts[-1][1])
                if size >= WORDS_AT_ONCE:
                    add()
                    size = 0
        add()
        return out


def fit(labelled: DataFrame, pieces: list[str] | None = None,
        docs_per_language: int = MAX_DOCS_PER_LANGUAGE) -> LanguageModel:
    """Fit on (doc_id, text, lang): an expected ``docs_per_language`` texts of each language.

    Word counts are summed in Spark, expected piece uses too; the driver gets one
    number per piece and language. Rows without language or text are passed over.
    """
    pieces = pieces or vocabulary()
    known = labelled.filter("lang is not null and text is not null")
    sizes = known.groupBy("lang").agg(F.count("*").alias("n"))
    share = F.lit(float(docs_per_language)) / F.col("n")
    place = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("language")), F.lit(1 << 20)) / float(1 << 20)
    sample = known.join(F.broadcast(sizes), "lang").filter(place < share).select("lang", "text")

    def count(batch: pa.RecordBatch) -> dict:
        seen: dict[str, Counter] = {}
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen.setdefault(lang, Counter()).update(word_list(text))
        rows = [(lang, word, n) for lang, c in seen.items() for word, n in c.items()]
        lang, word, n = zip(*rows) if rows else ((), (), ())
        return {"lang": list(lang), "word": list(word), "n": list(n)}

    counted = materialize(map_batches(sample, count, "lang string, word string, n long")
                          .groupBy("lang", "word").agg(F.sum("n").alias("n")), "language-words")
    languages = sorted(r.lang for r in counted.select("lang").distinct().collect())
    probs = np.tile(1.0 / (np.arange(len(pieces) + 1) + 10.0)[:, None], (1, max(1, len(languages))))
    probs[-1] = UNKNOWN
    probs[:-1] /= probs[:-1].sum(axis=0)
    for _ in range(ROUNDS if languages else 0):
        model = LanguageModel(languages, pieces, probs)

        def expect(batch: pa.RecordBatch, model=model) -> dict:
            langs = np.array([model.languages.index(x) for x in batch.column(0).to_pylist()])
            words, n = batch.column(1).to_pylist(), batch.column(2).to_numpy()
            rows = {"lang": [], "piece": [], "uses": []}
            for k in np.unique(langs):
                own = np.flatnonzero(langs == k)
                lattice = Lattice([words[i] for i in own], model.trie, len(model.pieces))
                uses = lattice.expected(model.probs[:, [k]], n[own].astype(float))[:-1, 0]
                used = np.flatnonzero(uses)
                rows["lang"].append(np.full(len(used), k))
                rows["piece"].append(used)
                rows["uses"].append(uses[used])
            return {k: np.concatenate(v) for k, v in rows.items()}

        uses = np.zeros((len(pieces), len(languages)))
        sums = map_batches(counted, expect, "lang int, piece int, uses double").groupBy("lang", "piece").agg(
            F.sum("uses").alias("uses"))
        for row in sums.collect():
            uses[row.piece, row.lang] = row.uses
        # what a language never used keeps a small share of the pieces' overall use
        overall = uses.sum(axis=1, keepdims=True) / max(1.0, uses.sum())
        smooth = uses + 50.0 * (overall + 1.0 / len(pieces))
        probs = np.vstack([smooth / smooth.sum(axis=0), np.full(len(languages), UNKNOWN)])
    return LanguageModel(languages, pieces, probs)


def identify(df: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score per row, in any order.

    ``score`` is the posterior of the best language under equal priors; a tie goes
    to the first language by name. Null, empty and letterless texts are ``und``
    with score 0, as is everything where no language was learned. Repeated rows
    and a null id get a result each; other columns are not read.
    """
    configure(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast((model.languages, model.pieces, model.probs))
    held: dict[str, LanguageModel] = {}

    def build(batch: pa.RecordBatch) -> dict:
        if not held:
            held["model"] = LanguageModel(*shared.value)
        own = held["model"]
        texts = batch.column(1).to_pylist()
        letters = np.array([bool(t and _LETTER.search(t)) for t in texts], bool)
        if not own.languages:
            letters[:] = False
            logs = np.zeros((len(texts), 1))
        else:
            logs = own.log_likelihood(texts)
        best = logs.argmax(axis=1) if len(texts) else np.zeros(0, int)
        top = 1.0 / np.exp(np.minimum(logs - logs.max(axis=1, keepdims=True), 0)).sum(axis=1)
        return {"doc_id": batch.column(0),
                "lang_pred": [own.languages[b] if ok else UNDETERMINED for b, ok in zip(best, letters)],
                "score": np.where(letters, np.clip(top, 0.0, 1.0), 0.0)}

    return map_batches(keyed_texts(df, id_col, text_col), build, "doc_id long, lang_pred string, score double")
