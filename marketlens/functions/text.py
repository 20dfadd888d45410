"""Text preparation as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


# White space as in Unicode text, and letters, numbers and underscore as words.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
WORD = r"\p{L}\p{N}_"


def normalize_ascii(text: Column) -> Column:
    """Lower case, only ASCII letters and white space; null becomes ''.

    Accented letters vanish, so 'não' turns into 'no'.
    """
    return F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[^a-zA-Z{SPACE}]", "")


def normalize_unicode(text: Column) -> Column:
    """Lower case without punctuation and digits; accents stay; null becomes ''."""
    bare = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), f"[^{WORD}{SPACE}]", "")
    return F.regexp_replace(bare, r"\p{Nd}+", "")


def tokens(text: Column) -> Column:
    """Words between white space."""
    return F.filter(F.split(text, f"[{SPACE}]+"), lambda word: word != "")


def model_tokens(text: Column) -> Column:
    """Words of two or more word characters, as the vectorizer counts them."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]{{2,}}"), 0)


def without(words: Column, stop_words: Sequence[str]) -> Column:
    """Word array without stop words (a long list becomes a hash lookup)."""
    return F.filter(words, lambda word: ~word.isin(*stop_words)) if stop_words else words


def remove_stopwords(text: Column, stop_words: Sequence[str]) -> Column:
    """Text without stop words, words joined by single blanks."""
    return F.array_join(without(tokens(text), stop_words), " ")
