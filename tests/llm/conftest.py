from __future__ import annotations

import pytest

from marketlens.llm.words import configure

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Build documents from (doc_id, text) pairs, with columns whose names could clash."""
    configure(spark)

    def build(*rows: tuple):
        data = [(i, t, "en", "s", len(t or ""), "x", 1, "k") for i, t in rows]
        return spark.createDataFrame(data, DOCUMENTS + ", row string, key int, kept string")
    return build
