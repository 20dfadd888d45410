from __future__ import annotations

import re
from pathlib import Path

import pytest

import __spark_entry__ as entry
import corpus_pipeline as pipeline
from marketlens.llm import language, neardup, packing, quality, substrings
from marketlens.llm.queries import language_model, quality_model
from tests.llm.test_duplicates import components, removed

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test tables are absent")


def test_stages_take_effect_one_after_the_other(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    kept = []
    for name, stage in pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF_DIR).cache()
        rows = out.collect()
        if name != "packing":
            assert out.columns == columns and {r.doc_id for r in rows} <= set(before)
        if name == "language":
            found = language.identify(docs, language_model(docs)).collect()
            want = {r.doc_id for r in found if r.lang_pred != "und" and r.score >= pipeline.MIN_LANGUAGE_SCORE}
        elif name == "quality":
            model = quality_model(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
            want = {r.doc_id for r in quality.score_quality(docs, model).collect() if r.predicted}
            bad = {r.doc_id for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect() if r.quality == 0}
            assert len(want & bad) < len(bad) / 2
        elif name == "near_duplicates":
            want = {i for i, (_, c) in components([(i, r.text) for i, r in before.items()]).items() if i == c}
        elif name == "repeated_passages":
            want = set(before)
            texts = removed([(i, r.text) for i, r in before.items()], substrings.WINDOW)
            for i, _, n_removed, t in texts:
                row = next(r for r in rows if r.doc_id == i)
                assert row.n_chars == (len(row.text) if n_removed else before[i].n_chars)
                assert row.text == before[i].text if not n_removed else words_of(row.text) == words_of(t)
        else:
            want = set(before)
            assert sum(r.length for r in rows) <= packing.SEQUENCE * len({r.sequence_id for r in rows})
        assert {r.doc_id for r in rows} == want
        kept.append(len(rows))
        docs = out
    assert kept[0] > 0.9 * 200 and neardup.SLOTS == 64


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text)


def test_repeated_passages_leave_the_rest_of_a_text_alone(spark):
    passage = " ".join(f"w{i}" for i in range(20))
    plain = "line one\n\nline two\n    indented\t"
    rows = [(1, f"first\n{passage}\nend"), (2, f"  lead\n\n{passage}\n\n  tail\n"), (3, plain), (4, None), (5, ""),
            (6, passage), (7, "x " * 200_000), (7, "x " * 200_000), (None, passage)]
    columns = ("kept", "starts", "copied", "n_words", "n_removed")
    data = [(i, t, "en", "s", len(t or ""), *[f"{c} {i}" for c in columns]) for i, t in rows]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, "
                                 + ", ".join(f"{c} string" for c in columns))
    out = pipeline.remove_repeated_passages(spark, docs, SF_DIR)
    assert out.columns == docs.columns
    found = sorted((tuple(r) for r in out.collect()), key=str)
    want = {2: "  lead\n\ntail\n", 6: ""}
    assert found == sorted(((i, want.get(i, t), "en", "s", len(want.get(i, t) or ""), *r)
                            for (i, t), (*_, a, b, c, d, e) in zip(rows, data) for r in [(a, b, c, d, e)]), key=str)
    assert pipeline.remove_repeated_passages(spark, docs.limit(0), SF_DIR).count() == 0


def test_run_and_registration(spark):
    assert pipeline.run(spark, SF_DIR).columns == [
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    names = entry.queries()
    for n in range(1, 14):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names
