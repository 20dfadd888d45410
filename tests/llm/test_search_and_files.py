from __future__ import annotations

import hashlib
import random
import struct
from urllib.parse import urlparse

import numpy as np
import pytest
import zstandard

from marketlens.llm import ann, imatch, warc
from marketlens.session import shared_dir


def exact(rows, modulus, k):
    known = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(
        x is not None and np.isfinite(x) for x in v) and any(v)]
    known = list({i: v for i, v in known}.items())
    out = {}
    for q, x in known:
        if q % modulus == 0:
            near = sorted((-float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), i)
                          for i, y in known if i != q and len(y) == len(x))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


@pytest.mark.parametrize("share, shard_rows", [(100.0, 64), (ann.SHARE, 200)])
def test_nearest(spark, monkeypatch, share, shard_rows):
    monkeypatch.setattr(ann, "SHARD_ROWS", shard_rows)
    monkeypatch.setattr(ann, "QUERY_ROWS", 16)
    rng = np.random.default_rng(0)
    rows = [(i, rng.normal(size=16).tolist()) for i in range(600)]
    rows += [(700 + i, rows[4][1]) for i in range(30)] + [rows[5]] * 2
    rows += [(i, v) for i, v in ((800, None), (801, []), (802, [0.0] * 16), (803, [1.0, None] * 8),
                                 (804, [float("nan")] * 16), (805, [float("inf")] * 16), (None, [1.0] * 16), (810, [1.0, 2.0]))]
    df = spark.createDataFrame([(i, v, "q") for i, v in rows], "vec_id long, embedding array<double>, q string")
    found = {}
    for r in ann.nearest(df, "vec_id % 10 = 0", share=share).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact(rows, 10, 5)
    hits = 0
    for q, near in want.items():
        got = sorted(found.get(q, []))
        assert [g[0] for g in got] == list(range(1, len(got) + 1))
        hits += len({i for i, _ in near} & {g[1] for g in got})
        if share > 1:
            assert [g[2] for g in got] == pytest.approx([s for _, s in near])
            assert [g[1] for g in got if g[2] > 0.999999] == [i for i, s in near if s > 0.999999]
    assert hits / sum(map(len, want.values())) >= (0.99 if share > 1 else 0.9)
    assert set(found) <= set(want)
    assert ann.nearest(df.limit(0), "vec_id % 10 = 0").count() == 0


def pages(rng):
    long = [f"<p>{rng.random()}</p>" * 60 for _ in range(5)]
    rows = [(i, f"http://a/{i}", rng.choice(long)) for i in range(40)]
    rows += [(50 + i, None, "short") for i in range(3)] + [(60, "u\r\nx", None), (61, "", ""), (62, "u", "é" * 600)]
    rows += [(70, "big", "<div>\r\n\r\n</div>" * 200_000), (None, "no id", long[0])]
    return rows


def test_archives_round_trip(spark, monkeypatch):
    monkeypatch.setattr(warc, "SAMPLE_RECORDS", 4)
    monkeypatch.setattr(warc, "ARCHIVE_BYTES", 30_000)
    rows = pages(random.Random(0))
    df = spark.createDataFrame([(i, u, h, "p", 1) for i, u, h in rows],
                               "page_id long, url string, html string, payload string, digest int").repartition(3)
    folder = f"{shared_dir(spark)}/warc-test-{random.random()}"
    got = warc.archive_pages(df, folder).collect()
    last = {}
    for i, _, h in rows:
        if i is not None:
            last[h or ""] = max(last.get(h or "", -1), i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        again = i is not None and len(raw) >= 1000 and last[h] != i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response",
                     last[h] if again else None))
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got),
                  key=repr) == sorted(want, key=repr)
    texts = {i: h for i, _, h in rows}
    assert all(bytes(r.payload).decode() == (texts[r.page_id] or "") for r in got if r.record_type == "response")


def test_archive_format(spark):
    folder = f"{shared_dir(spark)}/warc-format-{random.random()}"
    rows = [(i, f"http://a/{i}", f"<p>page {i} of the same kind</p>" * 9) for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    assert warc.archive_pages(df, folder).count() == 30
    files = spark.read.format("binaryFile").load(folder).collect()
    raw = bytes(files[0].content)
    magic, size = struct.unpack("<II", raw[:8])
    assert magic == 0x184D2A5D and raw[8 + size:12 + size] == warc.FRAME
    words, at, n = zstandard.ZstdCompressionDict(raw[8:8 + size]), raw[8 + size:], 0
    while at:
        one = zstandard.ZstdDecompressor(dict_data=words).decompressobj()
        record, at, n = one.decompress(at), one.unused_data, n + 1
        assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
    assert n == 30 and urlparse(files[0].path).path.endswith(".warc.zst")


def test_no_pages(spark):
    assert warc.archive_pages(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_a_short_archive_is_an_error(tmp_path):
    from pyarrow import fs
    archive = warc.Archive(f"file://{tmp_path}", [b"WARC/1.1 sample " * 4] * 20)
    archive.write(warc.record("response", 1, "u", "d", b"x" * 500, None))
    name, *_ = archive.close()
    whole = (tmp_path / name).read_bytes()
    (tmp_path / name).write_bytes(whole[:-3])
    with pytest.raises(ValueError, match="within a record"):
        list(warc.records_of(fs.LocalFileSystem(), str(tmp_path / name)))


def test_fingerprints(spark, documents):
    rng = random.Random(1)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    rows = [(3 * i, " ".join(rng.choices(words, k=rng.randint(1, 300)))) for i in range(120)]
    rows += [(1, None), (2, ""), (4, "é🙂 ünïcode" * 30), (5, " ".join(rng.choices(words, k=40_000))), (1000, rows[0][1]),
             (7, rows[3][1]), (7, rows[3][1])]
    out = imatch.fingerprints(documents(*rows, (None, "no id"))).collect()
    ordered = sorted((i, t or "") for i, t in rows) + [(None, "no id")]
    following = [t for _, t in ordered[1:]] + [ordered[0][1]]
    want = []
    for (i, t), nxt in zip(ordered, following):
        quarter = len(t) // 4
        want.append((i, len(t), t[:len(t) - quarter] + nxt[:quarter]))
    assert sorted(((r.doc_id, r.n_chars, r.edited) for r in out), key=repr) == sorted(want, key=repr)
    prints = {}
    for r in out:
        text = dict(ordered)[r.doc_id]
        assert prints.setdefault(text, r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if r.edited == text:
            assert r.near_edited == 1
    assert len(set(prints.values())) > 0.9 * len(prints)
    assert np.mean([r.near_edited for r in out]) > np.mean([r.near_next for r in out]) + 0.2
    assert imatch.fingerprints(documents((1, "x")).limit(0)).count() == 0
    assert len(imatch.fingerprints(documents((1, "only one"))).collect()) == 1


def test_fingerprints_of_texts_with_very_many_lexicon_terms(spark, documents):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(20_000)]
    rows = [(i, " ".join(rng.sample(words, 3_000))) for i in range(30)]
    half = len(words) // 2
    rows += [(100, " ".join(words[:half])), (101, " ".join(words[half:])), (102, " ".join(words)), (103, "")]
    out = {r.doc_id: r for r in imatch.fingerprints(documents(*rows)).collect()}
    for i in (100, 101, 102):
        spoken = [h for h in out[i].fingerprint.split(".") if h != imatch.EMPTY]
        assert len(spoken) >= 3 and out[i].near_edited < 1
    assert out[100].near_next == 0 and out[101].near_next < 1 and out[102].near_next == 0
    assert 0 < out[102].near_edited
    assert len({out[i].fingerprint for i in (100, 101, 102, 103)}) == 4


def test_every_number_of_lexicon_terms_has_a_fingerprint(spark):
    sizes = [1, 4, 5, 100, 1_436, 8_000, 100_000, 3_000_000]
    df = spark.createDataFrame([(n,) for n in sizes], "n long").selectExpr(
        "n", "sort_array(transform(sequence(1, n), i -> xxhash64(i))) found")
    df = df.select("n", imatch.subset_hashes(imatch.F.col("found"), imatch.F.lit(7)).alias("hashes"))
    for r in df.collect():
        assert sum(h != imatch.EMPTY for h in r.hashes) >= (2 if r.n <= 100_000 else 1), r.n


def follow(rows):
    """(id, edited text) of each row by brute force."""
    ordered = sorted(rows)
    following = [t for _, t in ordered[1:]] + [ordered[0][1]]
    return [(i, t[:len(t) - len(t) // 4] + n[:len(t) // 4]) for (i, t), n in zip(ordered, following)]


@pytest.mark.parametrize("ids", ["hashes", "gaps"])
def test_next_document_of_large_ids(spark, documents, ids):
    rng = random.Random(2)
    if ids == "hashes":
        keys = [rng.randrange(-(1 << 63), (1 << 63) - 1) for _ in range(400)]
    else:
        keys = [(1 << 60) + (i if i < 200 else (1 << 59) + 999 * i) for i in range(400)]
    rows = [(k, f"{i} " + " ".join(rng.choices("abcdefgh", k=12))) for i, k in enumerate(keys)]
    out = imatch.fingerprints(documents(*rows)).select("doc_id", "edited").collect()
    assert sorted(map(tuple, out)) == follow(rows)


def test_fingerprints_of_a_small_language(spark, documents):
    rng = random.Random(4)
    common = [f"c{i}" for i in range(200)]
    rows = [(i, " ".join(rng.sample(common, 20))) for i in range(2_000)]
    small = {500 * j + 250: [f"s{j}x{i}" for i in range(60 + j)] for j in range(4)}
    few = {500 * j + 350: common[j:j + 3] + [f"f{j}x{i}" for i in range(60 + j)] for j in range(4)}
    rows = [(i, " ".join((small | few)[i]) if i in small | few else t) for i, t in rows]
    out = {r.doc_id: r for r in imatch.fingerprints(documents(*rows)).collect()}
    for group in (small, few):
        assert np.mean([out[i].near_edited for i in group]) > 0.2
        assert np.mean([out[i].near_next for i in group]) < 0.05


def test_an_id_with_two_payloads_and_tasks_of_the_read_back(spark):
    a, b = "a" * 2_000, "b" * 2_000
    rows = [(1, "u", a), (1, "u", b), (9, "u", a), (9, "u", a)] + [(100 + i, "u", f"{i}" * 5) for i in range(200)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(12)
    read = warc.archive_pages(df)
    assert read.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = sorted((r.page_id, r.payload_digest, r.record_type, r.refers_to) for r in read.collect() if r.page_id < 100)
    digest = {x: hashlib.sha1(x.encode()).hexdigest() for x in (a, b)}
    assert found == sorted([(1, digest[a], "revisit", 9), (1, digest[b], "response", None),
                            (9, digest[a], "response", None), (9, digest[a], "response", None)], key=lambda r: r[:2])
