"""WARC archives compressed with a shared Zstandard dictionary.

An archive starts with a skippable frame that holds the dictionary; every record
after it is a frame of its own, so that a reader needs the archive alone and can
start at any record. Tasks write archives next to each other in a shared folder.
Each attempt of a task has a file name of its own, and only the files that the
finished tasks report are read: an attempt that was lost leaves a file behind
that nobody looks at.
"""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.words import configure
from marketlens.session import materialize, shared_dir

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
FRAME = b"\x28\xb5\x2f\xfd"
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MIN_REVISIT_BYTES = 1_000     # smaller payloads are always written in full
DICTIONARY_BYTES = 64 << 10
SAMPLE_RECORDS = 1_000        # records that train an archive's dictionary, at most
SAMPLE_BYTES = 8 << 20
ARCHIVE_BYTES = 256 << 20     # payload bytes after which a task starts another archive
LEVEL = 3


def record(kind: str, page_id: int | None, url: str | None, digest: str, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC record; a revisit has no payload and names the record it repeats."""
    body = payload if kind == "response" else b""
    head = [VERSION, f"WARC-Type: {kind}".encode(), f"WARC-Record-ID: <urn:page:{page_id}>".encode()]
    if url is not None:
        clean = url.replace("\r", "%0D").replace("\n", "%0A")
        head.append(b"WARC-Target-URI: " + clean.encode())
    head += [b"WARC-Date: 1970-01-01T00:00:00Z", b"WARC-Payload-Digest: sha1:" + digest.encode(),
             f"X-Payload-Length: {len(payload)}".encode()]
    if kind == "revisit":
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>".encode(), f"WARC-Profile: {PROFILE}".encode()]
    head += [b"Content-Type: text/html", f"Content-Length: {len(body)}".encode()]
    return b"\r\n".join(head) + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if lines[0] != VERSION:
        raise ValueError("not a WARC record")
    fields = {}
    for line in lines[1:]:
        name, _, value = line.partition(b": ")
        fields[name.decode()] = value.decode()
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record of the wrong length")
    return fields, rest[:size]


def train(samples: list[bytes]) -> bytes:
    """A dictionary from archived records; too few of them are the dictionary themselves."""
    try:
        size = min(DICTIONARY_BYTES, max(1 << 10, sum(map(len, samples)) // 8))
        return zstandard.train_dictionary(size, samples, level=LEVEL).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:] or VERSION


class Archive:
    """Writes one archive: dictionary frame first, then a frame per record."""

    def __init__(self, folder: str, samples: list[bytes]):
        filesystem, path = fs.FileSystem.from_uri(folder)
        self.name = f"pages-{uuid.uuid4().hex}.warc.zst"
        words = train(samples)
        self.file = filesystem.open_output_stream(f"{path}/{self.name}", compression=None)
        self.file.write(struct.pack("<II", SKIPPABLE, len(words)) + words)
        shared = zstandard.ZstdCompressionDict(words)
        shared.precompute_compress(level=LEVEL)
        self.compress = zstandard.ZstdCompressor(level=LEVEL, dict_data=shared).compress
        self.at, self.raw, self.records = 8 + len(words), 0, 0

    def write(self, raw: bytes) -> None:
        frame = self.compress(raw)
        self.file.write(frame)
        self.at += len(frame)
        self.raw += len(raw)
        self.records += 1

    def close(self) -> tuple[str, int, int]:
        self.file.close()
        return self.name, self.records, self.at


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write (page_id, url, payload, digest, record_type, refers_to); returns (name, records, bytes) per archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archive, waiting, size, done = None, [], 0, []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(6)]
            for page_id, url, payload, digest, kind, refers_to in zip(*columns):
                raw = record(kind, page_id, url, digest, payload, refers_to)
                if archive is not None:
                    archive.write(raw)
                else:
                    waiting.append(raw)
                    size += len(raw)
                    if len(waiting) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
                        archive = Archive(folder, waiting)
                        for one in waiting:
                            archive.write(one)
                        waiting, size = [], 0
                if archive is not None and archive.raw >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is None and waiting:
            archive = Archive(folder, waiting)
            for one in waiting:
                archive.write(one)
        if archive is not None:
            done.append(archive.close())
        if done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in zip(*done)], names=["name", "records", "bytes"])

    written = records.mapInArrow(run, "name string, records long, bytes long")
    return materialize(written, "archives")


def records_of(filesystem: fs.FileSystem, path: str) -> Iterator[bytes]:
    """The records of one archive, one at a time."""
    with filesystem.open_input_stream(path, compression=None) as file:
        magic, size = struct.unpack("<II", file.read(8))
        if magic != SKIPPABLE:
            raise ValueError("an archive without its dictionary frame")
        shared = zstandard.ZstdCompressionDict(file.read(size))
        held = b""
        reader = zstandard.ZstdDecompressor(dict_data=shared)
        while True:
            one, parts = reader.decompressobj(), []
            while not one.eof:
                if not held:
                    held = file.read(1 << 20)
                    if not held:
                        if parts or one.unused_data:
                            raise ValueError("an archive that ends within a record")
                        return
                parts.append(one.decompress(held))
                held = one.unused_data if one.eof else b""
            yield b"".join(parts)


def read_archives(archives: DataFrame, folder: str) -> DataFrame:
    """(page_id, url, record_type, payload_digest, payload_bytes, refers_to, payload) of all records.

    A task reads whole archives, a record at a time. The digest and length of a
    response are computed from what was read, those of a revisit are its header's.
    """
    names = ["page_id", "url", "record_type", "payload_digest", "payload_bytes", "refers_to", "payload"]

    def page(reference: str | None) -> int | None:
        number = (reference or "").removeprefix("<urn:page:").removesuffix(">")
        return int(number) if number.lstrip("-").isdigit() else None

    def flush(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                for raw in records_of(filesystem, f"{path}/{name}"):
                    fields, body = parse(raw)
                    kind = fields["WARC-Type"]
                    digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
                    if kind == "response":
                        digest, length = hashlib.sha1(body).hexdigest(), len(body)
                    rows.append((page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), kind, digest, length,
                                 page(fields.get("WARC-Refers-To")), body if kind == "response" else None))
                    size += len(body)
                    if size >= 8 << 20 or len(rows) >= 5_000:
                        yield flush(rows)
                        rows, size = [], 0
                if rows:
                    yield flush(rows)

    # With a number, as names are too short to keep tasks apart by size.
    tasks = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return archives.select("name").repartition(tasks, "name").mapInArrow(
        run, "page_id long, url string, record_type string, payload_digest string, payload_bytes long, "
             "refers_to long, payload binary")


def archive_pages(df: DataFrame, folder: str | None = None, id_col: str = "page_id", url_col: str = "url",
                  payload_col: str = "html") -> DataFrame:
    """Write one record per page to ``folder`` and read all of them back.

    Of equal payloads of at least MIN_REVISIT_BYTES the one of the largest page_id
    is a response and the others, its repeated rows too, are revisits that refer
    to it; an id counts once. Smaller payloads are all responses. A null payload is
    empty. A page without id is a response of its own and read back without id. An id
    with different payloads is judged payload by payload.
    Other columns are not read. An empty table gives no rows and no archive.
    """
    spark = configure(df.sparkSession)
    folder = folder or f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
    if "://" not in folder and not folder.startswith("file:"):
        folder = f"file://{folder}"
    filesystem, path = fs.FileSystem.from_uri(folder)
    filesystem.create_dir(path, recursive=True)
    pages = df.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"),
        F.coalesce(F.col(f"`{payload_col}`").cast("string"), F.lit("")).cast("binary").alias("payload"))
    pages = pages.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    large = pages.filter((F.col("size") >= MIN_REVISIT_BYTES) & F.col("page_id").isNotNull()).select(
        "page_id", "digest", "size")
    kept = large.groupBy("digest", "size").agg(F.max("page_id").alias("kept"), F.count("*").alias("n")).filter("n > 1")
    revisits = large.join(kept, ["digest", "size"]).filter("page_id != kept").select(
        "page_id", "digest", "size", F.col("kept").alias("refers_to")).distinct()
    records = pages.join(revisits, ["page_id", "digest", "size"], "left").select(
        "page_id", "url", "payload", "digest",
        F.when(F.col("refers_to").isNull(), "response").otherwise("revisit").alias("record_type"), "refers_to")
    return read_archives(write_archives(records, folder), folder)
