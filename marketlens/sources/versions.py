"""Tables as a row of complete versions, of which readers see the newest.

A version is a folder of Parquet files and a small manifest that names it. Nothing is
moved or overwritten: a writer fills a new folder and then creates the manifest of the
next number, which no other writer can create as well. A manifest that was cut off does
not parse and does not count. Versions stay for a while after they were replaced, for
readers that still use them.
"""

from __future__ import annotations

import json
import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

RETENTION = 3_600.0           # seconds a replaced version stays
ABANDONED = 7 * 24 * 3_600.0  # seconds until a folder without manifest counts as left by a dead writer
MANIFESTS = "_versions"


class VersionedTable:
    """The versions below one folder of any file system that Spark can write to."""

    def __init__(self, spark: SparkSession, root: str):
        self.root = root.rstrip("/")
        self._hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._io = spark.sparkContext._jvm.org.apache.commons.io.IOUtils
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._hadoop.Path(path)

    def _listed(self, folder: str) -> list:
        path = self._path(folder)
        try:
            return list(self._fs.listStatus(path))
        except Py4JJavaError as e:
            if "FileNotFoundException" in e.java_exception.getClass().getName():
                return []
            raise

    def _manifests(self) -> list[tuple[int, object]]:
        """(number, file status), newest first."""
        found = [(s.getPath().getName(), s) for s in self._listed(f"{self.root}/{MANIFESTS}")]
        return sorted(((int(name[:-5]), s) for name, s in found if name.endswith(".json")), key=lambda m: -m[0])

    def _parsed(self, status) -> dict | None:
        try:
            stream = self._fs.open(status.getPath())
            try:
                return json.loads(self._io.toString(stream, "UTF-8"))
            finally:
                stream.close()
        except (Py4JJavaError, ValueError):  # gone in the meantime, or cut off
            return None

    def versions(self) -> list[dict]:
        """Complete versions (version, folder, rows), newest first."""
        return [m for m in (self._parsed(s) for _, s in self._manifests()) if m]

    def current(self) -> str | None:
        """Folder of the newest complete version; None if there is none."""
        for _ in range(5):  # a listing may be older than a clean-up
            manifests = self._manifests()
            for _, status in manifests:
                found = self._parsed(status)
                if found:
                    return f"{self.root}/{found['folder']}"
            if not manifests:
                return None
        return None

    def new_folder(self) -> str:
        return f"{self.root}/data-{uuid.uuid4().hex}"

    def publish(self, folder: str, rows: int) -> int:
        """Make a filled folder the newest version; its number."""
        number = max([n for n, _ in self._manifests()], default=0) + 1
        while True:
            path = self._path(f"{self.root}/{MANIFESTS}/{number:010}.json")
            try:
                stream = self._fs.create(path, False)
                break
            except Py4JJavaError as e:
                if "AlreadyExists" not in e.java_exception.getClass().getName():
                    raise
                number += 1  # another writer was faster
        try:
            stream.write(bytearray(json.dumps(
                {"version": number, "folder": folder.rsplit("/", 1)[1], "rows": rows}).encode()))
        finally:
            stream.close()
        return number

    def discard(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)

    def clean(self, retention: float = RETENTION) -> None:
        """Remove versions that were replaced more than ``retention`` seconds ago, and what dead writers left."""
        now, used, replaced_at = time.time(), set(), None
        for _, status in self._manifests():
            written, found = status.getModificationTime() / 1000, self._parsed(status)
            if replaced_at is not None and now - replaced_at > retention:
                self._fs.delete(status.getPath(), False)  # first out of sight, then the data
                if found:
                    self.discard(f"{self.root}/{found['folder']}")
                continue
            if found:
                used.add(found["folder"])
                replaced_at = written
        for status in self._listed(self.root):
            name = status.getPath().getName()
            if name.startswith("data-") and name not in used and now - status.getModificationTime() / 1000 > ABANDONED:
                self._fs.delete(status.getPath(), True)
