"""Atomic publication of tables: data aside, a numbered manifest in front.

A published table is a folder with ``_data/<id>`` folders, written once and
never changed, and ``_manifests/<number>.json`` files. A manifest lists the
data folders that make up the table; the highest whole manifest is the table.

* A write puts its rows into a new data folder and then creates the next
  manifest. Readers see the table before or after, never in between; a write
  that dies leaves a folder that no manifest names.
* Creating a manifest fails if its number exists (compare and put): of two
  writers that started from the same state one gets ``ConcurrentWriteError``
  and nothing of it is visible. Appends may then start over from the new state.
* A manifest ends with a closing mark, so a torn one is not read.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

from dropgate.errors import ConcurrentWriteError

END = "\n# end\n"  # closing mark of a whole manifest


@contextmanager
def unsorted_partitions(spark: SparkSession, n: int = 8) -> Iterator[None]:
    """Writes into ``n`` partition folders keep a writer open for each (up to 8) instead of
    sorting all rows of a task by the partition column, which takes memory with the rows."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(min(max(n, 1), 8)))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


class Publication:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _numbers(self) -> list[int]:
        folder = self._path(f"{self.path}/_manifests")
        if not self.fs.exists(folder):
            return []
        names = [str(s.getPath().getName()) for s in self.fs.listStatus(folder)]
        return sorted((int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()), reverse=True)

    def _read(self, number: int) -> dict | None:
        stream = self.fs.open(self._path(f"{self.path}/_manifests/{number:020d}.json"))
        try:
            text = bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()
        return json.loads(text[: -len(END)]) if text.endswith(END) else None

    def current(self) -> tuple[int, dict | None]:
        """(highest number in use, the table's manifest): the highest manifest that is whole."""
        numbers = self._numbers()
        for n in numbers:
            manifest = self._read(n)
            if manifest is not None:
                return numbers[0], manifest
        return (numbers[0] if numbers else 0), None

    def folder(self, part: str = "") -> str:
        """A new data folder; ``part`` is a partition value's folder around it."""
        return f"{self.path}/_data/{part + '/' if part else ''}{uuid.uuid4().hex}"

    def publish(self, seen: int, folders: list[str]) -> None:
        """Make ``folders`` the table, if no manifest came after number ``seen``."""
        target = self._path(f"{self.path}/_manifests/{seen + 1:020d}.json")
        if self._numbers()[:1] not in ([], [seen]) or self.fs.exists(target):
            raise ConcurrentWriteError(f"{self.path} was written by someone else since it was read")
        try:
            stream = self.fs.create(target, False)
        except Exception as e:  # noqa: BLE001 - the file came into being in between
            raise ConcurrentWriteError(f"{self.path} was written by someone else since it was read") from e
        try:
            stream.write(bytearray((json.dumps({"folders": [f[len(self.path) + 1:] for f in folders]}) + END).encode()))
        finally:
            stream.close()

    def folders(self) -> list[str] | None:
        """The data folders of the table now; None if nothing is published."""
        manifest = self.current()[1]
        return None if manifest is None else [f"{self.path}/{f}" for f in manifest["folders"]]

    def unnamed(self) -> list[str]:
        """Data folders that the current manifest does not name: of old states and of writes that died."""
        named, out = set(self.folders() or []), []
        todo = [self._path(f"{self.path}/_data")]
        while todo:
            p = todo.pop()
            if not self.fs.exists(p):
                continue
            for s in self.fs.listStatus(p):
                at, name = s.getPath(), str(s.getPath().getName())
                if "=" in name:
                    todo.append(at)
                elif not any(str(at.toString()).endswith(n[len(self.path):]) for n in named):
                    out.append(str(at.toString()))
        return sorted(out)

    def clean(self) -> int:
        """Remove ``unnamed`` folders; for times when nobody reads an old state or writes."""
        gone = self.unnamed()
        for f in gone:
            self.fs.delete(self._path(f), True)
        return len(gone)
