"""Small file-system helpers over the Hadoop FileSystem of the session.

Only metadata goes through here (directory listings, tiny JSON commit
records); all data is read and written by Spark jobs.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class FileSystem:
    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)

    def _path(self, p: str):
        return self._jvm.org.apache.hadoop.fs.Path(p)

    def exists(self, p: str) -> bool:
        return bool(self._fs.exists(self._path(p)))

    def mkdirs(self, p: str) -> None:
        self._fs.mkdirs(self._path(p))

    def list_names(self, p: str) -> list[str]:
        if not self.exists(p):
            return []
        return sorted(str(s.getPath().getName()) for s in self._fs.listStatus(self._path(p)))

    def list_status(self, p: str) -> list[tuple[str, int, int]]:
        """(name, length, modification time) of the entries of ``p``."""
        if not self.exists(p):
            return []
        return sorted((str(s.getPath().getName()), int(s.getLen()), int(s.getModificationTime()))
                      for s in self._fs.listStatus(self._path(p)))

    def read_text(self, p: str) -> str:
        stream = self._fs.open(self._path(p))
        try:
            return str(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def write_text(self, p: str, text: str, overwrite: bool = False) -> None:
        out = self._fs.create(self._path(p), overwrite)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def rename(self, src: str, dst: str) -> bool:
        return bool(self._fs.rename(self._path(src), self._path(dst)))

    def delete(self, p: str, recursive: bool = True) -> bool:
        return bool(self._fs.delete(self._path(p), recursive))


class CommitConflict(RuntimeError):
    """Another writer has committed the same number."""


class CommitLog:
    """Numbered JSON commit records: ``<dir>/00000000000000000007.json``.

    Numbers are dense: a writer that prepared number n commits it by renaming
    a temporary file into place, which fails if the number is taken, so two
    writers cannot both commit it. A record names the exact folder of every
    table it publishes; what no record names is invisible. The newest record
    is the published state.

    ``_last`` is a hint, written after a commit: readers go on from it by
    probing the next numbers, so finding the newest record doesn't list the
    folder. A lost or stale hint only costs probes.
    """

    def __init__(self, fs: FileSystem, directory: str):
        self.fs = fs
        self.dir = directory

    def _file(self, n: int) -> str:
        return f"{self.dir}/{n:020d}.json"

    def _hint(self) -> int | None:
        try:
            return int(self.fs.read_text(f"{self.dir}/_last"))
        except Exception:  # none yet, or half-written by a lost writer
            names = [n for n in self.fs.list_names(self.dir) if n.endswith(".json")]
            return int(max(names)[:-5]) if names else None

    def last(self) -> int | None:
        """The newest committed number."""
        n = self._hint()
        while n is not None and self.fs.exists(self._file(n + 1)):
            n += 1
        return n

    def latest(self) -> dict | None:
        n = self.last()
        return None if n is None else self.get(n)

    def get(self, n: int) -> dict:
        return json.loads(self.fs.read_text(self._file(n)))

    def of_run(self, run_id: int) -> dict:
        """The first record of a run, by halving: run numbers never fall, and a
        record's own number is never below its run's."""
        low, high = run_id, self.last()
        while low < high:
            middle = (low + high) // 2
            low, high = (middle + 1, high) if self.get(middle)["run_id"] < run_id else (low, middle)
        return self.get(low)

    def commit(self, state: dict | None, record: dict) -> None:
        """Publish ``record`` as the successor of ``state`` (None: the first)."""
        n = 0 if state is None else state["version"] + 1
        record = {**record, "version": n}
        self.fs.mkdirs(self.dir)
        final = self._file(n)
        if self.fs.exists(final):
            raise CommitConflict(f"commit {n} already exists in {self.dir}")
        tmp = f"{self.dir}/.{uuid.uuid4().hex}.tmp"
        self.fs.write_text(tmp, json.dumps(record, sort_keys=True))
        if not self.fs.rename(tmp, final):
            self.fs.delete(tmp, False)
            raise CommitConflict(f"commit {n} lost a race in {self.dir}")
        self.fs.write_text(f"{self.dir}/_last", str(n), overwrite=True)
