"""Folders of a table, through the file system Spark itself uses."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import SparkSession

from daysync.sources.shards import SHARD


class Folder:
    """A table's folder, and the few calls on it that listing and swapping shards need."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path.rstrip("/")
        self._hadoop_path = spark._jvm.org.apache.hadoop.fs.Path
        self._read = spark._jvm.org.apache.commons.io.IOUtils.toString
        self._fs = self._hadoop_path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._hadoop_path(f"{self.path}/{name}" if name else self.path)

    def names(self, inner: str = "") -> list[str]:
        """What lies directly in the folder, or in one inside it; nothing if it is not there."""
        at = self._at(inner)
        return [s.getPath().getName() for s in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def exists(self, name: str = "") -> bool:
        return self._fs.exists(self._at(name))

    def shards(self, among: Collection[str] | None = None) -> list[str]:
        """The days, of those given, that the table has files of; an empty folder is no day."""
        mark = f"{SHARD}="
        days = [n.removeprefix(mark) for n in self.names() if n.startswith(mark)]
        return sorted(d for d in days if (among is None or d in among) and self._has_files(f"{mark}{d}"))

    def _has_files(self, inner: str) -> bool:
        return any(not n.startswith(("_", ".")) for n in self.names(inner))

    def size(self, name: str = "") -> int:
        """Bytes of all files in the folder, or in one inside it."""
        at = self._at(name)
        return self._fs.getContentSummary(at).getLength() if self._fs.exists(at) else 0

    def make(self) -> None:
        self._fs.mkdirs(self._at(""))

    def touch(self, name: str) -> None:
        self._fs.create(self._at(name)).close()

    def write_text(self, name: str, text: str) -> None:
        """A small file that is there whole or not at all, over what was there."""
        self.drop(f".{name}")
        out = self._fs.create(self._at(f".{name}"))
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        self.drop(name)
        self.move(f".{name}", name)

    def read_text(self, name: str) -> str:
        found = self._fs.open(self._at(name))
        try:
            return self._read(found, "UTF-8")
        finally:
            found.close()

    def drop(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def move(self, name: str, to: str) -> None:
        """Rename; nothing may be there."""
        if not self._fs.rename(self._at(name), self._at(to)):
            raise OSError(f"could not move {name} to {to} in {self.path}")
