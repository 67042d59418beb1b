"""Directories of a stored table, through the Hadoop file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    """One directory and what lies directly in it."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path  # looked up once, not for each name
        self.path = path.rstrip("/")
        at = self._at("")
        self._fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _at(self, name: str):
        return self._path(f"{self.path}/{name}" if name else self.path)

    def has(self, name: str) -> bool:
        return self._fs.exists(self._at(name))

    def directories(self, prefix: str) -> list[str]:
        """Names of directories starting with ``prefix``: one listing, not recursive."""
        if not self.has(""):
            return []
        found = [s.getPath().getName() for s in self._fs.listStatus(self._at("")) if s.isDirectory()]
        return sorted(n for n in found if n.startswith(prefix))

    def mark(self, name: str) -> None:
        """Create an empty directory."""
        self._fs.mkdirs(self._at(name))

    def remove(self, name: str) -> None:
        self._fs.delete(self._at(name), True)

    def restore(self, source: str, name: str) -> None:
        """Move the directory ``source`` (below this one) to the free place ``name``."""
        if not self._fs.rename(self._at(source), self._at(name)):
            raise OSError(f"cannot move {source} to {name}")
