"""Small driver-side steps on the file system of a lake, whichever one Spark can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Queries run in here delete their shuffle files as soon as they end, failed or not.

    Otherwise these stay on the executors' disks until the driver happens to collect garbage,
    which one that only plans hardly does: a flow of many writes then keeps the shuffles of all
    of them. Only for what runs once, as a write does: a second run would shuffle again.
    """
    normal = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        if normal is None:
            spark.conf.unset(FREE_SHUFFLES)
        else:
            spark.conf.set(FREE_SHUFFLES, normal)


class Files:
    """Folders and short texts below one root. Rows never pass through here."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark.sparkContext._jvm
        self._root = self._jvm.org.apache.hadoop.fs.Path(root)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(self._root, name)

    def delete(self, name: str) -> bool:
        """Delete a file or a whole folder; False if there is none."""
        return self._files.delete(self._path(name), True)

    def make(self, name: str) -> None:
        self._files.mkdirs(self._path(name))

    def names(self, folder: str) -> list[str]:
        """The names in a folder, in order; none if it does not exist."""
        path = self._path(folder)
        if not self._files.exists(path):
            return []
        return sorted(status.getPath().getName() for status in self._files.listStatus(path))

    def matches(self, folder: str, pattern: str) -> list[str]:
        """The paths below a folder that match a pattern, relative to the folder."""
        found = self._files.globStatus(self._path(f"{folder}/{pattern}")) or []
        depth = pattern.count("/") + 1
        return sorted(
            "/".join(status.getPath().toString().rsplit("/", depth)[1:]) for status in found
        )

    def read(self, name: str) -> str:
        stream = self._files.open(self._path(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> None:
        """Write a short text that others see whole or not at all."""
        folder, _, own = name.rpartition("/")
        hidden = f"{folder}/.{own}-{uuid.uuid4().hex}"
        stream = self._files.create(self._path(hidden), False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self._files.rename(self._path(hidden), self._path(name)):
            self.delete(hidden)
            raise RuntimeError(f"{name} could not be published")
