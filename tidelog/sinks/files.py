"""Folder listing on whatever file system a path names."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_DONE = "_SUCCESS"
# A normalised path never holds three slashes in a row.
_BETWEEN = "///"


class Folders:
    """The few file-system calls the lake needs, through Spark's Hadoop client."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self.root = root.rstrip("/")
        path = self._path(self.root)
        self._fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        self._done: set[str] = set()

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def at(self, *parts: str) -> str:
        return "/".join((self.root, *parts))

    def make(self, *parts: str) -> None:
        self._fs.mkdirs(self._path(self.at(*parts)))

    def claim(self, *parts: str) -> bool:
        """Create an empty file; False if it is there already.  One of several callers gets it."""
        try:
            self._fs.create(self._path(self.at(*parts)), False).close()
        except Py4JJavaError as error:
            if self._fs.exists(self._path(self.at(*parts))):
                return False
            raise error
        return True

    def age_seconds(self, *parts: str) -> float | None:
        """Seconds since the entry was written, None if it is not there."""
        path = self._path(self.at(*parts))
        if not self._fs.exists(path):
            return None
        return time.time() - self._fs.getFileStatus(path).getModificationTime() / 1000

    def names(self, *parts: str) -> list[str]:
        """Names of the entries directly below, in order.

        The listing crosses to Python as one string: a call per entry would cost
        more than the listing itself once there are thousands.
        """
        path = self._path(self.at(*parts))
        if not self._fs.exists(path):
            return []
        found = self._jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(self._fs.listStatus(path))
        listing = self._jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(found).mkString(_BETWEEN)
        return sorted(p.rpartition("/")[2] for p in listing.split(_BETWEEN) if p)

    def move(self, source: tuple[str, ...], target: tuple[str, ...]) -> None:
        """Rename one folder; fails if the target is there."""
        if self._fs.exists(self._path(self.at(*target))) or not self._fs.rename(
            self._path(self.at(*source)), self._path(self.at(*target))
        ):
            raise OSError(f"cannot move {source} to {target}")
        self._done.discard(self.at(*source))

    def set_time(self, millis: int, *parts: str) -> None:
        self._fs.setTimes(self._path(self.at(*parts)), millis, -1)

    def is_done(self, *parts: str) -> bool:
        """Whether a Spark write into the folder has been committed.

        A committed folder is never written again, so each is looked up once.
        """
        folder = self.at(*parts)
        if folder not in self._done and self._fs.exists(self._path(f"{folder}/{_DONE}")):
            self._done.add(folder)
        return folder in self._done

    def size(self, *parts: str) -> int:
        path = self._path(self.at(*parts))
        return self._fs.getContentSummary(path).getLength() if self._fs.exists(path) else 0

    def drop(self, *parts: str) -> None:
        """Delete one folder below the root."""
        if not parts or any(p in ("", ".", "..") for p in parts):
            raise ValueError(f"refusing to delete {parts}")
        self._done.discard(self.at(*parts))
        self._fs.delete(self._path(self.at(*parts)), True)
