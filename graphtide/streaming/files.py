"""The few file-system calls that have no DataFrame form, on Spark's own file systems."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def join(*parts: str) -> str:
    return "/".join(p.rstrip("/") for p in parts)


class Files:
    """Directory listing and markers on any file system Spark can reach."""

    def __init__(self, spark: SparkSession) -> None:
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        """Names of the direct children, none when the directory does not exist."""
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def size(self, path: str) -> int:
        """Bytes of all files below a directory."""
        fs, p = self._at(path)
        return fs.getContentSummary(p).getLength()

    def content(self, path: str) -> tuple[int, int]:
        """Number of the files below a directory, and their bytes."""
        fs, p = self._at(path)
        summary = fs.getContentSummary(p)
        return summary.getFileCount(), summary.getLength()

    def mark(self, path: str) -> None:
        """Create an empty file; it appears at once or not at all."""
        fs, p = self._at(path)
        fs.create(p, True).close()

    def remove(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)


def byte_count(size: str) -> int:
    """Bytes of a Spark size such as ``64MB`` or ``8k``."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


@contextmanager
def session_setting(spark: SparkSession, key: str, value: str) -> Iterator[None]:
    """A setting of the session for the jobs that are run inside."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new directory every executor can reach.

    It lies below ``spark.checkpoint.dir``, which a cluster sets to shared
    storage.  Only where that is unset, as in local tests, a temporary directory
    of this machine takes its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared directory on a cluster")
        root = tempfile.mkdtemp(prefix="graphtide-")
    return join(root, f"{purpose}-{uuid.uuid4().hex}")
