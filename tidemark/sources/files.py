"""Small file operations through Hadoop's file system API, so any storage Spark can read works."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession

# Masters whose executors are this process.
LOCAL = re.compile(r"local(\[.*\])?")


class Status(NamedTuple):
    """What tells one state of a file from another."""

    length: int
    modified: int


class Files:
    """Names, markers and moves. No table data passes through here."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where.getFileSystem(self._conf), where

    def exists(self, path: str) -> bool:
        fs, where = self._at(path)
        return fs.exists(where)

    def status(self, path: str) -> Status | None:
        """Length and time of change in milliseconds, or None for a missing file."""
        fs, where = self._at(path)
        if not fs.exists(where):
            return None
        found = fs.getFileStatus(where)
        return Status(found.getLen(), found.getModificationTime())

    def names(self, directory: str) -> list[str]:
        """Sorted names in a directory; none if it does not exist."""
        fs, where = self._at(directory)
        if not fs.exists(where):
            return []
        return sorted(s.getPath().getName() for s in fs.listStatus(where))

    def make_directory(self, path: str) -> None:
        fs, where = self._at(path)
        fs.mkdirs(where)

    def move(self, source: str, target: str) -> None:
        fs, where = self._at(source)
        if not fs.rename(where, self._jvm.org.apache.hadoop.fs.Path(target)):
            raise OSError(f"cannot move {source} to {target}")

    def drop(self, path: str) -> None:
        fs, where = self._at(path)
        fs.delete(where, True)

    def read_text(self, path: str) -> str:
        fs, where = self._at(path)
        stream = fs.open(where)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create_text(self, path: str, text: str) -> None:
        """Write a new small file. Fails if it exists, so two runs cannot both commit one name."""
        fs, where = self._at(path)
        stream = fs.create(where, False)
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()


def shared_directory(spark: SparkSession) -> str:
    """The folder all executors share, named by ``spark.checkpoint.dir``.

    Only a local session may go without it; it then gets a temporary folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not LOCAL.fullmatch(spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _own_directory()


@functools.cache
def _own_directory() -> str:
    """A temporary folder of this process, gone when it ends."""
    path = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)
    return path


def scratch(spark: SparkSession, purpose: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_directory(spark)}/{purpose}-{uuid.uuid4().hex}"
