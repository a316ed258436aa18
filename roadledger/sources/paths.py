"""Paths on whatever file system Hadoop resolves them to."""

from __future__ import annotations

import fnmatch
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def or_empty(spark: SparkSession, schema: StructType, read: Callable[[], DataFrame]) -> DataFrame:
    """The result of ``read``, or no rows under ``schema`` if its path does not exist."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


class Files:
    """The few file-system calls the jobs need, through Hadoop's ``FileSystem``."""

    def __init__(self, spark: SparkSession, root: str):
        self._jvm = spark._jvm
        self._fs = self.path(root).getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def exists(self, name: str) -> bool:
        return self._fs.exists(self.path(name))

    def size(self, name: str) -> int:
        return self._fs.getFileStatus(self.path(name)).getLen()

    def make_folder(self, name: str) -> None:
        self._fs.mkdirs(self.path(name))

    def rename(self, old: str, new: str) -> None:
        """Rename, refusing to nest a folder inside an existing one."""
        if self.exists(new):
            raise FileExistsError(new)
        if not self._fs.rename(self.path(old), self.path(new)):
            raise OSError(f"could not rename {old} to {new}")

    def delete(self, name: str, recursive: bool = False) -> bool:
        return self._fs.delete(self.path(name), recursive)

    def folders(self, glob: str) -> list[str]:
        """Paths matching ``glob``; for levels with few entries, such as dates."""
        return [s.getPath().toString() for s in self._fs.globStatus(self.path(glob)) or []]

    def states(self, parent: str) -> list[tuple[str, int]]:
        """Name and time of change (milliseconds) of each folder in ``parent``, from one listing.
        A folder's time changes when a file is added to it, replaced or removed."""
        if not self.exists(parent):
            return []
        return [(s.getPath().getName(), s.getModificationTime())
                for s in self._fs.listStatus(self.path(parent)) if s.isDirectory()]

    def changes(self, glob: str) -> dict[str, int]:
        """Time of change (milliseconds) of each path matching ``glob``."""
        return {s.getPath().toString(): s.getModificationTime() for s in self._fs.globStatus(self.path(glob)) or []}

    def count(self, folder: str) -> int:
        """Files anywhere under ``folder``, in one call to the file system."""
        return self._fs.getContentSummary(self.path(folder)).getFileCount()

    def empty_files(self, folder: str, pattern: str) -> list[str]:
        """Files of zero length under ``folder`` whose name matches ``pattern``."""
        found, entries = [], self._fs.listFiles(self.path(folder), True)
        while entries.hasNext():
            entry = entries.next()
            if entry.getLen() == 0 and fnmatch.fnmatch(entry.getPath().getName(), pattern):
                found.append(entry.getPath().toString())
        return found

    def names(self, folder: str) -> list[str]:
        """Names directly under ``folder``; for folders whose size is bounded."""
        return [s.getPath().getName() for s in self._fs.listStatus(self.path(folder))]


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file over what is there."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        out.write(bytearray(data))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that it appears complete or not at all."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    partial = jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    out = fs.create(partial, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(partial, target):
        raise OSError(f"could not write {path}")
