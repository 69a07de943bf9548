"""The few file-system calls the sinks need, through Hadoop so that any store works."""

from __future__ import annotations

import json

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation, SparkSession


def _fs(spark: SparkSession, pattern: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def numbered(spark: SparkSession, root: str, prefix: str, committed: bool = True) -> list[int]:
    """Sorted numbers n of folders ``<root>/<prefix>=<n>``; only finished writes by default."""
    tail = "/_SUCCESS" if committed else ""
    fs, path = _fs(spark, f"{root}/{prefix}=*{tail}")
    found = []
    for status in fs.globStatus(path) or []:
        folder = status.getPath().getParent() if committed else status.getPath()
        found.append(int(folder.getName().split("=", 1)[1]))
    return sorted(found)


def files_in(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files that a pattern stands for."""
    fs, path = _fs(spark, pattern)
    return sorted(s.getPath().getName() for s in fs.globStatus(path) or [])


def volume(spark: SparkSession, pattern: str) -> int:
    """Bytes of all files that a path or pattern stands for."""
    fs, path = _fs(spark, pattern)
    return sum(fs.getContentSummary(s.getPath()).getLength() for s in fs.globStatus(path) or [])


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of this library; nothing happens if it is not there."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Create or replace a small file."""
    fs, p = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's content; None where it is missing or was not written to its end."""
    fs, p = _fs(spark, path)
    try:
        source = fs.open(p)
    except Py4JJavaError as error:
        if "FileNotFoundException" in error.java_exception.getClass().getName():
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    except Py4JJavaError as error:
        if "ChecksumException" in error.java_exception.getClass().getName():
            return None
        raise
    finally:
        source.close()


def observed(seen: Observation) -> dict:
    """Metrics of a finished write; none where the plan was found to be empty beforehand."""
    try:
        return seen.get
    except Py4JJavaError as error:
        if "AssertionError" in error.java_exception.getClass().getName():
            return {}
        raise


class Record:
    """A small dictionary that is replaced as a whole and survives a crash while it is replaced.

    It alternates between two files, so a file that is cut short leaves the one before it: no
    store has to rename atomically, and nothing is ever listed. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._written: int | None = None  # number of the newest file, once known

    def _slots(self) -> list[tuple[int, dict]]:
        found = []
        for slot in (0, 1):
            text = read_text(self.spark, f"{self.path}.{slot}.json")
            try:
                found.append((json.loads(text)["escrita"], json.loads(text)["valor"]) if text else (-1, None))
            except ValueError:
                found.append((-1, None))
        return found

    def read(self) -> dict | None:
        return max(self._slots(), key=lambda s: s[0])[1]

    def write(self, value: dict) -> None:
        n = (max(s[0] for s in self._slots()) if self._written is None else self._written) + 1
        write_text(self.spark, f"{self.path}.{n % 2}.json", json.dumps({"escrita": n, "valor": value}))
        self._written = n
