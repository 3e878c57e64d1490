"""Hadoop file systems through the JVM: what Spark can read and write, this can list, write and delete."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class Entry:
    path: str
    is_dir: bool
    size: int
    modified_ms: int


class Files:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self._jvm = spark.sparkContext._jvm
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def entries(self, path: str) -> list[Entry]:
        if not self.exists(path):
            return []
        return [Entry(s.getPath().toString(), s.isDirectory(), s.getLen(), s.getModificationTime()) for s in self._fs.listStatus(self._path(path))]

    def read(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Write a new file; False if there is one already."""
        target = self._path(path)
        try:
            stream = self._fs.create(target, False)
        except Exception as e:
            if self._fs.exists(target):
                return False
            raise e
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def rename(self, old: str, new: str) -> bool:
        return self._fs.rename(self._path(old), self._path(new))

    def delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True)

    def close_all(self) -> None:
        """Drop cached file systems, after a failed round."""
        self._jvm.org.apache.hadoop.fs.FileSystem.closeAll()


@contextmanager
def switched(spark: SparkSession, properties: Mapping[str, str]) -> Iterator[None]:
    """The driver's JVM with other system properties; file systems that were opened under the former ones are dropped."""
    system, file_system = spark.sparkContext._jvm.java.lang.System, spark.sparkContext._jvm.org.apache.hadoop.fs.FileSystem
    before = {k: system.getProperty(k) for k in properties}

    def put(values: Mapping[str, str | None]) -> None:
        for k, v in values.items():
            system.clearProperty(k) if v is None else system.setProperty(k, v)
        file_system.closeAll()

    put(properties)
    try:
        yield
    finally:
        put(before)
