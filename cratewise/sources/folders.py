"""Folders on whatever file system the session reads: local, HDFS or an object store."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folder:
    def __init__(self, spark: SparkSession, path: str):
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        self._path = hadoop.Path(path)
        self._files = self._path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self._files.exists(self._path)

    def names(self) -> list[str]:
        """Names of the entries; none when the folder is absent."""
        if not self.exists():
            return []
        return [entry.getPath().getName() for entry in self._files.listStatus(self._path)]

    def create(self) -> None:
        self._files.mkdirs(self._path)

    def delete(self) -> None:
        self._files.delete(self._path, True)
