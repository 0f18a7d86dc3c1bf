"""Folders of the shared storage, through the cluster's own file systems."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Folders:
    """Listing, testing and removing folders of the shared storage."""

    def __init__(self, spark: SparkSession) -> None:
        self._path, self._conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()

    def _of(self, path: str):
        target = self._path(path)
        return target.getFileSystem(self._conf), target

    def exists(self, path: str) -> bool:
        files, target = self._of(path)
        return files.exists(target)

    def names(self, path: str) -> list[str]:
        files, target = self._of(path)
        return sorted(s.getPath().getName() for s in files.listStatus(target)) if files.exists(target) else []

    def remove(self, path: str) -> None:
        files, target = self._of(path)
        files.delete(target, True)
