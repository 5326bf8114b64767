"""The few file operations a stream needs, on whatever file system a folder lies."""

from __future__ import annotations

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(spark._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self.fs.exists(self.root):
            return []
        return [s.getPath().getName() for s in self.fs.listStatus(self.root)]

    def size(self) -> int:
        """Bytes of all files below the folder."""
        return self.fs.getContentSummary(self.root).getLength()

    def remove(self, name: str) -> None:
        self.fs.delete(self.jvm.org.apache.hadoop.fs.Path(self.root, name), True)
