"""File metadata: listings as DataFrames, and the few file-system calls a publish needs."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.session import scratch_path


class Files:
    """The file system behind a path, through Spark's own Hadoop configuration."""

    def __init__(self, spark: SparkSession, path: str):
        self._jvm = spark._jvm
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, path: str):
        return self._jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def modified_ms(self, path: str) -> int | None:
        """Modification time of a file, or None when there is none."""
        if not self.exists(path):
            return None
        return self._fs.getFileStatus(self._path(path)).getModificationTime()

    def size(self, path: str) -> int:
        """Bytes of all files below ``path``, from the file system's own summary; 0 when there is none."""
        return self._fs.getContentSummary(self._path(path)).getLength() if self.exists(path) else 0

    def children(self, path: str) -> list[tuple[str, bool]]:
        """(name, is_directory) of the direct children, sorted by name."""
        if not self.exists(path):
            return []
        found = self._fs.listStatus(self._path(path))
        return sorted((status.getPath().getName(), status.isDirectory()) for status in found)

    def modified(self, path: str) -> list[tuple[str, int]]:
        """(name, modification time in milliseconds) of the files in a folder, from one listing."""
        if not self.exists(path):
            return []
        return [(status.getPath().getName(), status.getModificationTime()) for status in self._fs.listStatus(self._path(path)) if status.isFile()]

    def text(self, path: str) -> str:
        """The content of a small file."""
        stream = self._fs.open(self._path(path))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def put(self, path: str, text: str) -> None:
        """Write a small file, replacing one of that name."""
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def ensure_folder(self, path: str) -> None:
        self._fs.mkdirs(self._path(path))

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def move(self, source: str, destination: str) -> None:
        """Rename, replacing whatever holds the destination name."""
        target = self._path(destination)
        self._fs.mkdirs(target.getParent())
        if self._fs.exists(target):
            self._fs.delete(target, True)
        if not self._fs.rename(self._path(source), target):
            raise OSError(f"cannot move {source} to {destination}")


def file_listing(spark: SparkSession, *paths: str) -> DataFrame:
    """path, file_name, length and modificationTime of every data file below the paths.

    Only metadata is read: the content column is never selected. A missing folder lists nothing.
    """
    there = [path for path in paths if len(paths) > 1 or Files(spark, path).exists(path)]
    if not there:
        return spark.createDataFrame([], "path string, file_name string, length bigint, modificationTime timestamp")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there)
    return files.select(
        "path", F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "modificationTime"
    )


@contextmanager
def staged(df: DataFrame) -> Iterator[DataFrame]:
    """``df`` written once to the shared scratch folder and read back, removed afterwards.

    For a computed frame that feeds several branches of a load. Parquet rather than
    ``checkpoint()``, so that each branch still reads only its own columns.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "staged")
    df.write.parquet(path)
    try:
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        Files(spark, path).delete(path)
