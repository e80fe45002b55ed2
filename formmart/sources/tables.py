"""Parquet tables that are replaced as a whole or not at all.

A table is a folder with one folder a version and the file ``CURRENT``, which names
the version that readers get.  A replacement writes a new version, and only when
all its files are there is a new ``CURRENT`` renamed over the old one.  A job that
fails, or an executor that is lost, leaves the table as it was; a reader that
began on the old version finishes on it, because the versions before the current
one are collected only by a later replacement.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from formmart.session import compact_tables, scratch_path, shuffles_deleted

CURRENT = "CURRENT"


def bucketed_table(df: DataFrame, name: str, key: str, buckets: int, sort: bool = True) -> DataFrame:
    """The frame written as a catalog table with files below the shared folder, bucketed by ``key``.

    Rows are written where they lie: a frame whose partitions each hold one
    bucket (hashed by the key, or one key value a partition) gives one file a bucket.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "tables", name)
    table = f"fm_{name}_{path.rsplit('/', 1)[1]}"
    writer = df.write.bucketBy(buckets, key)
    with compact_tables(spark):
        (writer.sortBy(key) if sort else writer).option("path", path).format("parquet").saveAsTable(table)
    return spark.table(table)


class VersionedTable:
    """A table at ``path`` on any file system that Spark writes to; ``keep`` old versions stay for running readers."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 1):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._at().getFileSystem(self._conf)

    def _at(self, *names: str):
        return self._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *names]))

    def versions(self) -> list[str]:
        """Version folders, oldest first (also those whose writing failed)."""
        if not self._fs.exists(self._at()):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._at())
                      if s.isDirectory() and s.getPath().getName().startswith("v"))

    def current(self) -> str | None:
        if not self._fs.exists(self._at(CURRENT)):
            return None
        stream = self._fs.open(self._at(CURRENT))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8").strip()
        finally:
            stream.close()

    def read(self) -> DataFrame:
        """A scan of the current version; it stays on that version."""
        version = self.current()
        if version is None:
            raise FileNotFoundError(f"no table at {self.path}")
        return self.spark.read.parquet(f"{self.path}/{version}")

    def replace(self, df: DataFrame) -> DataFrame:
        """Make ``df`` the table's content (it may read the table itself); returns a scan of it."""
        last = max([int(v[1:].split("-")[0]) for v in self.versions()], default=0)
        version = f"v{last + 1:012d}-{uuid.uuid4().hex[:8]}"
        with shuffles_deleted(self.spark):
            df.write.parquet(f"{self.path}/{version}")
        self._publish(version)
        self._collect()
        return self.read()

    def _publish(self, version: str) -> None:
        """Rename a complete file over ``CURRENT``: readers see the old name or the new one."""
        draft = self._at(f"_{version}")
        stream = self._fs.create(draft)
        try:
            stream.write(bytearray(version.encode()))
        finally:
            stream.close()
        files = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(draft.toUri(), self._conf)
        overwrite = self._jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = overwrite
        qualified = self._fs.makeQualified
        files.rename(qualified(draft), qualified(self._at(CURRENT)), options)

    def _collect(self) -> None:
        """Delete versions older than the current one but for the last ``keep``."""
        now = self.current()
        old = [v for v in self.versions() if v < now]
        for v in old[:max(0, len(old) - self.keep)]:
            self._fs.delete(self._at(v), True)
