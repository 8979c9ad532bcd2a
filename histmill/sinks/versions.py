"""SNK3: create-or-replace of a stage table that survives a failed write.

A version is a folder of its own below the table's path. It is written whole, and then one file,
``CURRENT``, which names it, is replaced by an atomic rename. Whatever fails before leaves the
old version as it was; a reader sees the old table or the new one. The rename is the file
system's own (HDFS and local files rename atomically; on an object store the pointer is one
small put). Old versions stay until ``clean``, so that running readers finish.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "CURRENT"


class VersionedTable:
    """The table below ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _hadoop(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")

    def _store(self):
        return self._hadoop(POINTER).getFileSystem(self._conf)

    def current(self) -> str | None:
        """Name of the version that readers see; None before the first."""
        if not self._store().exists(self._hadoop(POINTER)):
            return None
        return self.spark.read.text(f"{self.path}/{POINTER}").first()[0]

    def stage(self, df: DataFrame, *partition_by: str) -> str:
        """Write a version that no reader sees yet and return its name."""
        name = f"version-{uuid.uuid4().hex}"
        df.write.partitionBy(*partition_by).parquet(f"{self.path}/{name}")
        return name

    def publish(self, name: str) -> None:
        """Make a staged version the current one."""
        fresh = self._hadoop(f"{POINTER}-{name}")
        out = self._store().create(fresh)
        out.writeBytes(name)
        out.close()
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fresh.toUri(), self._conf).rename(
            self._store().makeQualified(fresh), self._store().makeQualified(self._hadoop(POINTER)), how)

    def discard(self, name: str) -> None:
        self._store().delete(self._hadoop(name), True)

    def replace(self, df: DataFrame, *partition_by: str) -> str:
        """Write ``df`` and make it the current version."""
        name = self.stage(df, *partition_by)
        self.publish(name)
        return name

    def read(self, name: str | None = None) -> DataFrame:
        """The current version, or the one of that name."""
        name = name or self.current()
        if name is None:
            raise FileNotFoundError(f"no version of {self.path} is published")
        return self.spark.read.parquet(f"{self.path}/{name}")

    def clean(self) -> int:
        """Delete all versions but the current one, and what failed writes left behind."""
        kept, store, gone = self.current(), self._store(), 0
        for status in store.listStatus(self._hadoop("")):
            name = status.getPath().getName()
            if name not in (kept, POINTER) and (name.startswith("version-") or name.startswith(f"{POINTER}-")):
                store.delete(status.getPath(), True)
                gone += 1
        return gone

