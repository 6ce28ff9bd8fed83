"""Parquet tables under one folder: the layer schemas and the full-refresh sink."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CODEC = "zstd"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCK = Lock()
_WRITES: dict[SparkSession, tuple[int, str]] = {}
"""Sessions in which tables are being written: by how many, and the setting to put back."""


class TableStore:
    """Named Parquet tables, each fully replaced on write.

    A write goes to a new folder, and the name moves there when the write is done: who
    reads the table meanwhile goes on with the old files, and a failed write leaves the
    table as it was. The files of earlier versions stay until ``expire``.

    A written table also cuts lineage: what reads it does not depend on any
    executor's memory or shuffle files. Those that made it are removed when it is written:
    else they stay until the driver happens to collect its garbage.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._schemas: dict[str, T.StructType] = {}
        self._paths: dict[str, str] = {}
        self._bucketed: dict[str, str] = {}
        self._old: list[str] = []
        self._footers: SparkSession | None = None

    def path(self, name: str) -> str:
        """The folder of the table's current version."""
        return self._paths[name]

    def write(self, name: str, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        path = self._new_path(name)
        writer = df.write if partition_by is None else df.write.partitionBy(partition_by)
        with _shuffles_removed(self.spark):
            writer.option("compression", CODEC).parquet(path)
        self._switch(name, path, df)
        self._bucketed.pop(name, None)
        return self.read(name)

    def write_bucketed(self, name: str, df: DataFrame, key: str, buckets: int) -> DataFrame:
        """Rows in buckets of ``key``: joins on it do not move them again.

        One task writes a bucket, so keys that hold too many rows must be kept apart.
        Buckets are known to the catalog alone, hence a table there under a name of
        its own, over the files of this version.
        """
        path, table = self._new_path(name), f"wardmart_{name}_{uuid.uuid4().hex[:12]}"
        dealt = df.repartition(buckets, key)
        with _shuffles_removed(self.spark):
            named = dealt.write.bucketBy(buckets, key).sortBy(key).option("compression", CODEC)
            named.option("path", path).saveAsTable(table)
        self._switch(name, path, df)
        self._bucketed[name] = table
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        if name in self._bucketed:
            return self.spark.table(self._bucketed[name])
        return self.spark.read.schema(self._schemas[name]).parquet(self.path(name))

    def release(self, name: str) -> None:
        """Give back the space of a table that nothing reads any more."""
        del self._schemas[name]
        self._remove(self._paths.pop(name))

    def expire(self) -> None:
        """Remove the files of earlier versions, when no one reads them any more."""
        old, self._old = self._old, []
        for path in old:
            self._remove(path)

    def _remove(self, folder: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def names(self) -> list[str]:
        """Catalog listing of the tables written through this store."""
        return sorted(self._schemas)

    def row_counts(self, names: list[str]) -> DataFrame:
        """(table_name, row_count) of stored tables, summed from the footers of their files.

        Only the newer Parquet reader answers from footers, and only under a setting. The
        query therefore belongs to a session of its own, and the given one keeps its settings.
        """
        if self._footers is None:
            self._footers = self.spark.newSession()
            self._footers.conf.set("spark.sql.sources.useV1SourceList", "")
            self._footers.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        # The pushed count of a table without rows is NULL, not 0: each name starts from a zero.
        zero = F.lit(0).cast("long").alias("row_count")
        names_once = F.explode(F.array(*[F.lit(name) for name in names]))
        counts = [self._footers.range(1).select(names_once.alias("table_name"), zero)]
        for name in names:
            rows = self._footers.read.schema(self._schemas[name]).parquet(self.path(name))
            pushed = rows.agg(F.count(F.lit(1)).alias("row_count"))
            counts.append(pushed.where("row_count > 0").select(F.lit(name).alias("table_name"), "row_count"))
        return reduce(DataFrame.unionByName, counts).groupBy("table_name").agg(F.sum("row_count").alias("row_count"))

    def _new_path(self, name: str) -> str:
        return f"{self.root}/{name}/{uuid.uuid4().hex[:12]}"

    def _switch(self, name: str, path: str, df: DataFrame) -> None:
        if name in self._paths:
            self._old.append(self._paths[name])
        self._paths[name], self._schemas[name] = path, _nullable(df.schema)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Spark removes the shuffle files of what is written meanwhile.

    The session's setting is put back after the last of several writes. Other queries of
    that time lose files only when they have ended, and make them again if they go on.
    """
    with _LOCK:
        writing, setting = _WRITES.get(spark) or (0, spark.conf.get(SHUFFLE_CLEANUP))
        _WRITES[spark] = (writing + 1, setting)
        spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        with _LOCK:
            writing, setting = _WRITES.pop(spark)
            if writing > 1:
                _WRITES[spark] = (writing - 1, setting)
            else:
                spark.conf.set(SHUFFLE_CLEANUP, setting)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])
