"""The table store: readers during a refresh, failed writes, versions, buckets."""

from __future__ import annotations

import os
import time

import pytest
from compare import files_read
from pyspark.sql import functions as F

from wardmart.session import table_root
from wardmart.sources.store import SHUFFLE_CLEANUP, TableStore


@pytest.fixture
def store(spark):
    return TableStore(spark, table_root(spark))


def test_a_reader_keeps_the_version_it_has(spark, store):
    before = store.write("t", spark.range(3))
    after = store.write("t", spark.range(10))
    assert (before.count(), after.count(), store.read("t").count()) == (3, 10, 10)


def test_a_failed_write_leaves_the_table(spark, store):
    store.write("t", spark.range(3))
    broken = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(Exception, match="no"):
        store.write("t", broken)
    assert store.read("t").count() == 3


def test_a_table_may_be_written_from_itself(spark, store):
    store.write("t", spark.range(3))
    store.write("t", store.read("t").union(store.read("t")))
    assert store.read("t").count() == 6


def test_earlier_versions_go_on_request(spark, store):
    store.write("t", spark.range(3))
    store.write("t", spark.range(4))
    folder = f"{store.root}/t"
    assert len(os.listdir(folder)) == 2
    store.expire()
    assert len(os.listdir(folder)) == 1
    assert store.read("t").count() == 4
    store.release("t")
    assert os.listdir(folder) == []
    assert store.names() == []


def test_buckets_join_without_a_shuffle(spark, store):
    keys = spark.range(200).select((F.col("id") % 50).alias("k"), "id")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = (store.write_bucketed(name, keys, "k", 4) for name in ("left", "right"))
        joined = left.join(right.withColumnRenamed("id", "other"), "k")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
        assert joined.count() == 50 * 16
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partitions_come_back_as_a_column(spark, store):
    table = store.write("t", spark.range(10).withColumn("p", (F.col("id") % 3).cast("int")), "p")
    assert table.where("p = 1").count() == 3
    assert files_read(table.where("p = 1")) < files_read(table)


def test_rows_are_counted_from_footers(spark, store):
    store.write("plain", spark.range(70))
    store.write("parted", spark.range(10).withColumn("p", (F.col("id") % 3).cast("int")), "p")
    store.write("empty", spark.range(0))
    store.write("plain", spark.range(50))
    counts = store.row_counts(["plain", "parted", "empty"])
    text = counts._jdf.queryExecution().executedPlan().toString()
    assert text.count("PushedAggregation: [COUNT(*)]") == 3
    assert "ReadSchema: struct<count(*):bigint>" in text
    assert "struct<id" not in text
    assert {r["table_name"]: r["row_count"] for r in counts.collect()} == {"plain": 50, "parted": 10, "empty": 0}
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def _shuffle_files(spark) -> set[str]:
    blocks = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()
    names = [os.path.basename(path) for path in blocks.getAllFiles().mkString("\n").split("\n")]
    return {name for name in names if name.startswith("shuffle_")}


def test_shuffle_files_go_when_a_table_is_written(spark, store):
    """Neither a plain nor a bucketed write leaves any, and the session keeps its setting."""
    setting, before = spark.conf.get(SHUFFLE_CLEANUP), _shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 50).alias("k")).count()
    store.write("plain", counts)
    store.write_bucketed("dealt", counts, "k", 4)
    deadline = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < deadline:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(SHUFFLE_CLEANUP) == setting
    assert store.read("plain").count() == store.read("dealt").count() == 50
