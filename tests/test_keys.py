"""Dense keys: same numbers as row_number over the whole table, in many tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from wardmart.functions.keys import dense_key, with_row_id, with_unknown
from wardmart.session import table_root
from wardmart.sources.store import TableStore


@pytest.fixture
def store(spark):
    return TableStore(spark, table_root(spark))


@pytest.fixture
def many_partitions(spark):
    """Keep small shuffles apart, so that several range partitions are really used."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_same_as_row_number(spark, store, many_partitions):
    rows = spark.range(5000).select(
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("k"), F.col("id") % 900)).alias("a"),
        (F.col("id") % 11).alias("b"),
        F.col("id").alias("c"),
    )
    got = dense_key(store, "t", with_row_id(rows), ["a", "b", "c"], "key")
    order = [F.col(n).asc_nulls_last() for n in ("a", "b", "c")]
    wanted = rows.withColumn("key", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    assert got.count() == 5000
    assert got.exceptAll(wanted.select(*got.columns)).isEmpty()


def test_equal_rows_spread_over_partitions(spark, store, many_partitions):
    """A third of all rows are copies of one row; they must not end up in one partition."""
    rows = spark.range(9000).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("a")
    )
    keyed = dense_key(store, "copies", with_row_id(rows), ["a"], "key")
    bounds = keyed.agg(F.min("key"), F.max("key"), F.countDistinct("key")).first()
    assert list(bounds) == [1, 9000, 9000]
    staged = store.read("copies__ordered").where("a = 'same'")
    parts = staged.select(F.shiftright("_pos", 33).alias("part")).groupBy("part").count().collect()
    assert len(parts) > 1
    assert max(r["count"] for r in parts) < 3000


def test_the_input_is_read_once(spark, store, many_partitions):
    """Range bounds are sampled from the written rows, not from what made them."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("long")
    def counted(value):
        seen.add(1)
        return value

    rows = spark.range(500).select(counted("id").alias("a"))
    keyed = dense_key(store, "once", rows, ["a"], "key")
    assert keyed.agg(F.max("key")).first()[0] == 500
    assert seen.value == 500
    assert "once__unordered" not in store.names()


def test_only_the_few_partition_counts_meet_in_one_task(spark, store):
    rows = with_row_id(spark.range(100).select(F.col("id").alias("a")))
    keyed = dense_key(store, "plan", rows, ["a"], "key")
    plan = keyed._jdf.queryExecution().executedPlan().toString()
    before_single = plan[plan.index("SinglePartition") :] if "SinglePartition" in plan else ""
    assert "HashAggregate" in before_single
    assert "BroadcastExchange" in plan


def test_unknown_member_takes_the_column_types(spark):
    frame = spark.createDataFrame([("a", 5, None)], "k string, n int, d decimal(18,3)")
    both = with_unknown(frame, {"k": "UNKNOWN"})
    assert both.schema == frame.schema
    assert sorted(map(tuple, both.collect())) == [("UNKNOWN", None, None), ("a", 5, None)]
