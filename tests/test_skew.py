"""Hot keys: found, split, and joined without losing or doubling a row."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from wardmart.functions.skew import SHARES, hot_keys, left_join_dealt, left_join_spread, split_hot


def visits(spark, rows=3000):
    """Every third row has one number, the others are spread; some have none."""
    number = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 10 == 1, None)
    key = number.otherwise(F.concat(F.lit("v"), F.col("id") % 400))
    return spark.range(rows).select(key.alias("k"), F.col("id").alias("v"))


def found(hot):
    return {row["k"]: row[SHARES] for row in hot.collect()}


def test_hot_keys_and_their_shares(spark):
    assert found(hot_keys(visits(spark), "k", rows_per_task=250)) == {"hot": 4}
    assert found(hot_keys(visits(spark), "k", rows_per_task=150)) == {"hot": 7, None: 2}
    assert found(hot_keys(visits(spark), "k")) == {}


def test_no_rows_no_hot_keys(spark):
    assert found(hot_keys(visits(spark).where("false"), "k", 1)) == {}


def test_any_number_of_hot_keys_is_found_and_split(spark):
    """2000 keys with four rows each, and a row alone: counts are exact, so none is missed."""
    rows = spark.range(8001).select(
        F.when(F.col("id") < 8000, F.col("id") % 2000).otherwise(-5).alias("k"), F.col("id").alias("_row")
    )
    hot = hot_keys(rows, "k", 2)
    assert found(hot) == dict.fromkeys(range(2000), 2)
    usual, heavy = split_hot(rows, "k", hot)
    assert [r["k"] for r in usual.collect()] == [-5]
    assert heavy.count() == 8000
    joined = left_join_dealt(rows, spark.range(2000).withColumnRenamed("id", "k"), "k", "_row", hot)
    assert joined.count() == 8001


def test_defining_a_join_starts_no_job(spark):
    """Exact counts are part of the plan."""
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("define", "")
    try:
        left = visits(spark).withColumn("_row", F.monotonically_increasing_id())
        hot = hot_keys(left, "k", 100)
        right = left.groupBy("k").agg(F.min("v").alias("first"))
        left_join_dealt(left, right, "k", "_row", hot)
        left_join_spread(right, *split_hot(left, "k", hot), "k", "_row", hot)
        assert list(tracker.getJobIdsForGroup("define")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


@pytest.mark.parametrize("rows_per_task", [100, 10_000])
def test_spread_join_is_a_left_join(spark, rows_per_task):
    right = visits(spark).withColumn("_row", F.monotonically_increasing_id())
    keys = ["hot", "v1", "v2", "absent", None, "hot"]
    left = spark.createDataFrame(list(enumerate(keys)), "n int, k string")
    hot = hot_keys(right, "k", rows_per_task)
    got = left_join_spread(left, *split_hot(right, "k", hot), "k", "_row", hot)
    wanted = left.join(right.drop("_row"), "k", "left")
    assert got.columns == wanted.columns
    assert got.exceptAll(wanted).isEmpty()
    assert wanted.exceptAll(got).isEmpty()


@pytest.mark.parametrize("rows_per_task", [50, 250, 10_000])
def test_dealt_join_is_a_left_join(spark, rows_per_task):
    left = visits(spark).withColumn("_row", F.monotonically_increasing_id())
    names = ["hot", *[f"v{i}" for i in range(0, 400, 3)], "absent"]
    right = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "k string, key int")
    hot = hot_keys(left, "k", rows_per_task)
    got = left_join_dealt(left, right, "k", "_row", hot)
    wanted = left.join(right, "k", "left")
    assert got.columns == wanted.columns
    assert got.exceptAll(wanted).isEmpty()
    assert wanted.exceptAll(got).isEmpty()


def test_dealt_join_spreads_hot_and_missing_keys(spark):
    """No task of the shuffled join gets a third of the rows any more."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = visits(spark, 30_000).withColumn("_row", F.monotonically_increasing_id())
        right = left.groupBy("k").agg(F.min("v").alias("first"))
        for rows_per_task, most in ((1_000_000, 9_000), (500, 2_500)):
            joined = left_join_dealt(left, right, "k", "_row", hot_keys(left, "k", rows_per_task))
            parts = joined.groupBy(F.spark_partition_id())
            sizes = parts.agg(F.count("*").alias("count"), F.max("first")).collect()
            assert sum(r["count"] for r in sizes) == 30_000
            assert (max(r["count"] for r in sizes) > most) == (rows_per_task == 1_000_000)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_adaptive_execution_splits_a_skewed_left_side(spark):
    """The plain lookups rely on this: with low thresholds the skewed partition is split."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2000",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        left = visits(spark, 60_000).repartition(8)
        lookup = spark.range(400).select(F.concat(F.lit("v"), "id").alias("k"), F.col("id").alias("key"))
        joined = left.join(lookup, "k", "left")
        assert joined.count() == 60_000
        joined.collect()
        assert "skew=true" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def test_other_keys_join_on_the_key_alone(spark):
    """So the right side stays where its aggregate put it; only hot keys join on (key, share)."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left = visits(spark).withColumn("_row", F.monotonically_increasing_id())
        right = left.groupBy("k").agg(F.min("v").alias("first"))
        joined = left_join_dealt(left, right, "k", "_row", hot_keys(left, "k", 100))
        text = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert re.search(r"SortMergeJoin \[k#\d+\], \[k#\d+\], LeftOuter", text)


def test_keys_are_counted_one_by_one_in_large_groups_only(spark):
    """Without a hot key the only rows that move are sizes of groups."""
    hot = hot_keys(visits(spark), "k")
    assert hot.collect() == []
    text = hot._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "hashpartitioning(k#" not in text
