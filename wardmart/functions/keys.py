"""Dense surrogate keys and unknown members, without a single-task sort."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardmart.sources.store import TableStore

ROW_ID = "_row_id"
_POS = "_pos"
_RUN_BITS = 33


def with_row_id(df: DataFrame) -> DataFrame:
    """Number rows at the scan. Use directly on a stored table, before any shuffle.

    File splits are fixed for a query, so the numbers do not move when a task
    runs again. They only break ties between equal rows and deal out hot keys.
    """
    return df.withColumn(ROW_ID, F.monotonically_increasing_id())


def dense_key(store: TableStore, name: str, df: DataFrame, order: list[str], key: str) -> DataFrame:
    """``key`` = 1..n in the order of ``order`` (NULL last), as ``row_number()`` over all rows.

    A window without partitions would sort the table in one task. Instead:

    1. write the input as it comes, so that whatever joins made it run once: range
       bounds come from a sample, and taking it evaluates the input a second time.
    2. range-partition and sort the written rows by ``order``; their row number as last
       column lets even identical rows spread over partitions. Write that with each
       row's position (partition number in the high bits, row in partition in the low
       bits).
    3. count rows per partition and run a sum over those few counts.
    4. key = rows in earlier partitions + row in partition + 1: a map-only pass.

    The write in step 2 is what makes steps 3 and 4 agree: a plan run twice could cut
    the ranges differently.
    """
    columns = [c for c in df.columns if c != ROW_ID]
    rows = with_row_id(store.write(f"{name}__unordered", df.select(*columns)))
    sort = [*[F.col(c).asc_nulls_last() for c in order], F.col(ROW_ID).asc()]
    ordered = rows.repartitionByRange(*sort).sortWithinPartitions(*sort)
    staged = store.write(
        f"{name}__ordered", ordered.select(*columns, F.monotonically_increasing_id().alias(_POS))
    )

    store.release(f"{name}__unordered")

    run = F.shiftright(F.col(_POS), _RUN_BITS)
    row = F.col(_POS).bitwiseAND(F.lit((1 << _RUN_BITS) - 1))
    earlier = Window.orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        staged.groupBy(run.alias("_run"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    # One row per range partition, so its size is set by the shuffle, not by the data.
    return staged.withColumn("_run", run).join(F.broadcast(offsets), "_run").select(
        (F.col("_before") + row + 1).cast("bigint").alias(key), *columns
    )


def with_unknown(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Add the unknown member: the given values, NULL elsewhere, in the types of ``df``."""
    spark = df.sparkSession
    row: list[Column] = []
    for field in df.schema:
        value = values.get(field.name)
        literal = value if isinstance(value, Column) else F.lit(value)
        row.append(literal.cast(field.dataType).alias(field.name))
    return spark.range(1).select(*row).unionByName(df)
