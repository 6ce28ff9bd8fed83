"""Finding hot keys, and joining around them.

A hot key never changes which rows come out, only how they are spread. Hot keys are
a DataFrame (key, shares) from exact counts, so nothing runs while a query is being
defined, and every key above one task's share is among them, however many there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROWS_PER_TASK = 1_000_000
"""A key with more rows than this is split."""

KEY_GROUPS = 1 << 16
"""Keys are counted in so many groups first; only those of a full group are counted one by one."""

SHARES = "_shares"
_HOT = "_hot"
_SHARE = "_share"


def hot_keys(df: DataFrame, key: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """(key, _shares): keys with more rows than one task should take, and how to split them.

    A hot key makes its group of keys large, so rows are counted per group of keys first
    (a shuffle of KEY_GROUPS rows a task at most). Only the keys of groups that are large
    enough to hold a hot key are counted one by one: normally none, so no key is shuffled.
    Counts combine before the shuffle. NULL stands for rows without a key.
    """
    group = F.pmod(F.xxhash64(key), F.lit(KEY_GROUPS))
    sizes = df.groupBy(group.alias("_group")).agg(F.count(F.lit(1)).alias("_n"))
    large = F.broadcast(sizes.where(F.col("_n") > rows_per_task).select("_group"))
    within = df.select(key, group.alias("_group")).join(large, "_group", "left_semi")
    counts = within.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_task)
    return counts.select(key, F.ceil(F.col("_n") / rows_per_task).cast("int").alias(SHARES))


def left_join_dealt(left: DataFrame, right: DataFrame, key: str, row_id: str, hot: DataFrame) -> DataFrame:
    """Left join where ``left`` may be full of the ``hot`` keys and ``right`` has one row per key.

    For a right side that comes out of an aggregate: adaptive execution splits only
    joins that read both sides straight from a shuffle. Left rows of hot keys are dealt over
    the shares of their key, also those without a key; the few right rows are repeated. All
    other rows join on the key alone, so a right side aggregated by the key is not moved again.

    ``row_id`` must be fixed at the scan, so that a task that runs again after a lost
    executor puts its rows into the same shares.
    """
    known = _known(hot, key)
    at = F.col(key).eqNullSafe(F.col(_HOT))
    others = left.join(known, at, "left_anti").join(right, key, "left")
    dealt = left.join(known, at).withColumn(_SHARE, F.pmod(F.col(row_id), F.col(SHARES)).cast("int"))
    repeated = _repeated(right.join(known, F.col(key) == F.col(_HOT)), F.col(SHARES))
    spread = dealt.drop(_HOT, SHARES).join(repeated, [key, _SHARE], "left").drop(_SHARE)
    return others.unionByName(spread)


def split_hot(df: DataFrame, key: str, hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of all other keys (also those without a key), and the rows of hot keys."""
    at = F.col(key) == F.col(_HOT)
    return df.join(_known(hot, key), at, "left_anti"), df.join(_known(hot, key), at, "left_semi")


def left_join_spread(
    left: DataFrame, usual: DataFrame, heavy: DataFrame, key: str, right_row_id: str, hot: DataFrame
) -> DataFrame:
    """Left join on ``key`` where the right side may be full of the ``hot`` keys.

    ``usual`` and ``heavy`` are the right side cut by ``split_hot``. Adaptive execution
    can split a skewed left side of an outer join but not the right. A key that is hot
    on the right is known to exist there, so its rows need no outer join: they join
    inner on (key, share), right rows dealt out over the shares and left rows repeated
    per share. ``usual`` may be a table bucketed by the key, which then does not move.
    """
    others, _ = split_hot(left, key, hot)
    at = F.col(key) == F.col(_HOT)
    dealt = heavy.join(_known(hot, key), at).withColumn(
        _SHARE, F.pmod(F.col(right_row_id), F.col(SHARES)).cast("int")
    )
    repeated = _repeated(left.join(_known(hot, key), at), F.col(SHARES))
    spread = repeated.join(dealt.drop(_HOT, SHARES, right_row_id), [key, _SHARE]).drop(_SHARE)
    return others.join(usual.drop(right_row_id), key, "left").unionByName(spread)


def _known(hot: DataFrame, key: str) -> DataFrame:
    """Broadcast by its bound: fewer keys than tasks that the rows would fill."""
    return F.broadcast(hot.select(F.col(key).alias(_HOT), SHARES))


def _repeated(rows: DataFrame, shares: Column) -> DataFrame:
    """Each row once per share of its key."""
    return rows.withColumn(_SHARE, F.explode(F.sequence(F.lit(0), shares - 1))).drop(_HOT, SHARES)
