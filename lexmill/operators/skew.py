"""Joins on keys of which one may hold a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when it holds more than this share of the rows; so at most 1 / HOT_SHARE keys are hot.
HOT_SHARE = 1 / 500
#: Rows under which no key is worth splitting.
HOT_ROWS = 100_000


def hot_keys(df: DataFrame, key: str, share: float = HOT_SHARE, least: int = HOT_ROWS) -> DataFrame:
    """``key``: the hot keys of ``df``, at most ``1 / share`` of them.

    Counting is partial before the shuffle, so that a hot key costs one row per task.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n").alias("_all"))
    return counts.where(F.col("_n") >= least).crossJoin(F.broadcast(total)).where(F.col("_n") > F.col("_all") * share).select(key)


def hot_keys_of(kept: DataFrame, key: str) -> DataFrame | None:
    """:func:`hot_keys` of a written table; None, without counting by key, where it is too short to have any."""
    return hot_keys(kept, key) if kept.count() >= HOT_ROWS else None


def salted_join(left: DataFrame, right: DataFrame, key: str, salt_from: str, hot: DataFrame | None, salts: int = 64, how: str = "inner") -> DataFrame:
    """Join where ``right`` has one row per ``key`` and ``left`` may have very many.

    The left rows of a hot key are spread over ``salts`` tasks by the hash of
    ``salt_from``; its one right row is repeated for each. ``hot`` is bounded by
    :func:`hot_keys`, which is why it may be broadcast; None means no hot key.
    """
    if hot is None:
        return left.join(right, key, how)
    mark = F.broadcast(hot.select(F.col(key), F.lit(True).alias("_hot")))
    spread = F.when(F.col("_hot"), F.pmod(F.xxhash64(salt_from), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    a = left.join(mark, key, "left").withColumn("_salt", spread).drop("_hot")
    every = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    b = right.join(mark, key, "left").withColumn("_salt", F.explode(every)).drop("_hot")
    return a.join(b, [key, "_salt"], how).drop("_salt")
