"""The highest rows of a table, at most so many, without sorting it or sending more than them to the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import durable


def at_most(df: DataFrame, level: Column, size: int) -> DataFrame:
    """Rows of the highest levels that are ``size`` or fewer together.

    ``level`` gives a whole number of a few hundred kinds. A level is taken
    whole or not at all, so that the choice does not depend on the order of rows.
    """
    kept = durable(df.withColumn("_level", level.cast("int")), "levels")
    left, lowest = size, None
    for r in sorted(kept.groupBy("_level").agg(F.count(F.lit(1)).alias("n")).collect(), key=lambda r: -r[0]):
        if r.n > left:
            break
        left, lowest = left - r.n, r[0]
    return kept.where(F.col("_level") >= lowest if lowest is not None else F.lit(False)).drop("_level")


def log_level(n: str) -> Column:
    """A level for counts: eight to each doubling."""
    return F.floor(F.log2(F.col(n).cast("double")) * 8)
