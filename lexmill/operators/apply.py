"""Guarded changes of a catalog: all of a candidate set, or nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.checks import placeholder_findings

# Plural categories.
CATEGORIES = ("zero", "one", "two", "few", "many", "other")


def candidate_errors(candidates: DataFrame) -> DataFrame:
    """``key error`` of ``key variation value``: empty values, unknown categories, flat and plural at once, twice the same unit."""
    known = F.col("variation").isin("", *[f"plural:{c}" for c in CATEGORIES])
    single = candidates.select("key", F.when(F.coalesce(F.length("value"), F.lit(0)) == 0, "empty value").when(~known, "unknown category").alias("error")).where("error is not null")
    shape = candidates.groupBy("key").agg(F.max((F.col("variation") == "").cast("int")).alias("flat"), F.max((F.col("variation") != "").cast("int")).alias("plural"))
    twice = candidates.groupBy("key", "variation").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.lit("given twice").alias("error"))
    return single.union(shape.where("flat = 1 and plural = 1").select("key", F.lit("flat and plural").alias("error"))).union(twice).distinct()


def plan_changes(units: DataFrame, candidates: DataFrame, overwrite: bool = False) -> DataFrame:
    """``key variation outcome``: unknown, unchanged, locked (translated), blocked (placeholders) or change, the first that holds.

    ``units``: ``key locale variation state source target`` of one locale.
    """
    known = units.select("key").distinct().withColumn("known", F.lit(True))
    now = units.select("key", "variation", "state", F.col("target").alias("old"), "source")
    df = candidates.join(known, "key", "left").join(now, ["key", "variation"], "left")
    pairs = df.where("known and source is not null").select("key", F.lit("").alias("locale"), "variation", "source", F.col("value").alias("target"))
    blocked = placeholder_findings(pairs).where("severity = 'critical'").select("key", "variation").distinct().withColumn("blocked", F.lit(True))
    df = df.join(blocked, ["key", "variation"], "left")
    locked = (F.col("state") == "translated") & F.lit(not overwrite)
    outcome = F.when(F.col("known").isNull(), "unknown").when(F.col("old").eqNullSafe(F.col("value")), "unchanged").when(locked, "locked").when(F.col("blocked"), "blocked").otherwise("change")
    return df.select("key", "variation", outcome.alias("outcome"))


def gate(plan: DataFrame) -> DataFrame:
    """The changes of a plan, or no row at all if any key is unknown, locked or blocked."""
    bad = plan.agg(F.coalesce(F.count_if(F.col("outcome").isin("unknown", "locked", "blocked")), F.lit(0)).alias("bad"))
    return plan.where("outcome = 'change'").crossJoin(F.broadcast(bad)).where("bad = 0").drop("bad")  # one row


def applied(units: DataFrame, candidates: DataFrame, changes: DataFrame, state: str = "needs_review") -> DataFrame:
    """``key variation value state`` after the changes."""
    new = candidates.join(changes.select("key", "variation"), ["key", "variation"], "left_semi").select("key", "variation", F.col("value").alias("new"), F.lit(True).alias("given"))
    df = units.select("key", "variation", F.col("target").alias("value"), "state").join(new, ["key", "variation"], "full")
    return df.select("key", "variation", F.when(F.col("given"), F.col("new")).otherwise(F.col("value")).alias("value"), F.when(F.col("given"), F.lit(state)).otherwise(F.col("state")).alias("state"))


def stray_changes(before: DataFrame, after: DataFrame, allowed: DataFrame) -> DataFrame:
    """``key variation`` that differ although their key is not allowed to; empty for a proper change."""
    from lexmill.operators.packets import changes_between

    unit = lambda df: df.withColumn("unit", F.struct("key", "variation"))
    diff = changes_between(unit(before), unit(after), "unit", ["value", "state"]).select("unit.key", "unit.variation")
    return diff.join(allowed.select("key").distinct(), "key", "left_anti")
