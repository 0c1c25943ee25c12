"""Audits of terms, controls and open items against units."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators.checks import term_hits


def term_prefix_counts(values: DataFrame, terms: DataFrame) -> DataFrame:
    """``locale term prefix n``: units with any form of a term, by the key's first segment. ``terms``: ``locale term_id form``."""
    hits = term_hits(values, terms.select("locale", F.col("form").alias("term")))
    ids = hits.join(terms.select("locale", F.col("form").alias("term"), "term_id").distinct(), ["locale", "term"])
    return ids.select("locale", "term_id", "key").distinct().groupBy("locale", "term_id", F.substring_index("key", ".", 1).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def forbidden_hits(values: DataFrame, terms: DataFrame) -> DataFrame:
    """``key locale term_id form``: of each unit and term the first forbidden form in list order (``locale term_id place form``)."""
    hits = term_hits(values, terms.select("locale", F.col("form").alias("term")))
    every = hits.join(terms.select("locale", "term_id", "place", F.col("form").alias("term")), ["locale", "term"])
    return every.groupBy("key", "locale", "term_id").agg(F.min_by("term", "place").alias("form"))


def control_matches(pairs: DataFrame, controls: DataFrame) -> DataFrame:
    """``key locale label match``: units whose source is a control's label; match is preferred, role:x or drift (a role wins over preferred on equal texts)."""
    label = X.casefold(X.strip_ellipsis("source"))
    c = controls.select("locale", X.casefold(F.col("label")).alias("folded"), "label", "preferred", "roles")
    df = pairs.where("source is not null").withColumn("folded", label).join(c, ["locale", "folded"])
    role = F.element_at(F.array_sort(F.map_keys(F.map_filter("roles", lambda k, v: v == F.col("target")))), 1)
    role = F.when(F.size(F.map_filter("roles", lambda k, v: v == F.col("target"))) > 0, role)
    match = F.when(role.isNotNull(), F.concat(F.lit("role:"), role)).when(F.col("target") == F.col("preferred"), "preferred").otherwise("drift")
    return df.select("key", "locale", "label", match.alias("match"))


def option_counts(values: DataFrame, items: DataFrame) -> DataFrame:
    """``locale option n``: in how many units of the locale an open item's option occurs."""
    options = items.select("locale", F.explode("options").alias("term")).distinct()
    hits = term_hits(values, options).groupBy("locale", "term").agg(F.count(F.lit(1)).alias("n"))
    return options.join(hits, ["locale", "term"], "left").select("locale", F.col("term").alias("option"), F.coalesce("n", F.lit(0)).alias("n"))


def totals(forbidden: DataFrame, controls: DataFrame) -> DataFrame:
    a = forbidden.agg(F.count(F.lit(1)).alias("forbidden_total"))
    return a.crossJoin(controls.agg(F.count_if(F.col("match") == "drift").alias("drift_total")))  # one row each
