"""Whole-phrase containment between two tables of texts, without meeting every text with every phrase."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import contains_whole
from lexmill.session import durable


def phrase_hits(texts: DataFrame, phrases: DataFrame, within: list[str]) -> DataFrame:
    """``texts`` columns but ``hay``, and ``phrases`` columns but ``needle``, for each text that holds a phrase whole.

    ``hay`` and ``needle`` are texts of single blanks between words
    (``functions.text.plain_words``); both tables have the columns ``within``,
    which must be equal. A phrase is looked up by its rarest word, so a text
    meets a phrase only where it has that word. Texts themselves are only
    shuffled once, to those of their words that some phrase is looked up by;
    words travel with the number of their text alone.
    """
    rest = [c for c in phrases.columns if c not in (*within, "needle")]
    kept = durable(texts.where("hay is not null and hay != ''").withColumn("_row", F.monotonically_increasing_id()), "texts")
    each = phrases.where("needle is not null and needle != ''").withColumn("_id", F.struct(*phrases.columns)).select(*within, "_id", F.explode(F.array_distinct(F.split("needle", " "))).alias("_word"))
    asked = each.select(*within, "_word").distinct()
    words = kept.select(*within, "_row", F.explode(F.array_distinct(F.split("hay", " "))).alias("_word"))
    seen = words.groupBy(*within, "_word").agg(F.count(F.lit(1)).alias("_df")).join(asked, [*within, "_word"])
    rare = each.join(seen, [*within, "_word"], "left").groupBy(*within, "_id").agg(F.min_by("_word", F.struct(F.coalesce("_df", F.lit(0)), "_word")).alias("_word"))
    lookup = rare.groupBy(*within, "_word").agg(F.collect_list("_id").alias("_ids"))  # phrases of one rarest word
    met = words.join(lookup, [*within, "_word"]).select("_row", "_ids")
    hits = kept.join(met, "_row").select(*texts.columns, F.explode("_ids").alias("_id")).where(contains_whole(F.col("hay"), F.col("_id.needle")))
    return hits.select(*[c for c in texts.columns if c != "hay"], *[F.col(f"_id.{c}").alias(c) for c in rest])
