"""Views of the tables as the relations the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.session import table


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key locale variation source target kind category verdict``: adjudicated entries, entries given twice once."""
    a = table(spark, sf_dir, "adjudication_entries")
    key = F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id")
    return a.select(
        key.alias("key"), "locale", F.lit("").alias("variation"), F.col("source.text").alias("source"), F.col("text").alias("target"), "kind", F.col("source.category").alias("category"),
        F.col("source.id").alias("source_id"), F.col("editor_verdict").alias("verdict"),
    ).distinct()


PAIRS = """pairs AS (
  SELECT DISTINCT packet_no || ':' || entry_id AS key, locale, source.text AS source, text AS target, kind, source.category AS category,
    source.id AS source_id, editor_verdict AS verdict FROM adjudication_entries)"""


def imports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key locale variation source target``: imported texts and what became of them."""
    p = table(spark, sf_dir, "pilot_staged").where("imported.text is not null")
    return p.select(F.col("id").alias("key"), F.col("language").alias("locale"), F.lit("").alias("variation"), F.col("imported.text").alias("source"), F.col("text").alias("target")).distinct()


IMPORTS = "imports AS (SELECT DISTINCT id AS key, language AS locale, imported.text AS source, text AS target FROM pilot_staged WHERE imported.text IS NOT NULL)"


def packet_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key packet_no locale variation target kind``: entries sent to editors."""
    p = table(spark, sf_dir, "editor_packets").select("packet_no", "locale", F.explode("entries").alias("e"))
    key = F.concat(F.col("packet_no").cast("string"), F.lit(":"), "e.id")
    return p.select(key.alias("key"), "packet_no", "locale", F.lit("").alias("variation"), F.col("e.text").alias("target"), F.col("e.kind").alias("kind")).distinct()


ENTRIES = """entries AS (
  SELECT DISTINCT packet_no || ':' || e.id AS key, packet_no, locale, e.text AS target, e.kind AS kind
  FROM (SELECT packet_no, locale, unnest(entries) AS e FROM editor_packets))"""


def quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged quotes, each record once."""
    p = table(spark, sf_dir, "pilot_staged")
    return p.select("id", "category", "text", "language", F.col("language").isNotNull().alias("has_language"), F.col("verification").alias("status"), "pair_id", "translation_of", F.col("attribution.name").isNotNull().alias("attributed")).distinct()


QUOTES = "quotes AS (SELECT DISTINCT id, category, text, language, verification AS status, pair_id, translation_of, attribution.name IS NOT NULL AS attributed FROM pilot_staged)"
