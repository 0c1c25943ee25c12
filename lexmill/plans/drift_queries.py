"""Queries over drifting glossary files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import drift
from lexmill.session import durable, table

TERM_COLUMNS = ["preferred", "forms", "forbidden", "decided_by", "note"]
OPEN_COLUMNS = ["options", "recommended", "recommended_reason", "decided_by", "status", "decision_date", "priority", "shipped", "note"]
#: Column types of glossary files; what is not named is text.
TYPES = {"terms.forms": "array<string>", "terms.forbidden": "array<string>", "open.options": "array<string>", "open.priority": "int"}


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.field_changes(table(spark, sf_dir, "glossary_files")).select("file_no", "field_path", "change")


def p2_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "glossary_files")
    names = drift.canonical_names(drift.field_changes(files))
    return drift.consistent_table(files, "terms", names, TERM_COLUMNS, TYPES)


def p2_open_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "glossary_files")
    names = drift.canonical_names(drift.field_changes(files))
    return drift.consistent_table(files, "open", names, OPEN_COLUMNS, TYPES)


def p2_path_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Path-type statistics over all files: in how many files a path has which type, and how many values fail the cast to the type most of them have."""
    files = table(spark, sf_dir, "glossary_files")
    names = drift.canonical_names(durable(drift.field_changes(files), "changes"))
    rows = drift.consistent_values(files, names)
    return rows.groupBy("field_path", F.coalesce("type", F.lit("null")).alias("type")).agg(
        F.countDistinct("file_no").alias("files"), F.count(F.lit(1)).alias("n_values"), F.count_if(~F.col("cast_ok")).alias("failed_casts")
    )
