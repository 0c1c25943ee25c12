"""All queries of the core, by name, and the SQL beside them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexmill.plans import catalog_queries, corpus_queries, drift_queries

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return catalog_queries.queries() | corpus_queries.queries() | {
        "p2_found": drift_queries.p2_found,
        "p2_terms": drift_queries.p2_terms,
        "p2_open_items": drift_queries.p2_open_items,
        "p2_path_types": drift_queries.p2_path_types,
    }


def oracle_sql() -> dict[str, str]:
    return catalog_queries.oracle_sql() | corpus_queries.oracle_sql()


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_queries.findings_summary(spark, sf_dir)
