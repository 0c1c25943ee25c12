"""Contracts of review results: coverage, verdicts, reasons, envelopes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Verdicts, severities, and verdicts that need a reason.
VERDICTS = ("pass", "finding", "not_checked", "not_applicable")
REVIEW_VERDICTS = ("pass", "finding", "not_checked")
SEVERITIES = ("critical", "major", "minor", "preference")
REASONED = ("not_checked", "not_applicable")


def id_coverage(expected: DataFrame, given: DataFrame, key: str) -> DataFrame:
    """``key problem``: missing, extra and duplicate ids, nulls included as one id."""
    g = given.groupBy(F.coalesce(F.col(key).cast("string"), F.lit("<null>")).alias(key)).agg(F.count(F.lit(1)).alias("n"))
    e = expected.select(F.coalesce(F.col(key).cast("string"), F.lit("<null>")).alias(key)).distinct().withColumn("e", F.lit(True))
    problem = F.array(F.when(F.col("n").isNull(), F.lit("missing")), F.when(F.col("e").isNull(), F.lit("extra")), F.when(F.col("n") > 1, F.lit("duplicate")))
    return g.join(e, key, "full").select(key, F.explode(F.filter(problem, lambda x: x.isNotNull())).alias("problem"))


def verdict_errors(results: DataFrame, columns: list[str]) -> DataFrame:
    """``id column error``: verdicts out of their set, and those without the reason they need (``reasons``: array of text)."""
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("v")) for c in columns]))
    df = results.select("id", "reasons", cells.alias("c"))
    no_reason = F.col("c.v").isin(*REASONED) & (F.size(F.filter(F.coalesce("reasons", F.array().cast("array<string>")), lambda x: F.trim(x) != "")) == 0)
    error = F.when(~F.coalesce(F.col("c.v").isin(*VERDICTS), F.lit(False)), "unknown verdict").when(no_reason, "no reason")
    return df.select("id", "c.column", error.alias("error")).where("error is not null")


def translator_errors(expected: DataFrame, candidates: DataFrame, holds: DataFrame) -> DataFrame:
    """``id problem``: coverage of candidates and holds together, ids in both, holds without reason, empty texts."""
    cover = id_coverage(expected, candidates.select("id").union(holds.select("id")).distinct(), "id")
    both = candidates.select("id").intersect(holds.select("id")).select("id", F.lit("candidate and hold").alias("problem"))
    bare = holds.where("reason is null or trim(reason) = ''").select("id", F.lit("hold without reason").alias("problem"))
    empty = candidates.where("text is null or trim(text) = ''").select("id", F.lit("empty text").alias("problem"))
    return cover.union(both).union(bare).union(empty)


def finding_errors(reviews: DataFrame) -> DataFrame:
    """``id problem`` of ``id verdict findings``: verdict and findings that contradict each other, unknown severities, findings without a span."""
    n = F.size(F.coalesce("findings", F.array().cast(reviews.schema["findings"].dataType)))
    bad_severity = F.exists("findings", lambda f: ~F.coalesce(f["severity"].isin(*SEVERITIES), F.lit(False)))
    bare = F.exists("findings", lambda f: f["target_span"].isNull() | (F.trim(f["target_span"]) == ""))
    rules = F.array(
        F.when((F.col("verdict") == "pass") & (n > 0), F.lit("pass with findings")), F.when((F.col("verdict") != "pass") & (n == 0), F.lit("finding without findings")),
        F.when(bad_severity, F.lit("unknown severity")), F.when(bare, F.lit("finding without span")),
    )
    return reviews.select("id", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("problem"))


def envelope_errors(packets: DataFrame, results: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key field``: fields of a result's envelope that differ from its packet's."""
    p = packets.select(key, *[F.col(f).alias(f"_p_{f}") for f in fields])
    df = results.join(p, key)
    wrong = F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_p_{f}")), F.lit(f)) for f in fields])
    return df.select(key, F.explode(F.filter(wrong, lambda x: x.isNotNull())).alias("field"))
