"""Streams of reviews, deliveries and events. The batch operators have the same results on the same rows."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def read_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 8) -> DataFrame:
    """Parquet files of a folder as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def latest_stream(rows: DataFrame, key: str, order: list[str], values: list[str]) -> DataFrame:
    """The newest record of each key so far (output mode complete or update); only one record per key is state."""
    best = rows.groupBy(key).agg(F.max_by(F.struct(*values), F.struct(*order)).alias("v"))
    return best.select(key, *[F.col(f"v.{v}").alias(v) for v in values])


def window_counts(events: DataFrame, time: str, by: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """``start end <by> n`` per tumbling window; rows later than the watermark are dropped (append mode)."""
    g = events.withWatermark(time, late).groupBy(F.window(time, width), *by).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *by, "n")


def first_deliveries(rows: DataFrame, key: str, time: str, late: str = "2 hours") -> DataFrame:
    """Each record once, however often it is delivered within the watermark."""
    return rows.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


REVIEW_STATE = T.StructType([T.StructField("candidate", T.StringType()), T.StructField("since", T.LongType()), T.StructField("roles", T.StringType())])


def review_stream(log: DataFrame) -> DataFrame:
    """``job candidate passed seq`` after every change of a job's reviews.

    A new candidate clears all reviews; a review counts for the current
    candidate only; any other review makes an adjudication void. State per job
    is a handful of verdicts.
    """
    out = "job string, candidate string, passed boolean, seq long"

    def step(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        candidate, since, packed = state.get if state.exists else (None, -1, "")
        roles = dict(x.split("=", 1) for x in packed.split("|") if x)
        last = since
        for pdf in batches:
            for r in pdf.sort_values("seq").itertuples(index=False):
                last = max(last, int(r.seq))
                if r.type == "candidate" and r.seq > since:
                    if r.candidate != candidate:
                        roles = {}
                    candidate, since = r.candidate, int(r.seq)
                elif r.type == "review" and r.candidate == candidate:
                    if r.role != "adjudicator":
                        roles.pop("adjudicator", None)
                    roles[r.role] = r.verdict
        state.update((candidate, since, "|".join(f"{k}={v}" for k, v in sorted(roles.items()))))
        passed = candidate is not None and all(roles.get(k) == "pass" for k in ("editor", "fidelity", "adjudicator"))
        yield pd.DataFrame({"job": [key[0]], "candidate": [candidate], "passed": [passed], "seq": [last]})

    return log.groupBy("job").applyInPandasWithState(step, out, REVIEW_STATE, "update", GroupStateTimeout.NoTimeout)


def append_valid(rows: DataFrame, violations, target: str):  # noqa: ANN001, ANN201
    """A writer that appends a micro-batch to ``target`` only if ``violations(batch)`` is empty; all or nothing, and once per batch id."""

    def write(batch: DataFrame, number: int) -> None:
        bad = violations(batch)
        if not bad.isEmpty():
            raise ValueError(f"batch {number} is refused")
        batch.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return rows.writeStream.foreachBatch(write)
