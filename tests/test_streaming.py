"""Streams end with what the batch operators give."""

import datetime

from pyspark.sql import functions as F

from lexmill.operators.worklist import latest_by_key
from lexmill.session import table
from lexmill.streaming import state


def drain(query):
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def test_latest_is_the_batch_result(spark, sf_dir, tmp_path):
    events = table(spark, sf_dir, "events")
    events.repartition(6).write.parquet(str(tmp_path / "in"))
    stream = state.latest_stream(state.read_stream(spark, str(tmp_path / "in"), events.schema, 2), "user_id", ["ts", "event_id"], ["event_id", "event_type"])
    drain(stream.writeStream.outputMode("complete").format("memory").queryName("latest_events").option("checkpointLocation", str(tmp_path / "cp")).start())
    want = latest_by_key(events, "user_id", ["ts", "event_id"], ["event_id", "event_type"])
    assert sorted(map(tuple, spark.table("latest_events").collect())) == sorted(map(tuple, want.collect()))


def test_reviews(spark, tmp_path):
    schema = "job string, seq long, type string, role string, candidate string, verdict string"
    parts = [
        [("j", 1, "candidate", None, "c1", None), ("j", 2, "review", "editor", "c1", "pass"), ("k", 1, "candidate", None, "c", None)],
        [("j", 3, "review", "fidelity", "c1", "pass"), ("j", 4, "review", "adjudicator", "c1", "pass"), ("k", 2, "review", "adjudicator", "c", "pass")],
        [("k", 3, "review", "editor", "c", "pass"), ("k", 4, "review", "fidelity", "c", "pass"), ("j", 5, "candidate", None, "c2", None)],
    ]
    for i, rows in enumerate(parts):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "tmp" / str(i)))
    import glob
    import os
    import shutil

    (tmp_path / "in").mkdir()
    for i in range(len(parts)):
        (path,) = glob.glob(str(tmp_path / "tmp" / str(i) / "*.parquet"))
        target = tmp_path / "in" / f"{i}.parquet"
        shutil.copy(path, target)
        os.utime(target, (1_700_000_000 + i, 1_700_000_000 + i))
    log = state.read_stream(spark, str(tmp_path / "in"), spark.createDataFrame(parts[0], schema).schema, 1)
    drain(state.review_stream(log).writeStream.outputMode("update").format("memory").queryName("reviews").option("checkpointLocation", str(tmp_path / "cp")).start())
    got = {(r.job, r.seq): (r.candidate, r.passed) for r in spark.table("reviews").collect()}
    assert got[("j", 4)] == ("c1", True) and got[("j", 5)] == ("c2", False) and not got[("k", 4)][1]


def test_windows_and_deliveries(spark, sf_dir, tmp_path):
    events = table(spark, sf_dir, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "event_type")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    far = events.agg(F.max("ts")).first()[0] + datetime.timedelta(days=9)
    spark.createDataFrame([(-1, far, "end")], events.schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = state.read_stream(spark, str(tmp_path / "in"), events.schema)
    counts = state.window_counts(stream, "ts", ["event_type"], "1 day", "30 days")
    drain(counts.writeStream.outputMode("update").format("memory").queryName("windows").option("checkpointLocation", str(tmp_path / "cp")).start())
    want = {(r.start, r.event_type): r.n for r in events.groupBy(F.window("ts", "1 day"), "event_type").count().select("window.start", "event_type", F.col("count").alias("n")).collect()}
    got = {(r.start, r.event_type): r.n for r in spark.table("windows").collect() if r.event_type != "end"}
    assert got == want


def test_refused_batch_writes_nothing(spark, sf_dir, tmp_path):
    events = table(spark, sf_dir, "events")
    events.coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = state.read_stream(spark, str(tmp_path / "in"), events.schema)
    query = state.append_valid(stream, lambda b: b.where("event_id < 0"), str(tmp_path / "ok")).option("checkpointLocation", str(tmp_path / "cp")).start()
    drain(query)
    assert spark.read.parquet(str(tmp_path / "ok")).count() == events.count()
