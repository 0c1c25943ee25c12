"""Durable steps, shared files and shipped code."""

import os

from pyspark import SparkFiles

from lexmill import session


def test_durable_cuts_the_lineage_and_keeps_rows(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, [1.5])], "n int, s string, x array<double>")
    kept = session.durable(df, "test")
    assert kept.schema == df.schema and sorted(map(str, kept.collect())) == sorted(map(str, df.collect()))
    assert all(session.shared_dir(spark).removeprefix("file://") in p for p in kept.inputFiles())
    session.forget(kept)
    assert not any(os.path.exists(p.removeprefix("file://")) for p in kept.inputFiles())
    assert session.durable(df.limit(0)).count() == 0


def test_files_reach_the_workers(spark):
    name = session.share_file(spark, "lexmill-test-1.bin", b"abc")
    assert session.share_file(spark, name, b"abc") == name

    def read(batches):
        import pyarrow as pa

        for b in batches:
            with open(SparkFiles.get(name), "rb") as f:
                yield pa.RecordBatch.from_arrays([pa.array([f.read().decode()] * b.num_rows)], ["s"])

    assert [r.s for r in spark.range(2).mapInArrow(read, "s string").collect()] == ["abc", "abc"]


def test_code_is_shipped_once(spark):
    session.ship_code(spark)
    session.ship_code(spark)
    names = [os.path.basename(x) for x in spark.sparkContext.listFiles]
    assert len([n for n in names if n.startswith("lexmill-code-")]) == 1
