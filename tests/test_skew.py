"""Hot keys are found, split, and lose nothing."""

from pyspark.sql import functions as F

from lexmill.operators import phrases, skew
from lexmill.session import durable, forget
from lexmill.sources.catalog import numbered


def test_salted_join_equals_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 97).cast("string"))).alias("key"), F.col("id"))
    right = left.select("key").distinct().where("key != 'k5'").withColumn("v", F.length("key"))
    hot = skew.hot_keys(left, "key", share=0.1, least=100)
    assert [r.key for r in hot.collect()] == ["hot"]
    for how in ("inner", "left"):
        want = sorted(map(tuple, left.join(right, "key", how).select("key", "id", "v").collect()), key=str)
        salted = skew.salted_join(left, right, "key", "id", hot, 16, how)
        assert sorted(map(tuple, salted.select("key", "id", "v").collect()), key=str) == want
        assert sorted(map(tuple, skew.salted_join(left, right, "key", "id", None, 16, how).select("key", "id", "v").collect()), key=str) == want
    assert skew.hot_keys(left.limit(0), "key").count() == 0
    kept = durable(left, "test")
    assert skew.hot_keys_of(kept, "key") is None
    forget(kept)


def test_numbered_over_many_ranges(spark):
    df = spark.range(1000).select((F.xxhash64("id") % 100000).alias("x"), "id").repartition(7)
    got = [(r.x, r.n) for r in numbered(df, ["x", "id"]).select("x", "n").collect()]
    assert sorted(n for _, n in got) == list(range(1, 1001)) and [x for x, _ in sorted(got, key=lambda r: r[1])] == sorted(x for x, _ in got)
    assert numbered(df.limit(0), ["x"]).count() == 0


def test_phrases(spark):
    texts = spark.createDataFrame([(1, "the red house"), (2, "a red the house"), (3, None), (4, "the")], "id int, hay string")
    items = spark.createDataFrame([("a", "red house"), ("b", "the"), ("c", ""), ("d", "blue")], "item string, needle string")
    assert {(r.id, r.item) for r in phrases.phrase_hits(texts, items, []).collect()} == {(1, "a"), (1, "b"), (2, "b"), (4, "b")}
