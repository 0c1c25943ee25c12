"""Consolidating pairwise links into groups by seed-tree pruning.

Every round each vertex tells its neighbours the smallest vertex it sees
(minimum selection). A vertex that no one, itself included, selects drops out
and hangs as a child under the smallest vertex it was told; those selected are
linked with one another and go on. When no links are left the survivors are the
seeds; their identifiers flow down the forest, last round first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions.text import trim_ws
from lexmill.operators.skew import hot_keys_of, salted_join
from lexmill.session import durable, forget

#: Rounds after which the input is taken to be broken; each round removes at least half of the vertices of a path.
MAX_ROUNDS = 64


def seed_forest(edges: DataFrame, max_rounds: int = MAX_ROUNDS) -> DataFrame:
    """``node``, ``root`` for every vertex of ``edges`` (``u``, ``v``; any order, repeats allowed).

    ``root`` is the smallest vertex of the component that survived the pruning,
    the same for all its vertices. Loops give a vertex that is its own root,
    links with a null end are ignored, an empty table gives an empty result.
    """
    spark = edges.sparkSession
    clean = edges.where("u is not null and v is not null").select("u", "v")
    kind = clean.schema["u"].dataType
    links = durable(clean.union(clean.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v").distinct(), "links")
    vertices = clean.select(F.col("u").alias("node")).union(clean.select("v")).distinct()
    fallen: list[DataFrame] = []
    while not links.isEmpty():
        if len(fallen) >= max_rounds:
            raise RuntimeError(f"links left after {max_rounds} rounds")
        least = links.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        hot = hot_keys_of(links, "u")
        told = salted_join(links, least, "u", "v", hot).select(F.col("v").alias("x"), "m")
        told = durable(told.union(least.select(F.col("u").alias("x"), "m")).distinct(), "told")
        # per vertex: the smallest it was told, and whether it was told itself
        best = told.groupBy("x").agg(F.min("m").alias("best"), F.max(F.col("m") == F.col("x")).alias("stays"))
        fallen.append(durable(best.where("not stays").select(F.col("x").alias("node"), F.col("best").alias("parent")), "fallen"))
        more = salted_join(told, best.select("x", "best"), "x", "m", hot_keys_of(told, "x")).where("m != best")
        pairs = more.select(F.col("m").alias("u"), F.col("best").alias("v"))
        new = durable(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "links")
        forget(told)
        forget(links)
        links = new
    rooted = spark.createDataFrame([], f"node {kind.simpleString()}, root {kind.simpleString()}")
    for step in reversed(fallen):
        parents = rooted.select(F.col("node").alias("parent"), "root")
        flown = salted_join(step, parents, "parent", "node", hot_keys_of(step, "parent"), how="left")
        rooted = durable(rooted.union(flown.select("node", F.coalesce("root", "parent").alias("root"))), "rooted")
    return vertices.join(rooted, "node", "left").select("node", F.coalesce("root", "node").alias("root"))


def consolidate(records: DataFrame, links: DataFrame, id_col: str = "id") -> DataFrame:
    """``group_id``, ``id`` of each record in a group of two or more.

    ``records`` has ``id_col``; ``links`` has ``a``, ``b``: two record ids, or a
    record id and the name of a hub that stands for "all records with this
    key", written so that it cannot be an id (then the hub, not every pair of
    its records, is a vertex). ``group_id`` is the smallest id of the group.
    Ids of links that are no record only connect if they are hubs. Null ids are
    ignored; repeated records and links count once; other columns are ignored.
    """
    # Vertices are 128-bit hashes: half the width of the ids, and evenly spread, which keeps the rounds few.
    vertex = lambda c: F.unhex(F.md5(F.col(c).cast("string")))
    ids = records.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    roots = seed_forest(links.select(vertex("a").alias("u"), vertex("b").alias("v")))
    named = durable(roots.join(ids.withColumn("node", vertex("id")), "node").select("root", "id"), "named")
    groups = named.groupBy("root").agg(F.min("id").alias("group_id"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    return salted_join(named, groups, "root", "id", hot_keys_of(named, "root")).select("group_id", "id")


#: Fixed value: what a pair id reads like, trimmed and in lower case.
PAIR_ID = r"^[\p{L}_]+-[0-9]+$"


def pair_hub(category: str, pair_id: str):
    """The hub of a (category, pair id), null where the pair id is none."""
    tidy = F.lower(trim_ws(pair_id))
    return F.when(tidy.rlike(PAIR_ID), F.concat_ws("\u0001", F.lit("pair"), F.col(category), tidy))


def staged_links(staged: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """``a``, ``b``: the links that the staged and the adjudicated records state."""
    known = staged.select(F.col("id").alias("a")).where("a is not null").distinct()
    own = staged.select(F.col("id").alias("a"), pair_hub("category", "pair_id").alias("b"))
    theirs = adjudicated.select(F.col("source.id").alias("a"), pair_hub("source.category", "source.pair_id").alias("b"))
    older = staged.select(F.col("id").alias("a"), F.col("curation.previous_duplicate_of").alias("b"))
    older = older.where("a is not null and b is not null and a != b").distinct().join(known.withColumnRenamed("a", "b"), "b", "left_semi")
    theirs = theirs.where("a is not null and b is not null").distinct().join(known, "a", "left_semi")
    return own.where("a is not null and b is not null").distinct().union(theirs).union(older.select("a", "b"))
