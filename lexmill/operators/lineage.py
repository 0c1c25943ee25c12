"""Lineage of quotes: issues of records, groups of counterparts, cycles, sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.operators.skew import hot_keys_of, salted_join
from lexmill.session import durable, forget

# Verification states that may be shipped, and those left out; the form of a language tag.
SHIPPABLE = ("sourced", "sourced_unverified", "supplied_unverified", "authored", "curated", "legacy_unsourced")
EXCLUDED = ("rejected", "not_relevant", "unverified")
TAG = r"^[A-Za-z]{2,3}(?:-[A-Za-z0-9]{2,8})*$"
BLOCKING = {"assumed_english": False, "unknown_original_language": False}


def record_locale(language: Column, present: Column) -> Column:
    """A missing field means en; null and malformed tags are invalid."""
    return F.when(~present, "en").when(language.isNotNull() & language.rlike(TAG), language).otherwise("<invalid>")


def record_issues(quotes: DataFrame) -> DataFrame:
    """``id code blocking`` of ``id category text language has_language status pair_id translation_of``; links are judged by a join with the records themselves."""
    known = quotes.where("id is not null").groupBy("id").agg(F.min("category").alias("parent_category"))
    # most records link to nothing; they stay out of the join, where they would all meet in one task
    parents = known.select(F.col("id").alias("translation_of"), "parent_category")
    alone = quotes.where("translation_of is null").withColumn("parent_category", F.lit(None).cast("string"))
    df = quotes.where("translation_of is not null").join(parents, "translation_of", "left").unionByName(alone)
    empty = lambda c: F.col(c).isNull() | (F.trim(c) == "")
    linked = F.col("translation_of").isNotNull()
    rules = {
        "invalid_category": empty("category"),
        "invalid_text": empty("text"),
        "assumed_english": ~F.col("has_language"),
        "invalid_language": F.col("has_language") & ~F.coalesce(F.col("language").rlike(TAG), F.lit(False)),
        "excluded_status": F.coalesce(F.col("status").isin(*EXCLUDED), F.lit(False)),
        "unknown_verification": ~F.coalesce(F.col("status").isin(*SHIPPABLE, *EXCLUDED), F.lit(False)),
        "invalid_pair_id": F.col("pair_id").isNotNull() & (F.trim("pair_id") == ""),
        "invalid_translation_link": linked & ((F.col("translation_of") == F.col("id")) | (F.trim("translation_of") == "")),
        "missing_translation_target": linked & F.col("parent_category").isNull() & (F.trim("translation_of") != ""),
        "cross_category_translation": linked & (F.col("parent_category") != F.col("category")),
    }
    found = F.array(*[F.when(c, F.struct(F.lit(k).alias("code"), F.lit(BLOCKING.get(k, True)).alias("blocking"))) for k, c in rules.items()])
    return df.select("id", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("i")).select("id", "i.code", "i.blocking")


def identity_errors(quotes: DataFrame) -> DataFrame:
    """``id error``: null and blank ids, and ids of records that differ; with any of them there is no lineage to build. A record sent again is no error."""
    named = quotes.withColumn("_body", F.xxhash64(*[c for c in quotes.columns if c != "id"]))
    counted = named.groupBy("id").agg(F.min("_body").alias("a"), F.max("_body").alias("b"))  # partial before the shuffle
    error = F.when(F.col("id").isNull(), "no id").when(F.trim("id") == "", "blank id").when(F.col("a") != F.col("b"), "different records")
    return counted.select("id", error.alias("error")).where("error is not null")


def lineage_edges(quotes: DataFrame) -> DataFrame:
    """``a b``: a translation and its existing parent of the same category, and each record with the smallest one of its (category, pair id)."""
    known = quotes.where("id is not null").select("id", "category").distinct()
    up = quotes.where("translation_of is not null and id != translation_of").select("id", "category", "translation_of").distinct()
    parents = known.select(F.col("id").alias("translation_of"), F.col("category").alias("c"))
    links = up.join(parents, "translation_of").where(F.col("c") == F.col("category")).select(F.col("id").alias("a"), F.col("translation_of").alias("b"))
    keyed = quotes.where("id is not null and trim(pair_id) != ''").select("id", "category", "pair_id").distinct()
    least = keyed.groupBy("category", "pair_id").agg(F.min("id").alias("b"))  # partial before the shuffle
    stars = keyed.join(least, ["category", "pair_id"]).where("id != b").select(F.col("id").alias("a"), "b")
    return links.union(stars).distinct()


def components(vertices: DataFrame, edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``id root``: the smallest id that each vertex is linked with, directly or through others.

    Alternately every vertex takes the smallest label around it, and labels are
    replaced by their own labels, so that long chains shrink by half each round.
    """
    both = durable(edges.union(edges.select("b", "a")).where("a != b").distinct(), "edges")
    labels = durable(vertices.select("id").distinct().withColumn("root", F.col("id")), "labels")
    hot = hot_keys_of(both, "b")
    for _ in range(max_rounds):
        around = salted_join(both, labels.withColumnRenamed("id", "b"), "b", "a", hot).groupBy("a").agg(F.min("root").alias("m"))
        low = labels.join(around, labels["id"] == around["a"], "left").select("id", F.col("root").alias("old"), F.least("root", F.coalesce("m", "root")).alias("root"))
        low = durable(low, "low")
        above = low.select(F.col("id").alias("root"), F.col("root").alias("higher"))
        # a giant component is one root for all its members
        new = durable(salted_join(low, above, "root", "id", hot_keys_of(low, "root"), how="left").select("id", "old", F.least("root", F.coalesce("higher", "root")).alias("root")), "labels")
        changed = not new.where("root != old").isEmpty()
        forget(low)
        labels = new.select("id", "root")
        if not changed:
            return labels
    raise RuntimeError(f"labels still change after {max_rounds} rounds")


def cycle_members(quotes: DataFrame, max_doublings: int = 40) -> DataFrame:
    """``id`` of records on a cycle of translation links; each has at most one parent, so pointers are doubled.

    After 2^k steps from every vertex of a component that has a cycle the walk
    is on it; the images of enough steps are exactly the vertices on cycles.
    """
    step = quotes.where("id is not null").groupBy("id").agg(F.min("translation_of").alias("to"))
    step = step.where("to is not null")
    step = durable(step.join(step.select(F.col("id").alias("to")), "to", "left_semi").select("id", "to"), "step")
    count = step.count()
    jumps = step
    for _ in range(min(max_doublings, max(1, count.bit_length()))):
        nxt = jumps.select(F.col("id").alias("to"), F.col("to").alias("far"))
        jumps = durable(jumps.join(nxt, "to").select("id", F.col("far").alias("to")), "jumps")
        if jumps.isEmpty():
            break
    return jumps.select(F.col("to").alias("id")).distinct()


def lineage_groups(quotes: DataFrame, roots: DataFrame, requested: list[str]) -> DataFrame:
    """One row per group: ``root n_members n_languages source_id missing ambiguous conflicting``.

    The source is the only linked root (a record without parent that another
    points to), else the only English member, else the only member, else the
    smallest id. Only counts and minima are gathered, never the members.
    """
    q = quotes.dropDuplicates(["id"]).join(roots, "id")
    pointed = quotes.select(F.col("translation_of").alias("id")).where("id is not null").distinct().withColumn("pointed", F.lit(True))
    valid = quotes.select(F.col("id").alias("translation_of")).distinct().withColumn("has_parent", F.lit(True))
    q = q.join(pointed, "id", "left")
    q = q.where("translation_of is not null").join(valid, "translation_of", "left").unionByName(q.where("translation_of is null").withColumn("has_parent", F.lit(None).cast("boolean")))
    locale = F.coalesce("language", F.lit("<invalid>"))
    is_root = F.col("has_parent").isNull()
    linked = is_root & F.col("pointed").isNotNull()
    g = q.groupBy("root").agg(
        F.count(F.lit(1)).alias("n_members"), F.countDistinct(locale).alias("n_languages"), F.countDistinct("pair_id").alias("n_pairs"),
        F.count_if(linked).alias("n_linked"), F.min(F.when(linked, F.col("id"))).alias("linked_root"), F.count_if(locale == "en").alias("n_en"), F.min(F.when(locale == "en", F.col("id"))).alias("en_id"),
        F.min("id").alias("least"), *[F.max((locale == x).cast("int")).alias(f"has_{x}") for x in requested],
    )
    source = F.when(F.col("n_linked") == 1, F.col("linked_root")).when(F.col("n_linked") > 1, F.col("least")).when(F.col("n_en") == 1, F.col("en_id")).otherwise(F.col("least"))
    ambiguous = (F.col("n_linked") > 1) | ((F.col("n_linked") == 0) & (F.col("n_en") != 1) & (F.col("n_members") > 1))
    missing = F.array_join(F.filter(F.array(*[F.when(F.col(f"has_{x}") == 0, F.lit(x)) for x in sorted(requested)]), lambda x: x.isNotNull()), ",")
    return g.select("root", "n_members", "n_languages", source.alias("source_id"), missing.alias("missing"), ambiguous.alias("ambiguous"), (F.col("n_pairs") > 1).alias("conflicting"))


def group_name(pair_id: Column, n_pairs: Column, source_carries: Column, reference: Column, source_id: Column) -> Column:
    """Stable name of a group: by its pair id, else its canonical reference, else its record."""
    return F.when((n_pairs == 1) & source_carries, F.concat(F.lit("pair:"), pair_id)).when(reference.isNotNull(), F.concat(F.lit("reference:"), reference)).otherwise(F.concat(F.lit("record:"), source_id))


def missing_jobs(groups: DataFrame) -> DataFrame:
    """``root source_id locale``: a job for every language that a group lacks."""
    return groups.where("missing != ''").select("root", "source_id", F.explode(F.split("missing", ",")).alias("locale"))
