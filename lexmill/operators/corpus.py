"""Jobs, batches and reviews of a corpus as reductions of append-only tables."""

from __future__ import annotations

import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.worklist import source_hash

# Review roles, and those that must pass.
ROLES = ("editor", "backtranslation", "fidelity", "adjudicator")
REQUIRED = ("editor", "fidelity", "adjudicator")
#: Contexts that are broadcast.
BROADCAST_ROWS = 10_000
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def content_kind(category: Column, attributed: Column, status: Column) -> Column:
    return F.when(category == "scripture", "scripture").when(attributed, "attributed").when(status.isin("authored", "curated"), "authored").otherwise("uncertain")


def scoped_contexts(jobs: DataFrame, contexts: DataFrame) -> DataFrame:
    """``job context``: contexts whose scope is ``*``, the job's locale or ``category:`` and its category; three equi joins instead of one on a condition."""
    scopes = F.explode(F.array(F.lit("*"), F.col("locale"), F.concat(F.lit("category:"), F.col("category"))))
    stated = contexts.select("scope", "context").distinct()
    # every job has the scope *, so a table of few contexts goes to the jobs; a longer one is joined by shuffling
    if stated.count() <= BROADCAST_ROWS:
        stated = F.broadcast(stated)
    return jobs.select("job", scopes.alias("scope")).join(stated, "scope").select("job", "context").distinct()


def context_counts(jobs: DataFrame, contexts: DataFrame) -> DataFrame:
    """``job n_contexts`` of :func:`scoped_contexts`, where a job has any; contexts of all jobs are counted once instead of meeting every job."""
    stated = contexts.where("context is not null").select("scope", "context").distinct()
    everywhere = stated.where("scope = '*'").select("context")
    every = everywhere.agg(F.count(F.lit(1)).alias("_every"))
    own = stated.where("scope != '*'").join(everywhere, "context", "left_anti")
    known = jobs.select("job", "locale", "category").distinct()
    # the two scopes of a job may state the same context; there are few kinds of jobs
    kinds = known.select("locale", "category").distinct().withColumn("_kind", F.struct("locale", "category"))
    scopes = kinds.select("_kind", F.explode(F.array(F.col("locale"), F.concat(F.lit("category:"), F.col("category")))).alias("scope"))
    counts = scopes.join(own, "scope").groupBy("_kind").agg(F.countDistinct("context").alias("_own")).select("_kind.locale", "_kind.category", "_own")
    each = known.join(counts, ["locale", "category"], "left").groupBy("job").agg(F.max(F.coalesce("_own", F.lit(0))).alias("_own"))
    return each.crossJoin(F.broadcast(every)).select("job", (F.col("_own") + F.col("_every")).alias("n_contexts")).where("n_contexts > 0")  # one row


#: What keeps a job from being exported, in this order.
BLOCKERS = ("unresolved lineage", "no category", "no review", "no context", "uncertain authorship", "scripture differs")


def export_blockers(jobs: DataFrame) -> DataFrame:
    """``job blocker`` of ``job blocked_lineage category passed n_contexts kind text evidence``; a job may have several.

    ``evidence``: the canonical text of a scripture job, null where none is known. Nulls count as what blocks.
    """
    never = lambda c: ~F.coalesce(c, F.lit(False))
    conditions = (
        F.coalesce(F.col("blocked_lineage"), F.lit(True)), F.coalesce(F.trim("category"), F.lit("")) == "", never(F.col("passed")), never(F.col("n_contexts") > 0),
        F.coalesce(F.col("kind"), F.lit("uncertain")) == "uncertain", (F.col("kind") == "scripture") & ~F.col("text").eqNullSafe(F.col("evidence")),
    )
    found = F.array(*[F.when(c, F.lit(b)) for b, c in zip(BLOCKERS, conditions)])
    return jobs.select("job", F.explode(F.filter(found, lambda x: x.isNotNull())).alias("blocker"))


def fingerprints(jobs: DataFrame) -> DataFrame:
    """``jobs`` with ``fingerprint`` over source, locale, group and context."""
    return jobs.withColumn("fingerprint", source_hash("source_hash", "locale", "group_id", "context_hash"))


def carried_jobs(new: DataFrame, old: DataFrame) -> DataFrame:
    """``job fingerprint kept``: old state is kept only for the same fingerprint."""
    o = old.select("job", F.col("fingerprint").alias("was"))
    return new.join(o, "job", "left").select("job", "fingerprint", F.col("was").eqNullSafe(F.col("fingerprint")).alias("kept"))


def lost_jobs(new_ids: DataFrame, old_ids: DataFrame, key: str) -> DataFrame:
    """Ids that an earlier state had; a synchronisation refuses if there are any."""
    return old_ids.select(key).distinct().join(new_ids.select(key).distinct(), key, "left_anti")


def entry_errors(given: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """``key error``: ids missing, extra or given twice."""
    g = given.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    e = expected.select(key).distinct().withColumn("expected", F.lit(True))
    error = F.when(F.col("n").isNull(), "missing").when(F.col("expected").isNull(), "extra").when(F.col("n") > 1, "twice")
    return g.join(e, key, "full").select(key, error.alias("error")).where("error is not null")


def token_parity(pairs: DataFrame, token: str = "{userName}") -> DataFrame:
    """Keys in whose target the token stands another number of times than in the source."""
    n = lambda c: (F.length(c) - F.length(F.replace(F.col(c), F.lit(token), F.lit("")))) / len(token)
    return pairs.where(n("source") != n("target")).select("key")


def current_reviews(events: DataFrame) -> DataFrame:
    """``job candidate role verdict reviewer valid`` from the log ``seq job type role candidate verdict reviewer evidence``.

    The newest candidate of a job counts; of each role its newest review after
    that candidate; an adjudication holds as long as no other review is newer.
    One row per job and role comes out of one aggregation each.
    """
    c = events.where("type = 'candidate'").groupBy("job").agg(F.max_by("candidate", "seq").alias("candidate"), F.max("seq").alias("since"))
    r = events.where("type = 'review'").groupBy("job", "role", F.col("candidate").alias("of")).agg(F.max_by(F.struct("verdict", "reviewer"), "seq").alias("v"), F.max("seq").alias("at"))
    df = c.join(r, "job").where("of = candidate and at > since")
    last = df.where("role != 'adjudicator'").groupBy("job").agg(F.max("at").alias("last_other"))
    df = df.join(last, "job", "left")
    valid = (F.col("role") != "adjudicator") | (F.col("at") > F.coalesce("last_other", F.lit(0)))
    return df.select("job", "candidate", "role", "v.verdict", "v.reviewer", valid.alias("valid"))


def passed(reviews: DataFrame) -> DataFrame:
    """``job``: every required role has a valid pass by its own reviewer."""
    ok = reviews.where(F.col("valid") & (F.col("verdict") == "pass") & F.col("role").isin(*REQUIRED))
    return ok.groupBy("job").agg(F.countDistinct("role").alias("roles"), F.countDistinct("reviewer").alias("people")).where(f"roles = {len(REQUIRED)} and people = roles").select("job")


def job_summary(jobs: DataFrame, candidates: DataFrame, done: DataFrame) -> DataFrame:
    """``status n``: pending, awaiting or reviewed."""
    df = jobs.select("job").distinct()
    df = df.join(candidates.select("job").distinct().withColumn("c", F.lit(True)), "job", "left").join(done.select("job").distinct().withColumn("d", F.lit(True)), "job", "left")
    status = F.when(F.col("d"), "reviewed").when(F.col("c"), "awaiting").otherwise("pending")
    return df.groupBy(status.alias("status")).agg(F.count(F.lit(1)).alias("n"))


def collisions(texts: DataFrame) -> DataFrame:
    """``category locale text_norm n_groups n_rows collision``: equal texts (white space and case aside) of more than one group with at least one new one.

    ``texts``: ``category locale group_id text is_new``. The name of a collision
    changes with its members: it is a sum of their hashes, which needs no list.
    """
    from lexmill.functions.text import casefold, collapse_ws

    df = texts.where("text is not null").withColumn("text_norm", casefold(collapse_ws("text")))
    member = F.conv(F.substring(F.md5(F.concat_ws("|", "group_id", F.col("is_new").cast("string"))), 1, 8), 16, 10).cast("long")
    g = df.withColumn("m", member).groupBy("category", "locale", "text_norm").agg(
        F.countDistinct("group_id").alias("n_groups"), F.count(F.lit(1)).alias("n_rows"), F.max(F.col("is_new").cast("int")).alias("any_new"), F.sum("m").alias("s")
    )
    return g.where("n_groups > 1 and any_new = 1").select("category", "locale", "text_norm", "n_groups", "n_rows", F.md5(F.concat_ws("|", "category", "locale", "text_norm", F.col("s").cast("string"))).alias("collision"))


def unacknowledged(found: DataFrame, decisions: DataFrame) -> DataFrame:
    return found.join(decisions.select("collision").distinct(), "collision", "left_anti")


@F.pandas_udf(T.StringType())
def stable_id(names: pd.Series) -> pd.Series:
    """Name-based ids (version 5), the same for the same name always."""
    return names.map(lambda n: None if n is None else str(uuid.uuid5(NAMESPACE, n)).upper())


def export_rows(jobs: DataFrame, blockers: DataFrame) -> DataFrame:
    """Rows to append: ``id category text language translation_of``; none at all while anything blocks."""
    bad = blockers.agg(F.count(F.lit(1)).alias("bad"))
    free = jobs.crossJoin(F.broadcast(bad)).where("bad = 0")  # one row
    return free.select(stable_id(F.concat_ws("/", "group_id", "locale")).alias("id"), "category", "text", F.col("locale").alias("language"), F.col("source_id").alias("translation_of"))


def changed_inputs(pinned: DataFrame, current: DataFrame) -> DataFrame:
    """``path`` of inputs whose hash is no longer the pinned one, or that are gone."""
    c = current.select("path", F.col("sha256").alias("now"))
    return pinned.join(c, "path", "left").where("now is null or now != sha256").select("path")
