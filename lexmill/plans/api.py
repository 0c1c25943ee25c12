"""Entry points: the operators composed as a user calls them.

Each takes DataFrames and gives DataFrames; where a run must stop on a
violation it gives the violations as well, and :func:`require` raises on them.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import apply, callsites, checks, corpus, lineage, packets, reference, reviews, terms, worklist
from lexmill.sources.catalog import numbered, opaque_ids, packet_rows


def require(violations: DataFrame, what: str) -> None:
    """Raises if there is any violation; one small action."""
    first = violations.limit(5).collect()
    if first:
        raise ValueError(f"{what}: " + ", ".join(str(tuple(r)) for r in first))


class CatalogReport(NamedTuple):
    findings: DataFrame
    summary: DataFrame
    ratios: DataFrame
    tiers: DataFrame


def check_catalog(units: DataFrame, locale: str, requested: DataFrame | None = None, forbidden: DataFrame | None = None, excluded: DataFrame | None = None, trigger: float = 1.35, source_locale: str = "en") -> CatalogReport:
    """All checks of a catalog's units (``sources.catalog.read_units``) for one locale.

    ``requested`` keys limit what is reported, except that divergence is judged
    over the whole catalog; ``excluded`` keys are checked for nothing. A missing
    table skips its check.
    """
    plain = units.where("variation is not null and locale is not null")
    two = plain.where(F.col("locale").isin(locale, source_locale))
    pairs = checks.source_units(two, source_locale)
    comments = units.select("key", "comment").distinct()
    found = checks.placeholder_findings(pairs.join(comments, "key", "left"))
    for more in (checks.plural_findings(two, source_locale), checks.markup_findings(pairs), checks.typography_findings(pairs), checks.identity_findings(pairs), checks.comment_findings(comments)):
        found = found.unionByName(more)
    found = found.unionByName(checks.state_findings(plain, requested if requested is not None else units.select("key"), locale))
    flat = pairs.where("variation = ''")
    found = found.unionByName(checks.divergence_findings(flat, selected=requested))
    if forbidden is not None:
        found = found.unionByName(checks.glossary_findings(pairs, forbidden))
    if requested is not None:
        found = found.join(requested.select("key").distinct(), "key", "left_semi").select(*checks.FINDING)
    if excluded is not None:
        found = checks.without(found, excluded)
    plural = F.max(F.col("variation").startswith("plural:").cast("int")) == 1
    tiers = plain.where(F.col("locale") == source_locale).groupBy("key").agg(F.max("value").alias("value"), plural.alias("plural"))
    return CatalogReport(found, checks.summary(found), checks.render_list(pairs, trigger), tiers.select("key", checks.tier(F.coalesce("value", F.lit("")), F.col("plural"), F.lit(False)).alias("tier")))


def slice_catalog(units: DataFrame, keys: DataFrame, locale: str, source_locale: str = "en") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(packet rows of the keys, the blind targets with opaque ids, unknown keys)."""
    rows = packet_rows(units.join(keys.select("key").distinct(), "key", "left_semi"), locale, source_locale)
    return rows, opaque_ids(rows), keys.select("key").distinct().join(units.select("key").distinct(), "key", "left_anti")


def build_worklist(units: DataFrame, locale: str, records: DataFrame, baseline: DataFrame | None = None, source_locale: str = "en") -> tuple[DataFrame, DataFrame]:
    """(``key status excluded``, ``feature batch class key``): what to do, and the batches of what isn't done."""
    source = F.max(F.when(F.col("locale") == source_locale, F.col("value")))
    base = units.groupBy("key").agg(source.alias("source"), F.max("comment").alias("comment"), F.min("pos").alias("pos"), (F.max((F.col("locale") == locale).cast("int")) == 1).alias("has_target"))
    hashed = base.withColumn("source_hash", worklist.source_hash("source", "comment"))
    current = hashed.join(worklist.target_state(units, locale), "key")
    status = worklist.work_status(current, records, baseline)
    status = status.join(base.select("key", worklist.fallback_exclusion(F.col("source"), F.col("key"), F.col("has_target")).alias("excluded")), "key")
    todo = base.join(status.where("status != 'unchanged_passed' and excluded is null").select("key"), "key", "left_semi").withColumn("group", X.group_of("key"))
    classes = worklist.group_class(todo.select("group", "key", "comment"))
    batches = worklist.pack_batches(todo.join(classes.select("group", "class"), "group").withColumn("feature", F.substring_index("key", ".", 1)))
    return status, batches


class TermReport(NamedTuple):
    counts: DataFrame
    forbidden: DataFrame
    controls: DataFrame
    options: DataFrame
    totals: DataFrame


def audit_terms(pairs: DataFrame, glossary_terms: DataFrame, controls: DataFrame, items: DataFrame) -> TermReport:
    """Terms, forbidden forms, controls and open options of glossaries (``sources.reference.read_glossary``) against pairs."""
    forms = glossary_terms.select("locale", "term_id", F.posexplode("forms").alias("place", "form"))
    bad = terms.forbidden_hits(pairs, glossary_terms.select("locale", "term_id", F.posexplode("forbidden").alias("place", "form")))
    matches = terms.control_matches(pairs, controls)
    return TermReport(terms.term_prefix_counts(pairs, forms), bad, matches, terms.option_counts(pairs, items), terms.totals(bad, matches))


def build_packets(entries: DataFrame, within: str = "batch") -> DataFrame:
    """``opaque_id key <within> before after control n_siblings n_facts`` of ``key pos source comment`` and the batch.

    Opaque ids follow the catalog's order over all batches; neighbours are those of the batch.
    """
    ids = numbered(entries.select("key", "pos"), ["pos", "key"]).select("key", F.concat(F.lit("s"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("opaque_id"))
    chain = worklist.neighbours(entries, within, ["pos", "key"], "key")
    facts = packets.invariants(entries).groupBy("key").agg(F.count(F.lit(1)).alias("n_facts"))
    siblings = packets.same_source(entries.select("key", "source")).select("key", "n_siblings")
    df = entries.select("key", packets.control_kind(F.col("key"), F.col("comment")).alias("control")).join(chain, "key").join(ids, "key").join(siblings, "key", "left").join(facts, "key", "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return df.select("opaque_id", "key", within, "before", "after", "control", zero("n_siblings"), zero("n_facts"))


def leak_report(blind: DataFrame, forbidden: DataFrame, allowed: DataFrame | None = None, path: str = "") -> DataFrame:
    """Leaks of ``blind`` (``key`` and a JSON ``document``); items that are long segments of the output path count as well."""
    leaves = packets.leaves(blind, "key", "document").select(F.concat_ws(" ", "key", "path").alias("key"), "leaf")
    parts = [(s,) for p in path.split("/")[-2:] for s in p.split(".") if len(s) >= 5]
    items = forbidden.select("item")
    if parts:
        items = items.union(blind.sparkSession.createDataFrame(parts, "item string"))
    return packets.leaks(leaves, items, allowed)


def plan_apply(units: DataFrame, candidates: DataFrame, overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """(changes, violations) of a candidate set; with any violation there is no change."""
    plan = apply.plan_changes(units, candidates, overwrite)
    errors = apply.candidate_errors(candidates)
    blocked = plan.where(F.col("outcome").isin("unknown", "locked", "blocked")).select("key", F.col("outcome").alias("error")).union(errors).distinct()
    bad = errors.agg(F.count(F.lit(1)).alias("n"))
    return apply.gate(plan).crossJoin(F.broadcast(bad)).where("n = 0").drop("n"), blocked  # one row


def check_brief(docs: DataFrame, headings: list[str], template: DataFrame, known_keys: DataFrame, roots: list[str]) -> DataFrame:
    """``id problem detail`` of Markdown briefs (``id text``)."""
    lines = reference.markdown_lines(docs, "id", "text")
    row = lambda df, p, d: df.select("id", F.lit(p).alias("problem"), d.cast("string").alias("detail"))
    empty = reference.section_sizes(lines).where("n_filled = 0")
    return (
        row(reference.heading_order_errors(lines, headings), "headings", F.col("headings"))
        .union(row(empty, "empty section", F.col("heading")))
        .union(row(reference.template_lines(lines, template), "template line", F.col("line")))
        .union(row(reference.honesty_findings(lines), "claim", F.col("sentence")))
        .union(row(reference.cited_keys(lines, known_keys, roots), "unknown key", F.col("token")))
    )


def canonical_index(references: DataFrame, verses: DataFrame, books: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(``reference text``, ``reference problem``): texts of references (``Book C:V-W``) whose verses are all there. ``books``: ``book id``."""
    parsed = reference.parse_references(references.select("reference").distinct()).join(F.broadcast(books), "book", "left")
    good = parsed.where("error is null and id is not null").drop("book").withColumnRenamed("id", "book")
    found = reference.select_ranges(good, verses)
    problems = parsed.where("error is not null or id is null").select("reference", F.coalesce("error", F.lit("unknown book")).alias("problem"))
    return found.where("missing = 0").select("reference", "text"), problems.union(found.where("missing > 0").select("reference", F.lit("missing verses")))


def validate_review(packets_: DataFrame, results: DataFrame, fields: list[str], ids: DataFrame, given: DataFrame) -> DataFrame:
    """``key problem``: envelope fields that differ (``key`` and ``fields``), and the coverage of ids (``id``)."""
    envelope = reviews.envelope_errors(packets_, results, "key", fields).select("key", F.concat(F.col("field"), F.lit(" differs")).alias("problem"))
    cover = reviews.id_coverage(ids, given, "id").select(F.col("id").alias("key"), F.concat(F.col("problem"), F.lit(" id")))
    return envelope.union(cover)


def build_lineage(quotes: DataFrame, requested: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(groups, ``id code blocking`` with cycles among them, jobs for missing languages of groups without a blocking issue)."""
    roots = lineage.components(quotes.where("id is not null"), lineage.lineage_edges(quotes))
    issues = lineage.record_issues(quotes).union(lineage.cycle_members(quotes).select("id", F.lit("translation_cycle"), F.lit(True)))
    groups = lineage.lineage_groups(quotes, roots, requested)
    held = issues.where("blocking").join(roots, "id").select("root").distinct()
    return groups, issues, lineage.missing_jobs(groups.join(held, "root", "left_anti"))


def scan_callsites(files: DataFrame, keys: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(call sites, keys without one, the tightest limits by key)."""
    sites = callsites.scan_sites(files)
    get = lambda name: F.element_at("modifiers", name)
    limits = packets.fit_limits(sites.select("key", get("lineLimit").alias("line_limit"), get("minimumScaleFactor").alias("scale"), F.regexp_replace(get("textCase"), r"^\.", "").alias("text_case")))
    return sites, callsites.unresolved(keys, sites), limits


def corpus_state(jobs: DataFrame, log: DataFrame, texts: DataFrame, decisions: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(summary of jobs, reviews that hold, blockers of an export): from the log of candidates and reviews, and the texts that may collide."""
    state = corpus.current_reviews(log)
    done = corpus.passed(state)
    summary = corpus.job_summary(jobs, log.where("type = 'candidate'"), done)
    open_jobs = jobs.select("job").distinct().join(done, "job", "left_anti").select(F.lit("not reviewed").alias("blocker"), F.col("job").alias("subject"))
    clashes = corpus.unacknowledged(corpus.collisions(texts), decisions).select(F.lit("collision"), F.col("collision"))
    return summary, state, open_jobs.union(clashes)
