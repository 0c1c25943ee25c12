"""Checks of reference data: Markdown briefs, glossaries, ranges of verses."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Claims of human approval, words that deny a claim, the form of seeded decisions.
CLAIM = r"(?i)native[- ](?:speaker|reader)[- ](?:approved|reviewed|verified|certified)|reviewed by a native|certified (?:translation|translator)|owner[- ]approved|human[- ]approved"
DENIAL = r"\b(no|not|never|without|neither|nobody|none|nothing|nor)\b|recommend|before the pilot|until a|claim"
SEED = r"^skill-seed-\d{4}-\d{2}-\d{2}$"
# Fields a term and an open item must have, and file endings that are no keys.
TERM_FIELDS = ("preferred", "forms", "forbidden", "decided_by", "note")
OPEN_FIELDS = ("id", "options", "recommended", "recommended_reason", "decided_by", "status", "note")
NOT_KEYS = r"\.(swift|md|json|py|sh|plist|png|xcstrings|strings|stringsdict|lproj|framework|app|bundle|txt|tsv)$"
REFERENCE = r"^(.+) ([1-9][0-9]*):([1-9][0-9]*)(?:-([1-9][0-9]*))?$"


def markdown_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id line text`` of documents."""
    return docs.select(F.col(id_col).alias("id"), F.posexplode(F.split(text_col, r"\r\n|\n|\r")).alias("line", "text"))


def sections(lines: DataFrame) -> DataFrame:
    """``id line heading text``: the heading each line stands under (null before the first); ordered within one document only."""
    w = Window.partitionBy("id").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    heading = F.when(F.col("text").startswith("## "), F.trim(F.substring("text", 4, 1 << 30)))
    return lines.withColumn("heading", F.last(heading, ignorenulls=True).over(w)).select("id", "line", "heading", "text")


def section_sizes(lines: DataFrame) -> DataFrame:
    """``id heading n_lines n_filled``: lines below each heading, and those that are not blank."""
    body = sections(lines).where("heading is not null and text not like '## %'")
    counted = body.groupBy("id", "heading").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.trim("text") != "").alias("n_filled"))
    return counted


def heading_order_errors(lines: DataFrame, expected: list[str]) -> DataFrame:
    """``id headings`` of documents whose headings are not the expected ones in order."""
    heads = lines.where("text like '## %'").groupBy("id").agg(F.array_sort(F.collect_list(F.struct("line", F.trim(F.substring("text", 4, 1 << 30)).alias("h")))).alias("hs"))
    got = F.transform("hs", lambda x: x["h"])
    return heads.where(got != F.array(*[F.lit(x) for x in expected])).select("id", F.array_join(got, " | ").alias("headings"))


def template_lines(lines: DataFrame, template: DataFrame, longer_than: int = 60) -> DataFrame:
    """``id line``: long lines of the template that were left in."""
    long = template.where(F.length("text") > longer_than).select("text").distinct()
    return lines.join(long, "text", "left_semi").select("id", "line")


def sentences(lines: DataFrame) -> DataFrame:
    return lines.select("id", "line", F.explode(F.split("text", r"(?<=[.!?])\s+")).alias("sentence")).where("trim(sentence) != ''")


def honesty_findings(lines: DataFrame) -> DataFrame:
    """``id line sentence`` of claims of human approval that the sentence itself does not deny."""
    s = sentences(lines)
    return s.where(F.col("sentence").rlike(CLAIM) & ~F.lower("sentence").rlike(DENIAL)).select("id", "line", "sentence")


def cited_keys(lines: DataFrame, known: DataFrame, roots: list[str]) -> DataFrame:
    """``id token``: dotted tokens under the known roots that are no key, no stem of one, and no file name."""
    token = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"(?<![\w./-])([a-z][A-Za-z0-9]*(?:\.[a-zA-Z][A-Za-z0-9]*){1,4})(?![\w/(*-])"), F.lit(1))))
    found = lines.select("id", token.alias("token")).where(~F.col("token").rlike(NOT_KEYS) & F.substring_index("token", ".", 1).isin(*roots)).distinct()
    parts = F.split("key", r"\.")
    stems = known.select(F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))).alias("token")).distinct()
    return found.join(stems, "token", "left_anti").select("id", "token")


def glossary_errors(terms: DataFrame) -> DataFrame:
    """``locale term_id error``: no preferred form, preferred not among the forms, a form that is forbidden as well."""
    rules = F.array(
        F.when(F.coalesce(F.length("preferred"), F.lit(0)) == 0, F.lit("no preferred form")),
        F.when(~F.array_contains("forms", F.col("preferred")), F.lit("preferred is not among the forms")),
        F.when(F.arrays_overlap("forms", "forbidden"), F.lit("a form is forbidden")),
    )
    return terms.select("locale", "term_id", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("error"))


def open_item_errors(items: DataFrame) -> DataFrame:
    """``item error``: a recommendation that is not among the options, or a missing field."""
    rules = F.array(
        F.when(~F.array_contains("options", F.col("recommended")), F.lit("recommended is not an option")),
        *[F.when(F.col(c).isNull(), F.lit(f"no {c}")) for c in ("recommended", "decided_by", "status")],
    )
    return items.select("item", F.explode(F.filter(rules, lambda x: x.isNotNull())).alias("error"))


def parse_references(references: DataFrame) -> DataFrame:
    """``reference book chapter first last error``: one verse or a range; reversed ranges and other forms are errors."""
    part = lambda i: F.regexp_extract("reference", REFERENCE, i)
    ok = F.col("reference").rlike(REFERENCE)
    first, last = part(3).try_cast("int"), F.coalesce(part(4).try_cast("int"), part(3).try_cast("int"))
    df = references.select("reference", F.when(ok, part(1)).alias("book"), part(2).try_cast("int").alias("chapter"), first.alias("first"), last.alias("last"))
    return df.withColumn("error", F.when(F.col("book").isNull(), "unreadable").when(F.col("last") < F.col("first"), "reversed"))


def select_ranges(ranges: DataFrame, verses: DataFrame) -> DataFrame:
    """``reference text n missing``: texts of the verses of each range in order, all or none.

    A range is expanded to its verses, so that the join is on equality.
    """
    wanted = ranges.where("error is null").select("reference", "book", "chapter", F.explode(F.sequence("first", "last")).alias("verse"))
    got = wanted.join(verses.select("book", "chapter", "verse", "text"), ["book", "chapter", "verse"], "left")
    g = got.groupBy("reference").agg(
        F.count(F.lit(1)).alias("asked"), F.count("text").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("verse", "text"))), lambda x: x["text"]), " ").alias("joined")
    )  # a range has as many verses as it names
    return g.select("reference", F.when(F.col("asked") == F.col("n"), F.col("joined")).alias("text"), "n", (F.col("asked") - F.col("n")).alias("missing"))


def requested_references(named: DataFrame, rows: DataFrame) -> DataFrame:
    """``reference n``: distinct references of both lists, the named ones first in their order."""
    both = named.select("reference", F.lit(0).alias("src"), "pos").union(rows.select("reference", F.lit(1), "pos"))
    return both.where("reference is not null").groupBy("reference").agg(F.min(F.struct("src", "pos")).alias("at"), F.count(F.lit(1)).alias("n"))
