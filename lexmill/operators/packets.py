"""Context packets: classification, siblings, neighbours, invariants, and the check that nothing leaks into a blind one."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators.phrases import phrase_hits
from lexmill.session import durable

# Facts that a translation must keep, by kind.
INVARIANTS = {
    "negation": r"(?i)\b(not|never|no|nothing|none|without|cannot|can't|won't|don't|doesn't|isn't|aren't|didn't)\b",
    "money": r"(?i)\b(price|priced|billed|billing|trial|subscription|subscribe|purchase|refund|charge|charged|free|earn|earned|earnings|money|paid|pay|restore|per (?:week|month|year))\b|[$€£]",
    "permission": r"(?i)\b(allow|permission|access|delete|deleted|remove|erase|reset|privacy|private|on your (?:phone|device))\b",
    "unit": r"(?i)\b(minutes?|mins?|hours?|hrs?|days?|weeks?|months?|years?|seconds?|mo|wk|yr)\b|%",
    "strength": r"(?i)\b(always|never|guaranteed|guarantee|every|all|forever|lowest|only|best|most|least|more|less|cheaper|faster|instantly|unlimited|100%)\b",
    "condition": r"(?i)\b(if|when|whenever|until|unless|after|before|once|while|as soon as)\b",
}
# Controls in the order in which they are looked for: name, (field, pattern) of which one must match, and one that must match as well.
# Fields: key, tail (the last segment), comment and head (its first clause); all but the key in lower case.
CONTROLS = (
    ("voiceover label", (("key", r"\.a11y\."), ("comment", "voiceover|accessibility")), None),
    ("widget name", (("tail", "^displayname$"),), None),
    ("widget description", (("tail", "^description$"),), ("key", r"^widgets\.")),
    ("alert body", (("key", r"\.alert\."), ("comment", "alert")), ("tail", "message|body")),
    ("alert title", (("key", r"\.alert\."), ("comment", "alert")), None),
    ("button", (("tail", "button|cta|action|confirm|cancel|done|skip|retry|continue|save|edit|delete|dismiss|close|allow|restore|subscribe|start|stop|primary|secondary"), ("comment", "button")), None),
    ("badge", (("tail", "badge"), ("comment", "badge")), None),
    ("toggle", (("tail", "toggle"), ("comment", "toggle")), None),
    ("hero headline", (("head", r"\bhero\b"),), None),
    ("placeholder", (("tail", "placeholder"), ("head", "placeholder")), None),
    ("subtitle", (("tail", "subtitle"),), None),
    ("title", (("tail", "title|heading|headline|hero"), ("head", "title")), None),
    ("caption", (("tail", "caption|footer|hint|detail"), ("comment", "caption")), None),
    ("body", (("tail", "body|message|description|explanation|summary|text|line"),), None),
    ("tab", (("tail", "^tab"), ("comment", "tab item")), None),
)
# Kinds of content in the order in which they are looked for; fields as above, and text, the source.
KINDS = (
    ("attributed", (("comment", "quotation|attributed|quote author"), ("key", r"quotation|attributed|quote author|\.author$"))),
    ("user", (("comment", "user-written|user content|user's own text|typed by the user"),)),
    ("disclaimer", (("text", r"(?i)not money earned|not (actual|real) (money|earnings)|disclaimer"), ("comment", r"not money earned|not (actual|real) (money|earnings)|disclaimer"))),
    ("legal", (("key", "(?i)legal|terms|privacy|eula|policy"), ("comment", "legal|terms|privacy|eula|policy"))),
    ("system-label", (("comment", "ios's own|system label|apple's own|mirrors the system|quotes ios"),)),
    ("authored", (("comment", "affirmation|authored"),)),
    ("promotional", (("key", "(?i)hero|benefit|motivation|celebration|winback|lastchance|beforeafter|encourag"), ("text", "!$"))),
)
# Controls whose texts are functional, and the most words of another functional text.
FUNCTIONAL, FUNCTIONAL_WORDS = ("button", "toggle", "tab", "badge", "placeholder", "widget name"), 4


def weakest_unit(units: DataFrame, locale: str) -> DataFrame:
    """``key value state`` of a locale: needs_review before new before the first; plural texts joined by category."""
    u = units.where(F.col("locale") == locale)
    rank = F.when(F.col("state") == "needs_review", 0).when(F.col("state") == "new", 1).otherwise(2)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("variation", "value"))), lambda x: x["value"]), " | ")  # a unit has a handful of categories
    return u.groupBy("key").agg(text.alias("value"), F.min_by("state", F.struct(rank, "variation")).alias("state"))


def _fields(key: Column, comment: Column, text: Column | None = None) -> dict[str, Column]:
    low = F.lower(F.coalesce(comment, F.lit("")))
    return {"key": key, "tail": F.lower(F.substring_index(key, ".", -1)), "comment": low, "head": F.regexp_extract(low, r"(?s)^.*?(?=[.;]\s|\z)", 0), "text": text}


def control_kind(key: Column, comment: Column) -> Column:
    """The first of CONTROLS that key and comment tell, else label."""
    fields = _fields(key, comment)
    name = lambda one_of, also: functools.reduce(operator.or_, (fields[f].rlike(p) for f, p in one_of)) & (fields[also[0]].rlike(also[1]) if also else F.lit(True))
    found = F.coalesce(*[F.when(name(one_of, also), F.lit(control)) for control, one_of, also in CONTROLS])
    return F.coalesce(found, F.lit("label"))


def content_kind(key: Column, text: Column, comment: Column, control: Column) -> Column:
    """The first of KINDS that key, source and comment tell, else functional or explanatory by control and length."""
    fields = _fields(key, comment, F.coalesce(text, F.lit("")))
    found = [F.when(functools.reduce(operator.or_, (fields[f].rlike(p) for f, p in one_of)), F.lit(kind)) for kind, one_of in KINDS]
    words = F.size(F.regexp_extract_all(fields["text"], F.lit(r"(?U)\S+"), F.lit(0)))
    short = F.when(control.isin(*FUNCTIONAL) | (words <= FUNCTIONAL_WORDS), F.lit("functional"))
    return F.coalesce(*found, short, F.lit("explanatory"))


def invariants(values: DataFrame) -> DataFrame:
    """``key kind fact``: distinct facts of each source text (``key source``), in lower case."""
    def facts(kind: str, pattern: str) -> Column:
        return F.transform(F.array_distinct(F.regexp_extract_all(F.lower("source"), F.lit(pattern), F.lit(0))), lambda m: F.struct(F.lit(kind).alias("kind"), m.alias("fact")))

    found = F.flatten(F.array(*[facts(k, p) for k, p in INVARIANTS.items()]))
    return values.where("source is not null").select("key", F.explode(found).alias("f")).select("key", "f.kind", "f.fact")


def token_samples(tokens: DataFrame, samples: DataFrame) -> DataFrame:
    """``key place token sample``: each distinct token of a key (``key place token kind locale``) gets the nth sample of its kind, of the locale or else of ``*``."""
    w = Window.partitionBy("key", "kind").orderBy("place")
    nth = tokens.withColumn("nth", F.row_number().over(w) - 1)
    own = nth.join(samples.select("locale", "kind", F.col("samples").alias("own")), ["locale", "kind"], "left")
    any_ = own.join(samples.where("locale = '*'").select("kind", F.col("samples").alias("any")), "kind", "left")
    pool = F.coalesce("own", "any")
    return any_.select("key", "place", "token", F.element_at(pool, (F.pmod(F.col("nth"), F.size(pool)) + 1).cast("int")).alias("sample"))


def same_source(values: DataFrame) -> DataFrame:
    """``key n_siblings first_sibling``: keys with the same source text, counted without pairing them."""
    w = values.where("source is not null").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("a"), F.min(F.struct("key")).alias("_"), F.sort_array(F.array(F.min("key"), F.max("key"))).alias("ends"))
    df = values.join(w.where("n > 1").select("source", "n", "ends"), "source")
    return df.select("key", (F.col("n") - 1).alias("n_siblings"), F.when(F.col("key") == F.col("ends")[0], F.col("ends")[1]).otherwise(F.col("ends")[0]).alias("first_sibling"))


def context_keys(entries: DataFrame, selected: DataFrame, most: int = 24) -> DataFrame:
    """``prefix key``: of each prefix (two segments) of selected keys with three or more, the first keys with a target in catalog order outside of the selection."""
    prefix = F.substring_index("key", ".", 2)
    deep = selected.where(F.size(F.split("key", r"\.")) >= 3).select(prefix.alias("prefix")).distinct()
    near = entries.where(F.length("target") > 0).join(selected.select("key").distinct(), "key", "left_anti").withColumn("prefix", prefix).join(deep, "prefix", "left_semi")
    first = Window.partitionBy("prefix").orderBy("pos", "key")
    return near.withColumn("k", F.row_number().over(first)).where(F.col("k") <= most).select("prefix", "key")


def overlay(catalog: DataFrame, candidates: DataFrame) -> DataFrame:
    """``key value``: a key among the candidates has its value there, also a null one."""
    c = candidates.select("key", F.col("value").alias("new"), F.lit(True).alias("given"))
    return catalog.join(c, "key", "full").select("key", F.when(F.col("given"), F.col("new")).otherwise(F.col("value")).alias("value"))


def carry_over(new: DataFrame, old: DataFrame, fields: list[str], guards: list[str]) -> DataFrame:
    """``new`` with the old values of ``fields`` where all ``guards`` are unchanged and the new value is null."""
    o = old.select("key", *[F.col(f).alias(f"_o_{f}") for f in fields], *[F.col(g).alias(f"_g_{g}") for g in guards])
    same = F.lit(True)
    for g in guards:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    df = new.join(o, "key", "left")
    rest = [c for c in new.columns if c not in fields]
    return df.select(*rest, *[F.when(same, F.coalesce(F.col(f), F.col(f"_o_{f}"))).otherwise(F.col(f)).alias(f) for f in fields])


def leaves(rows: DataFrame, key: str, json: str) -> DataFrame:
    """``key path leaf``: string leaves of JSON texts, through objects and arrays of any depth; a level at a time, as long as there is one."""
    level = rows.select(F.col(key).alias("key"), F.lit("$").alias("path"), F.try_parse_json(F.col(json)).alias("v")).where("v is not null")
    level, out = durable(level, "level"), None
    while not level.isEmpty():
        kind = F.schema_of_variant("v")
        strings = level.where(kind == "STRING").select("key", "path", F.try_variant_get("v", "$", "string").alias("leaf"))
        out = strings if out is None else out.union(strings)
        nested = level.where(kind.startswith("OBJECT") | kind.startswith("ARRAY"))
        nested.createOrReplaceTempView("_lexmill_nested")
        level = durable(nested.sparkSession.sql("SELECT n.key, n.path || '.' || coalesce(e.key, cast(e.pos AS string)) AS path, e.value AS v FROM _lexmill_nested n, LATERAL variant_explode(n.v) AS e(pos, key, value)"), "level")
    return out if out is not None else level.select("key", "path", F.lit("").alias("leaf"))


def leaks(blind: DataFrame, forbidden: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """``key item``: forbidden texts that stand whole in a blind text. ``blind``: ``key leaf``; ``forbidden``: ``item``; ``allowed``: ``item``.

    Items of four or more characters with a letter count.
    """
    items = forbidden.select("item").distinct().withColumn("needle", X.plain_words("item")).where("length(needle) >= 4 and needle rlike '[a-z]'")
    if allowed is not None:
        items = items.join(allowed.select(X.plain_words("item").alias("needle")).distinct(), "needle", "left_anti").select("item", "needle")
    hay = blind.where("leaf is not null").select("key", X.plain_words("leaf").alias("hay"))
    return phrase_hits(hay, items, []).select("key", "item").distinct()


def fit_limits(sites: DataFrame) -> DataFrame:
    """``key min_lines min_scale any_upper`` of ``key line_limit scale text_case``; only numeric arguments count."""
    return sites.groupBy("key").agg(F.min(F.col("line_limit").try_cast("int")).alias("min_lines"), F.min(F.col("scale").try_cast("double")).alias("min_scale"), F.max((F.col("text_case") == "uppercase").cast("int")).alias("any_upper"))


def agreement_terms(values: DataFrame, concepts: DataFrame) -> DataFrame:
    """``key concept``: the first concept (``concept place form locale``) of which a form stands in the target."""
    from lexmill.operators.checks import term_hits

    hits = term_hits(values, concepts.select("locale", F.col("form").alias("term")))
    return hits.join(concepts.select("locale", F.col("form").alias("term"), "concept", "place"), ["locale", "term"]).groupBy("key").agg(F.min_by("concept", "place").alias("concept"))


def changes_between(old: DataFrame, new: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``key change``: added, removed or changed between two states of a table."""
    o = old.select(key, F.struct(*fields).alias("o"), F.lit(True).alias("in_o"))
    n = new.select(key, F.struct(*fields).alias("n"), F.lit(True).alias("in_n"))
    change = F.when(F.col("in_o").isNull(), "added").when(F.col("in_n").isNull(), "removed").when(~F.col("o").eqNullSafe(F.col("n")), "changed")
    return o.join(n, key, "full").select(key, change.alias("change")).where("change is not null")
