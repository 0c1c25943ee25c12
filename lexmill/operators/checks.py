"""Checks of translated units. Every check gives findings of one schema, so that they compose by union.

``pairs``: ``key locale variation source target`` and, where a check needs
them, ``state comment``. Null texts count as missing: they are left out of all
checks but that of states. Repeated rows repeat their findings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators.phrases import phrase_hits

FINDING = ["check", "severity", "key", "variation", "message"]
# Order of severities.
SEVERITIES = ("critical", "major", "needs_disposition", "info")
# A comment that says a placeholder moved.
MOVED = r"(?i)placeholder moved to [\w.]+"
# Markdown links and emoji.
LINK = r"\[[^\]]+\]\([^)]+\)"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B50}\x{2B06}\x{2B07}]"
# Slips that a reader sees: locale, pattern, severity, message.
TYPOGRAPHY = [
    ("ro", "[şŞţŢ]", "major", "cedilla instead of comma below"),
    ("hu", "[õûÕÛ]", "major", "tilde or circumflex instead of double acute"),
    ("el", "[\\x{370}-\\x{3FF}][A-Za-z]|[A-Za-z][\\x{370}-\\x{3FF}]", "major", "Latin letter inside a Greek word"),
    ("el", "\\?", "info", "Latin question mark"),
    ("bg", "[\\x{400}-\\x{4FF}][A-Za-z]|[A-Za-z][\\x{400}-\\x{4FF}]", "major", "Latin letter inside a Cyrillic word"),
    ("he", "[\\x{590}-\\x{5FF}]['\"]", "major", "ASCII quote after a Hebrew letter"),
]
# Plural categories that a locale needs (``other`` always), and those it may have.
PLURAL_REQUIRED = {
    "en": "one", "ro": "one few", "da": "one", "sv": "one", "nb": "one", "fi": "one", "is": "one", "pl": "one few many", "hu": "one", "he": "one two", "tr": "one", "el": "one", "cs": "one few",
    "nl": "one", "sk": "one few", "bg": "one", "pt-BR": "one", "pt-PT": "one", "es-ES": "one", "es-MX": "one", "de": "one", "it": "one", "fr": "one", "ja": "", "ko": "",
}
PLURAL_OPTIONAL = {"pl": "other", "cs": "many", "sk": "many", "pt-BR": "many", "pt-PT": "many", "es-ES": "many", "es-MX": "many", "it": "many", "fr": "many"}


def _findings(df: DataFrame, check: str, *rules: tuple[Column, str | Column, str | Column]) -> DataFrame:
    """A finding for each rule (condition, severity, message) that holds."""
    lit = lambda x: F.lit(x) if isinstance(x, str) else x
    structs = F.array(*[F.when(c, F.struct(lit(s).alias("severity"), lit(m).alias("message"))) for c, s, m in rules])
    hit = df.select("key", "variation", F.explode(F.filter(structs, lambda x: x.isNotNull())).alias("f"))
    return hit.select(F.lit(check).alias("check"), "f.severity", "key", "variation", "f.message")


def source_units(units: DataFrame, source_locale: str = "en") -> DataFrame:
    """Pairs of each target unit with its source: the same variation, else the plural ``other``, else the flat one."""
    src = units.where(F.col("locale") == source_locale).where("value is not null and value != ''")
    rank = F.when(F.col("s.variation") == F.col("t.variation"), 0).when(F.col("s.variation") == "plural:other", 1).when(F.col("s.variation") == "", 2)
    both = units.where(F.col("locale") != source_locale).alias("t").join(src.alias("s"), F.col("t.key") == F.col("s.key"), "left").withColumn("rank", rank)
    best = both.groupBy("t.key", "t.locale", "t.variation").agg(
        F.min_by("s.value", "rank").alias("source"), F.first("t.value").alias("target"), F.first("t.state").alias("state"), F.first("t.pos").alias("pos")
    )
    return best


def placeholder_findings(pairs: DataFrame) -> DataFrame:
    """One finding per class and direction, not per occurrence; equal kinds bound to other arguments are critical, another order is info."""
    df = pairs.where("source is not null and target is not null")
    df = df.withColumn("a", X.placeholder_classes("source")).withColumn("b", X.placeholder_classes("target"))
    df = df.where((F.size("a") > 0) | (F.size("b") > 0))
    rules: list[tuple[Column, str | Column, str | Column]] = []
    for k in X.CLASSES:
        n, m = X.class_count(F.col("a"), k), X.class_count(F.col("b"), k)
        few = F.when((F.lit(k) == "d") & F.col("variation").isin("plural:zero", "plural:one", "plural:two"), "info").otherwise("critical")
        rules += [(m < n, few, f"missing placeholder {k}"), (m > n, "critical", f"extra placeholder {k}")]
    same = F.array_sort("a") == F.array_sort("b")
    bind = lambda c, t: F.arrays_zip(X.placeholder_positions(c).alias("p"), F.col(t).alias("c"))
    bound = F.array_sort(bind("source", "a")) == F.array_sort(bind("target", "b"))
    rules += [(same & ~bound, "critical", "placeholders bound to other arguments"), (same & bound & (F.col("a") != F.col("b")), "info", "placeholders in another order")]
    found = _findings(df, "C1", *rules)
    if "comment" in pairs.columns:
        moved = pairs.where(F.col("comment").rlike(MOVED)).select("key").distinct().withColumn("moved", F.lit(True))
        found = found.join(moved, "key", "left").select(
            "check", F.when(F.col("moved"), "info").otherwise(F.col("severity")).alias("severity"), "key", "variation", F.when(F.col("moved"), F.concat("message", F.lit(" (placeholder moved)"))).otherwise(F.col("message")).alias("message")
        )
    return found


def plural_findings(units: DataFrame, source_locale: str = "en") -> DataFrame:
    """Missing or surplus plural categories of a target whose source has plurals."""
    spark = units.sparkSession
    rows = [(k, sorted({*v.split(), "other"}), PLURAL_OPTIONAL.get(k, "").split()) for k, v in PLURAL_REQUIRED.items()]
    rules = spark.createDataFrame(rows, "locale string, required array<string>, optional array<string>")
    plural = F.col("variation").startswith("plural:")
    sources = units.where((F.col("locale") == source_locale) & plural).select("key").distinct()
    cats = F.collect_set(F.when(plural, F.substring("variation", 8, 20)))
    targets = units.where(F.col("locale") != source_locale).groupBy("key", "locale").agg(cats.alias("have"), F.max((F.col("variation") == "").cast("int")).alias("flat"))
    df = targets.join(sources, "key", "left_semi").join(F.broadcast(rules), "locale", "left")
    need = F.coalesce("required", F.array(F.lit("one"), F.lit("other")))
    may = F.concat(need, F.coalesce("optional", F.array().cast("array<string>")))
    flat = (F.col("flat") == 1) & (F.size("have") == 0)
    found = [
        df.where(flat).select("key", F.lit("major").alias("severity"), F.lit("plural source but flat target").alias("message")),
        df.where(~flat).select("key", F.explode(F.array_except(need, "have")).alias("c")).select("key", F.lit("major").alias("severity"), F.concat(F.lit("missing plural category "), "c").alias("message")),
        df.where(~flat).select("key", F.explode(F.array_except("have", may)).alias("c")).select("key", F.lit("info").alias("severity"), F.concat(F.lit("extra plural category "), "c").alias("message")),
    ]
    out = found[0].unionByName(found[1]).unionByName(found[2])
    return out.select(F.lit("C2").alias("check"), "severity", "key", F.lit("").alias("variation"), "message")


def markup_findings(pairs: DataFrame) -> DataFrame:
    """Bold marks, line breaks and links must be as many as in the source; ellipsis, double blanks, outer blanks and emoji are information."""
    df = pairs.where("source is not null and target is not null")
    n = lambda c, p: F.regexp_count(F.col(c), F.lit(p))
    differ = lambda p: n("source", p) != n("target", p)
    edge = lambda c: F.col(c).rlike(r"(?U)^\s|\s$")
    ellipsis_ = lambda c: F.contains(F.col(c), F.lit("…"))
    return _findings(
        df, "C3", (differ(r"\*\*"), "major", "bold marks differ"), (differ(r"\n"), "major", "line breaks differ"), (differ(LINK), "major", "links differ"),
        (ellipsis_("source") != ellipsis_("target"), "info", "ellipsis form differs"), (F.contains(F.col("target"), F.lit("  ")), "info", "double blank"),
        (edge("source") != edge("target"), "info", "outer white space differs"), (differ(EMOJI), "info", "emoji differ"),
    )


def typography_findings(values: DataFrame, rules: list[tuple[str, str, str, str]] | None = None) -> DataFrame:
    """``values``: ``key locale variation target``; a finding for each rule of the locale that a value breaks."""
    table = values.sparkSession.createDataFrame(rules or TYPOGRAPHY, "locale string, pattern string, severity string, message string")
    hit = values.join(F.broadcast(table), "locale").where(F.regexp_like("target", F.col("pattern")))
    return hit.select(F.lit("C4").alias("check"), "severity", "key", "variation", "message")


def length_ratios(pairs: DataFrame) -> DataFrame:
    """``key locale ratio``: the largest target length by source length of a key, 0 where there is none."""
    ratio = F.when(F.length("source") > 0, F.length("target") / F.length("source"))
    return pairs.groupBy("key", "locale").agg(F.coalesce(F.max(ratio), F.lit(0.0)).alias("ratio"))


def render_list(pairs: DataFrame, trigger: float = 1.35) -> DataFrame:
    """Keys whose ratio is above the trigger."""
    return length_ratios(pairs).where(F.col("ratio") > trigger)


def term_hits(values: DataFrame, terms: DataFrame) -> DataFrame:
    """``key locale term``: whole-word occurrences of ``terms`` (``locale term``) in ``values`` (``key locale target``), in any case."""
    t = terms.where("term is not null").select("locale", "term").distinct().withColumn("needle", X.plain_words("term"))
    v = values.where("target is not null").select("key", "locale", X.plain_words("target").alias("hay"))
    return phrase_hits(v, t, ["locale"]).select("key", "locale", "term").distinct()


def glossary_findings(values: DataFrame, forbidden: DataFrame) -> DataFrame:
    hits = term_hits(values, forbidden)
    return hits.select(F.lit("C6").alias("check"), F.lit("major").alias("severity"), "key", F.lit("").alias("variation"), F.concat(F.lit("forbidden form "), "term").alias("message"))


def state_findings(units: DataFrame, requested: DataFrame, locale: str) -> DataFrame:
    """Requested keys that are unknown, without a target unit, or in another state than translated."""
    keys = requested.select("key").distinct()
    known = units.select("key").distinct()
    target = units.where(F.col("locale") == locale)
    bad = lambda df, m: df.select(F.lit("C7").alias("check"), F.lit("major").alias("severity"), "key", "variation", m.alias("message"))
    unknown = bad(keys.join(known, "key", "left_anti").withColumn("variation", F.lit("")), F.lit("unknown key"))
    without = bad(keys.join(known, "key", "left_semi").join(target, "key", "left_anti").withColumn("variation", F.lit("")), F.lit("no target unit"))
    state = bad(target.join(keys, "key", "left_semi").where("state is null or state != 'translated'"), F.concat(F.lit("state is "), F.coalesce("state", F.lit("missing"))))
    return unknown.union(without).union(state)


def identity_findings(pairs: DataFrame, fixed_names: tuple[str, ...] = ("ok", "3d"), unit_words: tuple[str, ...] = ("h", "min", "s", "m", "sec", "kg", "km")) -> DataFrame:
    """Targets equal to their source, unless there is no word to translate."""
    words = F.regexp_extract_all(F.lower("source"), F.lit(r"\p{L}+"), F.lit(0))
    allowed = (F.size(words) == 0) | F.lower(F.col("source")).isin(*fixed_names) | F.forall(words, lambda w: w.isin(*unit_words))
    return _findings(pairs.where("source = target"), "C8", (~allowed, "major", "target equals source"))


def comment_findings(entries: DataFrame) -> DataFrame:
    """``entries``: ``key comment``; missing comments, or such that only repeat the key's last segment."""
    tail = F.lower(F.substring_index("key", ".", -1))
    stub = F.lower(X.trim_ws("comment")) == tail
    df = entries.withColumn("variation", F.lit(""))
    return _findings(df, "C9", (F.col("comment").isNull() | (X.trim_ws("comment") == ""), "info", "no comment"), (F.coalesce(stub, F.lit(False)), "info", "comment repeats the key"))


def divergent_groups(values: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sources with two or more different targets: ``source_norm <by> n_keys n_targets first_key``; over all values, never only a selection."""
    by = by or ["locale"]
    norm = values.where("source is not null and target is not null").select("key", *by, X.normalise("source").alias("source_norm"), X.normalise("target").alias("target_norm"))
    return norm.groupBy("source_norm", *by).agg(
        F.countDistinct("key").alias("n_keys"), F.countDistinct("target_norm").alias("n_targets"), F.min("key").alias("first_key")
    ).where("n_targets > 1")


def divergence_findings(values: DataFrame, controls: DataFrame | None = None, selected: DataFrame | None = None) -> DataFrame:
    """Where a control row (``label preferred roles``) exists each member outside of it is major; else one finding on the smallest key."""
    base = values.where("source is not null and target is not null").select("key", "locale", X.normalise("source").alias("source_norm"), X.normalise("target").alias("target_norm"), "target")
    groups = divergent_groups(values)
    if selected is not None:
        hit = base.join(selected.select("key").distinct(), "key", "left_semi").select("source_norm", "locale").distinct()
        groups = groups.join(hit, ["source_norm", "locale"], "left_semi")
    one = lambda df, s, k, m: df.select(F.lit("C10").alias("check"), F.lit(s).alias("severity"), k.alias("key"), F.lit("").alias("variation"), m.alias("message"))
    if controls is None:
        return one(groups, "needs_disposition", F.col("first_key"), F.concat("n_targets", F.lit(" targets of one source")))
    c = controls.select(F.lower("label").alias("source_norm"), "preferred", "roles")
    plain = one(groups.join(c, "source_norm", "left_anti"), "needs_disposition", F.col("first_key"), F.concat("n_targets", F.lit(" targets of one source")))
    members = base.join(groups.select("source_norm", "locale"), ["source_norm", "locale"], "left_semi").join(F.broadcast(c), "source_norm")
    off = members.where((F.col("target") != F.col("preferred")) & ~F.coalesce(F.array_contains(F.map_values("roles"), F.col("target")), F.lit(False)))
    return plain.union(one(off, "major", F.col("key"), F.lit("outside of the control's forms")))


# Words of a source that make a wrong translation costly.
CLAIM_WORDS = r"(?i)\b(price|pay|paid|pays|free|trial|subscri\w*|refund|charge\w*|bill\w*|cost\w*|currenc\w*|discount|lifetime|restore|premium|unlock\w*|locked|upgrade|allow\w*|permission\w*|access|authori\w*|screen time|delete\w*|remov\w*|erase\w*|reset|clear|discard|not|never|no|without|only|cannot|always|every|all|forever|lowest|guaranteed)\b|n't\b|\d|%(?!@)"
# Endings of keys that sit on one line, and of keys of running text.
SINGLE_LINE_TAIL = r"(?i)(button|cta|action|title|label|tab|toggle|badge|chip|pill|header|heading|name|option|placeholder|short|suffix|unit)$"
BODY_TAIL = r"(?i)(criterion|earned|message|body|description|explanation)$"


def tier(source: Column, is_plural: Column, risk: Column) -> Column:
    """A: plural, of a risk area, or with claim words; C: one word; else B."""
    words = F.size(F.regexp_extract_all(source, F.lit(r"\S+"), F.lit(0)))
    return F.when(is_plural | risk | F.regexp_like(source, F.lit(CLAIM_WORDS)), "A").when(words <= 1, "C").otherwise("B")


# Nouns that a comment names a control by, words of a single line, and what begins a further qualification of a noun.
CONTROL_NOUN = r"(?i)\b(button|line|tab|badge|chip|pill|toggle|widget|label|shield|caption|eyebrow|heading|header|title)$"
FIT_HINT = r"(?i)single[- ]line|one line"
QUALIFIER = r"(?i)\s+(?:used|shown|opening|above|below|under|for|on|in|by|of|with|to|into|from|across|that|which)\b.*$"


def names_control(phrase: Column) -> Column:
    """Whether a phrase's first clause ends in a control, or it asks for one line."""
    clause = F.regexp_extract(phrase, r"^[^;.,]*", 0)
    return F.trim(F.regexp_replace(clause, QUALIFIER, "")).rlike(CONTROL_NOUN) | phrase.rlike(FIT_HINT)


def length_class(key: Column, comment: Column | None = None) -> Column:
    """body endings first; single_line by the key's area or ending, or by what the comment (``element: purpose``) names; else open."""
    tail = F.substring_index(key, ".", -1)
    said = F.coalesce(comment if comment is not None else F.lit(""), F.lit(""))
    element, purpose = F.substring_index(said, ":", 1), F.regexp_extract(said, r"(?s)^[^:]*:(.*)$", 1)
    single = key.rlike(r"^(?:widgets|shield)\.") | tail.rlike(SINGLE_LINE_TAIL) | names_control(element) | names_control(purpose)
    return F.when(tail.rlike(BODY_TAIL), "body").when(single, "single_line").otherwise("open")


def severity_rank(c: str = "severity") -> Column:
    out = F.lit(len(SEVERITIES))
    for i, s in enumerate(SEVERITIES):
        out = F.when(F.col(c) == s, i).otherwise(out)
    return out


def summary(findings: DataFrame) -> DataFrame:
    """``check severity n n_keys``."""
    return findings.groupBy("check", "severity").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("n_keys"))


def without(findings: DataFrame, excluded: DataFrame) -> DataFrame:
    """Findings of keys that are not excluded."""
    return findings.join(excluded.select("key").distinct(), "key", "left_anti").select(*FINDING)
