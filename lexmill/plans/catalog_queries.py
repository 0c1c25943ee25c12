"""Checks, terms, work lists and packets over the tables, with the SQL beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import apply, casing, checks, packets, terms, worklist
from lexmill.plans.views import ENTRIES, IMPORTS, PAIRS, imports, packet_entries, pairs
from lexmill.session import table
from lexmill.sources.catalog import numbered

#: Forms looked for, and a control's forms: (locale, id, place, form) and (locale, label, preferred, role form).
TERMS = [
    ("de", "budget", 0, "wöchentliche Budget"), ("de", "budget", 1, "Budget"), ("fr", "liste", 0, "liste de tâches"), ("es", "hora", 0, "hora tranquila"), ("ro", "limita", 0, "o limită clară"), ("ro", "limita", 1, "limită"),
    ("hu", "cel", 0, "szerény célt"), ("tr", "liste", 0, "görev listesini"), ("el", "stochos", 0, "στόχο"), ("en", "budget", 0, "weekly budget"),
]
_TERMS = ", ".join(f"('{a}','{b}',{c},'{d}')" for a, b, c, d in TERMS)
#: RE2 and Java agree on these words of a text: letters and digits of any alphabet and apostrophes.
_PLAIN = "lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '[’‘ʼ]', '''', 'g'), '%([0-9]+\\$)?(%|@|l{{0,2}}[dui]|\\.?[0-9]*f|s)', ' ', 'g'), '[^\\p{{L}}\\p{{N}}'' ]+', ' ', 'g'), ' +', ' ', 'g')))"
_HIT = f"contains(' ' || {_PLAIN.format('v.target')} || ' ', ' ' || {_PLAIN.format('t.form')} || ' ')"


def _terms(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TERMS, "locale string, term_id string, place int, form string")


def unit_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return p.groupBy("locale", "kind", "verdict").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("n_keys"), F.sum(F.length("target")).alias("characters"), F.max(F.length("target")).alias("longest"))


def findings_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markup, typography and identity findings over entries and imports, by check and severity."""
    i = imports(spark, sf_dir)
    markup = checks.markup_findings(i).where("severity = 'major' or message = 'double blank'")
    return checks.summary(markup.union(checks.typography_findings(packet_entries(spark, sf_dir))).union(checks.identity_findings(i)))


def placeholder_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").where("text is not null")
    c = d.select("doc_id", F.explode(X.placeholder_classes("text")).alias("class"))
    return c.groupBy("doc_id", "class").agg(F.count(F.lit(1)).alias("n"))


PLACEHOLDER_SQL = f"""
SELECT doc_id, translate(c, 'DiuUxXoOeEgGaAFcCS', 'ddddddddffffffssss') AS class, count(*) AS n
FROM (SELECT doc_id, unnest(regexp_extract_all(text, '%(?:[0-9]+\\$)?[-+0#]*[0-9]*(?:\\.[0-9]+)?(?:hh|h|ll|l|q|z|t|L)?([@dDiuUxXoOfeEgGcCsSpaAF%])', 1)) AS c
  FROM documents WHERE text IS NOT NULL) GROUP BY 1, 2"""


def markup_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.markup_findings(imports(spark, sf_dir)).where("severity = 'major' or message = 'double blank'").select("key", "severity", "message")


_N = "len(regexp_extract_all({0}, '{1}'))"
MARKUP_SQL = f"""WITH {IMPORTS}
SELECT key, 'major' AS severity, 'bold marks differ' AS message FROM imports WHERE {_N.format("source", "\\*\\*")} <> {_N.format("target", "\\*\\*")}
UNION ALL SELECT key, 'major', 'line breaks differ' FROM imports WHERE length(source) - length(replace(source, chr(10), '')) <> length(target) - length(replace(target, chr(10), ''))
UNION ALL SELECT key, 'major', 'links differ' FROM imports WHERE {_N.format("source", "\\[[^\\]]+\\]\\([^)]+\\)")} <> {_N.format("target", "\\[[^\\]]+\\]\\([^)]+\\)")}
UNION ALL SELECT key, 'info', 'double blank' FROM imports WHERE contains(target, '  ')"""


def typography_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.typography_findings(packet_entries(spark, sf_dir)).select("key", "severity", "message")


def _typography_sql() -> str:
    rows = ", ".join("('{}', '{}', '{}', '{}')".format(a, b.replace("'", "''"), c, d) for a, b, c, d in checks.TYPOGRAPHY)
    return f"WITH {ENTRIES}, rules(locale, pattern, severity, message) AS (VALUES {rows}) SELECT e.key, r.severity, r.message FROM entries e JOIN rules r ON e.locale = r.locale WHERE regexp_matches(e.target, r.pattern)"


def length_ratio_render_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.render_list(pairs(spark, sf_dir), 1.1).select("key", "locale", F.round("ratio", 6).alias("ratio"))


RATIO_SQL = f"WITH {PAIRS} SELECT key, locale, round(max(length(target)::DOUBLE / length(source)), 6) AS ratio FROM pairs WHERE length(source) > 0 GROUP BY 1, 2 HAVING max(length(target)::DOUBLE / length(source)) > 1.1"


def forbidden_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.forbidden_hits(pairs(spark, sf_dir), _terms(spark))


FORBIDDEN_SQL = f"""WITH {PAIRS}, t(locale, term_id, place, form) AS (VALUES {_TERMS})
SELECT v.key, v.locale, t.term_id, arg_min(t.form, t.place) AS form FROM pairs v JOIN t ON v.locale = t.locale WHERE v.target IS NOT NULL AND {_HIT} GROUP BY 1, 2, 3"""


def term_prefix_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = pairs(spark, sf_dir).withColumn("key", F.concat("category", F.lit("."), F.regexp_replace("key", ":", ".")))
    return terms.term_prefix_counts(values, _terms(spark))


PREFIX_SQL = f"""WITH {PAIRS}, t(locale, term_id, place, form) AS (VALUES {_TERMS})
SELECT locale, term_id, prefix, count(*) AS n FROM (SELECT DISTINCT v.key, v.locale, t.term_id, v.category AS prefix FROM pairs v JOIN t ON v.locale = t.locale WHERE v.target IS NOT NULL AND {_HIT}) GROUP BY 1, 2, 3"""


def option_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return terms.option_counts(pairs(spark, sf_dir), table(spark, sf_dir, "glossary_open"))


OPTION_SQL = f"""WITH {PAIRS}, t AS (SELECT DISTINCT locale, unnest(options) AS form FROM glossary_open)
SELECT t.locale, t.form AS option, count(DISTINCT v.key) AS n FROM t LEFT JOIN pairs v ON v.locale = t.locale AND v.target IS NOT NULL AND {_PLAIN.format("t.form")} <> '' AND {_HIT} GROUP BY 1, 2"""


def control_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Screen keys as labels and titles as their forms; the most frequent title counts as the preferred one."""
    p = table(spark, sf_dir, "documents").where("title is not null").select(F.col("doc_id").alias("key"), F.lit("any").alias("locale"), F.col("screen_key").alias("source"), F.col("title").alias("target"))
    best = p.groupBy("locale", "source", "target").agg(F.count(F.lit(1)).alias("n")).groupBy("locale", "source").agg(F.max_by("target", F.struct("n", "target")).alias("preferred"), F.count(F.lit(1)).alias("forms")).where("forms > 1")
    controls = best.select("locale", X.strip_ellipsis("source").alias("label"), "preferred", F.create_map().cast("map<string,string>").alias("roles"))
    return terms.control_matches(p, controls).groupBy("locale", "match").agg(F.count(F.lit(1)).alias("n"))


CONTROL_SQL = """WITH pairs AS (SELECT doc_id AS key, 'any' AS locale, screen_key AS source, title AS target FROM documents WHERE title IS NOT NULL), c AS (SELECT locale, source, target, count(*) AS n FROM pairs WHERE source IS NOT NULL AND target IS NOT NULL GROUP BY 1, 2, 3),
b AS (SELECT locale, source, arg_max(target, (n, target)) AS preferred FROM c GROUP BY 1, 2 HAVING count(*) > 1)
SELECT p.locale, CASE WHEN p.target = b.preferred THEN 'preferred' ELSE 'drift' END AS match, count(*) AS n FROM pairs p JOIN b ON p.locale = b.locale AND p.source = b.source GROUP BY 1, 2"""


def state_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = pairs(spark, sf_dir).select("key", F.lit("any").alias("locale"), "variation", F.when(F.col("verdict") == "pass", "translated").otherwise("needs_review").alias("state")).distinct()
    return checks.state_findings(units, packet_entries(spark, sf_dir), "any").groupBy("message").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("n_keys"))


STATE_SQL = f"""WITH {PAIRS}, {ENTRIES}, u AS (SELECT DISTINCT key, CASE WHEN verdict = 'pass' THEN 'translated' ELSE 'needs_review' END AS state FROM pairs)
SELECT message, count(*) AS n, count(DISTINCT key) AS n_keys FROM (
  SELECT DISTINCT key, 'unknown key' AS message FROM entries WHERE key NOT IN (SELECT key FROM u)
  UNION ALL SELECT key, 'state is ' || state FROM u WHERE state <> 'translated' AND key IN (SELECT key FROM entries)) GROUP BY 1"""


def identity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checks.identity_findings(imports(spark, sf_dir)).select("key", "severity")


IDENTITY_SQL = f"WITH {IMPORTS} SELECT key, 'major' AS severity FROM imports WHERE source = target AND regexp_matches(source, '\\p{{L}}') AND lower(source) NOT IN ('ok', '3d')"


def same_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Equal quotes of a category that stand under different themes."""
    p = table(spark, sf_dir, "pilot_staged").select(F.col("id").alias("key"), "category", F.col("text").alias("source"), F.col("theme").alias("target"))
    return checks.divergent_groups(p, ["category"])


_NORM = "lower(trim(regexp_replace({0}, '\\s+', ' ', 'g')))"
DIVERGENCE_SQL = f"""WITH pairs AS (SELECT id AS key, category, text AS source, theme AS target FROM pilot_staged) SELECT {_NORM.format("source")} AS source_norm, category, count(DISTINCT key) AS n_keys, count(DISTINCT {_NORM.format("target")}) AS n_targets, min(key) AS first_key
FROM pairs WHERE source IS NOT NULL AND target IS NOT NULL GROUP BY 1, 2 HAVING count(DISTINCT {_NORM.format("target")}) > 1"""


def tier_classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    t = checks.tier(F.coalesce("source", F.lit("")), F.col("kind") == "plural", F.col("category") == "financial")
    return p.groupBy("category", t.alias("tier")).agg(F.count(F.lit(1)).alias("n"))


_CLAIMS = checks.CLAIM_WORDS.removesuffix("|%(?!@)").removesuffix("|\\d") + "|[0-9]|%([^@]|$)"
TIER_SQL = f"""WITH {PAIRS} SELECT category, CASE WHEN kind = 'plural' OR category = 'financial' OR regexp_matches(coalesce(source, ''), '{_CLAIMS.replace("'", "''")}') THEN 'A'
WHEN len(regexp_extract_all(coalesce(source, ''), '\\S+')) <= 1 THEN 'C' ELSE 'B' END AS tier, count(*) AS n FROM pairs GROUP BY 1, 2"""


def length_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupBy(checks.length_class(F.col("screen_key"), F.col("title")).alias("class"), X.key_prefix("screen_key", 1).alias("prefix")).agg(F.count(F.lit(1)).alias("n"))


def _names_control(c: str) -> str:
    clause = f"trim(regexp_replace(regexp_extract({c}, '^[^;.,]*'), '{checks.QUALIFIER}', ''))"
    return f"(regexp_matches({clause}, '{checks.CONTROL_NOUN}') OR regexp_matches({c}, '{checks.FIT_HINT}'))"


LENGTH_CLASS_SQL = rf"""SELECT CASE WHEN regexp_matches(tail, '(?i)(criterion|earned|message|body|description|explanation)$') THEN 'body'
WHEN starts_with(k, 'widgets.') OR starts_with(k, 'shield.') OR regexp_matches(tail, '(?i)(button|cta|action|title|label|tab|toggle|badge|chip|pill|header|heading|name|option|placeholder|short|suffix|unit)$')
OR {_names_control("split_part(c, ':', 1)")} OR {_names_control("CASE WHEN contains(c, ':') THEN substr(c, instr(c, ':') + 1) ELSE '' END")} THEN 'single_line' ELSE 'open' END AS class,
CASE WHEN regexp_matches(k, '^[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)+$') THEN split_part(k, '.', 1) ELSE '<literal>' END AS prefix, count(*) AS n
FROM (SELECT screen_key AS k, split_part(screen_key, '.', -1) AS tail, coalesce(title, '') AS c FROM documents) GROUP BY 1, 2"""


def source_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.select("doc_id", worklist.source_hash("title", "text").alias("source_hash"))


_CELL = "coalesce('=' || regexp_replace({0}, '([\\\\|])', '\\\\\\1', 'g'), '-')"
HASH_SQL = f"SELECT doc_id, sha256({_CELL.format('title')} || '|' || {_CELL.format('text')}) AS source_hash FROM documents"


def worklist_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged quotes against what was adjudicated last, and against their imports."""
    p = table(spark, sf_dir, "pilot_staged")
    current = p.groupBy(F.col("id").alias("key")).agg(F.min(F.sha2("text", 256)).alias("source_hash"), F.max(F.when(F.col("verification") == "sourced", "translated").otherwise("needs_review")).alias("state"))
    a = table(spark, sf_dir, "adjudication_entries").where("source.id is not null").select(F.col("source.id").alias("key"), F.sha2("source.text", 256).alias("source_hash"), F.col("editor_verdict").alias("verdict"), "adjudicated_at", "packet_no", "entry_id")
    records = worklist.latest_by_key(a, "key", ["adjudicated_at", "packet_no", "entry_id"], ["verdict", "source_hash"])
    baseline = p.groupBy(F.col("id").alias("key")).agg(F.min(F.sha2("imported.text", 256)).alias("source_hash")).where("source_hash is not null")
    return worklist.work_status(current, records, baseline)


WORKLIST_SQL = """WITH c AS (SELECT id AS key, min(sha256(text)) AS h, max(CASE WHEN verification = 'sourced' THEN 'translated' ELSE 'needs_review' END) AS state FROM pilot_staged GROUP BY 1),
b AS (SELECT id AS key, min(sha256(imported.text)) AS h FROM pilot_staged WHERE imported.text IS NOT NULL GROUP BY 1),
r AS (SELECT source.id AS key, arg_max(sha256(source.text), (adjudicated_at, packet_no, entry_id)) AS h FROM adjudication_entries WHERE source.id IS NOT NULL GROUP BY 1)
SELECT c.key, CASE WHEN b.key IS NULL THEN 'new' WHEN b.h <> c.h THEN 'changed_source' WHEN r.h IS NOT NULL AND r.h <> c.h THEN 'changed_source'
WHEN c.state <> 'translated' THEN 'changed_target_state' ELSE 'unchanged_passed' END AS status
FROM c LEFT JOIN b ON c.key = b.key LEFT JOIN r ON c.key = r.key"""


def latest_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = table(spark, sf_dir, "fidelity_reviews").withColumn("key", F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id"))
    return worklist.latest_by_key(f, "key", ["reviewed_at", "review_no"], ["review_no", "verdict", "candidate_hash"])


LATEST_SQL = """SELECT key, review_no, verdict, candidate_hash FROM (SELECT DISTINCT packet_no || ':' || entry_id AS key, review_no, verdict, candidate_hash, reviewed_at FROM fidelity_reviews)
QUALIFY row_number() OVER (PARTITION BY key ORDER BY reviewed_at DESC, review_no DESC) = 1"""


def latest_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.latest_by_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"], ["event_id", "event_type"])


EVENT_SQL = "SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1"


def batch_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return worklist.neighbours(table(spark, sf_dir, "orders"), "o_custkey", ["o_orderdate", "o_orderkey"], "o_orderkey")


NEIGHBOUR_SQL = "SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER w AS before, lead(o_orderkey) OVER w AS after FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"


def fixed_size_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged quotes that no packet holds yet, forty to a batch."""
    jobs = table(spark, sf_dir, "pilot_staged").select(F.col("id").alias("key")).distinct()
    held = pairs(spark, sf_dir).select(F.col("source_id").alias("key"))
    return worklist.fixed_batches(jobs, held, "key", 40).select("key", "batch", "place")


FIXED_SQL = f"""WITH {PAIRS}, f AS (SELECT DISTINCT id AS key FROM pilot_staged WHERE id NOT IN (SELECT source_id FROM pairs WHERE source_id IS NOT NULL))
SELECT key, (n - 1) // 40 AS batch, (n - 1) % 40 AS place FROM (SELECT key, row_number() OVER (ORDER BY key) AS n FROM f)"""


def batch_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = table(spark, sf_dir, "documents").groupBy(F.col("screen_key").alias("key")).agg(F.min("doc_id").alias("pos"))
    feature = F.substring_index("key", ".", 1)
    cls = F.when(feature.isin("paywall", "shield", "widgets"), feature).otherwise("general")
    return worklist.pack_batches(k.select(feature.alias("feature"), X.group_of("key").alias("group"), cls.alias("class"), "pos", "key"))


def leak_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    blind = packet_entries(spark, sf_dir).select("key", F.col("target").alias("leaf"))
    return packets.leaks(blind, table(spark, sf_dir, "glossary_open").select(F.col("recommended").alias("item")))


LEAK_SQL = f"""WITH {ENTRIES}, b AS (SELECT key, {_PLAIN.format("target")} AS hay FROM entries WHERE target IS NOT NULL),
i AS (SELECT DISTINCT recommended AS item, {_PLAIN.format("recommended")} AS needle FROM glossary_open)
SELECT DISTINCT b.key, i.item FROM b JOIN i ON length(i.needle) >= 4 AND regexp_matches(i.needle, '[a-z]') AND contains(' ' || b.hay || ' ', ' ' || i.needle || ' ')"""


def invariant_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return packets.invariants(p).groupBy("kind", "fact").agg(F.count(F.lit(1)).alias("n"))


def _invariant_sql() -> str:
    esc = lambda p: p.replace("'", "''")
    parts = " UNION ALL ".join(f"SELECT '{k}' AS kind, fact FROM (SELECT key, unnest(list_distinct(regexp_extract_all(lower(source), '{esc(p)}'))) AS fact FROM pairs WHERE source IS NOT NULL)" for k, p in packets.INVARIANTS.items())
    return f"WITH {PAIRS} SELECT kind, fact, count(*) AS n FROM ({parts}) GROUP BY 1, 2"


def same_source_siblings(spark: SparkSession, sf_dir: str) -> DataFrame:
    one = pairs(spark, sf_dir).groupBy("key").agg(F.min("source").alias("source"))
    return packets.same_source(one)


SIBLING_SQL = f"""WITH {PAIRS}, o AS (SELECT key, min(source) AS source FROM pairs GROUP BY 1), g AS (SELECT source, count(*) AS n, min(key) AS a, max(key) AS b FROM o WHERE source IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
SELECT o.key, g.n - 1 AS n_siblings, CASE WHEN o.key = g.a THEN g.b ELSE g.a END AS first_sibling FROM o JOIN g ON o.source = g.source"""


def context_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k = d.groupBy(F.col("screen_key").alias("key")).agg(F.min("doc_id").alias("pos"), F.max("title").alias("target"))
    return packets.context_keys(k, k.where("target is null"))


CONTEXT_SQL = """WITH k AS (SELECT screen_key AS key, min(doc_id) AS pos, max(title) AS target FROM documents GROUP BY 1),
p AS (SELECT *, array_to_string(string_split(key, '.')[1:2], '.') AS prefix FROM k),
d AS (SELECT DISTINCT prefix FROM p WHERE target IS NULL AND len(string_split(key, '.')) >= 3)
SELECT prefix, key FROM p WHERE length(target) > 0 AND prefix IN (SELECT prefix FROM d) QUALIFY row_number() OVER (PARTITION BY prefix ORDER BY pos, key) <= 24"""


def control_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    return d.groupBy(packets.control_kind(F.col("screen_key"), F.col("title")).alias("control")).agg(F.count(F.lit(1)).alias("n"))


_FIELD = {"key": "screen_key", "tail": "lower(split_part(screen_key, '.', -1))", "comment": "lower(coalesce(title, ''))", "head": "regexp_extract(lower(coalesce(title, '')), '(?s)^(.*?)(?:[.;]\\s|\\z)', 1)", "text": "coalesce(text, '')"}


def _told(field: str, pattern: str) -> str:
    return f"regexp_matches({_FIELD[field]}, '{pattern.replace(chr(39), chr(39) * 2)}')"


def _control_case() -> str:
    rules = [f"WHEN ({' OR '.join(_told(*x) for x in one_of)}){f' AND {_told(*also)}' if also else ''} THEN '{name}'" for name, one_of, also in packets.CONTROLS]
    return "CASE " + " ".join(rules) + " ELSE 'label' END"


def _control_kind_sql() -> str:
    return f"SELECT {_control_case()} AS control, count(*) AS n FROM documents GROUP BY 1"


def content_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What kind of content a text is, by its screen, its title as a comment, and itself."""
    d = table(spark, sf_dir, "documents")
    control = packets.control_kind(F.col("screen_key"), F.col("title"))
    return d.groupBy(packets.content_kind(F.col("screen_key"), F.col("text"), F.col("title"), control).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


def _content_sql() -> str:
    rules = [f"WHEN {' OR '.join(_told(*x) for x in one_of)} THEN '{kind}'" for kind, one_of in packets.KINDS]
    short = f"WHEN {_control_case()} IN ({', '.join(repr(c) for c in packets.FUNCTIONAL)}) OR len(regexp_extract_all(coalesce(text, ''), '[^\\s\\p{{Z}}]+')) <= {packets.FUNCTIONAL_WORDS} THEN 'functional'"
    return f"SELECT CASE {' '.join(rules)} {short} ELSE 'explanatory' END AS kind, count(*) AS n FROM documents GROUP BY 1".replace("{{", "{").replace("}}", "}")


def string_leaves(spark: SparkSession, sf_dir: str) -> DataFrame:
    """String fields at the head of glossary files, each file once."""
    g = table(spark, sf_dir, "glossary_files").select("file_no", "body").distinct()
    heads = packets.leaves(g, "file_no", "body").where(~F.substring(F.col("path"), 3, 1 << 20).contains("."))
    return heads.groupBy("path", "leaf").agg(F.count(F.lit(1)).alias("n"))


LEAVES_SQL = """SELECT '$.' || k AS path, v AS leaf, count(*) AS n FROM (SELECT unnest(json_keys(body)) AS k, body FROM (SELECT DISTINCT file_no, body FROM glossary_files)), LATERAL (SELECT json_extract_string(body, k) AS v, json_type(body, k) AS t)
WHERE t = 'VARCHAR' GROUP BY 1, 2"""


def state_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged texts against the adjudicated copies of them."""
    old = pairs(spark, sf_dir).groupBy(F.col("source_id").alias("id")).agg(F.min("source").alias("text"))
    new = table(spark, sf_dir, "pilot_staged").groupBy("id").agg(F.min("text").alias("text"))
    return packets.changes_between(old, new, "id", ["text"]).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


CHANGES_SQL = f"""WITH {PAIRS}, o AS (SELECT source_id AS id, min(source) AS text FROM pairs GROUP BY 1), n AS (SELECT id, min(text) AS text FROM pilot_staged GROUP BY 1)
SELECT change, count(*) AS n FROM (SELECT CASE WHEN o.id IS NULL THEN 'added' WHEN n.id IS NULL THEN 'removed' WHEN o.text IS DISTINCT FROM n.text THEN 'changed' END AS change
FROM o FULL JOIN n ON o.id = n.id) WHERE change IS NOT NULL GROUP BY 1"""


def simple_casing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return casing.simple_casing(packet_entries(spark, sf_dir).select("key", F.col("target").alias("value")))


CASING_SQL = f"""WITH {ENTRIES}, v AS (SELECT key, regexp_replace(target, '[^\\p{{L}}]', '', 'g') AS letters, regexp_extract(target, '[\\p{{L}}\\p{{N}}]') AS first FROM entries WHERE target IS NOT NULL)
SELECT key, 'starts with a lower-case letter' AS problem FROM v WHERE regexp_matches(first, '^\\p{{Ll}}')
UNION ALL SELECT key, 'all capitals' FROM v WHERE length(letters) > 1 AND NOT regexp_matches(letters, '[^\\p{{Lu}}]')"""


def casing_findings(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = packet_entries(spark, sf_dir)
    none = F.array().cast("array<string>")
    return casing.casing_findings(e.select("key", "variation", F.col("target").alias("value"), F.lit("sentence").alias("style"), F.array(F.lit("ID"), F.lit("API")).alias("protected"), none.alias("exceptions"), F.lit("review").alias("capitals")))


def casing_styles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every entry held to each style, the letters alone."""
    e = packet_entries(spark, sf_dir).where("target is not null")
    styles = F.explode(F.array(*[F.lit(x) for x in ("uppercase", "lowercase", "sentence", "title", "preserve")]))
    rows = e.select(F.col("key"), "variation", F.col("target").alias("masked"), styles.alias("style"), F.lit("sentence").alias("expected"))
    return casing.style_findings(rows).groupBy("severity", "message").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("key").alias("n_keys"))


STYLES_SQL = rf"""WITH {ENTRIES}, v AS (SELECT key, target, regexp_replace(target, '[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]', '', 'g') AS cased, regexp_extract(target, '[\p{{L}}\p{{N}}_]') AS first FROM entries WHERE target IS NOT NULL),
s(style) AS (VALUES ('uppercase'), ('lowercase'), ('sentence'), ('title'), ('preserve')), r AS (SELECT * FROM v CROSS JOIN s), f AS (
SELECT key, 'needs_disposition' AS severity, 'style is not the role''s and no exception names the value' AS message FROM r WHERE style <> 'sentence'
UNION ALL SELECT key, 'major', 'lower case in an uppercase role' FROM r WHERE style = 'uppercase' AND regexp_matches(target, '\p{{Ll}}')
UNION ALL SELECT key, 'needs_disposition', 'a capital in a lowercase role' FROM r WHERE style = 'lowercase' AND regexp_matches(target, '\p{{Lu}}')
UNION ALL SELECT key, 'major', 'starts with a lower-case letter' FROM r WHERE style IN ('sentence', 'title') AND regexp_matches(first, '\p{{Ll}}')
UNION ALL SELECT key, 'major', 'all capitals' FROM r WHERE style IN ('sentence', 'title') AND length(cased) > 1 AND NOT regexp_matches(cased, '[^\p{{Lu}}]')
UNION ALL SELECT key, 'needs_disposition', 'lower case after a sentence end' FROM r WHERE style IN ('sentence', 'title') AND regexp_matches(target, '[.!?][\s\p{{Z}}]+\p{{Ll}}')
UNION ALL SELECT key, 'needs_disposition', 'title case needs a reading of its main words' FROM r WHERE style = 'title')
SELECT severity, message, count(*) AS n, count(DISTINCT key) AS n_keys FROM f GROUP BY 1, 2"""


def equivalent_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = pairs(spark, sf_dir)
    return casing.drift(p.select(F.lower("source").alias("group"), F.col("locale").alias("role"), F.lit("standalone").alias("position"), F.lit("sentence").alias("style"), F.col("target").alias("value")))


DRIFT_SQL = f"""WITH {PAIRS} SELECT lower(source) AS "group", locale AS role, 'standalone' AS position, count(DISTINCT 'sentence') AS n_styles, count(DISTINCT target) AS n_spellings FROM pairs
GROUP BY 1, 2 HAVING count(DISTINCT target) > count(DISTINCT lower(target))"""


def guarded_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What editors were sent, as candidates against the adjudicated units."""
    units = pairs(spark, sf_dir).groupBy("key", "locale", "variation").agg(F.min("source").alias("source"), F.min("target").alias("target"), F.min(F.when(F.col("verdict") == "pass", "translated").otherwise("needs_review")).alias("state"))
    candidates = packet_entries(spark, sf_dir).groupBy("key", "variation").agg(F.min("target").alias("value"))
    return apply.plan_changes(units, candidates).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


_COUNT = "len(regexp_extract_all({0}, '%(?:[0-9]+\\$)?[-+0#]*[0-9]*(?:\\.[0-9]+)?(?:hh|h|ll|l|q|z|t|L)?[@dDiuUxXoOfeEgGcCsSpaAF%]'))"
APPLY_SQL = f"""WITH {PAIRS}, {ENTRIES}, u AS (SELECT key, min(source) AS source, min(target) AS target, min(CASE WHEN verdict = 'pass' THEN 'translated' ELSE 'needs_review' END) AS state FROM pairs GROUP BY 1),
c AS (SELECT key, min(target) AS value FROM entries GROUP BY 1)
SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN u.key IS NULL THEN 'unknown' WHEN u.target IS NOT DISTINCT FROM c.value THEN 'unchanged' WHEN u.state = 'translated' THEN 'locked'
WHEN {_COUNT.format("u.source")} <> {_COUNT.format("c.value")} THEN 'blocked' ELSE 'change' END AS outcome FROM c LEFT JOIN u ON c.key = u.key) GROUP BY 1"""


def opaque_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = table(spark, sf_dir, "documents").groupBy(F.col("screen_key").alias("key")).agg(F.count(F.lit(1)).alias("n_docs"))
    return numbered(k, ["key"]).select("key", "n_docs", "n")


OPAQUE_SQL = "SELECT key, n_docs, row_number() OVER (ORDER BY key) AS n FROM (SELECT screen_key AS key, count(*) AS n_docs FROM documents GROUP BY 1)"


def key_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first document (by id) that quotes a key of a known screen in backticks."""
    d = table(spark, sf_dir, "documents")
    quoted = F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit("`([a-z][A-Za-z0-9]*[.][A-Za-z0-9.]*)`"), F.lit(1))))
    found = d.select("doc_id", quoted.alias("quoted")).select("doc_id", F.substring_index("quoted", ".", 2).alias("key"))
    screens = d.select(F.substring_index("screen_key", ".", 2).alias("key")).distinct()
    return found.join(screens, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("first_doc"), F.countDistinct("doc_id").alias("n_docs"))


_SCREEN = "array_to_string(string_split({0}, '.')[1:2], '.')"
MENTION_SQL = f"""SELECT key, min(doc_id) AS first_doc, count(DISTINCT doc_id) AS n_docs
FROM (SELECT doc_id, {_SCREEN.format("q")} AS key FROM (SELECT doc_id, unnest(regexp_extract_all(text, '`([a-z][A-Za-z0-9]*[.][A-Za-z0-9.]*)`', 1)) AS q FROM documents))
WHERE key IN (SELECT {_SCREEN.format("screen_key")} FROM documents) GROUP BY 1"""


def queries() -> dict:
    return {f.__name__: f for f in (
        unit_inventory, findings_summary, placeholder_diff, markup_parity, typography_rules, length_ratio_render_list, forbidden_terms, term_prefix_counts, option_counts, control_drift, state_gate, identity_check,
        same_source_divergence, tier_classification, length_classes, source_hash, worklist_status, latest_verdict, latest_event, batch_neighbours, fixed_size_batches, batch_packing, leak_check, invariant_facts,
        same_source_siblings, context_neighbours, control_kinds, content_classes, string_leaves, state_changes, simple_casing, casing_styles, casing_findings, equivalent_drift, guarded_apply, opaque_numbers, key_mentions,
    )}


def _summary_sql() -> str:
    parts = (("C3", MARKUP_SQL), ("C4", _typography_sql()), ("C8", IDENTITY_SQL))
    union = " UNION ALL ".join(f"SELECT '{c}' AS \"check\", severity, key FROM ({q})" for c, q in parts)
    return f'SELECT "check", severity, count(*) AS n, count(DISTINCT key) AS n_keys FROM ({union}) GROUP BY 1, 2'


def oracle_sql() -> dict[str, str]:
    return {
        "findings_summary": _summary_sql(),
        "unit_inventory": f"WITH {PAIRS} SELECT locale, kind, verdict, count(*) AS n, count(DISTINCT key) AS n_keys, sum(length(target))::BIGINT AS characters, max(length(target)) AS longest FROM pairs GROUP BY 1, 2, 3",
        "placeholder_diff": PLACEHOLDER_SQL, "markup_parity": MARKUP_SQL, "typography_rules": _typography_sql(), "length_ratio_render_list": RATIO_SQL, "forbidden_terms": FORBIDDEN_SQL, "term_prefix_counts": PREFIX_SQL,
        "option_counts": OPTION_SQL, "control_drift": CONTROL_SQL, "state_gate": STATE_SQL, "identity_check": IDENTITY_SQL, "same_source_divergence": DIVERGENCE_SQL, "tier_classification": TIER_SQL, "length_classes": LENGTH_CLASS_SQL,
        "source_hash": HASH_SQL, "worklist_status": WORKLIST_SQL, "latest_verdict": LATEST_SQL, "latest_event": EVENT_SQL, "batch_neighbours": NEIGHBOUR_SQL, "fixed_size_batches": FIXED_SQL, "leak_check": LEAK_SQL,
        "invariant_facts": _invariant_sql(), "same_source_siblings": SIBLING_SQL, "context_neighbours": CONTEXT_SQL, "control_kinds": _control_kind_sql(), "content_classes": _content_sql(), "string_leaves": LEAVES_SQL, "state_changes": CHANGES_SQL,
        "simple_casing": CASING_SQL, "casing_styles": STYLES_SQL, "equivalent_drift": DRIFT_SQL, "guarded_apply": APPLY_SQL, "opaque_numbers": OPAQUE_SQL, "key_mentions": MENTION_SQL,
    }
