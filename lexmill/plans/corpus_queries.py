"""Lineage, corpus state, reviews and reference data over the tables, with the SQL beside them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import corpus, lineage, packets, reference, reviews
from lexmill.plans.views import ENTRIES, PAIRS, QUOTES, packet_entries, pairs, quotes
from lexmill.session import durable, table

LANGUAGES = ["en", "ro", "hu", "de", "fr", "es", "tr", "el"]


def record_issues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.record_issues(quotes(spark, sf_dir))


ISSUES_SQL = f"""WITH {QUOTES}, k AS (SELECT id, min(category) AS c FROM quotes WHERE id IS NOT NULL GROUP BY 1), q AS (SELECT quotes.*, k.c AS parent FROM quotes LEFT JOIN k ON quotes.translation_of = k.id)
SELECT id, 'invalid_category' AS code, true AS blocking FROM q WHERE coalesce(trim(category), '') = ''
UNION ALL SELECT id, 'invalid_text', true FROM q WHERE coalesce(trim(text), '') = ''
UNION ALL SELECT id, 'assumed_english', false FROM q WHERE language IS NULL
UNION ALL SELECT id, 'invalid_language', true FROM q WHERE language IS NOT NULL AND NOT regexp_full_match(language, '[A-Za-z]{{2,3}}(?:-[A-Za-z0-9]{{2,8}})*')
UNION ALL SELECT id, 'excluded_status', true FROM q WHERE status IN ('rejected', 'not_relevant', 'unverified')
UNION ALL SELECT id, 'unknown_verification', true FROM q WHERE status IS NULL OR status NOT IN ('sourced', 'sourced_unverified', 'supplied_unverified', 'authored', 'curated', 'legacy_unsourced', 'rejected', 'not_relevant', 'unverified')
UNION ALL SELECT id, 'invalid_pair_id', true FROM q WHERE pair_id IS NOT NULL AND trim(pair_id) = ''
UNION ALL SELECT id, 'invalid_translation_link', true FROM q WHERE translation_of IS NOT NULL AND (translation_of = id OR trim(translation_of) = '')
UNION ALL SELECT id, 'missing_translation_target', true FROM q WHERE translation_of IS NOT NULL AND parent IS NULL AND trim(translation_of) <> ''
UNION ALL SELECT id, 'cross_category_translation', true FROM q WHERE translation_of IS NOT NULL AND parent <> category"""


def _roots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    q = quotes(spark, sf_dir)
    return q, lineage.components(q.where("id is not null"), lineage.lineage_edges(q))


def lineage_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _roots(spark, sf_dir)[1]


_REACH = f"""{QUOTES}, known AS (SELECT DISTINCT id, category FROM quotes), pairkey AS (SELECT DISTINCT id, category, pair_id FROM quotes WHERE trim(pair_id) <> ''),
least AS (SELECT category, pair_id, min(id) AS b FROM pairkey GROUP BY 1, 2),
edge AS (SELECT DISTINCT q.id AS a, q.translation_of AS b FROM quotes q JOIN known k ON q.translation_of = k.id AND q.category = k.category WHERE q.id <> q.translation_of
  UNION SELECT p.id, l.b FROM pairkey p JOIN least l USING (category, pair_id) WHERE p.id <> l.b),
both_ways AS (SELECT a, b FROM edge UNION SELECT b, a FROM edge),
reach AS (SELECT DISTINCT id, id AS r FROM quotes UNION SELECT e.b, reach.r FROM reach JOIN both_ways e ON e.a = reach.id),
roots AS (SELECT id, min(r) AS root FROM reach GROUP BY id)"""


def lineage_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.cycle_members(quotes(spark, sf_dir))


CYCLES_SQL = f"""WITH RECURSIVE {QUOTES}, step AS (SELECT id, min(translation_of) AS t FROM quotes GROUP BY 1), s AS (SELECT id, t FROM step WHERE t IN (SELECT id FROM step WHERE t IS NOT NULL)),
walk AS (SELECT id, t, 1 AS n FROM s UNION SELECT w.id, s.t, w.n + 1 FROM walk w JOIN s ON w.t = s.id WHERE w.n < 64 AND w.t <> w.id)
SELECT DISTINCT id FROM walk WHERE id = t"""


def lineage_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    q, roots = _roots(spark, sf_dir)
    return lineage.lineage_groups(q, roots, LANGUAGES)


GROUPS_SQL = f"""WITH RECURSIVE {_REACH}, m AS (SELECT q.id, roots.root, coalesce(q.language, '<invalid>') AS l, q.pair_id, q.translation_of,
  q.id IN (SELECT translation_of FROM quotes WHERE id IS NOT NULL AND translation_of IS NOT NULL) AND (q.translation_of IS NULL OR q.translation_of NOT IN (SELECT id FROM quotes)) AS linked FROM quotes q JOIN roots ON q.id = roots.id),
g AS (SELECT root, count(*) AS n_members, count(DISTINCT l) AS n_languages, count(DISTINCT pair_id) AS n_pairs, count(*) FILTER (linked) AS nl, min(id) FILTER (linked) AS li, count(*) FILTER (l = 'en') AS ne, min(id) FILTER (l = 'en') AS en, min(id) AS least, list(DISTINCT l) AS have FROM m GROUP BY 1)
SELECT root, n_members, n_languages, CASE WHEN nl = 1 THEN li WHEN nl > 1 THEN least WHEN ne = 1 THEN en ELSE least END AS source_id,
array_to_string(list_filter(['de', 'el', 'en', 'es', 'fr', 'hu', 'ro', 'tr'], lambda x: NOT list_contains(have, x)), ',') AS missing, nl > 1 OR (nl = 0 AND ne <> 1 AND n_members > 1) AS ambiguous, n_pairs > 1 AS conflicting FROM g"""


def missing_locales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineage.missing_jobs(lineage_groups(spark, sf_dir)).groupBy("locale").agg(F.count(F.lit(1)).alias("n"))


MISSING_SQL = f"SELECT locale, count(*) AS n FROM (SELECT unnest(string_split(missing, ',')) AS locale FROM ({GROUPS_SQL}) WHERE missing <> '') GROUP BY 1"


def content_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = quotes(spark, sf_dir)
    return q.groupBy("category", corpus.content_kind(F.col("category"), F.col("attributed"), F.col("status")).alias("kind")).agg(F.count(F.lit(1)).alias("n"))


KIND_SQL = f"""WITH {QUOTES} SELECT category, CASE WHEN category = 'scripture' THEN 'scripture' WHEN attributed THEN 'attributed' WHEN status IN ('authored', 'curated') THEN 'authored' ELSE 'uncertain' END AS kind, count(*) AS n FROM quotes GROUP BY 1, 2"""


def target_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = pairs(spark, sf_dir).select("category", "locale", F.col("source_id").alias("group_id"), F.col("target").alias("text"), F.lit(True).alias("is_new"))
    q = quotes(spark, sf_dir).select("category", F.col("language").alias("locale"), F.col("id").alias("group_id"), "text", F.lit(True))
    return corpus.collisions(a.union(q).distinct()).drop("collision")


COLLISION_SQL = f"""WITH {PAIRS}, {QUOTES}, t AS (SELECT category, locale, source_id AS g, target AS text FROM pairs UNION SELECT category, language, id, text FROM quotes)
SELECT category, locale, replace(replace(lower(trim(regexp_replace(replace(text, 'İ', 'i' || chr(775)), '\\s+', ' ', 'g'))), 'ß', 'ss'), 'ς', 'σ') AS text_norm, count(DISTINCT g) AS n_groups, count(*) AS n_rows FROM t WHERE text IS NOT NULL GROUP BY 1, 2, 3 HAVING count(DISTINCT g) > 1"""


def identity_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjudicated copies of one source that differ."""
    a = pairs(spark, sf_dir).select(F.col("source_id").alias("id"), "category", F.col("source").alias("text"))
    return lineage.identity_errors(a)


IDENTITY_ERROR_SQL = f"""WITH {PAIRS}, r AS (SELECT DISTINCT source_id AS id, category, source AS text FROM pairs)
SELECT id, CASE WHEN id IS NULL THEN 'no id' WHEN trim(id) = '' THEN 'blank id' ELSE 'different records' END AS error FROM r GROUP BY id HAVING id IS NULL OR trim(id) = '' OR count(*) > 1"""


def export_blockers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What keeps adjudicated quotes back: their last verdict, blank themes for contexts, and how they are verified."""
    return corpus.export_blockers(_export_jobs(spark, sf_dir)).groupBy("blocker").agg(F.count(F.lit(1)).alias("n"))


def _export_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "adjudication_entries")
    job = a.groupBy(F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id").alias("job")).agg(
        F.min("source.category").alias("category"), F.min((F.col("editor_verdict") == "pass").cast("int") + (F.col("fidelity_verdict") == "pass").cast("int")).alias("passes"), F.count("source.theme").alias("n_contexts"),
        F.min("text").alias("text"), F.min("source.text").alias("evidence"), F.max(F.col("source.attribution.name").isNotNull().cast("int")).alias("named"), F.min("source.verification").alias("status"), F.max((F.col("source.pair_id") == "").cast("int")).alias("bad"),
    )
    kind = corpus.content_kind(F.col("category"), F.col("named") == 1, F.col("status"))
    return job.select("job", "category", (F.col("passes") == 2).alias("passed"), "n_contexts", kind.alias("kind"), "text", "evidence", (F.col("bad") == 1).alias("blocked_lineage"))


EXPORT_BLOCKER_SQL = """WITH j AS (SELECT packet_no || ':' || entry_id AS job, min(source.category) AS category, min((editor_verdict = 'pass')::INT + (fidelity_verdict = 'pass')::INT) AS passes, count(source.theme) AS n_contexts, min(text) AS text,
min(source.text) AS evidence, max((source.attribution.name IS NOT NULL)::INT) AS named, min(source.verification) AS status, max((source.pair_id = '')::INT) AS bad FROM adjudication_entries GROUP BY 1),
k AS (SELECT *, CASE WHEN category = 'scripture' THEN 'scripture' WHEN named = 1 THEN 'attributed' WHEN status IN ('authored', 'curated') THEN 'authored' ELSE 'uncertain' END AS kind FROM j)
SELECT blocker, count(*) AS n FROM (
SELECT 'unresolved lineage' AS blocker FROM k WHERE bad IS NULL OR bad = 1 UNION ALL SELECT 'no category' FROM k WHERE coalesce(trim(category), '') = '' UNION ALL SELECT 'no review' FROM k WHERE passes IS NULL OR passes < 2
UNION ALL SELECT 'no context' FROM k WHERE n_contexts = 0 UNION ALL SELECT 'uncertain authorship' FROM k WHERE kind = 'uncertain' UNION ALL SELECT 'scripture differs' FROM k WHERE kind = 'scripture' AND text IS DISTINCT FROM evidence) GROUP BY 1"""


def scoped_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Who decided glossary items that concern a job: decided ones by locale, others everywhere."""
    jobs = pairs(spark, sf_dir).select(F.col("key").alias("job"), "locale", "category").distinct()
    g = table(spark, sf_dir, "glossary_open").select(F.when(F.col("status") == "decided", F.col("locale")).otherwise("*").alias("scope"), F.col("decided_by").alias("context")).distinct()
    return corpus.context_counts(jobs, g)


SCOPE_SQL = f"""WITH {PAIRS}, g AS (SELECT DISTINCT CASE WHEN status = 'decided' THEN locale ELSE '*' END AS scope, decided_by FROM glossary_open)
SELECT p.key AS job, count(DISTINCT g.decided_by) AS n_contexts FROM pairs p JOIN g ON g.scope IN ('*', p.locale, 'category:' || p.category) GROUP BY 1"""


def _review_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "adjudication_entries").select(F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id").alias("job"), "candidate_hash", "adjudicated_at", "editor_verdict").distinct()
    f = table(spark, sf_dir, "fidelity_reviews").select(F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id").alias("job"), "candidate_hash", "reviewed_at", "verdict", "review_no").distinct()
    none = F.lit(None).cast("string")
    seq = lambda c, k: F.unix_micros(F.col(c).cast("timestamp")) * 10 + k
    c = f.groupBy("job", F.col("candidate_hash").alias("candidate")).agg((F.min(seq("reviewed_at", 0)) - 5).alias("seq"))
    first = c.select("job", "seq", F.lit("candidate").alias("type"), none.alias("role"), "candidate", none.alias("verdict"), none.alias("reviewer"))
    r = f.select("job", seq("reviewed_at", 1).alias("seq"), F.lit("review"), F.lit("fidelity"), "candidate_hash", "verdict", F.concat(F.lit("f"), F.col("review_no").cast("string")))
    e = a.select("job", seq("adjudicated_at", 2).alias("seq"), F.lit("review"), F.lit("adjudicator"), "candidate_hash", "editor_verdict", F.lit("adjudicator"))
    return first.union(r).union(e)


def review_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus.current_reviews(_review_log(spark, sf_dir))


REVIEW_SQL = """WITH a AS (SELECT DISTINCT packet_no || ':' || entry_id AS job, candidate_hash AS h, epoch_us(adjudicated_at) * 10 + 2 AS seq, editor_verdict AS verdict FROM adjudication_entries),
f AS (SELECT DISTINCT packet_no || ':' || entry_id AS job, candidate_hash AS h, epoch_us(reviewed_at) * 10 + 1 AS seq, verdict, 'f' || review_no AS reviewer FROM fidelity_reviews),
c AS (SELECT job, h, min(seq) - 6 AS seq FROM f GROUP BY 1, 2), cc AS (SELECT job, arg_max(h, seq) AS candidate, max(seq) AS since FROM c GROUP BY 1),
r AS (SELECT job, h, 'fidelity' AS role, seq, verdict, reviewer FROM f UNION ALL SELECT job, h, 'adjudicator', seq, verdict, 'adjudicator' FROM a),
n AS (SELECT r.job, candidate, role, max(seq) AS at, arg_max(verdict, seq) AS verdict, arg_max(reviewer, seq) AS reviewer FROM r JOIN cc ON r.job = cc.job AND r.h = cc.candidate WHERE r.seq > cc.since GROUP BY 1, 2, 3)
SELECT n.job, n.candidate, n.role, n.verdict, n.reviewer, n.role <> 'adjudicator' OR n.at > coalesce((SELECT max(x.at) FROM n x WHERE x.job = n.job AND x.role <> 'adjudicator'), 0) AS valid FROM n"""


def job_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    jobs = packet_entries(spark, sf_dir).select(F.col("key").alias("job"))
    given = pairs(spark, sf_dir).select(F.col("key").alias("job"), "verdict")
    return corpus.job_summary(jobs, given, given.where("verdict = 'pass'"))


JOBS_SQL = f"""WITH {PAIRS}, {ENTRIES} SELECT status, count(*) AS n FROM (SELECT DISTINCT key, CASE WHEN key IN (SELECT key FROM pairs WHERE verdict = 'pass') THEN 'reviewed' WHEN key IN (SELECT key FROM pairs) THEN 'awaiting' ELSE 'pending' END AS status FROM entries) GROUP BY 1"""


def id_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = table(spark, sf_dir, "fidelity_reviews").select(F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id").alias("key"))
    return reviews.id_coverage(packet_entries(spark, sf_dir), given, "key")


COVERAGE_SQL = f"""WITH {ENTRIES}, g AS (SELECT packet_no || ':' || entry_id AS key, count(*) AS n FROM fidelity_reviews GROUP BY 1), e AS (SELECT DISTINCT key FROM entries)
SELECT key, 'missing' AS problem FROM e WHERE key NOT IN (SELECT key FROM g) UNION ALL SELECT key, 'extra' FROM g WHERE key NOT IN (SELECT key FROM e) UNION ALL SELECT key, 'duplicate' FROM g WHERE n > 1"""


def finding_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews.finding_errors(table(spark, sf_dir, "fidelity_reviews").withColumnRenamed("review_no", "id").distinct())


FINDING_SQL = """WITH f AS (SELECT DISTINCT review_no AS id, verdict, findings FROM fidelity_reviews)
SELECT id, 'pass with findings' AS problem FROM f WHERE verdict = 'pass' AND coalesce(len(findings), 0) > 0
UNION ALL SELECT id, 'finding without findings' FROM f WHERE verdict <> 'pass' AND coalesce(len(findings), 0) = 0
UNION ALL SELECT DISTINCT id, 'unknown severity' FROM (SELECT id, unnest(findings) AS x FROM f) WHERE x.severity IS NULL OR x.severity NOT IN ('critical', 'major', 'minor', 'preference')
UNION ALL SELECT DISTINCT id, 'finding without span' FROM (SELECT id, unnest(findings) AS x FROM f) WHERE coalesce(trim(x.target_span), '') = ''"""


def envelope_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "editor_packets").select("packet_no", "locale", "packet_hash").distinct()
    r = table(spark, sf_dir, "adjudication_entries").select("packet_no", "locale", "packet_hash").distinct()
    return reviews.envelope_errors(p, r, "packet_no", ["locale", "packet_hash"])


ENVELOPE_SQL = """WITH p AS (SELECT DISTINCT packet_no, locale, packet_hash FROM editor_packets), r AS (SELECT DISTINCT packet_no, locale, packet_hash FROM adjudication_entries)
SELECT r.packet_no, 'locale' AS field FROM r JOIN p USING (packet_no) WHERE r.locale IS DISTINCT FROM p.locale UNION ALL SELECT r.packet_no, 'packet_hash' FROM r JOIN p USING (packet_no) WHERE r.packet_hash IS DISTINCT FROM p.packet_hash"""


def open_item_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.open_item_errors(table(spark, sf_dir, "glossary_open").withColumnRenamed("item_no", "item").distinct())


OPEN_SQL = """WITH g AS (SELECT DISTINCT item_no AS item, options, recommended, decided_by, status FROM glossary_open)
SELECT item, 'recommended is not an option' AS error FROM g WHERE NOT list_contains(options, recommended) UNION ALL SELECT item, 'no recommended' FROM g WHERE recommended IS NULL
UNION ALL SELECT item, 'no decided_by' FROM g WHERE decided_by IS NULL UNION ALL SELECT item, 'no status' FROM g WHERE status IS NULL"""


def canonical_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as chapters, their lines as verses; each order asks for its first three lines."""
    refs = table(spark, sf_dir, "orders").select(F.concat(F.lit("Order "), F.col("o_orderkey").cast("string"), F.lit(":1-3")).alias("reference"))
    verses = table(spark, sf_dir, "lineitem").groupBy(F.lit("Order").alias("book"), F.col("l_orderkey").cast("int").alias("chapter"), F.col("l_linenumber").cast("int").alias("verse")).agg(F.min(F.concat("l_returnflag", "l_linestatus")).alias("text"))
    return reference.select_ranges(reference.parse_references(refs), verses)


RANGE_SQL = """WITH v AS (SELECT l_orderkey AS c, l_linenumber AS n, min(l_returnflag || l_linestatus) AS t FROM lineitem WHERE l_linenumber BETWEEN 1 AND 3 GROUP BY 1, 2)
SELECT 'Order ' || o_orderkey || ':1-3' AS reference, CASE WHEN count(t) = 3 THEN string_agg(t, ' ' ORDER BY n) END AS text, count(t) AS n, 3 - count(t) AS missing FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderkey > 0) LEFT JOIN v ON c = o_orderkey GROUP BY o_orderkey"""


def markdown_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.section_sizes(reference.markdown_lines(table(spark, sf_dir, "documents"), "doc_id", "text"))


_LINES = "lines AS (SELECT doc_id AS id, unnest(l) AS text, unnest(range(len(l))) AS line FROM (SELECT doc_id, regexp_split_to_array(text, '\\r\\n|\\n|\\r') AS l FROM documents WHERE text IS NOT NULL))"
SECTION_SQL = f"""WITH {_LINES}, h AS (SELECT id, line, text, last_value(CASE WHEN starts_with(text, '## ') THEN trim(substr(text, 4)) END IGNORE NULLS) OVER (PARTITION BY id ORDER BY line) AS heading FROM lines)
SELECT id, heading, count(*) AS n_lines, count(*) FILTER (trim(text) <> '') AS n_filled FROM h WHERE heading IS NOT NULL AND NOT starts_with(text, '## ') GROUP BY 1, 2"""


def repeated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long lines that stand in several documents, as lines of a template do."""
    lines = reference.markdown_lines(table(spark, sf_dir, "documents"), "doc_id", "text").where(F.length("text") > 60)
    template = lines.groupBy("text").agg(F.countDistinct("id").alias("n")).where("n > 1")
    return reference.template_lines(lines, template)


REPEATED_SQL = f"WITH {_LINES}, t AS (SELECT text FROM lines WHERE length(text) > 60 GROUP BY 1 HAVING count(DISTINCT id) > 1) SELECT id, line FROM lines WHERE text IN (SELECT text FROM t)"


def honesty_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reference.honesty_findings(reference.markdown_lines(table(spark, sf_dir, "documents"), "doc_id", "text"))


def carried_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged themes carried over to adjudicated copies whose text is unchanged."""
    old = quotes(spark, sf_dir).join(table(spark, sf_dir, "pilot_staged").groupBy("id").agg(F.min("theme").alias("theme")), "id").groupBy(F.col("id").alias("key")).agg(F.min("text").alias("text"), F.min("theme").alias("theme"))
    new = pairs(spark, sf_dir).groupBy(F.col("source_id").alias("key")).agg(F.min("source").alias("text")).withColumn("theme", F.lit(None).cast("string"))
    return packets.carry_over(new, old, ["theme"], ["text"]).groupBy("theme").agg(F.count(F.lit(1)).alias("n"))


CARRY_SQL = f"""WITH {PAIRS}, o AS (SELECT id AS key, min(text) AS text, min(theme) AS theme FROM pilot_staged GROUP BY 1), n AS (SELECT source_id AS key, min(source) AS text FROM pairs GROUP BY 1)
SELECT CASE WHEN n.text IS NOT DISTINCT FROM o.text THEN o.theme END AS theme, count(*) AS n FROM n LEFT JOIN o ON n.key = o.key GROUP BY 1"""


def overlaid_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Adjudicated texts over sent ones; a key among the adjudicated has its text there."""
    sent = packet_entries(spark, sf_dir).groupBy("key").agg(F.min("target").alias("value"))
    new = pairs(spark, sf_dir).groupBy("key").agg(F.min("target").alias("value"))
    return packets.overlay(sent, new)


OVERLAY_SQL = f"""WITH {PAIRS}, {ENTRIES}, s AS (SELECT key, min(target) AS value FROM entries GROUP BY 1), n AS (SELECT key, min(target) AS value FROM pairs GROUP BY 1)
SELECT coalesce(s.key, n.key) AS key, CASE WHEN n.key IS NOT NULL THEN n.value ELSE s.value END AS value FROM s FULL JOIN n ON s.key = n.key"""


def lost_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that adjudication knows and the staged records no longer have."""
    return corpus.lost_jobs(quotes(spark, sf_dir), pairs(spark, sf_dir).select(F.col("source_id").alias("id")), "id")


LOST_SQL = f"WITH {PAIRS} SELECT DISTINCT source_id AS id FROM pairs WHERE source_id NOT IN (SELECT id FROM pilot_staged)"


def token_parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lexmill.plans.views import imports

    return corpus.token_parity(imports(spark, sf_dir)).distinct()


PARITY_SQL = """SELECT DISTINCT id AS key FROM pilot_staged WHERE imported.text IS NOT NULL AND length(imported.text) - length(replace(imported.text, '{userName}', '')) <> length(text) - length(replace(text, '{userName}', ''))"""


def export_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that would be appended for passed entries if no text collides within its category and language."""
    p = durable(pairs(spark, sf_dir).where("verdict = 'pass'"), "passed")
    jobs = p.groupBy("source_id", "locale").agg(F.min("category").alias("category"), F.min("target").alias("text")).withColumnRenamed("source_id", "group_id").withColumn("source_id", F.col("group_id"))
    clash = corpus.collisions(jobs.select("category", "locale", "group_id", "text", F.lit(True).alias("is_new")))
    return corpus.export_rows(jobs, clash)


def queries() -> dict:
    return {f.__name__: f for f in (
        record_issues, lineage_components, lineage_cycles, lineage_groups, missing_locales, content_kinds, target_collisions, identity_errors, export_blockers, scoped_contexts, review_state, job_summary, id_coverage, finding_errors, envelope_errors,
        open_item_errors, canonical_ranges, markdown_sections, repeated_lines, honesty_claims, carried_fields, overlaid_values, lost_records, token_parity, export_gate,
    )}


def oracle_sql() -> dict[str, str]:
    return {
        "record_issues": ISSUES_SQL, "lineage_components": f"WITH RECURSIVE {_REACH} SELECT id, root FROM roots", "lineage_cycles": CYCLES_SQL, "lineage_groups": GROUPS_SQL, "missing_locales": MISSING_SQL, "content_kinds": KIND_SQL,
        "target_collisions": COLLISION_SQL, "identity_errors": IDENTITY_ERROR_SQL, "export_blockers": EXPORT_BLOCKER_SQL, "scoped_contexts": SCOPE_SQL, "review_state": REVIEW_SQL, "job_summary": JOBS_SQL, "id_coverage": COVERAGE_SQL, "finding_errors": FINDING_SQL, "envelope_errors": ENVELOPE_SQL,
        "open_item_errors": OPEN_SQL, "canonical_ranges": RANGE_SQL, "markdown_sections": SECTION_SQL, "repeated_lines": REPEATED_SQL, "carried_fields": CARRY_SQL, "overlaid_values": OVERLAY_SQL, "lost_records": LOST_SQL, "token_parity": PARITY_SQL,
    }
