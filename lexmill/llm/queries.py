"""The registered queries of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.components import consolidate, staged_links
from lexmill.llm.covering import record_texts, similar_groups, similar_pairs
from lexmill.llm.encoding import encode_corpus
from lexmill.llm.language import detect, fit, labelled_sample, labelled_texts, wrong_labels
from lexmill.llm.lookalike import canonicalize, review_values
from lexmill.llm.mixing import mix
from lexmill.llm.names import attributed, link_names, linked_records
from lexmill.llm.pii import find, redact
from lexmill.session import durable, table


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_corpus(table(spark, sf_dir, "documents"))


def p1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of every record and of every segment of a mixed one."""
    docs = labelled_texts(table(spark, sf_dir, "pilot_staged"), table(spark, sf_dir, "adjudication_entries"))
    return detect(docs, fit(labelled_sample(docs)))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wrong_labels(p1_segments(spark, sf_dir)).select("tab", "rec_key", "seg_no", "lang").distinct()


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged = table(spark, sf_dir, "pilot_staged")
    return consolidate(staged, staged_links(staged, table(spark, sf_dir, "adjudication_entries")))


#: The same groups by a transitive closure.
P3_SQL = r"""
WITH RECURSIVE own AS (
  SELECT id AS a, category, lower(trim(pair_id)) AS p FROM pilot_staged
  UNION
  SELECT source.id, source.category, lower(trim(source.pair_id)) FROM adjudication_entries
  WHERE source.id IN (SELECT id FROM pilot_staged)
), hubs AS (
  SELECT a, category || '|' || p AS h FROM own WHERE regexp_full_match(p, '[\p{L}_]+-[0-9]+')
), firsts AS (
  SELECT a, min(a) OVER (PARTITION BY h) AS b FROM hubs
), links AS (
  SELECT a, b FROM firsts WHERE a <> b
  UNION
  SELECT id, curation.previous_duplicate_of FROM pilot_staged
  WHERE curation.previous_duplicate_of IN (SELECT id FROM pilot_staged) AND id <> curation.previous_duplicate_of
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT a AS id, a AS r FROM both_ways
  UNION
  SELECT l.b, reach.r FROM reach JOIN both_ways l ON l.a = reach.id
)
SELECT min(r) AS group_id, id FROM reach GROUP BY id
"""


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_pairs(record_texts(table(spark, sf_dir, "pilot_staged")))


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(record_texts(table(spark, sf_dir, "pilot_staged")))


#: The same pairs by the rarest words of each set, of which two similar sets share one.
P4_SQL = r"""
WITH texts AS (
  SELECT id, text FROM pilot_staged WHERE text IS NOT NULL
  UNION
  SELECT id, imported.text FROM pilot_staged WHERE imported.text IS NOT NULL
), w AS (
  SELECT DISTINCT id, list_sort(list_distinct(regexp_extract_all(lower(replace(text, 'İ', 'I' || chr(775))), '[\p{L}\p{N}]+'))) AS ws FROM texts
), s AS (
  SELECT ws, row_number() OVER () AS sid FROM (SELECT DISTINCT ws FROM w WHERE len(ws) > 0)
), u AS (
  SELECT sid, len(ws) AS n, unnest(ws) AS word FROM s
), df AS (
  SELECT word, count(*) AS d FROM u GROUP BY word
), r AS (
  SELECT sid, n, word, row_number() OVER (PARTITION BY sid ORDER BY d, word) AS k FROM u JOIN df USING (word)
), p AS (
  SELECT sid, n, word FROM r WHERE k <= n - ceil(0.8 * n) + 1
), c AS (
  SELECT DISTINCT a.sid AS x, b.sid AS y FROM p a JOIN p b ON a.word = b.word AND a.sid < b.sid AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)
), m AS (
  SELECT x, y FROM c JOIN s a ON a.sid = x JOIN s b ON b.sid = y
  WHERE 9 * len(list_intersect(a.ws, b.ws)) >= 4 * (len(a.ws) + len(b.ws))
  UNION ALL SELECT sid, sid FROM s
), o AS (
  SELECT id, sid FROM w JOIN s USING (ws)
)
SELECT DISTINCT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b FROM m JOIN o a ON a.sid = x JOIN o b ON b.sid = y WHERE a.id <> b.id
"""


def p5_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every value with its one form."""
    values = review_values(*(table(spark, sf_dir, t) for t in ("editor_packets", "fidelity_reviews", "glossary_open")))
    return canonicalize(values, "value", "locale")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p5_forms(spark, sf_dir).where("value != canonical").select("tab", "rec_key").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = durable(attributed(table(spark, sf_dir, "pilot_staged"), table(spark, sf_dir, "adjudication_entries")), "names")
    roster = table(spark, sf_dir, "person_roster")
    return linked_records(records, link_names(records, roster), roster)


def p6_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each distinct name that means a roster entry, with its similarities."""
    records = attributed(table(spark, sf_dir, "pilot_staged"), table(spark, sf_dir, "adjudication_entries"))
    return link_names(records, table(spark, sf_dir, "person_roster")).select("name", "person_id", F.round("cosine", 6).alias("cosine"), F.round("linkage", 6).alias("linkage"))


def p8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen documents with their repeats, in random order."""
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[0]


def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))[1]


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents")).select("doc_id", "kind", "span").distinct()


def p9_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return redact(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_segments": p1_segments, "p3_found": p3_found, "p4_found": p4_found, "p4_groups": p4_groups, "p5_found": p5_found, "p5_forms": p5_forms, "p6_found": p6_found, "p6_names": p6_names, "p7_ids": p7_ids, "p8_mix": p8_mix, "p8_shares": p8_shares, "p9_found": p9_found, "p9_redacted": p9_redacted}


def oracle_sql() -> dict[str, str]:
    return {"p3_found": P3_SQL, "p4_found": P4_SQL}
