"""Reference data: verses of OSIS documents, glossaries, quote corpora, paths quoted in Markdown."""

from __future__ import annotations

import itertools
import re
import unicodedata
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Elements whose text is not the verse's own, and the form of a verse id.
SKIPPED = ("note", "title", "reference")
VERSE_ID = re.compile(r"^([1-3]?[A-Za-z]+)\.([1-9]\d*)\.([1-9]\d*)$")


def _own_text(node: ET.Element) -> str:
    parts = [node.text or ""]
    for child in node:
        if child.tag.rpartition("}")[2] not in SKIPPED:
            parts.append(_own_text(child))
        parts.append(child.tail or "")
    return "".join(parts)


def normal_text(text: str) -> str:
    return " ".join(unicodedata.normalize("NFC", text).split())


def osis_verses(content: bytes) -> list[tuple[str, int, int, str]]:
    """(book, chapter, verse, text); raises for ids that are missing, ambiguous, double or without text."""
    out: dict[str, tuple[str, int, int, str]] = {}
    for node in ET.fromstring(content).iter():
        if node.tag.rpartition("}")[2] != "verse":
            continue
        ids = (node.get("osisID") or "").split()
        if len(ids) != 1 or (m := VERSE_ID.match(ids[0])) is None:
            raise ValueError(f"verse id {ids}")
        text = normal_text(_own_text(node))
        if ids[0] in out or not text:
            raise ValueError(f"verse {ids[0]} is double or empty")
        out[ids[0]] = (m[1], int(m[2]), int(m[3]), text)
    return list(out.values())


def read_osis(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """``path sha256 book chapter verse text``."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p, h, *v) for p, h, c in zip(pdf["path"], pdf["sha256"], pdf["content"]) for v in osis_verses(bytes(c))]
            yield pd.DataFrame(rows, columns=["path", "sha256", "book", "chapter", "verse", "text"])

    files = spark.read.format("binaryFile").load(paths)
    return files.select("path", F.sha2("content", 256).alias("sha256"), "content").mapInPandas(run, "path string, sha256 string, book string, chapter int, verse int, text string")


QUOTE = "id string, category string, text string, language string, verification string, theme string, pairId string, translationOf string, translatedFrom string, context string"


def read_quotes(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Quotes of corpus files: typed fields, ``has_language`` (an explicit null is not an absent field) and the whole record as ``raw``."""
    files = spark.read.option("wholetext", True).text(paths)
    raw = files.select(F.explode(F.from_json(F.get_json_object("value", "$.quotes"), "array<string>")).alias("raw"))
    fields = F.from_json("raw", QUOTE)
    status = F.coalesce(F.get_json_object("raw", "$.verification.status"), F.get_json_object("raw", "$.verification"))
    present = F.array_contains(F.json_object_keys("raw"), "language")
    more = [F.get_json_object("raw", p).alias(n) for p, n in (("$.source.canonicalReference", "canonical_reference"), ("$.source.verifiedBy", "verified_by"), ("$.attribution.name", "attribution_name"))]
    return raw.withColumn("f", fields).select("f.*", present.alias("has_language"), *more, status.alias("status"), "raw").drop("verification")


def read_glossary(spark: SparkSession, paths: str | list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(terms, controls, open items) of glossary files."""
    term = T.StructType([T.StructField("preferred", T.StringType()), T.StructField("forms", T.ArrayType(T.StringType())), T.StructField("forbidden", T.ArrayType(T.StringType())), T.StructField("decided_by", T.StringType()), T.StructField("note", T.StringType())])
    control = T.StructType([T.StructField("preferred", T.StringType()), T.StructField("roles", T.MapType(T.StringType(), T.StringType()))])
    item = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "recommended", "recommended_reason", "decided_by", "status", "note")] + [T.StructField("options", T.ArrayType(T.StringType()))])
    schema = T.StructType([T.StructField("locale", T.StringType()), T.StructField("terms", T.MapType(T.StringType(), term)), T.StructField("controls", T.MapType(T.StringType(), control)), T.StructField("open", T.ArrayType(item))])
    files = spark.read.schema(schema).option("multiLine", True).json(paths)
    return (
        files.select("locale", F.explode("terms").alias("term_id", "t")).select("locale", "term_id", "t.*"),
        files.select("locale", F.explode("controls").alias("label", "c")).select("locale", "label", "c.*"),
        files.select("locale", F.explode("open").alias("o")).select("locale", "o.*"),
    )


def expand_braces(path: str) -> list[str]:
    """``a/{b,c}.md`` as its paths, also nested."""
    m = re.search(r"\{([^{}]*)\}", path)
    if not m:
        return [path]
    return list(itertools.chain.from_iterable(expand_braces(path[: m.start()] + x + path[m.end() :]) for x in m[1].split(",")))


def quoted_paths(lines: DataFrame) -> DataFrame:
    """``path line quoted``: paths in backticks of Markdown lines, braces expanded, line suffixes dropped."""
    expand = F.udf(expand_braces, "array<string>")  # rows are few: one per quoted path
    found = F.explode(F.regexp_extract_all("text", F.lit(r"`([\w.{},/\-]+/[\w.{},/\-]*(?::\d+)?)`"), F.lit(1)))
    quoted = lines.select("path", "line", found.alias("q")).withColumn("q", F.regexp_replace("q", r":\d+$", ""))
    plain = quoted.where("q not like '%{%'").select("path", "line", F.col("q").alias("quoted"))
    return plain.union(quoted.where("q like '%{%'").select("path", "line", F.explode(expand("q"))))


def missing_paths(quoted: DataFrame, present: DataFrame) -> DataFrame:
    return quoted.join(present.select(F.col("path").alias("quoted")).distinct(), "quoted", "left_anti").select("path", "line", "quoted")
