"""String catalogs: one row per unit, in catalog order, and the writer that keeps their exact form."""

from __future__ import annotations

import json
import os
import tempfile
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

UNIT_SCHEMA = "path string, key string, pos long, comment string, extraction_state string, locale string, unit_path string, variation string, state string, value string"


def _units(localization: dict, path: str = "") -> Iterator[tuple[str, dict]]:
    """(path, unit) of a localization, through variations and substitutions of any depth."""
    if "stringUnit" in localization:
        yield path, localization["stringUnit"] or {}
    for kind, cases in (localization.get("variations") or {}).items():
        for case, inner in cases.items():
            yield from _units(inner, f"{path}/{kind}:{case}" if path else f"{kind}:{case}")
    for name, inner in (localization.get("substitutions") or {}).items():
        yield from _units(inner, f"{path}/substitution:{name}" if path else f"substitution:{name}")


def _numbered(value: str, substitutions: dict) -> str:
    """``%#@name@`` as the numbered placeholder its substitution declares."""
    for name, s in substitutions.items():
        if s.get("argNum"):
            value = value.replace(f"%#@{name}@", f"%{s['argNum']}${s.get('formatSpecifier', '@')}")
    return value


def catalog_rows(path: str, text: str) -> Iterator[tuple]:
    data = json.loads(text)
    for pos, (key, entry) in enumerate((data.get("strings") or {}).items()):
        head = (path, key, pos, entry.get("comment"), entry.get("extractionState"))
        localizations = entry.get("localizations") or {}
        if not localizations:
            yield (*head, None, None, None, None, None)
        for locale, loc in localizations.items():
            subs = loc.get("substitutions") or {}
            for unit_path, unit in _units(loc):
                inner = "substitution:" in unit_path
                value = unit.get("value")
                yield (*head, locale, unit_path, None if inner else unit_path, unit.get("state"), _numbered(value, subs) if value is not None and not inner else value)


def read_units(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Units of catalogs: ``path key pos comment extraction_state locale unit_path variation state value``.

    ``variation`` is null for units inside of substitutions, which checks of
    whole texts leave out; keys without a localization keep one row of nulls.
    """

    def run(rows):  # noqa: ANN001, ANN202
        for pdf in rows:
            out = [r for p, c in zip(pdf["path"], pdf["content"]) for r in catalog_rows(p, bytes(c).decode("utf-8"))]
            import pandas as pd

            yield pd.DataFrame(out, columns=[x.split(" ")[0] for x in UNIT_SCHEMA.split(", ")])

    return spark.read.format("binaryFile").load(paths).select("path", "content").mapInPandas(run, UNIT_SCHEMA)


def packet_rows(units: DataFrame, locale: str, source_locale: str = "en") -> DataFrame:
    """One row per key: ``key pos kind source target state placeholders``; plural texts joined by category."""
    plain = units.where("variation is not null and locale is not null")
    text = lambda loc: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("locale") == loc, F.struct("variation", "value")))), lambda x: x["value"]), " | ")
    from lexmill.functions.text import PRINTF

    tokens = F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.regexp_extract_all("value", F.lit(PRINTF), F.lit(0))))))
    kind = F.when(F.max(F.col("variation").startswith("plural:").cast("int")) == 1, "plural").otherwise("flat")
    states = F.array_distinct(F.collect_list(F.when(F.col("locale") == locale, F.col("state"))))
    state = F.when(F.size(states) == 0, "missing").when(F.size(states) == 1, F.element_at(states, 1)).otherwise("mixed")
    return plain.groupBy("key", "pos").agg(kind.alias("kind"), text(source_locale).alias("source"), text(locale).alias("target"), state.alias("state"), tokens.alias("placeholders"))


def opaque_ids(rows: DataFrame, text: str = "target") -> DataFrame:
    """``opaque_id key <text>``: dense ids sNNN in catalog order for rows with a text; numbered without one task for all rows."""
    return numbered(rows.where(F.length(text) > 0), ["pos", "key"]).select(F.concat(F.lit("s"), F.lpad(F.col("n").cast("string"), 3, "0")).alias("opaque_id"), "key", text)


def numbered(rows: DataFrame, order: list[str], out: str = "n") -> DataFrame:
    """``rows`` with 1, 2, ... in the order of ``order``: ranges are sorted apart and begin after the rows of the ranges before."""
    from lexmill.session import durable

    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    kept = durable(sorted_, "numbered")
    part = F.shiftright("_id", 33)
    sizes = {r[0]: r[1] for r in kept.groupBy(part.alias("p")).agg(F.count(F.lit(1)).alias("c")).collect()}  # one row per task
    starts, at = [], 0
    for p in sorted(sizes):
        starts += [F.lit(p), F.lit(at)]
        at += sizes[p]
    base = F.create_map(*starts)[part] if starts else F.lit(0)
    return kept.withColumn(out, (base + F.col("_id").bitwiseAND((1 << 33) - 1) + 1).cast("long")).drop("_id")


def subset_catalog(data: dict, keys: Iterable[str], locales: Iterable[str] | None = None) -> dict:
    """A catalog of the chosen keys, in its own order, optionally with the chosen locales only."""
    wanted, kept = set(keys), None if locales is None else set(locales)
    strings = {}
    for key, entry in (data.get("strings") or {}).items():
        if key in wanted:
            entry = dict(entry)
            if kept is not None and "localizations" in entry:
                entry["localizations"] = {k: v for k, v in entry["localizations"].items() if k in kept}
            strings[key] = entry
    return {**data, "strings": strings}


def dump_catalog(data: dict, final_newline: bool = False) -> str:
    """The catalog editor's own form: two blanks, `` : `` between name and value, empty objects over three lines."""

    def write(x: object, depth: int) -> str:
        pad = "  " * (depth + 1)
        if isinstance(x, dict):
            if not x:
                return "{\n\n" + "  " * depth + "}"
            inner = ",\n".join(f"{pad}{json.dumps(k, ensure_ascii=False)} : {write(v, depth + 1)}" for k, v in x.items())
            return "{\n" + inner + "\n" + "  " * depth + "}"
        if isinstance(x, list):
            if not x:
                return "[\n\n" + "  " * depth + "]"
            return "[\n" + ",\n".join(pad + write(v, depth + 1) for v in x) + "\n" + "  " * depth + "]"
        return json.dumps(x, ensure_ascii=False)

    return write(data, 0) + ("\n" if final_newline else "")


def write_atomic(path: str, text: str) -> None:
    """All of ``text`` or nothing: a temporary file beside the target, synced, then renamed."""
    folder = os.path.dirname(os.path.abspath(path))
    with tempfile.NamedTemporaryFile("w", encoding="utf-8", dir=folder, delete=False) as f:
        f.write(text)
        f.flush()
        os.fsync(f.fileno())
    os.replace(f.name, path)


def guard_output(path: str, inputs: Iterable[str]) -> None:
    """Refuses to write over an input."""
    if os.path.realpath(path) in {os.path.realpath(p) for p in inputs}:
        raise ValueError(f"{path} is an input")


def read_keys_file(path: str) -> list[str]:
    """Keys of a JSON list, of ``{"keys": [...]}``, or one per line with # comments."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if text.lstrip()[:1] in ("[", "{"):
        data = json.loads(text)
        return list(data["keys"] if isinstance(data, dict) else data)
    return [s for line in text.splitlines() if (s := line.split("#")[0].strip())]


def select_keys(entries: DataFrame, keys: list[str] | None = None, prefix: str | None = None) -> tuple[DataFrame, list[str]]:
    """(entries of the keys or under the prefix, the given keys that are unknown)."""
    if keys is not None:
        asked = entries.sparkSession.createDataFrame([(k,) for k in keys], "key string").distinct()
        unknown = [r.key for r in asked.join(entries, "key", "left_anti").orderBy("key").collect()]
        return entries.join(F.broadcast(asked), "key", "left_semi"), unknown
    return (entries.where(F.col("key").startswith(prefix)) if prefix else entries), []


# Fields of a literal block by locale.
SHIELD_FIELD = {"en": "English", "ro": "Romanian", "he": "Hebrew"}


def shield_units(files: DataFrame, locales: Iterable[str] = ("en", "ro", "he")) -> DataFrame:
    """Units of literal blocks in source text (``path text``): ``shield.<id>.title`` and ``.body`` per locale, always translated."""
    block = F.explode(F.expr(r"slice(split(text, '\\.init\\('), 2, 1000000)"))
    quoted = r':\s*"((?:[^"\\]|\\.)*)"'
    field = lambda name: F.regexp_replace(F.regexp_extract("block", rf"\b{name}" + quoted, 1), r"\\(.)", "$1")
    blocks = files.select("path", block.alias("block")).withColumn("id", field("id")).where("id != ''")
    style = F.regexp_extract("block", r"\bstyle:\s*\.(\w+)", 1)
    cells = F.explode(F.array(*[F.struct(F.lit(loc).alias("locale"), F.lit(part).alias("part"), field(part + SHIELD_FIELD[loc]).alias("value")) for loc in locales for part in ("title", "body")]))
    rows = blocks.select("path", "id", style.alias("style"), cells.alias("c")).where("c.value != ''")
    return rows.select(F.concat(F.lit("shield."), "id", F.lit("."), "c.part").alias("key"), "c.locale", F.lit("").alias("variation"), F.lit("translated").alias("state"), "c.value", "style")


def expand_shield_ids(keys: DataFrame, known: DataFrame) -> DataFrame:
    """``shield.<id>`` as its title and body, unless it is a key itself."""
    plain = keys.join(known.select("key").distinct(), "key", "left_semi")
    rest = keys.join(known.select("key").distinct(), "key", "left_anti")
    parts = F.when(F.col("key").startswith("shield."), F.array(F.concat("key", F.lit(".title")), F.concat("key", F.lit(".body")))).otherwise(F.array("key"))
    return plain.select("key").union(rest.select(F.explode(parts)))


def latest_verdicts(spark: SparkSession, root: str) -> DataFrame:
    """``key verdict source_hash evidence modified``: of verdict files anywhere below ``root`` the newest word on each key; broken files are skipped."""
    entry = T.StructType([T.StructField("verdict", T.StringType()), T.StructField("source_hash", T.StringType()), T.StructField("evidence", T.ArrayType(T.StringType()))])
    schema = T.StructType([T.StructField("keys", T.MapType(T.StringType(), entry))])
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "verdict.json").option("wholetext", True).text(root)
    rows = files.select("_metadata.file_path", F.col("_metadata.file_modification_time").alias("modified"), F.from_json("value", schema).alias("j"))
    each = rows.select("file_path", "modified", F.explode("j.keys").alias("key", "e"))
    best = each.groupBy("key").agg(F.max_by("e", F.struct("modified", "file_path")).alias("e"), F.max("modified").alias("modified"))
    return best.select("key", "e.verdict", "e.source_hash", "e.evidence", "modified")


def source_lines(spark: SparkSession, root: str, pattern: str = "*.swift") -> DataFrame:
    """``path line text`` of source files below ``root``."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).option("wholetext", True).text(root)
    return files.select("_metadata.file_path", F.posexplode(F.split("value", r"\r\n|\n|\r"))).select(F.col("file_path").alias("path"), (F.col("pos") + 1).alias("line"), F.col("col").alias("text"))
