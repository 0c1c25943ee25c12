"""Schemas that drift between the files of a series.

Each file is loaded as a list of (path, raw type, values by term or item). Its
statistics are compared with those of the file before it in the series, which
gives the changes; renames found on the way lead every field to one name, under
which all files are projected to typed columns, with a report of failed casts.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import durable

class Shape(NamedTuple):
    """Where the records of a file are: heads whose values are maps of records, heads that are lists of records (with the field that names one), and objects of list records whose own fields are followed, under this name and every one it is renamed to."""

    maps: tuple[str, ...] = ("terms",)
    lists: tuple[tuple[str, str], ...] = (("open", "id"),)
    nested: str = "open.role_forms"

    @property
    def levels(self) -> tuple[str, ...]:
        return (*self.maps, *(k for k, _ in self.lists))


#: The shape of glossary files; other files take another one.
GLOSSARY = Shape()

#: Per path: its type, its nulls, and the terms or items that have it with the hashes of their values, eight bytes each.
PROFILE = "array<struct<path:string,type:string,nulls:int,items:binary,hashes:binary>>"
CHANGES = "file_no long, field_path string, change string"


def raw_type(value: object) -> str | None:
    """The type of a JSON value, None for null."""
    if value is None:
        return None
    for kind, name in ((bool, "boolean"), (int, "integer"), (float, "double"), (str, "string"), (list, "array"), (dict, "object")):
        if isinstance(value, kind):
            return name
    raise TypeError(type(value))


def _hash(text: str) -> bytes:
    return xxhash.xxh3_64_digest(text.encode("utf-8", "surrogatepass"))


def _value_hash(value: object) -> bytes:
    """Equal for equal values; strings and numbers, which most are, without writing JSON."""
    kind = type(value)
    if kind is str:
        return _hash('"' + value)
    return _hash(repr(value) if kind is int or value is None else _canonical(value))


def _values(p: dict) -> dict[bytes, bytes]:
    """Item -> value, both as hashes."""
    items, hashes = p["items"], p["hashes"]
    return {items[i : i + 8]: hashes[i : i + 8] for i in range(0, len(items), 8)}


def _canonical(value: object) -> str:
    return json.dumps(value, sort_keys=True, ensure_ascii=True)


def paths(body: object, nested: frozenset[str] | None = None, shape: Shape = GLOSSARY) -> Iterator[tuple[str, str, object]]:
    """(path, record, value) of every field of one parsed file; below objects of list records only those ``nested``, or all."""
    if not isinstance(body, dict):
        return
    for field, value in body.items():
        yield field, "", value
    named = [(head, k, x) for head in shape.maps if isinstance(body.get(head), dict) for k, x in body[head].items()]
    named += [(head, str(x.get(key)), x) for head, key in shape.lists if isinstance(body.get(head), list) for x in body[head] if isinstance(x, dict)]
    lists = {head for head, _ in shape.lists}
    for level, name, x in named:
        if isinstance(x, dict):
            for field, value in x.items():
                yield f"{level}.{field}", name, value
                if level in lists and isinstance(value, dict) and (nested is None or f"{level}.{field}" in nested):
                    for inner, v in value.items():
                        yield f"{level}.{field}.{inner}", name, v


def profile(body: str | None, shape: Shape = GLOSSARY) -> list[dict] | None:
    """Path-type statistics of one file, None for a body that is no JSON object."""
    try:
        parsed = json.loads(body) if body else None
    except ValueError:
        return None
    if not isinstance(parsed, dict):
        return None
    found: dict[str, dict[str, object]] = {}
    for path, item, value in paths(parsed, shape=shape):
        found.setdefault(path, {})[item] = value
    out = []
    names = {k: _hash(k) for values in found.values() for k in values}
    for path, values in sorted(found.items()):
        kinds = {k for v in values.values() if (k := raw_type(v))}
        if kinds == {"integer", "double"}:
            kinds = {"double"}
        out.append({
            "path": path, "type": "|".join(sorted(kinds)) or None, "nulls": sum(v is None for v in values.values()),
            "items": b"".join(names[k] for k in values), "hashes": b"".join(map(_value_hash, values.values())),
        })
    return out


def compare(old: list[dict], new: list[dict]) -> list[tuple[str, str, str | None]]:
    """(path, change, former path) between two profiles.

    A rename needs equal values in every term or item both files have, and at
    least one; among several candidates the first by name is taken. Fields
    below a reported one are left out.
    """
    a, b = ({p["path"]: p for p in x} for x in (old, new))
    level = lambda path: path.rpartition(".")[0]

    def shared(top: str) -> set[bytes]:
        """The terms or items of both files; a head field has the one of no name."""
        if not top:
            return {_hash("")}
        return set.intersection(*({i for p in x.values() if p["path"].startswith(top + ".") for i in _values(p)} for x in (a, b)))

    both: dict[str, set[bytes]] = {}
    changes: list[tuple[str, str, str | None]] = []
    closed: set[str] = set()

    def below(path: str) -> bool:
        parts = path.split(".")
        return any(".".join(parts[:i]) in closed for i in range(1, len(parts)))

    for depth in range(max((p.count(".") for p in (*a, *b)), default=-1) + 1):
        gone = [p for p in sorted(a) if p not in b and p.count(".") == depth and not below(p)]
        come = [p for p in sorted(b) if p not in a and p.count(".") == depth and not below(p)]
        for old_path in list(gone):
            rivals = [path for path in come if level(path) == level(old_path)]
            if not rivals:
                continue
            top = level(old_path).partition(".")[0]
            if top not in both:
                both[top] = shared(top)
            common = both[top]
            before = {i: h for i, h in _values(a[old_path]).items() if i in common}
            for path in rivals:
                if before and before == {i: h for i, h in _values(b[path]).items() if i in common}:
                    changes.append((path, "renamed", old_path))
                    closed |= {path, old_path}
                    gone.remove(old_path)
                    come.remove(path)
                    break
        changes += [(p, "removed", None) for p in gone] + [(p, "added", None) for p in come]
        closed |= {*gone, *come}
        for p in sorted(a):
            if p in b and p.count(".") == depth and not below(p) and (x := a[p]["type"]) and (y := b[p]["type"]) and x != y:
                changes.append((p, "type_changed", None))
                closed.add(p)
    return changes


def file_profiles(files: DataFrame, shape: Shape = GLOSSARY) -> DataFrame:
    """One row per distinct file: ``file_no app_no locale rev received_at profile`` (null profile: no JSON object)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                made = [profile(x, shape) for x in part.column(5).to_pylist()]
                kind = kind or pa.list_(pa.struct([("path", pa.string()), ("type", pa.string()), ("nulls", pa.int32()), ("items", pa.binary()), ("hashes", pa.binary())]))
                yield pa.RecordBatch.from_arrays([*part.columns[:5], pa.array(made, kind)], [*SLIM, "profile"])

    kinds = {f.name: f.dataType.simpleString() for f in files.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in SLIM) + f", profile {PROFILE}"
    return files.select(*SLIM, F.col("body").cast("string").alias("body")).mapInArrow(run, schema)


SLIM = ("file_no", "app_no", "locale", "rev", "received_at")


def predecessors(files: DataFrame) -> DataFrame:
    """``file_no before``: of each file, the file of the next lower revision present in its series.

    Only these narrow rows are sorted by series, never the bodies. Of several
    files with that revision the last received counts. Null revisions have no place in the order.
    """
    slim = files.select(*SLIM).where("file_no is not null and rev is not null").dropDuplicates(["file_no"])
    series = Window.partitionBy("app_no", "locale").orderBy("rev")
    last = slim.groupBy("app_no", "locale", "rev").agg(F.max(F.struct("received_at", "file_no")).alias("last"))
    last = last.select("app_no", "locale", "rev", F.lag("last.file_no").over(series).alias("before"))
    same = slim["app_no"].eqNullSafe(last["app_no"]) & slim["locale"].eqNullSafe(last["locale"]) & (slim["rev"] == last["rev"])
    return slim.join(last, same).select("file_no", "before").where("before is not null")


def field_changes(files: DataFrame, shape: Shape = GLOSSARY) -> DataFrame:
    """``file_no field_path change former_path``: each change of a file against the one before it.

    ``files`` has ``file_no app_no locale rev received_at body``. Files sent
    again count once; a null or broken body has no fields to compare and takes
    no part as a predecessor either way (it yields no rows); an empty table
    gives an empty result; other columns are ignored.
    """
    every = durable(all_changes(files, shape), "changes")
    parent = F.substring_index("field_path", ".", 2)
    below = F.size(F.split("field_path", r"\.")) > 2
    return every.where(~below | parent.isin(sorted(nested_names(every, shape))))


def nested_names(changes: DataFrame, shape: Shape = GLOSSARY) -> frozenset[str]:
    """The names of the followed object: its own and what renames link it with, directly or through others; field names bound their number."""
    level = shape.nested.partition(".")[0]
    renames = changes.where((F.col("change") == "renamed") & F.col("field_path").startswith(level + ".")).where(F.size(F.split("field_path", r"\.")) == 2)
    pairs = [(r.former_path, r.field_path) for r in renames.select("former_path", "field_path").distinct().collect()]
    names = {shape.nested}
    while more := {x for p in pairs if names & set(p) for x in p} - names:
        names |= more
    return frozenset(names)


def all_changes(files: DataFrame, shape: Shape = GLOSSARY) -> DataFrame:
    """:func:`field_changes` with the fields below every object of open items."""
    # a file sent again is parsed again, but only its profile is shuffled
    profiles = durable(file_profiles(files, shape).dropDuplicates(["file_no"]), "profiles")
    good = profiles.where("profile is not null")
    pairs = predecessors(good)
    new = good.select("file_no", F.col("profile").alias("new"))
    old = good.select(F.col("file_no").alias("before"), F.col("profile").alias("old"))
    joined = pairs.join(new, "file_no").join(old, "before").select("file_no", "old", "new")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(n, *c) for n, old, new in zip(*(x.to_pylist() for x in batch.columns)) for c in compare(old, new)]
            columns = list(zip(*rows)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64())] + [pa.array(c, pa.string()) for c in columns[1:]], ["file_no", "field_path", "change", "former_path"])

    return joined.mapInArrow(run, CHANGES + ", former_path string")


def canonical_names(changes: DataFrame) -> dict[str, str]:
    """Field path -> the name all its spellings get; from the distinct renames, whose number the field names bound.

    Of a chain of renames the name seen first by order of the alphabet's
    smallest file stays; a path that is both old and new resolves to one end.
    """
    renames = changes.where("change = 'renamed'").groupBy("former_path", "field_path").agg(F.count(F.lit(1)).alias("n"))
    parent: dict[str, str] = {}

    def root(x: str) -> str:
        while parent.get(x, x) != x:
            x = parent[x]
        return x

    for r in sorted(renames.collect(), key=lambda r: (-r.n, r.former_path, r.field_path)):
        a, b = root(r.former_path), root(r.field_path)
        if a != b:
            parent[b] = a
    return {x: root(x) for x in parent if root(x) != x}


def long_values(files: DataFrame, nested: frozenset[str] | None = None, shape: Shape = GLOSSARY) -> DataFrame:
    """``file_no app_no locale rev level item path type value``: one row per file, term or item and field; values as JSON text, strings bare."""

    followed = frozenset({shape.nested}) if nested is None else nested

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file_no", "app_no", "locale", "rev", "item", "path", "type", "value"]
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                try:
                    parsed = json.loads(row.column(4)[0].as_py() or "null")
                except ValueError:
                    parsed = None
                cells = [(k, p, raw_type(v), v if isinstance(v, str) or v is None else _canonical(v)) for p, k, v in paths(parsed, followed, shape) if p not in shape.levels]
                n = len(cells)
                columns = list(zip(*cells)) or [[], [], [], []]
                head = [pa.concat_arrays([c] * n) if n else c.slice(0, 0) for c in row.columns[:4]]
                yield pa.RecordBatch.from_arrays(head + [pa.array(c, pa.string()) for c in columns], names)

    kinds = {f.name: f.dataType.simpleString() for f in files.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in SLIM[:4]) + ", item string, path string, type string, value string"
    return files.dropDuplicates(["file_no"]).select(*SLIM[:4], F.col("body").cast("string").alias("body")).mapInArrow(run, schema)


#: Type of a column by the raw type that most of a path's values have.
COLUMN_TYPES = {"integer": "bigint", "double": "double", "boolean": "boolean", "array": "array<string>"}


def inferred_types(rows: DataFrame, path: str) -> dict[str, str]:
    """Column type of each path from the raw types of its values (``path``, ``type``): that of most values, as text where none leads; field names bound the result.

    Whole numbers are doubles where some values are; on equal counts text wins.
    """
    counts = rows.where("type is not null").groupBy(path, "type").agg(F.count(F.lit(1)).alias("n")).collect()
    by: dict[str, dict[str, int]] = {}
    for r in counts:
        by.setdefault(r[0], {})[r[1]] = r[2]
    out = {}
    for name, kinds in by.items():
        if "double" in kinds:
            kinds["double"] += kinds.pop("integer", 0)
        best = max(kinds, key=lambda k: (kinds[k], k == "string", k))
        out[name] = COLUMN_TYPES.get(best, "string")
    return out


def _typed(value: Column, kind: str) -> Column:
    """``value`` (text) as ``kind``, null where that fails."""
    if kind.startswith("array"):
        return F.when(value.startswith("["), F.from_json(value, kind)).otherwise(F.when(value.isNotNull(), F.array(value)))
    return value.try_cast(kind) if kind != "string" else value


def consistent_values(files: DataFrame, names: dict[str, str], types: dict[str, str] | None = None, shape: Shape = GLOSSARY) -> DataFrame:
    """:func:`long_values` under canonical names with ``as_type``, ``cast_ok``: the typed projection in long form, from which tables are pivoted.

    Types that are not given are inferred from the path-type statistics of all files.
    """
    mapping = F.create_map(*[F.lit(x) for pair in sorted(names.items()) for x in pair]) if names else None
    path = F.col("path")
    if mapping is not None:
        # the object's own name first, then the field's name below it
        parent = F.substring_index("path", ".", 2)
        path = F.when(F.size(F.split("path", r"\.")) > 2, F.concat(F.coalesce(mapping[parent], parent), F.lit("."), F.substring_index("path", ".", -1))).otherwise(path)
        path = F.coalesce(mapping[path], path)
    nested = frozenset({shape.nested, *(x for x, y in names.items() if y == names.get(shape.nested, shape.nested))})
    rows = long_values(files, nested, shape).withColumn("field_path", path).drop("path")
    if types is None:
        rows = durable(rows, "values")
        types = inferred_types(rows, "field_path")
    kinds = F.create_map(*[F.lit(x) for pair in sorted(types.items()) for x in pair]) if types else None
    rows = rows.withColumn("as_type", F.coalesce(kinds[F.col("field_path")], F.lit("string")) if kinds is not None else F.lit("string"))
    ok = F.when(F.col("value").isNull(), True)
    for kind in sorted(set(types.values()) - {"string"}):
        ok = ok.when(F.col("as_type") == kind, _typed(F.col("value"), kind).isNotNull())
    return rows.withColumn("cast_ok", ok.otherwise(True))


def consistent_table(files: DataFrame, level: str, names: dict[str, str], columns: list[str], types: dict[str, str] | None = None, shape: Shape = GLOSSARY) -> DataFrame:
    """One row per file and term or item of ``level``, with typed ``columns``, ``other`` (fields without a column) and ``failed`` (fields whose cast failed)."""
    every = consistent_values(files, names, types, shape)
    if types is None:
        types = {r.field_path: r.as_type for r in every.select("field_path", "as_type").distinct().collect()}  # field names bound it
    rows = every.where(F.col("field_path").startswith(level + "."))
    field = F.substring_index("field_path", ".", -1) if level.count(".") else F.regexp_replace("field_path", f"^{level}\\.", "")
    rows = rows.withColumn("field", field)
    one = lambda c: F.max(F.when(F.col("field") == c, F.col("value")))
    held = rows.groupBy("file_no", "app_no", "locale", "rev", "item").agg(
        *[one(c).alias(c) for c in columns],
        F.map_from_entries(F.sort_array(F.collect_set(F.when(~F.col("field").isin(columns) & F.col("value").isNotNull(), F.struct("field", "value"))))).alias("other"),
        F.sort_array(F.collect_set(F.when(~F.col("cast_ok"), F.col("field")))).alias("failed"),
    )
    return held.select("file_no", "app_no", "locale", "rev", "item", *[_typed(F.col(c), types.get(f"{level}.{c}", "string")).alias(c) for c in columns], "other", "failed")
