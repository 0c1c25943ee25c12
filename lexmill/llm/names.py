"""Variant spellings of names, linked to the entries of a roster.

Distinct names become weighted character n-gram vectors; a sparse top-n join
gives each its most similar roster spellings by cosine. Around every roster
spelling a group grows by average linkage (the mean of the cosines with all
members, which is the product with the group's mean vector), and a name belongs
to the group it is linked with best, if by the threshold or more. A check token
by token follows: one typo, initials, short forms, order, titles and remarks
explain a variant, anything else is another person.

Short forms of given names are learned: a token that stands beside the family
names of several bearers of one given name, and hardly beside others.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.skew import hot_keys, salted_join
from lexmill.session import durable

GRAM = 3
#: Roster spellings looked at for a name: the most similar ones at or above the threshold.
TOP_N = 25
THRESHOLD = 0.3
#: Average linkage with a group of a roster spelling from which a name belongs to it.
LINKAGE = 0.3
#: Bearers of a given name beside whose family names its short form must stand, or one if it begins alike; its share there, and how far that must be above the given name's own share of the families.
BEARERS, SHARE, LIFT = 2, 0.5, 2.0

#: Grams of a roster that every task holds; a larger one is joined by shuffling.
BROADCAST_ROWS = 200_000

# Words that go with a name but are not part of it.
TITLES = frozenset("dr prof professor phd md mr mrs ms miss sir dame lord lady st saint rev fr sr jr dipl ing mag doc esq the attributed to by from after via said quoted per as told in words of".split())
# Words of an organisation's name that may be left out.
FILLERS = frozenset("the for of and on de la le du des der die das und et y e 4 a an in".split())
# Letters that do not decompose into a plain one.
PLAIN = str.maketrans({"ł": "l", "Ł": "L", "ı": "i", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ß": "ss", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "þ": "th", "ð": "d"})


def fold(text: str) -> str:
    """Lower case without accents."""
    flat = unicodedata.normalize("NFKD", text.translate(PLAIN))
    return "".join(c for c in flat if not unicodedata.combining(c)).lower()


def bare(name: str) -> list[str]:
    """The name's tokens (folded) without titles, dates, remarks and punctuation; hyphens separate."""
    text = re.sub(r"\([^)]*\)|\[[^\]]*\]|\{[^}]*\}|[\"“”„«»]", " ", unicodedata.normalize("NFKC", name))
    text = re.split(r"\s[-–—]\s|[;|/]", text.strip())[0]
    return [t for t in re.findall(r"[^\W_]+(?:['’][^\W_]+)*", fold(text)) if t not in TITLES and not t.isdigit()]


# Legal forms written after an organisation's name.
_LEGAL = re.compile(r"(?i)\b(?:e\.\s?v\.?|ltd\.?|inc\.?|gmbh|llc|plc|s\.?a\.?|s\.?r\.?l\.?|n\.?v\.?|b\.?v\.?|corp\.?|co\.)(?=\W|$)")


def body_words(name: str) -> list[str]:
    """An organisation's telling words (folded); what stands in brackets counts."""
    tokens = re.findall(r"[^\W_]+", fold(_LEGAL.sub(" ", unicodedata.normalize("NFKC", name))))
    return [t for t in tokens if t not in FILLERS and t not in TITLES]


def one_edit(a: str, b: str) -> bool:
    """Whether one insertion, deletion, substitution or exchange of neighbours makes ``a`` into ``b``."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    i = 0
    while i < min(len(a), len(b)) and a[i] == b[i]:
        i += 1
    if len(a) == len(b):
        return a[i + 1 :] == b[i + 1 :] or (a[i : i + 2] == b[i : i + 2][::-1] and a[i + 2 :] == b[i + 2 :])
    return a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]


def explains(name: str, entry: str, kind: str, short: frozenset[str] = frozenset()) -> float | None:
    """How well the roster ``entry`` explains ``name``: 0 is best, None is not at all. ``short``: short forms of its given name."""
    return _organisation(name, entry) if kind == "organisation" else _person(bare(name), bare(entry), short)


def _person(have: list[str], want: list[str], short: frozenset[str]) -> float | None:
    if len(want) < 2 or not have:
        return None
    given, middle = want[0], [t for t in want[1:] if len(t) == 1]
    family = [t for t in want[1:] if len(t) > 1]
    left, cost = list(have), 0.0
    joined = "".join(family)
    if joined in left and len(family) > 1:
        left.remove(joined)
    else:
        missing = []
        for part in family:
            if part in left:
                left.remove(part)
            else:
                missing.append(part)
        if len(missing) == 1 and len(family) == 2 and not any(one_edit(t, missing[0]) for t in left):
            missing, cost = [], 0.5  # one half of a double name
        for part in missing:
            typo = next((t for t in left if len(part) > 3 and len(t) > 2 and one_edit(t, part)), None)
            if typo is None:
                return None
            left.remove(typo)
            cost += 1
    best = None
    for i, t in enumerate(left):
        if t == given:
            c, used = 0.0, ""
        elif t in short:
            c, used = 0.2, ""
        elif len(t) == 1 and t == given[0]:
            c, used = 0.4, ""
        elif len(t) == 2 and middle and t == given[0] + middle[0]:
            c, used = 0.3, middle[0]
        elif len(t) > 2 and len(given) > 3 and one_edit(t, given):
            c, used = 1.0, ""
        else:
            continue
        if best is None or c < best[0]:
            best = (c, i, used)
    if best is None:
        return None
    cost += best[0]
    rest = left[: best[1]] + left[best[1] + 1 :]
    initials = [t for t in rest if len(t) == 1]
    if [t for t in rest if len(t) > 1] or len(initials) > 1:
        return None
    if initials and middle and initials[0] != middle[0]:
        return None
    if not best[2] and bool(initials) != bool(middle):
        cost += 0.05
    return cost if cost < 2 else None


def _organisation(name: str, entry: str) -> float | None:
    want, have = body_words(entry), body_words(name)
    letters = re.sub(r"[^a-z]", "", fold(name))
    if len(want) > 2 and letters in ("".join(t[0] for t in want), "".join(t[0] for t in bare(entry))):
        return 0.3
    if not want or not have:
        return None
    left, cost = list(have), 0.0
    for part in want:
        if part in left:
            left.remove(part)
            continue
        hit = next((t for t in left if one_edit(t, part)), None)
        c = 1.0
        if hit is None:
            hit, c = next((t for t in left if len(t) > 2 and part.startswith(t)), None), 0.2
        if hit is None:
            return None
        left.remove(hit)
        cost += c
    return cost if not left and cost < 2 else None


def spellings(name: str, kind: str) -> list[str]:
    """The forms of a roster entry that the n-gram index holds."""
    tokens = bare(name)
    if kind == "organisation":
        want = body_words(name)
        return [" ".join(want), "".join(t[0] for t in want), "".join(t[0] for t in tokens)]
    family = [t for t in tokens[1:] if len(t) > 1]
    forms = [" ".join(tokens), " ".join([*tokens[:1], *family]), " ".join([*(t[0] for t in tokens[:1]), *family])]
    return forms + [f"{tokens[0]} {part}" for part in family if len(family) > 1]


def query_form(name: str) -> str:
    letters = re.findall(r"[^\W_]", fold(name))
    if 2 < len(letters) <= 8 and all(len(t) == 1 or t == name.lower() for t in re.findall(r"[^\W_]+", fold(name))):
        return "".join(letters)
    tokens = body_words(name) if "(" in name and not re.search(r"\(\W*\d", name) else [t for t in bare(name) if t not in FILLERS]
    return "".join(tokens) if tokens and all(len(t) == 1 for t in tokens) else " ".join(tokens)


def _forms(df: DataFrame, of_roster: bool) -> DataFrame:
    """``key form``: the forms of each name or roster entry."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            pairs = [(r["key"], f) for r in rows for f in (dict.fromkeys(spellings(r["name"], r["kind"])) if of_roster else [query_form(r["name"])]) if f]
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.string()), pa.array([p[1] for p in pairs], pa.string())], ["key", "form"])

    return df.mapInArrow(run, "key string, form string")


def _grams(forms: DataFrame) -> DataFrame:
    """``key form gram tf``: padded n-grams of each form."""
    padded = F.concat(F.lit("  "), F.regexp_replace("form", " ", "  "), F.lit(" "))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - GRAM + 1), lambda i: F.substring(padded, i, F.lit(GRAM)))
    return forms.select("key", "form", F.explode(grams).alias("gram")).groupBy("key", "form", "gram").agg(F.count(F.lit(1)).alias("tf"))


def _vectors(grams: DataFrame, idf: DataFrame) -> DataFrame:
    """``key form vec``: unit vectors as arrays of (gram, w, idf), rare grams first."""
    w = grams.join(idf, "gram").withColumn("w", F.sqrt("tf") * F.col("idf"))
    of = w.groupBy("key", "form").agg(F.sort_array(F.collect_list(F.struct("idf", "gram", "w")), asc=False).alias("g"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    return of.select("key", "form", F.transform("g", lambda x: F.struct(x["gram"].alias("gram"), (x["w"] / F.col("norm")).alias("w"))).alias("vec"))


def _prefixed(vectors: DataFrame, keys: list[str], vec: str, least: float, mark: str) -> DataFrame:
    """``keys gram w<mark> rest<mark>``: the first grams of each vector (of at most unit length), the rest of which, ``rest`` long, is too short for a product of ``least`` with any other.

    Two vectors in the same order with such a product have a gram of both prefixes in common.
    """
    start = F.struct(F.lit(0.0).alias("sum"), F.lit(0).alias("n"), F.lit(0.0).alias("rest"))

    def step(x: Column, g: Column) -> Column:
        total = x["sum"] + g["w"] * g["w"]
        out = total < (least - 1e-9) ** 2
        return F.struct(total.alias("sum"), F.when(out, x["n"] + 1).otherwise(x["n"]).alias("n"), F.when(out, F.sqrt(total)).otherwise(x["rest"]).alias("rest"))

    cut = vectors.select(*keys, vec, F.aggregate(F.reverse(vec), start, step).alias("cut"))
    kept = F.slice(vec, F.lit(1), F.size(vec) - F.col("cut.n"))
    return cut.select(*keys, F.explode(kept).alias("g"), F.col("cut.rest").alias("rest")).select(*keys, "g.gram", F.col("g.w").alias("w" + mark), F.col("rest").alias("rest" + mark))


def _met(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """``name person_id stated cosine`` of products of ``least`` or more, by joins.

    Prefixes whose rest is below half of ``least`` are joined: what they share,
    with the longer rest added, must reach ``least``, else the whole vectors
    are never multiplied. Common grams are in no prefix.
    """
    keys = ["name", "person_id", "stated"]
    joined = _prefixed(left, ["name"], "v", least / 2, "1").join(_prefixed(right, ["person_id", "stated"], "u", least / 2, "2"), "gram")
    shared = joined.groupBy(*keys).agg((F.sum(F.col("w1") * F.col("w2")) + F.greatest(F.first("rest1"), F.first("rest2"))).alias("most"))
    asked = shared.where(F.col("most") >= least - 1e-9).select(*keys)
    scored = asked.join(left, "name").join(right, ["person_id", "stated"]).withColumn("cosine", _product("v", "u"))
    return scored.where(F.col("cosine") >= least).select(*keys, "cosine")


def _met_small(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """:func:`_met` with a roster that every task holds whole: one pass over the names, the grams' postings added up."""
    rows = right.collect()
    postings: dict[str, tuple[list[int], list[float]]] = {}
    for i, r in enumerate(rows):
        for g in r.u:
            at, w = postings.setdefault(g.gram, ([], []))
            at.append(i)
            w.append(g.w)
    held = {g: (np.array(at), np.array(w)) for g, (at, w) in postings.items()}
    shared = left.sparkSession.sparkContext.broadcast((held, [r.person_id for r in rows], [r.stated for r in rows]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, people, stated = shared.value
        for batch in batches:
            out: list[tuple[str, int, float]] = []
            for name, vec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total = np.zeros(len(people))
                for g in vec:
                    if (hit := index.get(g["gram"])) is not None:
                        total[hit[0]] += g["w"] * hit[1]
                out += [(name, i, float(total[i])) for i in np.flatnonzero(total >= least).tolist()]
            cells = list(zip(*out)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cells[0], pa.string()), pa.array([people[i] for i in cells[1]], pa.string()), pa.array([stated[i] for i in cells[1]], pa.string()), pa.array(cells[2], pa.float64())], ["name", "person_id", "stated", "cosine"])

    return left.mapInArrow(run, "name string, person_id string, stated string, cosine double")


def _product(a: str, b: str) -> Column:
    """The product of two vectors."""
    held = F.map_from_entries(F.col(b))
    return F.aggregate(a, F.lit(0.0), lambda x, g: x + g["w"] * F.coalesce(F.try_element_at(held, g["gram"]), F.lit(0.0)))


def short_forms(names: DataFrame, entries: DataFrame) -> DataFrame:
    """``given short``: short forms of given names, from names whose family name is a roster person's.

    ``names``: ``name tokens``; ``entries``: ``person_id kind tokens``. A token
    is a short form of the given name beside the family names of whose bearers
    it stands, at least BEARERS of them (or one, if it begins with the same two
    letters) and at least a SHARE of all families it stands beside, LIFT times
    that of the given name in the roster's families; a token that is itself a
    given name of the roster is none.
    """
    people = entries.where("kind != 'organisation' and size(tokens) > 1")
    given = F.get("tokens", F.lit(0))
    families = F.filter(F.slice("tokens", 2, 99), lambda t: F.length(t) > 1)
    people = people.select("person_id", given.alias("given"), F.array_distinct(families).alias("family")).where("size(family) > 0")
    beside = names.select("name", "tokens", F.explode(F.array_distinct("tokens")).alias("part"))
    met = beside.join(people.select("*", F.explode("family").alias("part")), "part")
    left = F.filter(F.array_except("tokens", "family"), lambda t: F.length(t) > 1)
    alone = met.withColumn("left", left).where((F.size("left") == 1) & (F.size(F.array_except("family", "tokens")) <= F.size("family") - 1))
    seen = alone.select(F.get("left", F.lit(0)).alias("short"), "given", F.array_join("family", " ").alias("family")).distinct()
    seen = seen.join(people.select(F.col("given").alias("short")).distinct(), "short", "left_anti")
    every = seen.groupBy("short").agg(F.countDistinct("family").alias("families"))
    counted = seen.groupBy("short", "given").agg(F.countDistinct("family").alias("n")).join(every, "short")
    named = people.select("given", F.array_join("family", " ").alias("family")).distinct()
    own = named.groupBy("given").agg(F.count(F.lit(1)).alias("own")).crossJoin(F.broadcast(named.agg(F.countDistinct("family").alias("all"))))  # one row
    counted = counted.join(own, "given").where(F.col("n") * F.col("all") >= F.col("families") * F.col("own") * LIFT)
    alike = F.substring("short", 1, 2) == F.substring("given", 1, 2)
    return counted.where(((F.col("n") >= BEARERS) | alike) & (F.col("n") >= F.col("families") * SHARE)).select("given", "short")


def _tokens(df: DataFrame) -> DataFrame:
    """``df`` with ``tokens``: the bare tokens of its ``name``."""
    schema = T.StructType([*df.schema.fields, T.StructField("tokens", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = pa.array([bare(n) for n in batch.column("name").to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([*batch.columns, made], schema.names)

    return df.mapInArrow(run, schema)


def link_names(names: DataFrame, roster: DataFrame, top_n: int = TOP_N, threshold: float = THRESHOLD, linkage: float = LINKAGE, nicknames: DataFrame | None = None) -> DataFrame:
    """``name person_id cosine linkage``: of each distinct name the roster entry it means, where there is one.

    ``names`` has ``name``; ``roster`` has ``person_id display_name kind``;
    ``nicknames`` (``given short``, folded) adds short forms to those learned.
    Null and blank names mean nobody. Names that several entries explain
    equally well, also by their groups' average linkage, mean nobody. Repeated
    names count once; empty tables give an empty result; other columns are ignored.
    """
    distinct = durable(_tokens(names.select("name").where("name is not null and trim(name) != ''").distinct()), "names")
    entries = roster.where("person_id is not null and display_name is not null").select(F.col("person_id").alias("key"), F.col("display_name").alias("name"), F.coalesce("kind", F.lit("person")).alias("kind")).dropDuplicates(["key"])
    asked = _forms(distinct.select(F.col("name").alias("key"), "name", F.lit("").alias("kind")), False)
    stated = _forms(entries, True)
    asked_grams, stated_grams = durable(_grams(asked), "grams"), durable(_grams(stated), "grams")
    # Statistics of grams over all names; the collection is that of distinct forms.
    total = asked.select("key").distinct().union(stated.select("key").distinct()).agg(F.count(F.lit(1)).alias("all"))
    df = asked_grams.select("gram", "key").union(stated_grams.select("gram", "key")).groupBy("gram").agg(F.count(F.lit(1)).alias("df"))
    idf = df.crossJoin(F.broadcast(total)).select("gram", F.log(1 + F.col("all") / F.col("df")).alias("idf"))  # one row
    a, b = durable(_vectors(asked_grams, idf), "asked"), durable(_vectors(stated_grams, idf), "stated")
    left = a.select(F.col("key").alias("name"), F.col("vec").alias("v"))
    right = b.select(F.col("key").alias("person_id"), F.col("form").alias("stated"), F.col("vec").alias("u"))
    small = b.agg(F.coalesce(F.sum(F.size("vec")), F.lit(0)).alias("n")).first().n <= BROADCAST_ROWS
    scored = (_met_small if small else _met)(left, right, threshold)
    pairs = scored.groupBy("name", "person_id").agg(F.max_by("stated", F.struct("cosine", "stated")).alias("stated"), F.max("cosine").alias("cosine"))
    best = _top(pairs, top_n)

    people = durable(_tokens(entries), "entries")
    shorts = short_forms(distinct, people.withColumnRenamed("key", "person_id"))
    if nicknames is not None:
        shorts = shorts.unionByName(nicknames.select("given", "short")).distinct()
    said = distinct.select("name", F.explode(F.array_distinct("tokens")).alias("short")).join(shorts, "short").groupBy("name", "given").agg(F.collect_set("short").alias("shorts"))
    candidates = best.join(people.select(F.col("key").alias("person_id"), F.col("name").alias("display_name"), "kind", F.get("tokens", F.lit(0)).alias("given")), "person_id")
    candidates = candidates.join(said, ["name", "given"], "left").select("name", "person_id", "stated", "cosine", "display_name", "kind", F.coalesce("shorts", F.array().cast("array<string>")).alias("shorts"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            costs = [explains(r["name"], r["display_name"], r["kind"], frozenset(r["shorts"])) for r in batch.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(costs, pa.float64())], ["name", "person_id", "stated", "cosine", "cost"])

    judged = candidates.mapInArrow(judge, "name string, person_id string, stated string, cosine double, cost double")
    judged = durable(judged.where("cost is not null"), "judged")
    # The groups: each spelling of the roster with the names that are nearest to it among those that explain them best.
    order = Window.partitionBy("name").orderBy("cost", F.desc("cosine"), "person_id")
    nearest = judged.withColumn("k", F.row_number().over(order)).where("k = 1").select("name", "person_id", "stated")
    members = nearest.join(left, "name").select("person_id", "stated", F.col("v").alias("u")).union(right.select("person_id", "stated", "u"))
    sizes = members.groupBy("person_id", "stated").agg(F.count(F.lit(1)).alias("size"))
    means = members.select("person_id", "stated", F.explode("u").alias("g")).groupBy("person_id", "stated", "g.gram").agg(F.sum("g.w").alias("w"))
    means = means.groupBy("person_id", "stated").agg(F.collect_list(F.struct("gram", "w")).alias("u")).join(sizes, ["person_id", "stated"])
    linked = judged.join(left, "name").join(means, ["person_id", "stated"]).withColumn("linkage", _product("v", "u") / F.col("size"))
    linked = linked.where(F.col("linkage") >= linkage).select("name", "person_id", "cosine", "cost", "linkage")
    least = linked.groupBy("name").agg(F.min("cost").alias("least"))
    tied = linked.join(least, "name").where(F.col("cost") <= F.col("least") + 1e-9)
    top = tied.groupBy("name").agg(F.max_by(F.struct("person_id", "cosine", "linkage"), F.struct("linkage", "person_id")).alias("t"), F.max("linkage").alias("hi"), F.min("linkage").alias("lo"), F.count(F.lit(1)).alias("n"))
    return top.where("n = 1 or hi > lo + 0.02").select("name", "t.person_id", "t.cosine", "t.linkage")


def _top(pairs: DataFrame, n: int) -> DataFrame:
    order = Window.partitionBy("name").orderBy(F.desc("cosine"), "person_id")
    return pairs.withColumn("k", F.row_number().over(order)).where(F.col("k") <= n).drop("k")


def attributed(staged: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """``tab rec_key name``: the attribution name of each record; one row per distinct record and name."""
    a = staged.select(F.lit("pilot_staged").alias("tab"), F.col("id").alias("rec_key"), F.col("attribution.name").alias("name"))
    b = adjudicated.select(F.lit("adjudication_entries").alias("tab"), F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id").alias("rec_key"), F.col("source.attribution.name").alias("name"))
    return a.union(b).where("name is not null").distinct()


def linked_records(records: DataFrame, links: DataFrame, roster: DataFrame) -> DataFrame:
    """``tab rec_key person_id`` of the records whose name means a roster entry and isn't its display name."""
    wrong = links.join(roster.select("person_id", "display_name").dropDuplicates(["person_id"]), "person_id").where("name != display_name").select("name", "person_id")
    return salted_join(records, wrong, "name", "rec_key", hot_keys(records, "name")).select("tab", "rec_key", "person_id").distinct()
