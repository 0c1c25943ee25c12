"""Column expressions over texts. All patterns state Unicode classes, which Java does not use by default."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The three placeholder grammars, which differ on purpose.
PRINTF = r"%(\d+\$)?[-+0#]*\d*(?:\.\d+)?(?:hh|h|ll|l|q|z|t|L)?([@dDiuUxXoOfeEgGcCsSpaAF%])"
CASING_TOKEN = r"%#@\w+@|%(?:\d+\$)?[-+0#]*\d*(?:\.\d+)?(?:hh|h|ll|l|q|z|t|L)?[@dDiuUxXoOfeEgGcCsSpaAF%]"
PACKET_TOKEN = r"%(\d+\$)?(%|@|l{0,2}[dui]|\.?\d*f|s)"
# Conversion letters by class; the other classes are their own letter.
CLASS_OF = {"d": "dDiuUxXoO", "f": "feEgGaAF", "s": "sScC"}
CLASSES = ("@", "%", "p", "d", "f", "s")
# A key of two or more segments.
NAMED_KEY = r"^[A-Za-z0-9_-]+(\.[A-Za-z0-9_-]+)+$"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c: Column | str) -> Column:
    """Without any white space at the ends, line breaks and no-break spaces included."""
    return F.regexp_replace(col(c), r"(?U)^\s+|\s+$", "")


def collapse_ws(c: Column | str) -> Column:
    return trim_ws(F.regexp_replace(col(c), r"(?U)\s+", " "))


def normalise(c: Column | str) -> Column:
    """Trimmed, white space collapsed, lower case; the dotted capital I becomes a plain i, without a mark of its own."""
    return F.lower(F.translate(collapse_ws(c), "İ", "i"))


def placeholder_classes(c: Column | str) -> Column:
    """The class of each printf placeholder, in order; ``%%`` is the class percent."""
    letters = F.regexp_extract_all(col(c), F.lit(PRINTF), F.lit(2))
    every = {x: k for k, v in CLASS_OF.items() for x in v}
    return F.transform(letters, lambda x: F.translate(x, "".join(every), "".join(every.values())))


def placeholder_positions(c: Column | str) -> Column:
    """The argument number of each placeholder: as written, or its place in the text."""
    given = F.regexp_extract_all(col(c), F.lit(PRINTF), F.lit(1))
    return F.transform(given, lambda x, i: F.when(x == "", i + 1).otherwise(F.regexp_replace(x, r"\$", "").cast("int")))


def class_count(classes: Column, name: str) -> Column:
    return F.size(F.filter(classes, lambda x: x == name))


def quote_regex(term: Column | str) -> Column:
    """A literal as a pattern."""
    return F.regexp_replace(col(term), r"([\\.\[\]{}()*+?^$|#&~\-])", r"\\$1")


def whole_word(text: Column | str, pattern: Column | str) -> Column:
    """Whether ``pattern`` occurs with no word character on either side, in any case."""
    p = pattern if isinstance(pattern, Column) else F.lit(pattern)
    return F.regexp_like(col(text), F.concat(F.lit(r"(?iuU)(?<!\w)(?:"), p, F.lit(r")(?!\w)")))


def plain_words(c: Column | str) -> Column:
    """For containment checks: tokens and punctuation become blanks, apostrophes are straightened, white space collapses, lower case."""
    straight = F.regexp_replace(col(c), "[’‘ʼ]", "'")
    bare = F.regexp_replace(F.regexp_replace(straight, PACKET_TOKEN, " "), r"[^\p{L}\p{N}' ]+", " ")
    return F.lower(F.trim(F.regexp_replace(bare, " +", " ")))


def contains_whole(haystack: Column, needle: Column) -> Column:
    """Whole-word containment of texts brought through :func:`plain_words`."""
    return F.contains(F.concat(F.lit(" "), haystack, F.lit(" ")), F.concat(F.lit(" "), needle, F.lit(" ")))


def fold_cedilla(c: Column | str) -> Column:
    return F.translate(col(c), "şŞţŢ", "șȘțȚ")


def strip_ellipsis(c: Column | str) -> Column:
    return F.regexp_replace(trim_ws(c), r"(\.\.\.|…)$", "")


def key_prefix(key: Column | str, segments: int = 2) -> Column:
    """The first segments of a named key, ``<literal>`` for others."""
    return F.when(col(key).rlike(NAMED_KEY), F.substring_index(col(key), ".", segments)).otherwise(F.lit("<literal>"))


def group_of(key: Column | str) -> Column:
    """feature.screen; a key of two segments belongs to feature.root."""
    k = col(key)
    return F.when(F.size(F.split(k, r"\.")) <= 2, F.concat(F.substring_index(k, ".", 1), F.lit(".root"))).otherwise(F.substring_index(k, ".", 2))


def under_prefix(key: Column | str, prefix: str) -> Column:
    """Segment-aware: the prefix itself or a key below it."""
    return (col(key) == prefix) | col(key).startswith(prefix + ".")


@F.pandas_udf(T.StringType())
def nfc(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else unicodedata.normalize("NFC", v))


@F.pandas_udf(T.StringType())
def casefold(values: pd.Series) -> pd.Series:
    return values.map(lambda v: None if v is None else v.casefold())
