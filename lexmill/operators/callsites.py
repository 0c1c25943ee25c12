"""Call sites of keys in source text: constructs, modifiers, containers, conditions."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Constructs that show a text, the modifiers that limit it, and lines that make it conditional.
CONSTRUCTS = ("Text", "Label", "Button", "Link", "Section", "Toggle", "TextField", "SecureField", "NavigationLink", "Picker", "Menu", "Stepper", "DatePicker", "ContentUnavailableView", "ShieldConfiguration")
MODIFIERS = ("lineLimit", "minimumScaleFactor", "truncationMode", "fixedSize", "allowsTightening", "font", "textCase", "frame", "dynamicTypeSize")
CONDITION = r"#if DEBUG|#Preview|ViewThatFits|isAccessibilitySize|widgetFamily|\bfamily\b|horizontalSizeClass|dynamicTypeSize|widgetRenderingMode|showsWidgetContainerBackground|^\s*(if|guard|switch|else)\b|^\s*case\s+[.(let]"
_OPEN = re.compile(rf"\b({'|'.join(CONSTRUCTS)})\s*\(")
_DECLARED = re.compile(r"\b(struct|class|enum|extension|actor|protocol)\s+(\w+)")
_LITERAL = re.compile(r'"((?:[^"\\]|\\.)*)"')


def code_only(text: str) -> str:
    """The line without string contents and comments, as long as before."""
    text = _LITERAL.sub(lambda m: '"' + " " * (len(m.group()) - 2) + '"', text)
    return text.split("//")[0]


def balanced(text: str, start: int) -> int:
    """Where the bracket at ``start`` closes, or the end of the text."""
    depth = 0
    for i in range(start, len(text)):
        depth += (text[i] in "([{") - (text[i] in ")]}")
        if depth == 0:
            return i
    return len(text)


def parse_modifiers(chain: str) -> dict[str, str]:
    """Arguments of the known modifiers of a chain; the last of a kind wins."""
    out = {}
    for m in re.finditer(rf"\.({'|'.join(MODIFIERS)})\s*\(", chain):
        out[m[1]] = chain[m.end() : balanced(chain, m.end() - 1)].strip()
    return out


def file_sites(path: str, text: str) -> list[tuple]:
    """(key, path, line, view, construct, modifiers, conditional, debug) of every literal that a construct shows."""
    lines = text.split("\n")
    code = [code_only(x) for x in lines]
    flat, at = "\n".join(code), [0]
    for x in code:
        at.append(at[-1] + len(x) + 1)
    out, stack, debug, preview = [], [], [], 0
    depth = 0
    for n, (line, bare) in enumerate(zip(lines, code)):
        s = bare.strip()
        if s.startswith("#if"):
            debug.append("DEBUG" in s)
        elif s.startswith("#else") and debug:
            debug[-1] = False
        elif s.startswith("#endif") and debug:
            debug.pop()
        if (m := _DECLARED.search(bare)) or "#Preview" in bare:
            stack.append((depth, m[2] if m else "#Preview"))
        for m in _OPEN.finditer(bare):
            literal = _LITERAL.match(line[m.end() :].lstrip())
            if not literal:
                continue
            close = balanced(flat, at[n] + m.end() - 1)
            end = close + 1
            while (c := re.compile(r"\s*\.\w+\s*(?=\()").match(flat, end)) is not None:
                end = balanced(flat, c.end()) + 1
            source = "\n".join(lines)[close + 1 : end] if len(flat) == len("\n".join(lines)) else flat[close + 1 : end]
            window = lines[max(0, n - 15) : n + 1]
            view = next((x for _, x in reversed(stack) if x != "#Preview"), "")
            out.append((literal[1], path, n + 1, view, m[1], sorted(parse_modifiers(source).items()), any(re.search(CONDITION, w) for w in window), any(debug) or any(x == "#Preview" for _, x in stack)))
        depth += bare.count("{") - bare.count("}")
        while stack and depth <= stack[-1][0] and "}" in bare:
            stack.pop()
    return out


SITES = "key string, path string, line int, view string, construct string, modifiers map<string,string>, conditional boolean, unreachable boolean"


def scan_sites(files: DataFrame) -> DataFrame:
    """Call sites of ``path text``, a file at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(*r[:5], dict(r[5]), *r[6:]) for p, t in zip(pdf["path"], pdf["text"]) if t for r in file_sites(p, t)]
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in SITES.split(", ")])

    return files.select("path", "text").mapInPandas(run, SITES).dropDuplicates(["key", "path", "line", "view"])


def unresolved(keys: DataFrame, sites: DataFrame) -> DataFrame:
    return keys.select("key").distinct().join(sites.select("key").distinct(), "key", "left_anti")


def one_hop(accessors: DataFrame, usages: DataFrame, types: DataFrame) -> DataFrame:
    """``key path line view``: keys behind an accessor (``key type accessor``) at the places that use it (``type accessor path line view``); only types declared once."""
    unique = types.groupBy("type").agg(F.count(F.lit(1)).alias("n")).where("n = 1").select("type")
    return accessors.join(unique, "type", "left_semi").join(usages, ["type", "accessor"]).select("key", "path", "line", "view").distinct()


def literal_pattern(key: str) -> str:
    """A pattern for a literal key in source text, its placeholders standing for interpolations."""
    parts = re.split(r"%(?:\d+\$)?(?:@|lld|ld|d|f)", key)
    return '"' + r"\\\([^\"]*\)".join(map(re.escape, parts)) + '"'


def origins(sites: DataFrame) -> DataFrame:
    """``key origin``: unreachable if every site of a key is, else reachable."""
    g = sites.groupBy("key").agg(F.min(F.col("unreachable").cast("int")).alias("all"))
    return g.select("key", F.when(F.col("all") == 1, "unreachable").otherwise("reachable").alias("origin"))


def condition_windows(lines: DataFrame, back: int = 15) -> DataFrame:
    """``path line n_conditions``: conditional lines among the ``back`` before; ordered within one file only."""
    w = Window.partitionBy("path").orderBy("line").rowsBetween(-back, -1)
    return lines.select("path", "line", F.coalesce(F.sum(F.col("text").rlike(CONDITION).cast("int")).over(w), F.lit(0)).cast("long").alias("n_conditions"))
