"""Languages of documents and of the segments of mixed ones, by partial matching.

Per language a variable-order byte context tree holds how often a byte followed
a context inside a word. Its statistics are frozen, so the code length of a
word under each tree (with escape probabilities from longer to shorter
contexts) is a fixed number, is computed once per distinct word and is added up
over sentences. The sentences of a text are then cut into the cheapest runs. A
run that the frequencies of single bytes over all languages describe more
shortly than any language's contexts is in none of them.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Longest context in bytes.
ORDER = 4
#: Labelled records per language that the trees are fitted to, at most.
SAMPLE = 1000
#: Bits that another language must save to begin a new segment.
SWITCH_BITS = 14.0
#: Distinct words whose code lengths a worker keeps.
MEMO_WORDS = 200_000

# Codes and names of the languages, in lower case.
LABELS = {
    "en": "en eng english anglais englisch inglés engleză angol ingilizce αγγλικά",
    "ro": "ro ron rum romanian română romana limba română roumain rumänisch rumano román romence mo mol ρουμανικά",
    "hu": "hu hun hungarian magyar hongrois ungarisch húngaro maghiară macarca ουγγρικά",
    "de": "de deu ger german deutsch allemand alemán germană német almanca γερμανικά",
    "fr": "fr fra fre french français francais französisch francés franceză francia fransızca γαλλικά",
    "es": "es spa spanish español espanol castellano espagnol spanisch spaniolă spanyol ispanyolca ισπανικά",
    "tr": "tr tur turkish türkçe turkce turc türkisch turco turcă török τουρκικά",
    "el": "el ell gre gr greek ελληνικά ελληνικη ellinika grec griechisch griego greacă görög yunanca",
}
_NAMES = {n: k for k, v in LABELS.items() for n in v.split()}

_WORD = re.compile(r"[^\W\d_]+")
_BREAK = re.compile(r"(?<=[.!?…])[\"'»”’)\]]*\s+(?=[\W\d_]*[^\W\d_])|[\r\n]+")
_QUOTED = re.compile(r"«[^»]*»|“[^”]*”|„[^“”]*[“”]|\"[^\"]*\"|‹[^›]*›|\{[^}]*\}|`[^`]*`")


def label_language(label: str | None) -> str | None:
    """The language a label names in any spelling, code or region; None for none of them."""
    if not label:
        return None
    text = label.strip().lower().replace("i̇", "i")
    return _NAMES.get(text) or _NAMES.get(re.split(r"[-_\s(/]", text, maxsplit=1)[0])


def sentences(text: str) -> list[str]:
    """Sentences; a full stop before a lower-case letter ends none."""
    out: list[str] = []
    for part in _BREAK.split(text):
        first = _WORD.search(part)
        if out and first and part[first.start()].islower() and not out[-1].endswith("\n"):
            out[-1] += " " + part
        else:
            out.append(part)
    return [s for s in out if s.strip()]


def sentence_words(sentence: str) -> list[str]:
    """Words (lower case) outside of quotations, or all if hardly any are outside."""
    if _QUOTED.search(sentence):
        outside = _WORD.findall(_QUOTED.sub(" ", sentence))
        if len(outside) >= 2:
            return [w.lower() for w in outside]
    return _WORD.findall(sentence.lower())


class ContextTree:
    """Code lengths in bits of bytes after contexts, and of escapes from contexts."""

    def __init__(self, words: dict[str, int], order: int = ORDER):
        counts: dict[bytes, int] = {}
        for word, n in words.items():
            seq = b" " + word.encode("utf-8", "replace") + b" "
            for i in range(1, len(seq)):
                for k in range(min(order, i) + 1):
                    key = seq[i - k : i + 1]
                    counts[key] = counts.get(key, 0) + n
        total: dict[bytes, int] = {}
        kinds: dict[bytes, int] = {}
        for key, n in counts.items():
            total[key[:-1]] = total.get(key[:-1], 0) + n
            kinds[key[:-1]] = kinds.get(key[:-1], 0) + 1
        self.order = order
        self.symbol = {key: math.log2((total[key[:-1]] + kinds[key[:-1]]) / n) for key, n in counts.items()}
        self.escape = {c: math.log2((total[c] + kinds[c]) / kinds[c]) for c in total}

    def bits(self, word: str) -> float:
        seq = b" " + word.encode("utf-8", "replace") + b" "
        symbol, escape, out = self.symbol, self.escape, 0.0
        for i in range(1, len(seq)):
            for k in range(min(self.order, i), -1, -1):
                b = symbol.get(seq[i - k : i + 1])
                if b is not None:
                    out += b
                    break
                out += escape.get(seq[i - k : i], 0.0)
            else:
                out += 8.0
        return out


#: Name under which the tree of no language is kept, and the scale of confidences beside the trees.
NONE = ""


class Trees(dict):
    """Language -> tree, with the tree of single bytes under NONE; ``scale``: bits that count as one in a confidence."""

    scale = 1.0


class Scorer:
    """Code lengths of words and sentences under all languages, and under none in the last column."""

    def __init__(self, trees: dict[str, ContextTree]):
        self.languages = sorted(k for k in trees if k != NONE)
        self.trees = [trees[k] for k in [*self.languages, *([NONE] if NONE in trees else [])]]
        self.scale = getattr(trees, "scale", 1.0)
        self.rows: dict[str, int] = {}
        self.table = np.zeros((1024, len(self.trees)))

    def name(self, language: int | None) -> str | None:
        return None if language is None else self.languages[language]

    def batch(self, texts: list[list[list[str]]]) -> tuple[np.ndarray, np.ndarray]:
        """Of texts as lists of sentences as lists of words: bits [sentence, language], and the first sentence of each text."""
        if len(self.rows) > MEMO_WORDS:
            self.rows.clear()
        rows, at, lengths, first = self.rows, [], [], [0]
        for text in texts:
            for words in text:
                for w in words:
                    # a long run of letters is kept by its hash only
                    name = w if len(w) < 200 else hashlib.blake2b(w.encode("utf-8", "replace")).digest()
                    r = rows.get(name)
                    if r is None:
                        r = rows[name] = len(rows)
                        if r >= len(self.table):
                            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                        self.table[r] = [t.bits(w) for t in self.trees]
                    at.append(r)
                lengths.append(len(words))
            first.append(len(lengths))
        sums = np.zeros((len(at) + 1, len(self.trees)))
        np.cumsum(self.table[np.array(at, np.int64)], axis=0, out=sums[1:])
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
        return sums[ends[1:]] - sums[ends[:-1]], np.array(first)


def cut(bits: np.ndarray, switch: float = SWITCH_BITS) -> np.ndarray:
    """The language of each sentence on the cheapest path, where a change costs ``switch`` bits."""
    n, k = bits.shape
    cost, back = bits[0].copy(), np.zeros((n, k), np.int64)
    for i in range(1, n):
        best = int(cost.argmin())
        stay = cost <= cost[best] + switch
        back[i] = np.where(stay, np.arange(k), best)
        cost = np.where(stay, cost, cost[best] + switch) + bits[i]
    path = np.zeros(n, np.int64)
    path[-1] = int(cost.argmin())
    for i in range(n - 1, 0, -1):
        path[i - 1] = back[i, path[i]]
    return path


def confidence(bits: np.ndarray, language: int, scale: float = 1.0) -> float:
    """Probability of the language against the others, all being equally likely before, from code lengths in units of ``scale`` bits."""
    return float(1 / np.sum(np.exp2(np.clip((bits[language] - bits) / scale, -1000, 1000))))


def segments(bits: np.ndarray, heard: np.ndarray, languages: int | None = None, scale: float = 1.0) -> list[tuple[int | None, float, int, int]]:
    """(language, confidence, first sentence, end) of a text; ``heard``: which sentences have words.

    The columns after the first ``languages`` stand for none: a segment that one of them describes best has no language.
    """
    if not heard.any():
        return []
    every, bits = bits, bits[:, :languages]
    best = bits.argmin(1)

    def judged(language: int, start: int, end: int) -> tuple[int | None, float, int, int]:
        total = every[start:end].sum(0)
        none = int(total.argmin())
        known = languages is None or none < languages
        return (language if known else None, confidence(total, language if known else none, scale), start, end)

    if (best[heard] == best[heard][0]).all():
        return [judged(int(best[heard][0]), 0, len(bits))]
    path = cut(bits)
    out, start = [], 0
    for i in range(1, len(path) + 1):
        if i == len(path) or path[i] != path[start]:
            out.append(judged(int(path[start]), start, i))
            start = i
    return out


def calibrated(bits: np.ndarray, right: np.ndarray) -> float:
    """The scale at which the confidences of held-out sentences (bits [sentence, language]) describe their labels best."""
    if not len(bits):
        return 1.0
    gap = bits[np.arange(len(bits)), right][:, None] - bits
    loss = {scale: float(np.log2(np.exp2(np.clip(gap / scale, -500, 500)).sum(1)).mean()) for scale in (1.0, 1.5, 2.0, 3.0, 4.0, 6.0, 8.0, 12.0, 16.0, 24.0, 32.0)}
    return min(loss, key=lambda x: (loss[x], x))


def fit(sample: list[tuple[str, str]], order: int = ORDER) -> Trees:
    """Trees from (language, text).

    Each half of the texts is judged by trees of the other half; the sentences
    found in another language are left out of the final trees, and the margins
    of all give the scale of confidences.
    """
    parsed = [(lang, [sentence_words(s) for s in sentences(text)]) for lang, text in sample]
    counts: list[dict[str, Counter[str]]] = [{}, {}]
    for i, (lang, text) in enumerate(parsed):
        for words in text:
            for half in counts:
                half.setdefault(lang, Counter())
            counts[i % 2][lang].update(words)
    if not counts[0]:
        return Trees()
    clean: dict[str, Counter[str]] = {k: Counter() for k in counts[0]}
    margins, labels = [], []
    for part in (0, 1):
        other = counts[1 - part]
        # rare words tell nothing yet, and wrong labels are rare
        fitted = {k: ContextTree({w: n for w, n in c.items() if n > 1} or c or counts[part][k], order) for k, c in other.items()}
        scorer = Scorer(fitted)
        own = parsed[part::2]
        bits, first = scorer.batch([t for _, t in own])
        for (lang, text), a in zip(own, first.tolist()):
            for i, words in enumerate(text):
                if words:
                    margins.append(bits[a + i])
                    labels.append(scorer.languages.index(lang))
                    if scorer.languages[int(bits[a + i].argmin())] == lang:
                        clean[lang].update(words)
    trees = Trees({k: ContextTree(c or counts[0][k] + counts[1][k], order) for k, c in clean.items()})
    trees[NONE] = ContextTree(sum(clean.values(), Counter()) or sum(counts[0].values(), sum(counts[1].values(), Counter())), 0)
    trees.scale = calibrated(np.array(margins), np.array(labels, np.int64))
    return trees


def labelled_sample(docs: DataFrame, per_language: int = SAMPLE) -> list[tuple[str, str]]:
    """(language, text) of at most ``per_language`` records a language, chosen by the hash of the text; of ``docs``: ``label text``."""
    spell = F.lower(F.trim("label"))
    names = F.create_map(*[F.lit(x) for k, v in sorted(_NAMES.items()) for x in (k, v)])
    lang = F.coalesce(names[spell], names[F.regexp_extract(spell, r"^[^-_\s(/]+", 0)])
    known = docs.where("text is not null").select(lang.alias("lang"), "text", F.xxhash64("text").alias("h")).where("lang is not null")
    # A share of the hashes of each language first, so that only a few times the sample is sorted; a rare language is taken whole.
    shares = F.lit(1)
    for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        shares = F.when(F.col("lang") == r.lang, max(1, r.n // (per_language * 40))).otherwise(shares)
    picked = known.where(F.pmod("h", shares.cast("long")) == 0)
    order = Window.partitionBy("lang").orderBy("h", "text")
    rows = picked.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_language).select("lang", "text").collect()
    return [(r.lang, r.text) for r in rows]


def detect(docs: DataFrame, trees: dict[str, ContextTree]) -> DataFrame:
    """``tab rec_key label seg_no lang confidence n_sentences`` of ``tab rec_key label text``.

    A text in one language gives one row with ``seg_no`` 0; a mixed one a row
    per segment, numbered from 1. A text without words, an empty or a null one
    gives one row with ``seg_no`` 0, ``lang`` null and confidence 0; one in none
    of the trees' languages, or a segment like that, has ``lang`` null and the
    confidence of that. Texts and words of any length are read whole. Repeated
    rows repeat their result; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    schema = "tab string, rec_key string, label string, seg_no int, lang string, confidence double, n_sentences int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = None
        for batch in batches:
            scorer = scorer or Scorer(shared.value)
            for k in range(0, batch.num_rows, 2000):
                part = batch.slice(k, 2000)
                parsed = [[sentence_words(s) for s in sentences(t)] if t and shared.value else [] for t in part.column(3).to_pylist()]
                bits, first = scorer.batch(parsed) if shared.value else (np.zeros((0, 0)), np.zeros(len(parsed) + 1, np.int64))
                heard = np.array([bool(w) for t in parsed for w in t], bool)
                at, rows = [], []
                for i, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                    found = segments(bits[a:b], heard[a:b], len(scorer.languages), scorer.scale) if b > a else []
                    if not found:
                        rows.append((0, None, 0.0, 0))
                    elif len(found) == 1:
                        rows.append((0, scorer.name(found[0][0]), found[0][1], b - a))
                    else:
                        rows += [(j, scorer.name(x[0]), x[1], x[3] - x[2]) for j, x in enumerate(found, 1)]
                    at += [i] * max(1, len(found))
                head = part.take(pa.array(at, pa.int64())).columns[:3]
                cells = list(zip(*rows)) or [[]] * 4
                yield pa.RecordBatch.from_arrays([*head, *(pa.array(c, t) for c, t in zip(cells, (pa.int32(), pa.string(), pa.float64(), pa.int32())))], ["tab", "rec_key", "label", "seg_no", "lang", "confidence", "n_sentences"])

    return docs.select("tab", "rec_key", "label", F.col("text").cast("string").alias("text")).mapInArrow(run, schema)


def wrong_labels(detected: DataFrame) -> DataFrame:
    """Of :func:`detect`: mixed texts' segments, and texts in one language whose label is missing or names another."""
    spell = F.lower(F.trim("label"))
    names = F.create_map(*[F.lit(x) for k, v in sorted(_NAMES.items()) for x in (k, v)])
    said = F.coalesce(names[spell], names[F.regexp_extract(spell, r"^[^-_\s(/]+", 0)])
    return detected.where(F.col("lang").isNotNull() & ((F.col("seg_no") > 0) | ~said.eqNullSafe(F.col("lang"))))


def labelled_texts(staged: DataFrame, adjudicated: DataFrame) -> DataFrame:
    """``tab rec_key label text`` of the staged and the adjudicated records."""
    a = staged.select(F.lit("pilot_staged").alias("tab"), F.col("id").alias("rec_key"), F.col("language").alias("label"), "text")
    b = adjudicated.select(F.lit("adjudication_entries").alias("tab"), F.concat(F.col("packet_no").cast("string"), F.lit(":"), "entry_id").alias("rec_key"), F.col("source.language").alias("label"), F.col("source.text").alias("text"))
    return a.union(b)
