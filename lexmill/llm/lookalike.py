"""One consistent form for text that looks the same but is written with other characters.

A vocabulary of the corpus's ordinary words is kept as a trie per locale. An
edit automaton walks it for every token that has unusual characters: look-alike
letters and ignorable characters cost nothing, anything else is refused. Tokens
without a path are normalised by table. A vocabulary that is too large for every
task is joined with the unusual tokens by a key that look-alikes share, and each
value walks a trie of the words it may mean.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.skew import hot_keys_of, salted_join
from lexmill.session import durable

# Letters beside a-z (or the base script) that a locale's spelling has.
EXTRA_LETTERS = {
    "en": "", "ro": "ăâîșț", "hu": "áéíóöőúüű", "de": "äöüß", "fr": "àâæçéèêëîïôœùûüÿ", "es": "áéíñóúü", "tr": "çğıöşüâîû", "el": "άέήίόύώϊϋΐΰς", "he": "", "bg": "",
}
# The script a locale is written in, where it isn't Latin.
SCRIPT_OF = {"el": "GREEK", "he": "HEBREW", "bg": "CYRILLIC"}
# Letters that look like a Latin one.
LATIN_LIKE = {
    "CYRILLIC": dict(zip("аеорсухіјѕԁԛԝһӏғѵАВЕЅІЈКМНОРСТХУԚԜҮӀԌ", "aeopcyxijsdqwhlfvABESIJKMHOPCTXYQWYIG")),
    "GREEK": dict(zip("οανιρυκτχεωγϲϳΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹͿ", "oavipuktxewycjABEZHIKMNOPTYXCJ")),
    "ARMENIAN": dict(zip("օսցհոզՕՍ", "ougnnqOU")),
}
# Single Latin letters that look like a plain one, whatever the locale.
LATIN_TWINS = {"ɡ": "g", "ɑ": "a", "ɩ": "i", "ɪ": "i", "ʏ": "y", "ȷ": "j", "ᴏ": "o", "ᴄ": "c", "ᴠ": "v", "ᴡ": "w", "ᴢ": "z", "ꜱ": "s", "ʀ": "r", "ɴ": "n", "ʟ": "l", "ʜ": "h", "ʙ": "b", "ǀ": "l", "ɾ": "r", "ɯ": "m", "ʋ": "v", "ƶ": "z", "ſ": "s"}
# Marks that a neighbouring language writes in place of one another.
MARK_TWINS = [("̦", "̧"), ("̋", "̃"), ("̋", "̂"), ("̋", "̈"), ("̆", "̌"), ("́", "΄"), ("́", "̍")]
# Neighbouring spellings, by locale, used where the vocabulary has no answer.
NEIGHBOURS = {
    "ro": dict(zip("şţŞŢǎǍãÃ", "șțȘȚăĂăĂ")), "hu": dict(zip("õûÕÛôÔ", "őűŐŰőŐ")), "tr": dict(zip("șțȘȚǧǦ", "ştŞTğĞ")), "de": {"β": "ß"}, "el": {"µ": "μ", "ά": "ά", "ß": "β"},
}
# Characters that show nothing.
INVISIBLE = "­͏؜ᅟᅠ឴឵᠋-᠏​-‏‪-‮⁠-⁤⁦-⁯ㅤ︀-️﻿ﾠ￹-￻\U0001d173-\U0001d17a\U000e0000-\U000e0fff"
# Spaces other than U+0020.
SPACES = "   -   　"

_INVISIBLE = re.compile(f"[{INVISIBLE}]")
_SPACES = re.compile(f"[{SPACES}]")
_PICTURE = r"[←-⇿⌀-⏿①-⓿■-➿⤀-⥿⬀-⯿〰〽㊗㊙\U0001f000-\U0001faff#*0-9©®‼⁉™ℹ]"
#: Pictures with their selectors, joiners and skin tones; in these, invisible characters are at home.
_EMOJI = re.compile(rf"{_PICTURE}(?:[︎️]|[\U0001f3fb-\U0001f3ff])*⃣?(?:‍{_PICTURE}(?:[︎️]|[\U0001f3fb-\U0001f3ff])*)*")
_TOKEN = re.compile(r"[^\W\d_]+", re.UNICODE)
_PLAIN = re.compile(r"[\x00-\x7f]*")

#: Words of the vocabulary over all locales that are handed to every task; a larger one is joined with the unusual tokens.
VOCABULARY = 200_000
#: How often a word of the home script must occur, and by how much more often than its Latin twin, to stand behind a wholly Latin token.
HOME_LEAST, HOME_TIMES = 20, 20


@functools.lru_cache(maxsize=1 << 16)
def script(ch: str) -> str:
    """The script of a letter by its name, "" for others."""
    if not ch.isalpha():
        return ""
    return "LATIN" if ch < "ɐ" and ch not in "ªº" else unicodedata.name(ch, "").split(" ")[0]


@functools.lru_cache(maxsize=1 << 16)
def compat(ch: str) -> str:
    """``ch`` in its ordinary width and without ligature; other compatibility forms stay."""
    kind = unicodedata.decomposition(ch)
    if kind.startswith(("<wide>", "<narrow>", "<font>", "<initial>", "<medial>", "<final>", "<isolated>")):
        return unicodedata.normalize("NFKC", ch)
    if kind.startswith("<compat>") and (ch.isalpha() or unicodedata.category(ch) == "Nl"):
        flat = unicodedata.normalize("NFKC", ch)
        return flat if flat.isalpha() else ch
    return ch


def strip(text: str) -> str:
    """Widths, ligatures, split accents, invisible characters and spaces settled by table; emoji sequences untouched."""
    out, at = [], 0
    for m in _EMOJI.finditer(text):
        if len(m.group()) > 1 or not m.group().isascii():
            out += [_settle(text[at : m.start()]), m.group()]
            at = m.end()
    out.append(_settle(text[at:]))
    return "".join(out)


def _settle(part: str) -> str:
    if _PLAIN.fullmatch(part):
        return part
    part = _SPACES.sub(" ", _INVISIBLE.sub("", part))
    return unicodedata.normalize("NFC", "".join(map(compat, part)))


@functools.cache
def _alphabet(locale: str) -> frozenset[str]:
    extra = EXTRA_LETTERS.get(locale)
    return frozenset(extra + extra.upper().replace("SS", "")) | ({"İ"} if locale == "tr" else set()) if extra is not None else frozenset()


def ordinary(token: str, locale: str) -> bool:
    """Whether a settled token has only letters of the locale's own alphabet, or plain Latin ones alone."""
    home = SCRIPT_OF.get(locale, "LATIN")
    if token.isascii():
        return True
    own = _alphabet(locale)
    if home == "LATIN":
        return all(c < "\x80" or c in own for c in token)
    return all(script(c) == home for c in token) and not any(c in NEIGHBOURS.get(locale, ()) for c in token)


# Letters of the other scripts' ordinary spelling, composed.
HOME_LETTERS = {"el": "Α-Ωα-ωςΆΈΉΊΌΎΏΪΫάέήίόύώϊϋΐΰ", "he": "א-ת", "bg": "А-яѝЍ"}
# Marks that ordinary texts of any locale have.
MARKS = "“”‘’„‚«»‹›–—…•·€£°׳״"


@functools.cache
def _twins_of(locale: str) -> frozenset[str]:
    """Plain Latin letters that look like one of a locale's own, other script."""
    return frozenset(c for c in LATIN_LIKE.get(SCRIPT_OF.get(locale, ""), {}).values() if c.isascii())


def disguised(token: str, locale: str) -> bool:
    """Whether a wholly Latin token of a locale of another script may be a word of that script."""
    twins = _twins_of(locale)
    return bool(twins) and all(c in twins for c in token)


@functools.cache
def _untouched(locale: str) -> re.Pattern:
    """Texts in which every word is ordinary and every sign known: they are their own form."""
    signs = rf"\x00-@\[-`{{-\x7f{MARKS}"
    if locale in HOME_LETTERS:
        own, twins = HOME_LETTERS[locale], "".join(sorted(_twins_of(locale)))
        latin = rf"(?![{twins}]+(?![A-Za-z]))[A-Za-z]+" if twins else "[A-Za-z]+"
        return re.compile(rf"(?:{latin}(?![{own}])|[{own}]+(?![A-Za-z])|[{signs}]+)*+")
    return re.compile(rf"[A-Za-z{signs}{''.join(sorted(_alphabet(locale)))}]*+")


@functools.cache
def _alternatives() -> dict[str, tuple[str, ...]]:
    """Character of a decomposed token -> characters of a vocabulary word that look the same."""
    groups: dict[str, set[str]] = {}

    def alike(a: str, b: str) -> None:
        both = groups.setdefault(a, {a}) | groups.setdefault(b, {b})
        for x in both:
            groups[x] = both

    for table in LATIN_LIKE.values():
        for a, b in table.items():
            alike(a, b)
    for a, b in LATIN_TWINS.items():
        alike(a, b)
    alike("β", "ß")
    out = {c: tuple(sorted(g)) for c, g in groups.items()}
    for a, b in MARK_TWINS:
        out[a], out[b] = tuple(sorted({*out.get(a, (a,)), b})), tuple(sorted({*out.get(b, (b,)), a}))
    return out


@functools.cache
def _classes() -> dict[str, str]:
    """Character -> what stands for all that look like it or like its other case, directly or through others."""
    parent: dict[str, str] = {}

    def root(c: str) -> str:
        while parent.get(c, c) != c:
            c = parent[c]
        return c

    pairs = [(a, b) for a, ways in _alternatives().items() for b in ways]
    pairs += [(c, low) for x in pairs for c in x for low in [c.lower()] if len(low) == 1]
    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {c: root(c) for x in pairs for c in x}


def skeleton(token: str) -> str:
    """A key that two tokens share if a trie can lead from the one to the other, or if they differ in case only."""
    classes = _classes()
    flat = unicodedata.normalize("NFD", _INVISIBLE.sub("", "".join(map(compat, token))))
    return "".join(classes.get(x, x) for c in flat for x in c.lower())


class Trie:
    """Vocabulary words in decomposed form; a node is a dict, and "" holds (count, spelling)."""

    def __init__(self, words: dict[str, int]):
        self.root: dict = {}
        for word, n in words.items():
            node = self.root
            for c in unicodedata.normalize("NFD", word):
                node = node.setdefault(c, {})
            if n > node.get("", (0, ""))[0]:
                node[""] = (n, word)

    def spellings(self, token: str) -> list[tuple[int, str]]:
        """(count, spelling) of the words that a token matches at no cost, the most frequent first."""
        alternatives = _alternatives()
        states = [self.root]
        for c in unicodedata.normalize("NFD", "".join(map(compat, token))):
            if _INVISIBLE.match(c):
                continue
            ways = alternatives.get(c, (c,))
            states = [s[w] for s in states for w in ways if w in s]
            if not states:
                return []
        return sorted((s[""] for s in states if "" in s), key=lambda x: (-x[0], x[1]))


def by_table(token: str, locale: str) -> str:
    """A token of several scripts, or with foreign letters, in the script it is mostly written in."""
    home = SCRIPT_OF.get(locale, "LATIN")
    near = NEIGHBOURS.get(locale, {})
    token = "".join(LATIN_TWINS.get(c, c) for c in token)
    kinds = [script(c) for c in token]
    if len(set(kinds)) > 1:
        most = max(set(kinds), key=lambda k: (kinds.count(k), k == home, k == "LATIN"))
        if home in kinds and _fits(token, home):
            most = home
        elif not _fits(token, most):
            most = next((k for k in sorted(set(kinds)) if _fits(token, k)), most)
        token = "".join(_to(c, most) for c in token)
    return "".join(near.get(c, c) for c in token)


def _fits(token: str, kind: str) -> bool:
    return all(script(c) == kind or script(_to(c, kind)) == kind for c in token)


@functools.lru_cache(maxsize=1 << 14)
def _to(ch: str, kind: str) -> str:
    """``ch`` in script ``kind`` if it has a look-alike there; accents are kept."""
    if script(ch) == kind:
        return ch
    base, *marks = unicodedata.normalize("NFD", ch)
    plain = LATIN_LIKE.get(script(base), {}).get(base, base)
    if kind != "LATIN":
        plain = {b: a for a, b in reversed(LATIN_LIKE.get(kind, {}).items())}.get(plain, plain)
    new = unicodedata.normalize("NFC", "".join([plain, *marks]))
    return new if script(new[0]) == kind else ch


class Canonicalizer:
    """Brings values into their one form, given the vocabulary of each locale."""

    def __init__(self, vocabulary: dict[str, dict[str, int]]):
        home = {k: {w: n for w, n in v.items() if k not in SCRIPT_OF or script(w[0]) == SCRIPT_OF[k]} for k, v in vocabulary.items()}
        self.counts = vocabulary
        self.words = {k: frozenset(w.lower() for w in v) for k, v in home.items()}
        self.tries = {k: Trie(v) for k, v in home.items()}
        self.foreign: dict[str, set[str]] = {}
        for locale, words in self.words.items():
            if (kind := SCRIPT_OF.get(locale)) is not None:
                self.foreign.setdefault(kind, set()).update(w for w in words if script(w[0]) == kind)
        self.memo: dict[tuple[str, str, bool], str] = {}

    def token(self, token: str, locale: str, beside: bool) -> str:
        """``beside``: a neighbouring token is wholly of this token's other script, so that script is meant."""
        if ordinary(token, locale):
            return token
        if len(self.memo) > 1 << 17:
            self.memo.clear()
        key = (token, locale, beside)
        if key not in self.memo:
            self.memo[key] = self._token(token, locale, beside)
        return self.memo[key]

    def _token(self, token: str, locale: str, beside: bool) -> str:
        home = SCRIPT_OF.get(locale, "LATIN")
        kinds = {script(c) for c in token}
        if kinds != {home} and len(kinds) == 1 and home == "LATIN":
            kind = next(iter(kinds))
            if beside or self._sure(token):
                return token
            if (found := self.tries[locale].spellings(token) if locale in self.tries else []):
                return _case_like(found[0][1], token)
            return token if token.lower() in self.foreign.get(kind, ()) else "".join(_to(c, home) for c in token)
        for form in (token, token.lower()):
            if form.lower() in self.words.get(locale, ()):
                return token
            if locale in self.tries and (found := self.tries[locale].spellings(form)):
                return _case_like(found[0][1], token)
        return by_table(token, locale)

    def _home_word(self, token: str, locale: str) -> str:
        """The word of the home script behind a wholly Latin token beside words of that script, if it is far more frequent."""
        found = self.tries[locale].spellings(token) if locale in self.tries else []
        least = max(HOME_LEAST, HOME_TIMES * self.counts.get(locale, {}).get(token, 0))
        return found[0][1] if found and found[0][0] >= least else token

    def value(self, text: str, locale: str) -> str:
        if _untouched(locale).fullmatch(text):
            return text
        settled = strip(text)
        if settled.isascii():
            return settled
        spans = list(_TOKEN.finditer(settled))
        scripts = [{script(c) for c in m.group()} for m in spans]
        out, at = [], 0
        for i, m in enumerate(spans):
            near = [s for j in (i - 1, i + 1) if 0 <= j < len(spans) for s in [scripts[j]]]
            if SCRIPT_OF.get(locale) and disguised(m.group(), locale) and {SCRIPT_OF[locale]} in near:
                out += [settled[at : m.start()], self._home_word(m.group(), locale)]
                at = m.end()
                continue
            beside = len(scripts[i]) == 1 and any(s == scripts[i] and self._sure(spans[j].group()) for j, s in zip([k for k in (i - 1, i + 1) if 0 <= k < len(spans)], near))
            out += [settled[at : m.start()], self.token(m.group(), locale, beside)]
            at = m.end()
        return "".join([*out, settled[at:]])

    def _sure(self, token: str) -> bool:
        """Whether a token of another script can't be a Latin word in disguise."""
        return not all(c in LATIN_LIKE.get(script(c), {}) for c in token)


def _case_like(word: str, token: str) -> str:
    if len(word) == len(token):
        return "".join(w.upper() if t.isupper() and len(w.upper()) == 1 else w for w, t in zip(word, token))
    return word[:1].upper() + word[1:] if token[:1].isupper() else word


def vocabulary(values: DataFrame, value_col: str, locale_col: str) -> DataFrame:
    """``locale word n``: the ordinary words of all values that occur twice or more; counted per task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], int] = {}

        def out() -> pa.RecordBatch:
            keys = list(counts)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array(list(counts.values()), pa.int64())], ["locale", "word", "n"])

        for batch in batches:
            for text, locale in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text or locale is None:
                    continue
                home = SCRIPT_OF.get(locale, "LATIN")
                for word in _TOKEN.findall(text):
                    if ordinary(word, locale) and (home == "LATIN" or script(word[0]) == home or disguised(word, locale)):
                        counts[locale, word] = counts.get((locale, word), 0) + 1
            if len(counts) > 200_000:
                yield out()
                counts.clear()
        if counts:
            yield out()

    parts = values.select(F.col(value_col).cast("string").alias("v"), F.col(locale_col).cast("string").alias("l")).mapInArrow(run, "locale string, word string, n long")
    return parts.groupBy("locale", "word").agg(F.sum("n").alias("n")).where("n > 1")


def unusual_keys(text: str, locale: str) -> set[str]:
    """Keys under which the words are that a value's tokens may mean: those of its locale, and those of a script."""
    out = set()
    if not text.isascii() and not _untouched(locale).fullmatch(text):
        for token in _TOKEN.findall(strip(text)):
            if not ordinary(token, locale) or disguised(token, locale):
                out.add(f"{locale}\0{skeleton(token)}")
                if (kind := script(token[0])) != "LATIN":
                    out.add(f"{kind}\0{token.lower()}")
    return out


def _keyed(words: DataFrame) -> DataFrame:
    """``key words`` of a vocabulary: the words under each key, which are the spellings of one word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for locale, word, n in zip(*(c.to_pylist() for c in batch.columns)):
                rows.append((f"{locale}\0{skeleton(word)}", locale, word, n))
                if script(word[0]) == SCRIPT_OF.get(locale):
                    rows.append((f"{script(word[0])}\0{word.lower()}", locale, word, n))
            cells = list(zip(*rows)) or [[]] * 4
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in cells[:3]), pa.array(cells[3], pa.int64())], ["key", "locale", "word", "n"])

    keyed = words.select("locale", "word", "n").mapInArrow(run, "key string, locale string, word string, n long")
    return keyed.groupBy("key").agg(F.collect_list(F.struct("locale", "word", "n")).alias("words"))


def canonicalize(values: DataFrame, value_col: str, locale_col: str, out_col: str = "canonical", size: int = VOCABULARY) -> DataFrame:
    """``values`` with ``out_col``, the one form of ``value_col``.

    Null stays null, an empty text stays empty; a null or unknown locale is
    settled by table for Latin script; repeated rows stay repeated; an empty
    table stays empty. An existing column ``out_col`` is replaced. Up to
    ``size`` words of the vocabulary are handed to every task; more are joined
    with the values that need them, which gives the same forms.
    """
    counts = durable(vocabulary(values, value_col, locale_col), "vocabulary")
    rest = [c for c in values.columns if c != out_col]
    schema = T.StructType([values.schema[c] for c in rest] + [T.StructField(out_col, T.StringType())])
    typed = values.select(*rest, F.col(value_col).cast("string").alias("_v_"), F.col(locale_col).cast("string").alias("_l_"))
    if counts.count() > size:
        return _by_joins(typed, counts, schema)
    words: dict[str, dict[str, int]] = {}
    for r in counts.collect():
        words.setdefault(r.locale, {})[r.word] = r.n
    shared = values.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forms = None
        for batch in batches:
            forms = forms or Canonicalizer(shared.value)
            n = len(rest)
            made = [None if t is None else t if t.isascii() else forms.value(t, l or "") for t, l in zip(batch.column(n).to_pylist(), batch.column(n + 1).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(made, pa.string())], schema.names)

    return typed.mapInArrow(run, schema)


def _by_joins(typed: DataFrame, counts: DataFrame, schema: T.StructType) -> DataFrame:
    """:func:`canonicalize` of values with ``_v_ _l_``, every unusual one with the words it may mean."""
    rows = durable(typed.select("*", F.monotonically_increasing_id().alias("_row_")), "values")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            asked = [(row, k) for row, t, l in zip(*(c.to_pylist() for c in batch.columns)) if t for k in unusual_keys(t, l or "")]
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in asked], pa.int64()), pa.array([x[1] for x in asked], pa.string())], ["_row_", "key"])

    asked = durable(rows.select("_row_", "_v_", "_l_").mapInArrow(ask, "_row_ long, key string"), "asked")
    met = salted_join(asked, _keyed(counts), "key", "_row_", hot_keys_of(asked, "key"))
    held = met.groupBy("_row_").agg(F.flatten(F.collect_list("words")).alias("_words_"))  # the spellings of one value's unusual tokens
    names = schema.names[:-1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made, n = [], len(names)
            for t, l, words in zip(*(batch.column(n + i).to_pylist() for i in range(3))):
                if t is None or t.isascii():
                    made.append(t)
                    continue
                of: dict[str, dict[str, int]] = {}
                for w in words or ():
                    of.setdefault(w["locale"], {})[w["word"]] = w["n"]
                made.append(Canonicalizer(of).value(t, l or ""))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(made, pa.string())], schema.names)

    return rows.join(held, "_row_", "left").select(*names, "_v_", "_l_", "_words_").mapInArrow(run, schema)


def review_values(packets: DataFrame, reviews: DataFrame, glossary: DataFrame) -> DataFrame:
    """``tab rec_key locale value`` of the three places that hold typed values; one row per distinct record and value."""
    a = packets.select("packet_no", "locale", F.explode("entries").alias("e"))
    a = a.select(F.lit("editor_packets").alias("tab"), F.concat(F.col("packet_no").cast("string"), F.lit(":"), "e.id").alias("rec_key"), "locale", F.col("e.text").alias("value"))
    b = reviews.select("review_no", "locale", F.posexplode("findings").alias("n", "f"))
    b = b.select(F.lit("fidelity_reviews").alias("tab"), F.concat(F.col("review_no").cast("string"), F.lit(":"), (F.col("n") + 1).cast("string")).alias("rec_key"), "locale", F.col("f.target_span").alias("value"))
    c = glossary.select(F.lit("glossary_open").alias("tab"), F.col("item_no").cast("string").alias("rec_key"), "locale", F.col("recommended").alias("value"))
    return a.union(b).union(c)
