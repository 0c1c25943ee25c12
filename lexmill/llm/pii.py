"""Personal information in free text by bootstrapped contextual extraction.

Email addresses are certain by their form and are, with a few cue words, the
seeds. Other candidates (number-like strings, runs of capitalised words, lines
with a street) are collected over all documents together with the words beside
them. On the graph between contexts and instances (shapes of numbers, name
tokens, shapes of addresses) the seeds' confidence spreads: a context is as good
as the instances it holds, an instance as good as the contexts it stands in.
Contexts and instances of high confidence then decide on every candidate.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections import defaultdict
from collections.abc import Iterable, Iterator, Sequence
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmill.operators.skew import hot_keys_of, salted_join
from lexmill.session import durable

#: Rounds over the graph, and the confidence that accepts.
ROUNDS = 4
ACCEPT = 0.5
#: Contexts and instances that are handed to the executors, if there are no more of either; else the candidates are joined with them.
LEXICON = 100_000
#: Confidence from which a context or an instance counts.
KNOWN = 0.2
#: Times a context must occur to be trusted.
SUPPORT = 3
#: Occurrences that the form of a number or an address counts as; with more of them the graph decides.
PRIOR = 5.0

# Words that introduce a number of a kind (parts of words, lower case).
CUES = {
    "phone": ("tel", "phone", "mobil", "call", "cell", "fax", "τηλ", "κιν", "handy", "whatsapp"),
    "id_number": ("passport", "ssn", "ident", "dni", "nie", "cnp", "kimlik", "személyi", "ausweis", "ταυτότητας", "nino", "national", "numărul", "seria", "insurance"),
    "person": ("regards", "sincerely", "signed", "cheers", "grüßen", "gruß", "cordialement", "à vous", "saludo", "saludos", "atentamente", "cu drag", "cu stimă", "üdvözlettel", "tisztelettel", "saygılarımla", "sevgiler", "εκτίμηση", "χαιρετισμούς"),
}
# Words for a street after its name, before it, and as its ending.
STREET_AFTER = r"street|st|road|rd|lane|ln|avenue|ave|drive|court|close|terrace|square|crescent|utca|utcája|út|útja|tér|köz|körút|sok|sokak|sokağı|cad|cadde|caddesi|mah|mahallesi"
STREET_BEFORE = r"rue|avenue|boulevard|chemin|impasse|quai|allée|calle|avenida|plaza|paseo|strada|str|bulevardul|aleea|calea|οδός|λεωφόρος|πλατεία|via|piazza"
STREET_WORDS = f"{STREET_AFTER}|{STREET_BEFORE}"
STREET_ENDINGS = "straße|strasse|weg|gasse|platz|allee|damm|ufer"
_U = "A-ZÀ-ÖØ-ÞĀ-ŽȘȚΆ-Ϋ"
_STREET = re.compile(
    rf"(?<=[^\W\d_] )(?i:{STREET_AFTER})\b|(?i:\b(?:{STREET_BEFORE})\b)(?=\.? (?:d[eu] |des |la |le |del )*[{_U}])|(?<![^\W\d_])[^\W\d_]{{3,}}(?:{STREET_ENDINGS})\b"
)

_AT = r"(?: ?@ ?| ?[\[(] ?at ?[\])] ?|(?<=\w) at (?=[\w-]+(?: dot | ?[\[(] ?dot)))"
_DOT = r"(?:\.| ?[\[(] ?dot ?[\])] ?| dot )"
EMAIL = re.compile(rf"(?i)(?<![\w.+%-])[a-z0-9][\w.+%-]*{_AT}[a-z0-9][a-z0-9-]*(?:{_DOT}[a-z0-9-]+)*{_DOT}[a-z]{{2,}}(?![\w])")
_FILES = re.compile(r"(?i)\.(?:png|jpe?g|gif|svg|webp|pdf|json|xml)$")

_SEP = r"(?: ?[-./–] ?| ?\(\d{1,4}\) ?| )"
NUMBER = re.compile(
    rf"(?<![\w.`$%/-])(?:[A-ZΑ-Ω]{{1,2}} ?\d(?:[ -]?\d|[A-Z](?=\d))*(?: ?[A-Z](?!\w))?|(?:\+ ?)?(?:\(\d{{1,4}}\) ?)?\d+(?:{_SEP}\d+)*(?:-?[A-Z])?)(?![\w`])"
)
_UP = "A-ZÀ-ÖØ-ÞĀĂĄĆĈĊČĎĐĒĔĖĘĚĜĞĠĢĤĦĨĪĬĮİĲĴĶĹĻĽĿŁŃŅŇŊŌŎŐŒŔŖŘŚŜŞŠŢŤŦŨŪŬŮŰŲŴŶŸŹŻŽȘȚΆΈ-ΏΑ-ΫА-Я"
_CAP = rf"[{_UP}][^\W\d_]+(?:['’][^\W\d_]+)?"
_NAMED = rf"{_CAP}(?:-{_CAP})*"
# The first letter comes before the look behind it, which lets the search skip to capitals.
NAME = re.compile(rf"[{_UP}](?<![\w'’`.@-][{_UP}])(?:[^\W\d_]+(?:['’][^\W\d_]+)?(?:-{_CAP})*|\.)(?: (?:{_NAMED}|[{_UP}]\.(?= [{_UP}]))){{1,3}}(?![\w`@])")
_PART = rf"(?<!\w)(?:(?i:no)\b:|[{_UP}][\w'’-]*\.?|\d+[A-Za-z]{{0,2}}(?:/\d+)?(?:\.º|º|ª)?(?!\w)|(?i:nr|bl|ap|et|sc|no|bis|ter|de|du|des|la|le|del|των|του|της|utca|utcája|út|útja|tér|köz|körút|rue|avenue|chemin|quai|boulevard|allée|calle|strada|str|sok|cad|mah|kat|ajtó|em|fszt|daire)\b[.:]?)"
_ADDRESS = re.compile(rf"{_PART}(?:,? {_PART})*")
_DOTTED = re.compile(r"(?i)^(?:st|rd|ave|str|nr|bl|ap|et|sc|no|mah|sok|cad|em|bd|av)\.$")

KINDS = ("email", "phone", "id_number", "address", "person")


@functools.lru_cache(maxsize=1 << 17)
def fold(text: str) -> str:
    flat = unicodedata.normalize("NFKD", text.replace("ı", "i").replace("ł", "l").replace("Ł", "L"))
    return "".join(c for c in flat if not unicodedata.combining(c)).lower()


class Candidate(NamedTuple):
    group: str  # email, number, address, person
    start: int
    end: int
    instances: Sequence[str]
    contexts: Sequence[str]


def contexts(text: str, start: int, end: int, names: bool = False) -> list[str]:
    """The two words to the left, the two to the right and, but for names, one of each, within the line.

    ``text`` has only ``\\n`` as line break. Numbers become 9, lower case, and
    capitalised words that are likely names X.
    """
    low = start - 36 if start > 36 else 0
    line = text.rfind("\n", low, start)
    a = text[line + 1 if line >= 0 else low : start].rsplit(None, 2)[-2:]
    if len(a) < 2 and (line >= 0 or not low):
        a.insert(0, "^")
    right = text[end : end + 30]
    line = right.find("\n")
    b = (right if line < 0 else right[:line]).split(None, 2)[:2] or ["$"]
    a = a or ["^"]
    if len(a) > 1 and a[0][0].isupper() and (names or a[1][0].isupper()):
        a[0] = "X"
    if len(b) > 1 and b[1][0].isupper():
        b[1] = "X"
    if names:
        # a place at the edge of a line, or between signs, tells nothing about a name
        told = [f"l {' '.join(a)}"] if a[-1][0].isalnum() or a[-1][-1].isalnum() else []
        if b[0][0].islower() or (len(b) > 1 and b[1][0].islower()):
            told.append(f"r {' '.join(b)}")
        return _DIGITS.sub("9", "\0".join(told)).lower().split("\0") if told else []
    return _DIGITS.sub("9", f"l {' '.join(a)}\0r {' '.join(b)}\0b {a[-1]} _ {b[0]}").lower().split("\0")


_DIGITS = re.compile(r"\d+")


def number_shape(span: str) -> str:
    return re.sub(r"[A-ZΑ-Ω]", "A", re.sub(r"\d", "9", span))


@functools.cache
def _needles() -> ahocorasick.Automaton:
    """Finds where a street word may be (with what must stand around it); the pattern then looks at these places only."""
    out = ahocorasick.Automaton()
    for w in STREET_AFTER.split("|"):
        for c in " ,.;:\n|)-":
            out.add_word(f" {w}{c}", (len(w) + 1, False))
    for w in STREET_BEFORE.split("|"):
        for c in (" ", ". "):
            out.add_word(w + c, (len(w) + len(c), False))
    for w in STREET_ENDINGS.split("|"):
        out.add_word(w, (len(w), True))
    out.make_automaton()
    return out


def street_hits(text: str) -> Iterator[re.Match]:
    low = text.lower()
    if len(low) != len(text):  # a few letters get longer in lower case
        yield from _STREET.finditer(text)
        return
    last = -1
    for end, (size, glued) in _needles().iter(low + "\n"):
        at = end - size + 1
        while glued and at and low[at - 1].isalpha():
            at -= 1
        if at > last and (m := _STREET.match(text, at)) is not None:
            last = m.end()
            yield m


_DIGIT_RUN = re.compile(r"\d[\dA-ZΑ-Ω ./()–-]{4,}[\dA-Z]")


def number_spans(text: str) -> Iterator[tuple[int, int]]:
    """Spans of seven or more characters; runs of digits are found first, the pattern looks around them only."""
    last = 0
    for run in _DIGIT_RUN.finditer(text):
        at = max(last, run.start() - 8)
        while (m := NUMBER.search(text, at)) is not None and m.start() < run.end():
            at = last = m.end()
            if m.end() - m.start() >= 7:
                yield m.span()


def email_spans(text: str) -> Iterator[tuple[int, int]]:
    """Addresses around each sign for at, of any length: the local part is walked back to its start."""
    last = 0
    # the written-out forms are rare, and a single sign is found much faster
    low = text.lower()
    written = any(x in low for x in _WRITTEN)
    for m in (_AT_SIGN if written else _AT_ONLY).finditer(text):
        at = m.start()
        if at < last:
            continue
        start = at - 1 if at and text[at - 1] == " " else at
        while start > last and (text[start - 1].isalnum() or text[start - 1] in "_.+%-"):
            start -= 1
        while start < at and not (text[start].isascii() and text[start].isalnum()):
            start += 1
        e = EMAIL.match(text, start)
        if e is not None and at < e.end() and not _FILES.search(e.group()):
            last = e.end()
            yield e.span()


_AT_ONLY = re.compile(r"@")
_WRITTEN = ("at]", "at)", "at ]", "at )", " dot ", "[dot", "(dot", "[ dot", "( dot")
_AT_SIGN = re.compile(r"(?i)@|[\[(] ?at ?[\])]| at (?=[\w-]+(?: dot | ?[\[(] ?dot))", re.ASCII)


def address_spans(text: str) -> Iterator[tuple[int, int]]:
    """Runs of address parts around a word for a street, within one line, with a number in them; each line is read once."""
    last, end_of_line = -1, -1
    runs: Iterator[re.Match] = iter(())
    run: re.Match | None = None
    for hit in street_hits(text):
        if hit.start() < last:
            continue
        if hit.start() > end_of_line:
            a = max(text.rfind("\n", 0, hit.start()), text.rfind("\r", 0, hit.start())) + 1
            end_of_line = min(x for x in (text.find("\n", hit.end()), text.find("\r", hit.end()), len(text)) if x >= 0)
            runs = _ADDRESS.finditer(text, a, end_of_line)
            run = next(runs, None)
        while run is not None and run.end() <= hit.start():
            run = next(runs, None)
        if run is not None and run.start() <= hit.start():
            start, end = _trim(text, run.start(), run.end(), hit.start())
            if start <= hit.start() < end and any(c.isdigit() for c in text[start:end]):
                last = end
                yield start, end


def _trim(text: str, start: int, end: int, hit: int) -> tuple[int, int]:
    """Cuts the run at full stops that belong to no abbreviation and drops dangling parts."""
    pieces = list(re.finditer(r"\S+", text[start:end]))
    first, final = 0, len(pieces)
    for i, p in enumerate(pieces):
        word = p.group().rstrip(",")
        if word.endswith(".") and not _DOTTED.match(word):
            if start + p.end() <= hit:
                first = i + 1
            else:
                final = i + 1
                break
    while final > first and pieces[final - 1].group().lower().strip(".,") in ("de", "du", "des", "la", "le", "del", "no", "a", "i"):
        final -= 1
    if first >= final:
        return end, end
    last = pieces[final - 1]
    stop = start + last.end() - (1 if last.group()[-1] in ".," else 0)
    begin = start + pieces[first].start()
    # a run may begin with the word of a sentence, which an address part does not follow by a comma or number
    while first < final - 1 and re.fullmatch(rf"[{_UP}][^\W\d_]*", pieces[first].group()) and re.match(r"(?i)(?:de|du|des|la|le|del)\b", pieces[first + 1].group()) and not _STREET.match(pieces[first].group()):
        first += 2
        if first >= final:
            return end, end
        begin = start + pieces[first].start()
    return begin, _town_end(text, begin, stop)


def _town_end(text: str, begin: int, end: int) -> int:
    """Ends the last part of an address before what begins another item: a cue word, or a third capitalised word after the town."""
    at = text.rfind(",", begin, end) + 1
    words = list(re.finditer(r"\S+", text[at:end])) if at > begin else []
    named = [i for i, w in enumerate(words) if w.group()[0].isupper() and w.group()[-1].islower()]
    for i in named[1:]:
        if any(words[i].group().lower().startswith(c) for c in _OTHER_ITEM):
            return at + words[i - 1].end()
    return at + words[named[1] - 1].end() if len(named) > 2 else end


_OTHER_ITEM = (*CUES["phone"], *CUES["id_number"], "e-mail", "email", "mail")


def address_shape(span: str) -> str:
    words = []
    for w in re.findall(r"[^\W\d_]+|\d+|,", span):
        street = re.fullmatch(rf"(?i:{STREET_WORDS})|[^\W\d_]{{3,}}(?:{STREET_ENDINGS})", w)
        words.append("9" if w.isdigit() else "S" if street else "," if w == "," else "N" if w[0].isupper() and len(w) > 1 else w.lower() if len(w) > 1 else "a")
    return " ".join(words)


_forms: dict[str, str] = {}


def name_forms(name: str) -> list[str]:
    """The form of each token; tokens repeat, whole names hardly do."""
    out = []
    for token in name.replace("-", " ").split():
        form = _forms.get(token)
        if form is None:
            if len(_forms) > 200_000:
                _forms.clear()
            form = _forms[token] = name_form(fold(token))
        out.append(form)
    return out


def name_form(token: str) -> str:
    """What stands for a (folded) name token in the graph: itself if short, else its ending, which family names share."""
    return token if len(token) < 7 else "~" + token[-5:]


def candidates(text: str, judge: Judge | None = None) -> Iterator[Candidate]:
    """Candidates of a text; what an email or an address covers belongs to no other one.

    With a ``judge`` names are left out that it can't accept: all their tokens
    unknown, and beside no word that is beside names.
    """
    text = text.replace("\r", "\n")
    spans = list(email_spans(text))
    for a, b in spans:
        yield Candidate("email", a, b, (), ())
    text = _blanked(text, spans)
    spans = list(address_spans(text))
    for a, b in spans:
        yield Candidate("address", a, b, (address_shape(text[a:b]),), contexts(text, a, b))
    text = _blanked(text, spans)
    for a, b in number_spans(text):
        span = text[a:b]
        if sum(map(str.isdigit, span)) >= 6:
            yield Candidate("number", a, b, (number_shape(span),), contexts(text, a, b))
    for m in NAME.finditer(text):
        a, b = m.span()
        name = m.group()
        if "." in name:
            name = _INITIAL.sub(" ", name)
        tokens = name_forms(name)
        if judge and judge.names.isdisjoint(tokens) and not judge.beside(text, a, b):
            continue
        if tokens:
            yield Candidate("person", a, b, tokens, contexts(text, a, b, True))


def _blanked(text: str, spans: list[tuple[int, int]]) -> str:
    """The text with spans (in order) as zeros of equal length."""
    out, at = [], 0
    for a, b in spans:
        out += [text[at:a], "\0" * (b - a)]
        at = b
    return "".join([*out, text[at:]]) if out else text


_INITIAL = re.compile(r"(?<!\w)\w\.")


def email_tokens(span: str) -> set[str]:
    """Name-like parts of the local part, also without an initial glued to them."""
    local = re.split(rf"(?i){_AT}", span)[0]
    parts = [p for p in re.split(r"[^a-z]+", fold(local)) if len(p) > 3]
    return {name_form(x) for p in parts for x in ((p, p[1:]) if len(p) > 5 else (p,))}


def evidence(docs: DataFrame, text_col: str) -> DataFrame:
    """``grp context instance n``: the graph, counted per task before the shuffle; ``grp`` seed holds the emails' name parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: defaultdict[tuple[str, str], defaultdict[str, int]] = defaultdict(lambda: defaultdict(int))

        def out() -> pa.RecordBatch:
            rows = [(g, x, i, n) for (g, x), d in seen.items() for i, n in d.items()]
            columns = list(zip(*rows)) or [[]] * 4
            return pa.RecordBatch.from_arrays([*(pa.array(c, pa.string()) for c in columns[:3]), pa.array(columns[3], pa.int64())], ["grp", "context", "instance", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                for group, start, end, instances, places in candidates(text) if text else ():
                    if group == "email":
                        for t in email_tokens(text[start:end]):
                            seen["seed", ""][t] += 1
                    else:
                        for x in places:
                            d = seen[group, x]
                            for i in instances:
                                d[i] += 1
            if len(seen) > 20_000:
                yield out()
                seen.clear()
        if seen:
            yield out()

    parts = docs.select(F.col(text_col).cast("string").alias("t")).mapInArrow(run, "grp string, context string, instance string, n long")
    return parts.groupBy("grp", "context", "instance").agg(F.sum("n").alias("n"))


def bootstrap(graph: DataFrame, rounds: int = ROUNDS) -> tuple[DataFrame, DataFrame]:
    """``kind context c`` and ``kind instance score``: the confidences of KNOWN or more, from the seeds."""
    cue = lambda kind: F.lower("context").rlike(r"^[lb] .*(?:" + "|".join(CUES[kind]) + ")")
    links = graph.where("grp != 'seed'")
    kinds = F.when(F.col("grp") == "number", F.array(F.lit("phone"), F.lit("id_number"))).otherwise(F.array("grp"))
    links = durable(links.select(F.explode(kinds).alias("kind"), "context", "instance", "n"), "graph")
    tokens = graph.where("grp = 'seed'").select(F.lit("person").alias("kind"), "instance", F.lit(1.0).alias("seed"))
    shaped = links.where("kind != 'person'").select("kind", "instance").distinct()
    shaped = shaped.select(
        "kind", "instance",
        F.when(F.col("kind") == "phone", F.col("instance").startswith("+").cast("double"))
        .when(F.col("kind") == "id_number", (F.col("instance").contains("A")).cast("double"))
        .otherwise(F.col("instance").rlike(r"(?:^| )(?:N S 9|9 a?,? ?N S|S (?:de |du |des |la )*N|S 9,|a?,? ?N S|S 9 a?)(?: |$)").cast("double")).alias("seed"),
    ).where("seed > 0")
    seeds = durable(shaped.union(tokens), "seeds")
    cued = F.when(cue("phone") & (F.col("kind") == "phone"), 1.0).when(cue("id_number") & (F.col("kind") == "id_number"), 1.0)
    greeting = r"^l .*(?:" + "|".join(CUES["person"]) + r")[,:.]?(?: -)?$"
    cued = cued.when(F.lower("context").rlike(greeting) & (F.col("kind") == "person"), 1.0)
    against = F.when((cue("phone") & (F.col("kind") == "id_number")) | (cue("id_number") & (F.col("kind") == "phone")), 0.0)
    scored = seeds.withColumnRenamed("seed", "score")
    context = None
    for _ in range(rounds):
        by = links.join(scored, ["kind", "instance"], "left").groupBy("kind", "context").agg(
            F.sum("n").alias("all"), F.sum(F.col("n") * F.coalesce("score", F.lit(0.0))).alias("good")
        )
        by = by.where((F.col("all") >= SUPPORT) | (cued == 1.0))
        context = durable(by.select("kind", "context", "all", F.coalesce(cued, against, F.col("good") / (F.col("all") + 0.5)).alias("c")), "contexts")
        sides = links.join(context.select("kind", "context", "c"), ["kind", "context"], "left").groupBy("kind", "instance", F.substring("context", 1, 1).alias("side")).agg(
            F.sum("n").alias("all"), F.sum(F.col("n") * F.coalesce("c", F.lit(0.0))).alias("good")
        )
        # the words on one side may tell a kind while those on the other tell nothing
        best = sides.groupBy("kind", "instance").agg(F.sum("all").alias("all"), F.sum("good").alias("good"), F.max_by("all", F.col("good") / F.col("all")).alias("side_all"), F.max_by("good", F.col("good") / F.col("all")).alias("side_good"))
        best = best.join(seeds, ["kind", "instance"], "left")
        # parts of email addresses are names; a shape only speaks for itself while it is rare
        shaped = F.when(F.col("kind") != "person", (F.col("seed") * PRIOR + F.col("side_good")) / (F.col("side_all") + PRIOR))
        score = F.coalesce(shaped, F.greatest("seed", F.col("good") / (F.col("all") + 0.5)))
        scored = durable(best.select("kind", "instance", "all", score.alias("score")), "instances")
        final = scored
        scored = scored.select("kind", "instance", "score")
    return context.where(F.col("c") >= KNOWN).select("kind", "context", "c"), final.where(F.col("score") >= KNOWN).select("kind", "instance", "score")


def lexicon(*tables: DataFrame) -> tuple[dict[tuple[str, str], float], ...] | None:
    """The confidences of each table by its two keys; None if one has over LEXICON of them."""
    if any(df.count() > LEXICON for df in tables):
        return None
    return tuple({(r[0], r[1]): r[2] for r in df.collect()} for df in tables)


class Judge:
    def __init__(self, contexts: dict[tuple[str, str], float], instances: dict[tuple[str, str], float]):
        self.contexts, self.instances = contexts, instances
        self.names = {i for k, i in instances if k == "person"}
        strong = [x.split(" ") for (k, x), c in contexts.items() if k == "person" and c >= 0.8]
        self.before = {x[-1] for x in strong if x[0] == "l"}
        self.after = {x[1] for x in strong if x[0] == "r"}

    def beside(self, text: str, start: int, end: int) -> bool:
        left, right = text[max(0, start - 30) : start].rsplit(None, 1), text[end : end + 24].split(None, 1)
        return bool(left and left[-1].lower() in self.before) or bool(right and right[0].lower() in self.after)

    def kind(self, c: Candidate) -> str | None:
        if c.group == "email":
            return "email"
        kinds = ("phone", "id_number") if c.group == "number" else (c.group,)
        best = max(((self.confidence(c, k), k) for k in kinds), key=lambda x: x[0])
        return best[1] if best[0] >= ACCEPT else None

    def confidence(self, c: Candidate, kind: str) -> float:
        """For names every token counts, or the context; for shapes the context and the shape support each other."""
        context = max((self.contexts.get((kind, x), 0.0) for x in c.contexts), default=0.0)
        known = [self.instances.get((kind, i), 0.0) for i in c.instances]
        if kind == "person":
            return max(context, min(known) if len(known) > 1 else 0.0) if max(known, default=0.0) > 0 or context >= 0.8 else 0.0
        return 1 - (1 - context) * (1 - max(known, default=0.0))


def joined(docs: DataFrame, contexts: DataFrame, instances: DataFrame) -> DataFrame:
    """``row kind start end span`` of ``row text``: what a :class:`Judge` of all contexts and instances accepts, by joins with them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (whole.slice(k, 500) for whole in batches for k in range(0, whole.num_rows, 500)):
            rows = [
                (row, n, c.group, c.start, c.end, text[c.start : c.end], list(c.instances), list(c.contexts))
                for row, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for n, c in enumerate(candidates(text) if text else ())
            ]
            cells = list(zip(*rows)) or [[]] * 8
            words = pa.list_(pa.string())
            kinds = (pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string(), words, words)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cells, kinds)], ["row", "n", "grp", "start", "end", "span", "instances", "contexts"])

    schema = "row long, n int, grp string, start long, end long, span string, instances array<string>, contexts array<string>"
    found = durable(docs.select("row", "text").mapInArrow(run, schema), "candidates")
    kinds = F.when(F.col("grp") == "number", F.array(F.lit("phone"), F.lit("id_number"))).otherwise(F.array("grp"))
    asked = found.where("grp != 'email'").withColumn("kind", F.explode(kinds))

    def known(table: DataFrame, key: str, value: str, values: str) -> DataFrame:
        name = lambda k: F.concat_ws("\0", "kind", k).alias("key")
        of = asked.select("row", "n", "kind", F.explode(values).alias("x")).select("row", "n", "kind", name("x"))
        return salted_join(of, table.select(name(key), value), "key", "row", hot_keys_of(of, "key")).select("row", "n", "kind", value)

    told = known(contexts, "context", "c", "contexts").withColumn("score", F.lit(None).cast("double"))
    told = told.unionByName(known(instances, "instance", "score", "instances").withColumn("c", F.lit(None).cast("double")))
    told = told.groupBy("row", "n", "kind").agg(
        F.coalesce(F.max("c"), F.lit(0.0)).alias("c"), F.coalesce(F.max("score"), F.lit(0.0)).alias("most"), F.min("score").alias("least"), F.count("score").alias("scores")
    )
    told = told.join(found.select("row", "n", "start", "end", "span", F.size("instances").alias("tokens")), ["row", "n"])
    every = F.when((F.col("tokens") > 1) & (F.col("scores") == F.col("tokens")), F.col("least")).otherwise(0.0)
    name = F.when((F.col("most") > 0) | (F.col("c") >= 0.8), F.greatest("c", every)).otherwise(0.0)
    told = told.withColumn("sure", F.when(F.col("kind") == "person", name).otherwise(1 - (1 - F.col("c")) * (1 - F.col("most"))))
    best = told.groupBy("row", "n").agg(F.max(F.struct("sure", (F.col("kind") == "phone").alias("first"), "kind", "start", "end", "span")).alias("b"))
    accepted = best.where(F.col("b.sure") >= ACCEPT).select("row", "b.kind", "b.start", "b.end", "b.span")
    return accepted.union(found.where("grp = 'email'").select("row", "grp", "start", "end", "span"))


def numbered_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``row id text`` with a number that tells repeated rows and null ids apart."""
    return durable(docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")), "texts")


def learn(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Confident contexts and instances of all texts, for :func:`find` and :func:`redact`."""
    return bootstrap(durable(evidence(docs, text_col), "evidence"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", learned: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``id_col kind span start``: every piece of personal information as it stands in the text (``start`` in characters).

    Null, empty and blank texts have none; a null id stays null; repeated rows
    repeat their result; texts are read whole; an empty table gives an empty
    result; other columns are ignored. ``learned``: what :func:`learn` gave for
    the same or other texts; without it these texts are learned from.
    """
    confident = learned or learn(docs, text_col)
    if (held := lexicon(*confident)) is None:
        texts = numbered_texts(docs, id_col, text_col)
        return joined(texts, *confident).join(texts.select("row", "id"), "row").select(F.col("id").alias(id_col), "kind", "span", "start")
    shared = docs.sparkSession.sparkContext.broadcast(held)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("kind", T.StringType()), T.StructField("span", T.StringType()), T.StructField("start", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = None
        for batch in batches:
            judge = judge or Judge(*shared.value)
            at, rows = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for c in candidates(text, judge) if text else ():
                    if (kind := judge.kind(c)) is not None:
                        at.append(i)
                        rows.append((kind, text[c.start : c.end], c.start))
            cells = list(zip(*rows)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), pa.array(cells[0], pa.string()), pa.array(cells[1], pa.string()), pa.array(cells[2], pa.int64())], schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t_")).mapInArrow(run, schema)


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", learned: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """``id_col redacted``: each text with typed placeholders (``[EMAIL]`` and so on) in place of what :func:`find` finds; null stays null."""
    confident = learned or learn(docs, text_col)
    schema = T.StructType([T.StructField(id_col, docs.schema[id_col].dataType), T.StructField("redacted", T.StringType())])

    def replaced(text: str, spans: Iterable[tuple[int, int, str]]) -> str:
        out, at = [], 0
        for start, end, kind in sorted(spans):
            out += [text[at:start], f"[{kind.upper()}]"]
            at = end
        return "".join([*out, text[at:]])

    def settled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [None if t is None else replaced(t, ((s["start"], s["end"], s["kind"]) for s in spans or ())) for t, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], schema.names)

    if (held := lexicon(*confident)) is None:
        texts = numbered_texts(docs, id_col, text_col)
        spans = joined(texts, *confident).groupBy("row").agg(F.collect_list(F.struct("start", "end", "kind")).alias("spans"))
        return texts.join(spans, "row", "left").select("id", "text", "spans").mapInArrow(settled, schema)
    shared = docs.sparkSession.sparkContext.broadcast(held)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = None
        for batch in batches:
            judge = judge or Judge(*shared.value)
            made = [
                None if text is None else replaced(text, ((c.start, c.end, k) for c in (candidates(text, judge) if text else ()) if (k := judge.kind(c))))
                for text in batch.column(1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("_t_")).mapInArrow(run, schema)
