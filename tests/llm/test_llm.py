"""Operators over training data against brute force, exact round trips, held-out accuracy and small cases."""

import itertools
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import same_rows
from lexmill.llm import bpe, components, covering, encoding, language, lookalike, mixing, names, pii, queries, transducer
from lexmill.session import durable, table


# --- registered queries ------------------------------------------------------


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_runs(spark, sf_dir, duck, name):
    df = queries.queries()[name](spark, sf_dir)
    if name in queries.oracle_sql():
        same_rows(df, duck, queries.oracle_sql()[name])
    else:
        assert df.count() > 0


# --- 7: encoding ---------------------------------------------------------------


def reference_encoding():
    import base64

    import public_tokenizers as P
    import tiktoken

    with open(P.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_merges_are_exact(text):
    ranks = bpe.load_ranks(encoding.default_ranks())
    ours = [i for w in bpe.split_words(text) for i in bpe.merge(w.encode("utf-8", "replace"), ranks)]
    assert ours == reference_encoding().encode_ordinary(text)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.binary(max_size=6), st.lists(st.integers(0, 9), max_size=3), max_size=40), st.lists(st.binary(max_size=6), max_size=20))
def test_transducer_holds_a_dictionary(tmp_path_factory, words, others):
    path = str(tmp_path_factory.mktemp("t") / "x")
    with open(path, "wb") as f:
        f.write(transducer.pack(transducer.compile_transducer(list(words.items()))))
    t = transducer.Transducer(path)
    asked = [*words, *others]
    for w, r in zip(asked, t.ranks(asked).tolist()):
        assert (list(t.outputs(r)) if r >= 0 else None) == words.get(w)


def test_transducer_shares_suffixes():
    t = transducer.compile_transducer([(p + b"ationally", [1]) for p in (b"n", b"r", b"s", b"t")])
    assert len(t["final"]) <= 12


def test_encoding_of_odd_rows(spark):
    texts = ["", None, "  ", "a" * 20_000, "<|endoftext|>", "ţară 🧘‍♀️\r\n", "x²½ ٣", "same", "same", " and", "é"]
    rows = [(i if i != 3 else None, t, "clash") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    e = reference_encoding()
    got = encoding.encode_corpus(df, lexicon_words=50).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, list(r.ids)) for r in got) == sorted((i if i != 3 else -1, e.encode_ordinary(t) if t else []) for i, t in enumerate(texts))
    assert encoding.encode_corpus(df.limit(0)).count() == 0
    counted = encoding.token_counts(df.select("doc_id", "text"), "text").collect()
    assert sorted(r.n_tokens for r in counted) == sorted(len(e.encode_ordinary(t)) if t else 0 for t in texts)


# --- 3: groups -------------------------------------------------------------------


def brute_groups(ids, links):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    groups = {}
    for i in ids:
        groups.setdefault(root(i), set()).add(i)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_against_union_find(spark, seed):
    rng = random.Random(seed)
    ids = [f"r{i:04}" for i in range(300)]
    links = [(rng.choice(ids), rng.choice(ids)) for _ in range(170)] + list(zip(ids[200:260], ids[201:261])) + [(i, "hub") for i in ids[270:290]]
    got = components.consolidate(spark.createDataFrame([(i,) for i in [*ids, *ids[:20], None]], "id string"), spark.createDataFrame([*links, *links[:9], (None, "x"), ("x", None), ("r0001", "r0001")], "a string, b string"))
    groups = {}
    for r in got.collect():
        groups.setdefault(r.group_id, set()).add(r.id)
    assert {frozenset(g) for g in groups.values()} == brute_groups(ids, links)
    assert all(k == min(g) for k, g in groups.items())


def test_groups_of_nothing(spark):
    none = spark.createDataFrame([], "a string, b string")
    assert components.consolidate(spark.createDataFrame([("a",)], "id string"), none).count() == 0
    assert components.seed_forest(none.toDF("u", "v")).count() == 0


# --- 4: near duplicates ------------------------------------------------------------


def brute_pairs(rows, s=0.8):
    sets = {}
    for i, t in rows:
        if i is not None and t and (w := frozenset(covering.words_of(t))):
            sets.setdefault(i, set()).add(w)
    out = set()
    for a, b in itertools.combinations(sorted(sets), 2):
        if any(len(x & y) >= s * len(x | y) - 1e-9 for x in sets[a] for y in sets[b]):
            out.add((a, b))
    return out


def edited(rng, words, n, vocabulary):
    words = list(words)
    for _ in range(n):
        k = rng.randrange(3)
        at = rng.randrange(len(words))
        if k == 0:
            words[at] = rng.choice(vocabulary)
        elif k == 1 and len(words) > 2:
            del words[at]
        else:
            words.insert(at, rng.choice(vocabulary))
    rng.shuffle(words)
    return words


@pytest.mark.parametrize("seed,s", [(1, 0.8), (2, 0.8), (3, 0.6), (4, 0.3), (5, 1.0)])
def test_near_duplicates_against_brute_force(spark, seed, s):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    rows = []
    for _ in range(60):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 3, 5, 9, 20, 35, 50, 60, 110, 150, 300]))]
        for _ in range(4):
            rows.append((f"d{len(rows):04}", " ".join(edited(rng, base, rng.randrange(0, max(2, len(base) // 5)), vocabulary))))
    rows += [("d0001", "another text of the same id"), ("x1", "Another, TEXT of the same id!"), ("x2", ""), ("x3", None), (None, "w1 w2"), ("x4", "... !"), rows[0], rows[0], ("x5", " ".join(vocabulary * 3)), ("x6", " ".join(vocabulary[:370]))]
    df = spark.createDataFrame([(*r, "c") for r in rows], "id string, text string, id_a string")
    got = {(r.id_a, r.id_b) for r in covering.similar_pairs(df, s).collect()}
    assert got == brute_pairs(rows, s)
    grouped = {}
    for r in covering.similar_groups(df, s).collect():
        grouped.setdefault(r.group_id, set()).add(r.id)
    assert {frozenset(g) for g in grouped.values()} == brute_groups({i for i, _ in rows if i}, got)


def sketches(sets):
    wide = np.zeros((covering.WIDTH // 64, len(sets)), np.uint64)
    for i, ws in enumerate(sets):
        for w in ws:
            bit = covering.word_hash(w) % covering.WIDTH
            wide[bit >> 6, i] ^= np.uint64(1 << (bit & 63))
    return wide


def test_hot_buckets_lose_no_pair(monkeypatch):
    """Hundreds of sets that agree in most words fall into the same buckets; they are split, not dropped."""
    monkeypatch.setattr(covering, "PAIRED", 200)
    monkeypatch.setattr(covering, "LEVELS", 2)
    rng = random.Random(5)
    common = [f"c{i}" for i in range(24)]
    sets = [sorted({*common, *(f"x{rng.randrange(60)}" for _ in range(6))}) for _ in range(600)]
    wide = sketches(sets)
    lo, hi = covering.fold_lanes(wide, 2)
    n = np.array([len(s) for s in sets])
    hot = {(p, t, int(b[0])) for (p, t), b, _ in covering.entries(n, wide, 0.8, set()) if len(b) and t % 2 == 0}
    for given_hot in (set(), hot):
        every = [(b, e) for _, b, e in covering.entries(n, wide, 0.8, given_hot)]
        task = np.concatenate([b for b, _ in every]) % np.uint64(3)
        e = np.concatenate([x for _, x in every])
        found = {tuple(p) for k in range(3) for part in covering.local_pairs(e[task == k], np.zeros(0, covering.LONG_ENTRY), 0.8) for p in part.tolist()}
        for a, b in itertools.combinations(range(0, 600, 2), 2):
            x, y = set(sets[a]), set(sets[b])
            if len(x & y) >= 0.8 * len(x | y) and (lo[a], hi[a]) != (lo[b], hi[b]):
                k = sorted([(int(lo[a]), int(hi[a])), (int(lo[b]), int(hi[b]))])
                assert (*k[0], *k[1]) in found


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 150), st.floats(0.3, 1), st.randoms(use_true_random=False))
def test_similar_sets_share_a_bucket(n, s, rng):
    """Any two sets of similarity s or more have an entry in common, whatever their words and sizes."""
    limit, by_words = covering.short_limit(s), covering.long_from(s)
    base = [f"b{i}-{rng.random()}" for i in range(n)]
    other = list(base)
    while True:  # edits as long as the sets stay similar
        more = list(other)
        if rng.random() < 0.5 and len(more) > 1:
            del more[rng.randrange(len(more))]
        else:
            more.append(f"m{len(more)}-{rng.random()}")
        if len(set(more) & set(base)) < s * len(set(more) | set(base)) - 1e-9 or rng.random() < 0.02:
            break
        other = more
    counts = np.array([rng.randrange(5) for _ in range(64)] * (covering.COUNTERS // 64))
    seen = []
    for ws in (base, other):
        if len(ws) <= limit:
            keys = {(p, int(b[0])) for p, b, _ in covering.entries(np.array([len(ws)]), sketches([ws]), s, set()) if len(b)}
        else:
            keys = set()
        seen.append(keys | ({("word", k) for k in covering.long_keys(sorted(ws), 7, counts, s).tolist()} if len(ws) >= by_words else set()))
    assert seen[0] & seen[1]


@pytest.mark.parametrize("words", [80, 150, 300, 1000])
def test_unrelated_long_texts_give_few_candidates(spark, words):
    """Candidates grow with the texts, not with their square; near ones among them are all found."""
    rng = random.Random(words)
    # common words as in running text, and rare ones
    draw = lambda: f"w{int(rng.paretovariate(0.6)) % 50_000}"
    rows, n_pairs = [], []
    for size in (100, 200):
        while len(rows) < size:
            ws = set()
            while len(ws) < words:
                ws.add(draw())
            rows.append((f"d{len(rows)}", " ".join(sorted(ws))))
        near = [(f"n{i}", " ".join([*rows[i][1].split(" ")[words // 12 :], "extra", "more"])) for i in range(0, size, 40)]
        df = spark.createDataFrame(rows + near, "id string, text string")
        sketched = covering.sketch_texts(df)
        n_pairs.append(covering.near_sketches(sketched, 0.8).count() / size)
    got = {(r.id_a, r.id_b) for r in covering.similar_pairs(df).collect()}
    assert {tuple(sorted((f"n{i}", f"d{i}"))) for i in range(0, size, 40)} <= got
    assert max(n_pairs) < 0.5


def test_cells_of_a_common_word_lose_no_pair(monkeypatch):
    monkeypatch.setattr(covering, "CELL", 10)
    counts = np.full(covering.COUNTERS, 95)
    for a, b in itertools.combinations(range(40), 2):
        assert set(covering.long_keys(["x", "y"], a, counts, 1.0).tolist()) & set(covering.long_keys(["x", "y"], b, counts, 1.0).tolist())


@pytest.mark.parametrize("a,b,s", [(118, 124, 0.8), (56, 57, 0.8), (46, 57, 0.8), (56, 70, 0.8), (45, 56, 0.8), (40, 80, 0.5)])
def test_pairs_across_the_border_of_long_sets(spark, a, b, s):
    rows = [(f"{g}{n}", " ".join(f"{g}x{i}" for i in range(n))) for g in "abcdefgh" for n in (a, b)]
    df = spark.createDataFrame(rows, "id string, text string")
    got = {(r.id_a, r.id_b) for r in covering.similar_pairs(df, s).collect()}
    assert got == brute_pairs(rows, s) and len(got) == 8


def same_bit_words(n):
    """``n`` words that hash to one bit of the sketch."""
    return list(itertools.islice((w for w in (f"t{i}" for i in itertools.count()) if covering.word_hash(w) % covering.WIDTH == 5), n))


def test_long_sets_of_one_sketch_are_each_hashed(spark):
    base, out, other = [f"x{i}" for i in range(110)], same_bit_words(20)[:10], same_bit_words(20)[10:]
    partner = [*base, *other, *(f"y{i}" for i in range(14))]
    rows = [("a", " ".join(base + out)), ("b", " ".join(base + other)), ("c", " ".join(partner))]
    df = spark.createDataFrame(rows, "id string, text string")
    assert {(r.id_a, r.id_b) for r in covering.similar_pairs(df).collect()} == brute_pairs(rows)


def test_equal_sketches_of_different_sizes(spark):
    base = [f"x{i}" for i in range(28)]
    rows = [("a", " ".join(base)), ("b", " ".join([*base, *same_bit_words(2)]))]
    df = spark.createDataFrame(rows, "id string, text string")
    assert [(r.id_a, r.id_b) for r in covering.similar_pairs(df).collect()] == [("a", "b")]
    assert {(r.id, r.n_links) for r in covering.similar_groups(df).collect()} == {("a", 1), ("b", 1)}


def test_near_duplicates_of_nothing(spark):
    none = spark.createDataFrame([], "id string, text string")
    assert covering.similar_pairs(none).count() == 0 and covering.similar_groups(none).count() == 0


# --- 1: languages --------------------------------------------------------------------


def test_held_out_accuracy(spark, sf_dir):
    p = table(spark, sf_dir, "pilot_staged").where("length(language) = 2 and language rlike '^[a-z]+$' and language not in ('xx')")
    rows = [(r.language, r.text) for r in p.select("language", "text").distinct().orderBy(F.xxhash64("text")).collect()]
    fitted, held = rows[: len(rows) // 2], rows[len(rows) // 2 :]
    scorer = language.Scorer(language.fit(fitted))
    right = total = 0
    for lang, text in held:
        words = [language.sentence_words(s) for s in language.sentences(text)]
        found = language.segments(scorer.batch([words])[0], np.array([bool(w) for w in words]), len(scorer.languages), scorer.scale)
        if len(found) == 1 and found[0][0] is not None:
            total += 1
            right += scorer.languages[found[0][0]] == lang
    assert total > 50 and right / total > 0.9  # some labels are wrong on purpose


def test_segments_and_labels(spark, sf_dir):
    docs = language.labelled_texts(table(spark, sf_dir, "pilot_staged"), table(spark, sf_dir, "adjudication_entries"))
    trees = language.fit(language.labelled_sample(docs))
    en, de = "I plan the weekly budget before breakfast. Patience costs nothing and pays for much.", "Ich plane das wöchentliche Budget vor dem Frühstück. Geduld kostet nichts und bezahlt vieles."
    rows = [("t", "mix", "en", f"{en} {de}"), ("t", "ok", "en_GB", en), ("t", "wrong", "French", de), ("t", "none", None, de), ("t", "empty", None, ""), ("t", "null", "en", None), ("t", "digits", None, "12 34."), ("t", "quote", "eng", en[:-1] + " («das wöchentliche Budget vor dem Frühstück»)."), ("t", "ok", "en_GB", en)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "tab string, rec_key string, label string, text string, lang int")
    found = language.detect(df, trees)
    got = {(r.rec_key, r.seg_no, r.lang) for r in found.collect()}
    assert got == {("mix", 1, "en"), ("mix", 2, "de"), ("ok", 0, "en"), ("wrong", 0, "de"), ("none", 0, "de"), ("empty", 0, None), ("null", 0, None), ("digits", 0, None), ("quote", 0, "en")}
    assert {(r.rec_key, r.seg_no) for r in language.wrong_labels(found).collect()} == {("mix", 1), ("mix", 2), ("wrong", 0), ("none", 0)}
    assert language.detect(df.limit(0), trees).count() == 0 and language.detect(df, {}).where("lang is not null").count() == 0
    assert language.label_language(" Română ") == "ro" and language.label_language("es-MX") == "es" and language.label_language("und") is None


def test_texts_of_no_known_language_and_long_runs(spark, sf_dir):
    docs = language.labelled_texts(table(spark, sf_dir, "pilot_staged"), table(spark, sf_dir, "adjudication_entries"))
    trees = language.fit(language.labelled_sample(docs))
    foreign = ["Każdego dnia zaczynam od krótkiego spaceru przez park, żeby dobrze się czuć.", "Ik zou graag willen weten hoeveel uur wij vandaag nog hebben voor de vergadering.", "今日はとても良い天気ですね。", "Я хочу знать, сколько времени осталось до собрания."]
    run = "Geduldkostetnichtsundbezahltvieles"
    rows = [("t", f"f{i}", None, t) for i, t in enumerate(foreign)] + [("t", "run", None, "x" * 250 + run * 400)]
    got = {r.rec_key: r.lang for r in language.detect(spark.createDataFrame(rows, "tab string, rec_key string, label string, text string"), trees).collect()}
    assert [got["f0"], got["f2"], got["f3"]] == [None] * 3 and got["run"] == "de"


def test_a_rare_language_is_sampled_whole(spark):
    rows = [("en", f"text number {i}") for i in range(3000)] + [("hu", f"szöveg {i}") for i in range(9)]
    sample = language.labelled_sample(spark.createDataFrame(rows, "label string, text string"), per_language=10)
    assert sum(k == "hu" for k, _ in sample) == 9 and sum(k == "en" for k, _ in sample) == 10


def test_code_lengths_are_those_of_the_statistics():
    import math

    tree = language.ContextTree({"ab": 3, "ac": 1}, order=1)
    # after " a": b 3 of 4 with two kinds; "d" was never seen and is spelled from the start
    assert tree.bits("ab") == pytest.approx(math.log2((4 + 1) / 4) + math.log2((4 + 2) / 3) + math.log2((3 + 1) / 3))
    assert tree.bits("ad") > tree.bits("ac") > tree.bits("ab")


# --- 5: look-alikes --------------------------------------------------------------------

WORDS = {"en": {"copy": 9, "to": 9, "the": 9, "list": 5}, "ro": {"țară": 9, "și": 9, "este": 3}, "el": {"το": 9, "λίστα": 5}, "hu": {"időm": 4}, "de": {"Straße": 3}}
CASES = [
    ("en", "ｃｏｐｙ", "copy"), ("en", "сору the list", "copy the list"), ("en", "li​st", "list"), ("en", "a b", "a b"), ("en", "ﬁrst", "first"), ("en", "café", "café"), ("en", "café", "café"),
    ("en", "copy («το λίστα»)", "copy («το λίστα»)"), ("en", "помощь", "помощь"), ("en", "🧘‍♀️ ❤️ ok", "🧘‍♀️ ❤️ ok"), ("en", "K lamp", "K lamp"), ("en", "“quoted” – dash…", "“quoted” – dash…"),
    ("ro", "ţară şi", "țară și"), ("ro", "și", "și"), ("ro", "ѕі", "si"), ("hu", "idõm", "időm"), ("hu", "õr", "őr"), ("de", "Straβe", "Straße"), ("el", "λίστα το lista", "λίστα το lista"), ("el", "λίστα τo", "λίστα το"),
    ("el", "λίσ­τα", "λίστα"), ("xx", "сору", "copy"), ("", "plain", "plain"), ("en", "", ""),
]


@pytest.mark.parametrize("locale,text,want", CASES)
def test_one_form(locale, text, want):
    forms = lookalike.Canonicalizer(WORDS)
    assert forms.value(text, locale) == want and forms.value(want, locale) == want


@settings(max_examples=80, deadline=None)
@given(st.text(max_size=30), st.sampled_from(["en", "ro", "el", "bg", "tr"]))
def test_one_form_is_stable(text, locale):
    forms = lookalike.Canonicalizer(WORDS)
    once = forms.value(text, locale)
    assert forms.value(once, locale) == once


def test_forms_of_odd_rows(spark):
    df = spark.createDataFrame([(1, "ｘ", "en", "old"), (2, None, "en", "old"), (3, "", None, "old"), (1, "ｘ", "en", "old"), (4, "y" * 5000 + "​", "ro", "old")], "n int, value string, locale string, canonical string")
    got = sorted((r.n, r.canonical) for r in lookalike.canonicalize(df, "value", "locale").collect() if r.n != 2)
    assert got == [(1, "x"), (1, "x"), (3, ""), (4, "y" * 5000)]
    assert lookalike.canonicalize(df.limit(0), "value", "locale").count() == 0


def test_a_vocabulary_of_any_size_gives_the_same_forms(spark, sf_dir):
    values = lookalike.review_values(*(table(spark, sf_dir, t) for t in ("editor_packets", "fidelity_reviews", "glossary_open")))
    more = spark.createDataFrame([("t", f"k{i}", locale, text) for i, (locale, text, _) in enumerate(CASES)] + [("t", "n", None, "сору"), ("t", "m", "el", None)], values.schema)
    forms = lambda size: sorted(map(repr, lookalike.canonicalize(values.union(more), "value", "locale", size=size).collect()))
    assert forms(1) == forms(1 << 20)


def test_wholly_latin_words_of_another_script():
    forms = lookalike.Canonicalizer({"el": {"Η": 90, "λίστα": 30, "H": 2, "Α": 30, "A": 9}, "bg": {"а": 50, "списък": 9}})
    assert forms.value("H λίστα", "el") == "Η λίστα" and forms.value("A λίστα", "el") == "A λίστα" and forms.value("H list λίστα", "el") == "H list λίστα"
    assert forms.value("списък a", "bg") == "списък а" and forms.value("a list", "bg") == "a list"


@settings(max_examples=60, deadline=None)
@given(st.sampled_from(["țară", "λίστα", "Straße", "Boston", "HOPE", "кора"]), st.randoms(use_true_random=False))
def test_twins_share_a_key(word, rng):
    ways = lookalike._alternatives()
    made = "".join(rng.choice(ways.get(c, (c,))) + rng.choice(["", "\u200b"]) for c in lookalike.unicodedata.normalize("NFD", word))
    assert lookalike.skeleton(made) == lookalike.skeleton(word) == lookalike.skeleton(word.upper() if "ß" not in word else word)
    assert word in [w for _, w in lookalike.Trie({word: 2}).spellings(made)]


# --- 6: names -----------------------------------------------------------------------------

ROSTER = [("P1", "Ștefan F. Velmoțeanu", "person"), ("P2", "Dorothea Ubelhurst-Dunrasvoy", "person"), ("P3", "Dorothea Ubelneke", "person"), ("P4", "Tavrin Institute for Applied Patience", "organisation"), ("P5", "Josephine Ubelmot", "person"), ("P6", "Jörg Ubelmot", "person"), (None, "Nobody", "person")]
NAMES = {
    "Velmoteanu, Stefan": "P1", "Dr. Ș. F. VELMOȚEANU": "P1", "Ștefan Velmoțenu (1891-1960)": "P1", "Fane Velmoțeanu": None, "attributed to Ștefan Velmoțeanu": "P1", "SF Velmoțeanu": "P1", "Ștefan G. Velmoțeanu": None,
    "Dorry Ubelhurst Dunrasvoy": "P2", "Dorothea Ubelhurst": "P2", "Dunrasvoy-Ubelhurst, D.": "P2", "Maria Ubelneke": None, "T.I.A.P.": "P4", "The Tavrin Institute, Applied Patience": "P4", "Tavrin Institute for Applied Patinece": "P4", "Tavrin Institute": None,
    "Josie Ubelmot": "P5", "": None, "Anonymous": None,
}


def test_names(spark):
    df = spark.createDataFrame([(n, 1) for n in [*NAMES, *NAMES, None]], "name string, person_id int")
    roster = spark.createDataFrame(ROSTER, "person_id string, display_name string, kind string")
    got = {r.name: r.person_id for r in names.link_names(df, roster).collect()}
    assert {n: got.get(n) for n in NAMES} == NAMES
    assert names.link_names(df.limit(0), roster).count() == 0 and names.link_names(df, roster.limit(0)).count() == 0


def test_short_forms_are_learned(spark):
    """From names that stand on no list: a token beside the family names of several bearers of a given name, not one beside any."""
    families = ["Abrelund", "Benquist", "Cordovan", "Dellamar", "Estevund", "Farquell"]
    roster = [(f"W{i}", f"Wendeline {f}", "person") for i, f in enumerate(families)] + [(f"X{i}", f"{g} {f}x{g.lower()}", "person") for i, (g, f) in enumerate(itertools.product(("Barnaby", "Quintus", "Sibylla"), families))]
    rows = [f"Lyn {f}" for f in families[:4]] + [f"Oscar {r[1].split(' ')[1]}" for r in roster] + ["Wendi Farquell", "Barnaby Cordovan", "Wendeline Abrelund"]
    df, known = spark.createDataFrame([(r,) for r in rows], "name string"), spark.createDataFrame(roster, "person_id string, display_name string, kind string")
    got = {r.name: r.person_id for r in names.link_names(df, known).collect()}
    assert got == {"Lyn Abrelund": "W0", "Lyn Benquist": "W1", "Lyn Cordovan": "W2", "Lyn Dellamar": "W3", "Wendi Farquell": "W5", "Wendeline Abrelund": "W0"}
    more = spark.createDataFrame([("wendeline", "oscar")], "given string, short string")
    assert {r.name for r in names.link_names(df, known, nicknames=more).collect()} == {*got, *(f"Oscar {f}" for f in families)}


def test_a_roster_of_any_size_gives_the_same_links(spark, sf_dir, monkeypatch):
    records = names.attributed(table(spark, sf_dir, "pilot_staged"), table(spark, sf_dir, "adjudication_entries"))
    links = lambda: sorted((r.name, r.person_id, round(r.cosine, 9)) for r in names.link_names(records, table(spark, sf_dir, "person_roster")).collect())
    held = links()
    monkeypatch.setattr(names, "BROADCAST_ROWS", 10)
    assert links() == held and len(held) > 50


def test_one_edit():
    assert names.one_edit("abcd", "abdc") and names.one_edit("abcd", "abd") and names.one_edit("abd", "abcd") and names.one_edit("abcd", "abxd")
    assert not names.one_edit("abcd", "abcd") and not names.one_edit("abcd", "badc") and not names.one_edit("ab", "abcd")


# --- 8: mixing -------------------------------------------------------------------------------


def test_mixture(spark):
    rng = random.Random(3)
    docs = [(i, rng.choice(["a", "a", "a", "b"]) if i > 4 else "c", " ".join(rng.choice(["word", "other", "third"]) + str(i) for _ in range(rng.randrange(5, 60)))) for i in range(600)]
    docs += [(1000, "a", None), (1001, None, "x y"), (1002, "zz", "x y"), (1003, "b", ""), (None, "a", "no id"), (1004, docs[50][1], docs[50][2])]
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("c", 0.1, 4), ("absent", 0.1, 2), (None, 0.2, 1)], "source string, target_share double, max_repeats int")
    df = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, source string, text string, copy_no int")
    chosen, shares = mixing.mix(df, targets)
    rows = chosen.collect()
    cap, copies = {"a": 1, "b": 3, "c": 4}, {}
    for r in rows:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert copies[r.doc_id] <= cap[r.source]
    assert not {1000, 1001, 1002, 1003, None} & set(copies) and not {1004, 50} <= set(copies)
    total = sum(r.n_tokens for r in rows)
    got = {r.source: r for r in shares.collect()}
    assert set(got) == {"a", "b", "c", "absent"} and got["absent"].tokens == 0
    for s, want in (("a", 0.5), ("b", 0.3), ("c", 0.1)):
        assert got[s].actual_share == pytest.approx(sum(r.n_tokens for r in rows if r.source == s) / total)
        assert got[s].actual_share == pytest.approx(want / 0.9, abs=0.03)
    assert [r.doc_id for r in mixing.mix(df, targets)[0].collect()] == [r.doc_id for r in rows]
    assert mixing.mix(df.limit(0), targets)[0].count() == 0 and mixing.mix(df, targets.limit(0))[0].count() == 0


def test_each_source_meets_its_share_to_one_document(spark):
    """Also one that is so large that its share is far less than a bin of its numbers, and one between two bins."""
    docs = [(i, "big", f"word{i} " + "and more " * 40) for i in range(9000)] + [(10_000 + i, "small", f"word{i} is it") for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, source string, text string")
    for share, total in ((0.5, None), (0.9, 900), (0.2, 1500)):
        targets = spark.createDataFrame([("big", share, 2), ("small", 1 - share, 2)], "source string, target_share double, max_repeats int")
        got = {r.source: r for r in mixing.mix(df, targets, total_tokens=total)[1].collect()}
        size = got["big"].tokens / got["big"].copies
        want = total or got["small"].tokens / (1 - share)
        assert abs(got["big"].tokens - want * share) <= size


@settings(max_examples=50, deadline=None)
@given(st.floats(0.01, 6), st.integers(1, 5))
def test_poisson_inverse_rises(rate, cap):
    values = [mixing.copies_at((i + 0.5) / 200, rate, cap) for i in range(200)]
    assert values == sorted(values) and max(values) <= cap


# --- 9: personal information --------------------------------------------------------------------


def test_personal_information(spark):
    first = ["Mira", "Owen", "Lola", "Radu", "Elif", "Uwe"]
    last = ["Ashbrook", "Norbrook", "Kirkvits", "Pelvits", "Ivomark", "Rowmark"]
    docs = []
    for i, (a, b) in enumerate(itertools.product(first, last)):
        docs.append((i, f"Mail {a.lower()}.{b.lower()}@post.example now.\nBest regards, {a} {b}\nCall +44 7700 9{i:05} today. Between Solvena Dorthaa and Kirvana Bolder there are 12 pages."))
    docs += [
        (100, "Best regards, Ivo J. Kirkvits-Rowmark."), (101, "passport XX1234567 and (+34 000 123 456) on 2026-09-14, counts 943 080 before"), (102, "I live at Flat 8, 37 Harrow Road, Dolil. Lane 34 of the grid holds 12 cells."),
        (103, "write to lola [at] home dot example, or lola at home dot example. See icon@2x.png and %1$@."), (104, None), (105, ""), (None, "x@y.example"), (100, "Best regards, Ivo J. Kirkvits-Rowmark."), (106, "Nothing " * 20_000 + "z@y.example"),
    ]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, kind string")
    got = {(r.doc_id, r.kind, r.span) for r in pii.find(df).collect()}
    assert {(100, "person", "Ivo J. Kirkvits-Rowmark"), (101, "id_number", "XX1234567"), (101, "phone", "+34 000 123 456"), (102, "address", "Flat 8, 37 Harrow Road, Dolil"), (103, "email", "lola [at] home dot example"), (103, "email", "lola at home dot example"), (None, "email", "x@y.example"), (106, "email", "z@y.example")} <= got
    assert {(0, "person", "Mira Ashbrook"), (0, "email", "mira.ashbrook@post.example"), (0, "phone", "+44 7700 900000")} <= got
    assert not {s for _, k, s in got if k == "person" and ("Solvena" in s or "Bolder" in s)} and len([x for x in got if x[0] in (101, 102, 103)]) == 5
    clean = {r.doc_id: r.redacted for r in pii.redact(df).collect()}
    assert clean[102] == "I live at [ADDRESS]. Lane 34 of the grid holds 12 cells." and clean[104] is None and clean[105] == ""
    assert pii.find(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    "text,span",
    [
        ("to joe@163.com now", "joe@163.com"), ("joe.smith [At] example.com", "joe.smith [At] example.com"), ("joe (At) example (Dot) com", "joe (At) example (Dot) com"),
        ("JOE.SMITH AT EXAMPLE DOT COM", "JOE.SMITH AT EXAMPLE DOT COM"), ("x" * 300 + "@home.example", "x" * 300 + "@home.example"), ("see icon@2x.png", None), ("at 5 dot plots", None),
        ("a@" + "sub." * 200 + "example.org", "a@" + "sub." * 200 + "example.org"),
    ],
)
def test_addresses_of_any_form_and_length(text, span):
    assert [text[a:b] for a, b in pii.email_spans(text)] == ([span] if span else [])


def test_long_lines_are_read_once():
    import time

    line = " ".join(f"Flat {i}, {i} Harrow Road, Dolil; write to u{i}@home.example" for i in range(6000))
    began = time.time()
    found = list(pii.candidates(line))
    assert sum(c.group == "email" for c in found) == 6000 and sum(c.group == "address" for c in found) == 6000 and time.time() - began < 20


def test_more_contexts_than_the_lexicon_holds(spark, sf_dir, monkeypatch):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    df = docs.union(docs.limit(20)).union(docs.limit(20).select(F.lit(None).cast(docs.schema["doc_id"].dataType), "text")).union(docs.limit(1).select("doc_id", F.lit(None).cast("string")))
    df = durable(df)
    rows = lambda: [sorted(map(repr, x.collect())) for x in (pii.find(df), pii.redact(df))]
    held = rows()
    monkeypatch.setattr(pii, "LEXICON", 1)
    assert rows() == held and {r.kind for r in pii.find(docs).collect()} == set(pii.KINDS)
