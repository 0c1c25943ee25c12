"""Unit checks on small fixtures of our own."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmill.functions import text as X
from lexmill.operators import apply, casing, checks, packets, terms, worklist

PAIR = "key string, locale string, variation string, source string, target string"


def found(df):
    return {(r.key, r.severity, r.message) for r in df.collect()}


def test_placeholders(spark):
    rows = [
        ("a", "ro", "", "%d of %d", "nimic"), ("b", "ro", "", "%1$@ in %2$d", "%2$d in %1$@"), ("c", "ro", "", "%@ and %d", "%d and %@"), ("d", "ro", "plural:one", "%d day", "o zi"),
        ("e", "ro", "", "100%% sure", "100%% sigur"), ("f", "ro", "", None, "x"), ("g", "ro", "", "plain", "%s"), ("h", "ro", "", "%1$@ %2$@", "%2$@ %1$@"),
    ]
    got = found(checks.placeholder_findings(spark.createDataFrame(rows, PAIR)))
    assert ("a", "critical", "missing placeholder d") in got and len([x for x in got if x[0] == "a"]) == 1
    assert ("b", "info", "placeholders in another order") in got
    assert ("c", "critical", "placeholders bound to other arguments") in got
    assert ("d", "info", "missing placeholder d") in got
    assert not {x for x in got if x[0] in "ef"}
    assert ("g", "critical", "extra placeholder s") in got


def test_moved_placeholder_is_information(spark):
    df = spark.createDataFrame([("a", "ro", "", "%d", "x")], PAIR).withColumn("comment", F.lit("Placeholder moved to b.c"))
    assert {s for _, s, _ in found(checks.placeholder_findings(df))} == {"info"}


def test_plurals(spark):
    units = [("k", l, v, 0, "translated", "x") for l, v in (("en", "plural:one"), ("en", "plural:other"), ("ro", "plural:one"), ("ro", "plural:other"), ("hu", ""), ("fr", "plural:one"), ("fr", "plural:other"), ("fr", "plural:many"), ("tr", "plural:two"))]
    got = found(checks.plural_findings(spark.createDataFrame(units, "key string, locale string, variation string, pos int, state string, value string")))
    assert got == {("k", "major", "missing plural category few"), ("k", "major", "plural source but flat target"), ("k", "major", "missing plural category one"), ("k", "major", "missing plural category other"), ("k", "info", "extra plural category two")}


def test_source_units_prefer_the_same_variation(spark):
    units = [("k", "en", "plural:other", 0, "", "days"), ("k", "en", "plural:one", 0, "", "day"), ("k", "ro", "plural:few", 0, "", "zile"), ("k", "ro", "plural:one", 0, "", "zi")]
    got = {(r.variation, r.source) for r in checks.source_units(spark.createDataFrame(units, "key string, locale string, variation string, pos int, state string, value string")).collect()}
    assert got == {("plural:few", "days"), ("plural:one", "day")}


def test_markup_and_typography(spark):
    rows = [("a", "ro", "", "**x** [l](u)", "x"), ("b", "ro", "", "a…", "a  b "), ("c", "ro", "", "x", "şase"), ("d", "el", "", "x", "τaυ"), ("e", "hu", "", "x", "õ")]
    df = spark.createDataFrame(rows, PAIR)
    got = found(checks.markup_findings(df))
    assert {("a", "major", "bold marks differ"), ("a", "major", "links differ"), ("b", "info", "ellipsis form differs"), ("b", "info", "double blank"), ("b", "info", "outer white space differs")} <= got
    assert {k for k, _, _ in found(checks.typography_findings(df))} == {"c", "d", "e"}


def test_whole_words_in_any_alphabet(spark):
    values = spark.createDataFrame([("a", "ro", "o serie"), ("b", "ro", "ăserie"), ("c", "ro", "SERIE nouă"), ("d", "ro", "două serie noi"), ("e", "ro", None)], "key string, locale string, target string")
    words = spark.createDataFrame([("ro", "serie"), ("ro", "serie nouă")], "locale string, term string")
    assert {(r.key, r.term) for r in checks.term_hits(values, words).collect()} == {("a", "serie"), ("c", "serie"), ("c", "serie nouă"), ("d", "serie")}
    row = spark.range(1).select(X.whole_word(F.lit("ăserie"), "serie").alias("no"), X.whole_word(F.lit("Ș SERIE"), "ș serie").alias("yes"), X.trim_ws(F.lit("  x\n")).alias("t")).first()
    assert (row.no, row.yes, row.t) == (False, True, "x")


def test_states_identity_comments(spark):
    units = spark.createDataFrame([("a", "ro", "", "new"), ("b", "en", "", "translated"), ("c", "ro", "", "translated")], "key string, locale string, variation string, state string")
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("z",)], "key string")
    assert found(checks.state_findings(units, keys, "ro")) == {("a", "major", "state is new"), ("b", "major", "no target unit"), ("z", "major", "unknown key")}
    same = spark.createDataFrame([("a", "ro", "", "Settings", "Settings"), ("b", "ro", "", "OK", "OK"), ("c", "ro", "", "%d min", "%d min"), ("d", "ro", "", "12", "12")], PAIR)
    assert {k for k, _, _ in found(checks.identity_findings(same))} == {"a", "c"}
    comments = spark.createDataFrame([("a.title", "Title"), ("b.title", None), ("c.title", "Shown first")], "key string, comment string")
    assert {k for k, _, _ in found(checks.comment_findings(comments))} == {"a.title", "b.title"}


def test_divergence_with_controls(spark):
    v = spark.createDataFrame([("a", "ro", "", "Cancel", "Anulează"), ("b", "ro", "", "cancel ", "Renunță"), ("c", "ro", "", "Go", "Mergi"), ("d", "ro", "", "go", "Du-te")], PAIR)
    c = spark.createDataFrame([("Cancel", "Anulează", {"link": "x"})], "label string, preferred string, roles map<string,string>")
    assert found(checks.divergence_findings(v, c)) == {("b", "major", "outside of the control's forms"), ("c", "needs_disposition", "2 targets of one source")}


def test_worklist_cascade(spark):
    cur = spark.createDataFrame([(k, "h", s) for k, s in (("new", "translated"), ("base", "translated"), ("rec", "translated"), ("state", "new"), ("stale", "translated"), ("ok", "translated"), ("nohash", "translated"))], "key string, source_hash string, state string")
    base = spark.createDataFrame([("base", "x")] + [(k, "h") for k in ("rec", "state", "stale", "ok", "nohash")], "key string, source_hash string")
    rec = spark.createDataFrame([("rec", "pass", "x"), ("stale", "pass", "h"), ("ok", "pass", "h"), ("nohash", "pass", None), ("state", "pass", "h")], "key string, verdict string, source_hash string")
    gone = spark.createDataFrame([("stale",)], "key string")
    got = {r.key: r.status for r in worklist.work_status(cur, rec, base, gone).collect()}
    assert got == {"new": "new", "base": "changed_source", "rec": "changed_source", "state": "changed_target_state", "stale": "stale_evidence", "ok": "unchanged_passed", "nohash": "unchanged_passed"}


def test_packing():
    groups = [("f.a", "general", [f"f.a.{i}" for i in range(12)]), ("f.b", "general", [f"f.b.{i}" for i in range(6)]), ("f.c", "hero", ["f.c.1"]), ("f.d", "general", [f"f.d.{i:03}" for i in range(95)])]
    batches = worklist.pack(groups)
    assert [(c, len(k)) for c, _, k in batches] == [("general", 18), ("hero", 1), ("general", 32), ("general", 32), ("general", 31)]
    assert sorted(k for *_, ks in batches for k in ks) == sorted(k for *_, ks in groups for k in ks)
    assert all(len(p) <= 40 for p in worklist.balanced_split([f"a.{i // 7}.x.{i}" for i in range(130)], 40))


def test_hash_keeps_fields_apart(spark):
    df = spark.createDataFrame([("a", "b|c"), ("a|b", "c"), ("a", None), ("a", ""), ("=a", "b")], "x string, y string")
    assert df.select(worklist.source_hash("x", "y").alias("h")).distinct().count() == 5


def test_guarded_apply(spark):
    units = spark.createDataFrame([("a", "ro", "", "new", "%d x", None), ("b", "ro", "", "translated", "y", "z"), ("c", "ro", "", "new", "q", "w")], "key string, locale string, variation string, state string, source string, target string")
    cand = lambda *r: spark.createDataFrame(list(r), "key string, variation string, value string")
    plan = apply.plan_changes(units, cand(("a", "", "fără"), ("b", "", "n"), ("c", "", "w"), ("z", "", "n")))
    assert {r.key: r.outcome for r in plan.collect()} == {"a": "blocked", "b": "locked", "c": "unchanged", "z": "unknown"}
    assert apply.gate(plan).count() == 0
    fine = cand(("a", "", "%d fără"))
    changes = apply.gate(apply.plan_changes(units, fine))
    assert changes.count() == 1
    after = {r.key: (r.value, r.state) for r in apply.applied(units, fine, changes).collect()}
    assert after["a"] == ("%d fără", "needs_review") and after["b"] == ("z", "translated")
    assert {r.error for r in apply.candidate_errors(cand(("a", "", ""), ("b", "plural:lots", "x"), ("c", "", "x"), ("c", "plural:one", "x"))).collect()} == {"empty value", "unknown category", "flat and plural"}


def test_controls_prefer_roles(spark):
    pairs = spark.createDataFrame([("a", "ro", "Done…", "Gata"), ("b", "ro", "done", "OK"), ("c", "ro", "Done", "Terminat")], "key string, locale string, source string, target string")
    c = spark.createDataFrame([("ro", "Done", "Gata", {"nav": "Gata", "alert": "OK"})], "locale string, label string, preferred string, roles map<string,string>")
    assert {r.key: r.match for r in terms.control_matches(pairs, c).collect()} == {"a": "role:nav", "b": "role:alert", "c": "drift"}


def test_leaks_and_overlay(spark):
    blind = spark.createDataFrame([("a", "Don’t delete the Weekly Budget now"), ("b", "budgets weekly"), ("c", None)], "key string, leaf string")
    items = spark.createDataFrame([("weekly budget",), ("don't",), ("now",), ("12345",)], "item string")
    assert {(r.key, r.item) for r in packets.leaks(blind, items).collect()} == {("a", "weekly budget"), ("a", "don't")}
    assert packets.leaks(blind, items, spark.createDataFrame([("Weekly budget",)], "item string")).count() == 1
    old = spark.createDataFrame([("a", "x"), ("b", "y")], "key string, value string")
    new = spark.createDataFrame([("a", None), ("c", "z")], "key string, value string")
    assert {(r.key, r.value) for r in packets.overlay(old, new).collect()} == {("a", None), ("b", "y"), ("c", "z")}


def test_casing(spark):
    rows = [
        ("a", "open the list", "sentence", [], []), ("b", "OPEN LIST", "sentence", [], []), ("c", "Deschide Lista. Apoi mergi", "sentence", [], []), ("d", "Ένα. Δύο", "sentence", [], []),
        ("e", "%d days left", "sentence", [], []), ("f", "ios settings", "sentence", ["iOS"], []), ("g", "iOS settings", "sentence", ["iOS"], []), ("h", "Save", "lowercase", [], []), ("i", "weird", "sentence", [], ["weird"]),
        ("j", "anything", "preserve", [], []), ("k", None, "sentence", [], []), ("l", "Done: Next", "sentence", None, None), ("m", "ABC abc", "uppercase", ["ABC"], []),
    ]
    units = spark.createDataFrame([(k, "", v, s, p, e, "review") for k, v, s, p, e in rows], "key string, variation string, value string, style string, protected array<string>, exceptions array<string>, capitals string")
    got = {}
    for r in casing.casing_findings(units).collect():
        got.setdefault(r.key, set()).add(r.message)
    assert got == {
        "a": {"starts with a lower-case letter"}, "b": {"all capitals", "a capital inside of the sentence"}, "c": {"a capital inside of the sentence"},
        "f": {"protected spelling is iOS", "starts with a lower-case letter"}, "h": {"a capital in a lowercase role"}, "m": {"protected spelling is ABC", "lower case in an uppercase role"},
    }
    lexical = units.withColumn("capitals", F.lit("lexical_review")).withColumn("expected", F.lit("sentence"))
    told = {(r.key, r.message) for r in casing.casing_findings(lexical).collect()}
    assert {("h", "a fragment begins with a capital"), ("h", "style is not the role's and no exception names the value"), ("j", "style is not the role's and no exception names the value")} <= told
    assert list(casing.protected_spans("ApplePie Apple", "Apple")) == [(9, 14)] and casing.casing_findings(units.limit(0)).count() == 0


def test_names_beside_a_dotted_capital_i():
    assert list(casing.protected_spans("İptal id İd", "ID")) == [(6, 8)] and casing.masked("İ ID", ["ID"])[0] == f"İ {casing.MASK}"
    assert list(casing.protected_spans("İ ΟΔΟΣ", "Οδος")) == [(2, 6)]


def test_casing_contexts(spark):
    schema = "key string, status string, role string, position string, style string, owner string, evidence string, expected_style string, exceptions array<struct<text:string,reason:string>>, protected array<string>, transform struct<operation:string,file:string,line:int,render_locale:string,render_evidence:string,render_status:string,catalog_value:string,rendered_value:string>"
    good = ("button", "standalone", "sentence", "catalog", "seen", "sentence", [], [], None)
    place = ("uppercase", "a.swift", 3, "ro", "shot", "pass", "salut", "SALUT")
    rows = [
        ("ok", "confirmed", *good), ("a", None, *good), ("b", "confirmed", "continuation", "standalone", "title", "view", "", "sentence", [("x", None)], [""], None), ("c", "confirmed", *good[:-1], ("uppercase", None, 0, None, None, None, None, None)),
        ("d", "confirmed", "button", "standalone", "title", "view", "seen", "sentence", [("x", "name")], [], place), ("e", "confirmed", "button", "standalone", "title", "view", "seen", "sentence", [], [], place),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {(r.key, r.error) for r in casing.context_errors(df).collect()}
    assert got == {
        ("a", "not confirmed"), ("b", "continuation role in another position"), ("b", "no evidence"), ("b", "exception without text or reason"), ("b", "protected names are no list of spellings"), ("b", "view text without a transform"),
        ("c", "transform without a place"), ("c", "transform of text that no view owns"), ("e", "style is not the role's"),
    }
    shown = df.select("key", casing.displayed_value(F.lit("salut"), F.col("owner"), F.col("transform"), F.lit("ro")).alias("v"))
    assert {r.key: r.v for r in shown.collect()} == {"ok": "salut", "a": "salut", "b": None, "c": "salut", "d": "SALUT", "e": "SALUT"}
    told = spark.createDataFrame([("x", "one", "", "button", "standalone", "title", "view"), ("x", "one", "", "tab", "standalone", "title", "view"), ("y", "old", "", "tab", "standalone", "title", "view")], "key string, source string, comment string, role string, position string, style string, owner string")
    now = spark.createDataFrame([("x", "one", None), ("y", "new", None)], "key string, source string, comment string")
    assert {(r.key, r.error) for r in casing.context_conflicts(told, now).collect()} == {("x", "contexts of one key differ"), ("y", "source or comment changed")}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["general", "hero", "paywall"]), st.integers(1, 70)), max_size=12))
def test_packing_keeps_its_bounds(sizes):
    groups = [(f"f.g{i}", cls, [f"f.g{i}.x{k // 9}.{k}" for k in range(n)]) for i, (cls, n) in enumerate(sizes)]
    batches = worklist.pack(groups)
    assert [k for *_, ks in batches for k in ks] == [k for *_, ks in groups for k in ks]
    kind = {k: cls for _, cls, ks in groups for k in ks}
    for cls, _, ks in batches:
        assert len(ks) <= worklist.CLASS_BOUND.get(cls, worklist.BOUND) and {kind[k] for k in ks} == {cls}


def test_no_unbounded_tables_are_broken(spark):
    empty = spark.createDataFrame([], PAIR)
    assert checks.placeholder_findings(empty).count() == 0 and checks.markup_findings(empty).count() == 0 and checks.divergent_groups(empty).count() == 0
