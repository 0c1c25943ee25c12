"""The entry points on small fixtures."""

import json

import pytest
from pyspark.sql import functions as F

from lexmill.plans import api
from lexmill.sources import catalog
from test_state import QUOTE, SWIFT, quote


@pytest.fixture(scope="module")
def units(spark, tmp_path_factory):
    def loc(v, s="translated"):
        return {"stringUnit": {"state": s, "value": v}}

    plural = lambda **k: {"variations": {"plural": {c: loc(v) for c, v in k.items()}}}
    strings = {
        "home.list.title": {"comment": "Button", "localizations": {"en": loc("Open %@"), "ro": loc("Deschide")}},
        "home.list.body": {"comment": "Shown first", "localizations": {"en": loc("Never delete the list"), "ro": loc("Nu șterge lista", "needs_review")}},
        "home.days": {"comment": "Days", "localizations": {"en": plural(one="%d day", other="%d days"), "ro": plural(one="o zi", other="%d zile")}},
        "home.go": {"comment": "x", "localizations": {"en": loc("Go"), "ro": loc("Mergi")}},
        "away.go": {"comment": "x", "localizations": {"en": loc("go"), "ro": loc("Du-te")}},
        "away.none": {"localizations": {"en": loc("Nothing yet")}},
    }
    path = tmp_path_factory.mktemp("cat") / "c.xcstrings"
    path.write_text(catalog.dump_catalog({"sourceLanguage": "en", "strings": strings, "version": "1.0"}))
    return catalog.read_units(spark, str(path)).cache()


def test_check_catalog(spark, units):
    report = api.check_catalog(units, "ro", forbidden=spark.createDataFrame([("ro", "lista")], "locale string, term string"))
    got = {(r.check, r.severity, r.key) for r in report.findings.collect()}
    assert {("C1", "critical", "home.list.title"), ("C2", "major", "home.days"), ("C6", "major", "home.list.body"), ("C7", "major", "home.list.body"), ("C7", "major", "away.none"), ("C10", "needs_disposition", "away.go")} <= got
    assert {r.key: r.tier for r in report.tiers.collect()}["home.list.body"] == "A"
    one = api.check_catalog(units, "ro", requested=spark.createDataFrame([("home.go",)], "key string")).findings.collect()
    assert {r.key for r in one} <= {"home.go"}


def test_slice_and_worklist(spark, units):
    rows, blind, unknown = api.slice_catalog(units, spark.createDataFrame([("home.days",), ("home.go",), ("zz",)], "key string"), "ro")
    assert {(r.key, r.kind, r.target) for r in rows.collect()} == {("home.days", "plural", "o zi | %d zile"), ("home.go", "flat", "Mergi")}
    assert {r.opaque_id for r in blind.collect()} == {"s001", "s002"} and [r.key for r in unknown.collect()] == ["zz"]
    records = spark.createDataFrame([("home.go", "pass", None)], "key string, verdict string, source_hash string")
    status, batches = api.build_worklist(units, "ro", records)
    got = {r.key: r.status for r in status.collect()}
    assert got["home.go"] == "unchanged_passed" and got["away.none"] == "new" and got["home.list.body"] == "changed_target_state"
    assert {r.key for r in batches.collect()} == {"away.none", "home.list.body"}


def test_packets_and_leaks(spark):
    rows = [("b", "home.x.title", 1, "Never pay", "Button"), ("b", "home.x.body", 2, "If it is free", None), ("c", "home.y.title", 3, "Never pay", None)]
    got = {r.key: r for r in api.build_packets(spark.createDataFrame(rows, "batch string, key string, pos int, source string, comment string")).collect()}
    assert got["home.x.title"].control == "button" and got["home.x.title"].after == "home.x.body" and got["home.y.title"].before is None
    assert got["home.x.title"].n_siblings == 1 and got["home.x.body"].n_facts == 2 and got["home.y.title"].opaque_id == "s003"
    blind = spark.createDataFrame([("p", json.dumps({"entries": [{"text": "Never pay again"}], "to": {"x": "widget box"}}))], "key string, document string")
    leaks = {r.item for r in api.leak_report(blind, spark.createDataFrame([("Never pay",), ("absent",)], "item string"), path="out/widget.json").collect()}
    assert leaks == {"Never pay", "widget"}


def test_apply_terms_briefs(spark):
    units = spark.createDataFrame([("a", "ro", "", "new", "x", None)], "key string, locale string, variation string, state string, source string, target string")
    cand = spark.createDataFrame([("a", "", "y"), ("b", "", "z")], "key string, variation string, value string")
    changes, bad = api.plan_apply(units, cand)
    assert changes.count() == 0 and [tuple(r) for r in bad.collect()] == [("b", "unknown")]
    with pytest.raises(ValueError):
        api.require(bad, "candidates")
    assert api.plan_apply(units, cand.where("key = 'a'"))[0].count() == 1
    pairs = spark.createDataFrame([("k.a", "ro", "Done", "Gata lista")], "key string, locale string, source string, target string")
    terms = spark.createDataFrame([("ro", "t", ["lista"], ["gata"])], "locale string, term_id string, forms array<string>, forbidden array<string>")
    controls = spark.createDataFrame([("ro", "Done", "Gata", {})], "locale string, label string, preferred string, roles map<string,string>")
    items = spark.createDataFrame([("ro", ["lista", "rând"])], "locale string, options array<string>")
    report = api.audit_terms(pairs, terms, controls, items)
    assert report.totals.first() == (1, 1) and {(r.option, r.n) for r in report.options.collect()} == {("lista", 1), ("rând", 0)}
    long = "x" * 70
    docs = spark.createDataFrame([("d", f"## A\n\n## C\nowner-approved text\n{long}\nsee a.b.zz")], "id string, text string")
    problems = {r.problem for r in api.check_brief(docs, ["A", "B"], spark.createDataFrame([(long,)], "text string"), spark.createDataFrame([("a.b.c",)], "key string"), ["a"]).collect()}
    assert problems == {"headings", "empty section", "template line", "claim", "unknown key"}


def test_index_reviews_lineage_sites(spark):
    refs = spark.createDataFrame([("Genesis 1:1-2",), ("Genesis 1:9",), ("Nowhere 1:1",), ("bad",)], "reference string")
    verses = spark.createDataFrame([("Gen", 1, 1, "a"), ("Gen", 1, 2, "b")], "book string, chapter int, verse int, text string")
    texts, problems = api.canonical_index(refs, verses, spark.createDataFrame([("Genesis", "Gen")], "book string, id string"))
    assert [tuple(r) for r in texts.collect()] == [("Genesis 1:1-2", "a b")]
    assert {tuple(r) for r in problems.collect()} == {("Genesis 1:9", "missing verses"), ("Nowhere 1:1", "unknown book"), ("bad", "unreadable")}
    env = "key string, locale string, rev string"
    v = api.validate_review(spark.createDataFrame([("p", "ro", "1")], env), spark.createDataFrame([("p", "ro", "2")], env), ["locale", "rev"], spark.createDataFrame([("i",)], "id string"), spark.createDataFrame([("j",)], "id string"))
    assert {tuple(r) for r in v.collect()} == {("p", "rev differs"), ("i", "missing id"), ("j", "extra id")}
    q = spark.createDataFrame([quote("a"), quote("b", language="ro", translation_of="a"), quote("x", translation_of="y"), quote("y", translation_of="x")], QUOTE)
    groups, issues, jobs = api.build_lineage(q, ["en", "ro", "hu"])
    assert {(r.root, r.source_id, r.missing) for r in groups.collect()} == {("a", "a", "hu"), ("x", "x", "hu,ro")}
    assert {r.id for r in issues.where("code = 'translation_cycle'").collect()} == {"x", "y"} and [tuple(r) for r in jobs.collect()] == [("a", "a", "hu")]
    sites, rest, limits = api.scan_callsites(spark.createDataFrame([("a.swift", SWIFT)], "path string, text string"), spark.createDataFrame([("home.title",), ("q",)], "key string"))
    assert [r.key for r in rest.collect()] == ["q"] and limits.where("key = 'home.title'").first().min_lines == 1 and sites.count() == 3


def test_corpus_state(spark):
    log = spark.createDataFrame([("j", 1, "candidate", None, "c", None, None), ("k", 1, "candidate", None, "c", None, None), *[("j", 2 + i, "review", r, "c", "pass", r) for i, r in enumerate(("editor", "fidelity", "adjudicator"))]], "job string, seq long, type string, role string, candidate string, verdict string, reviewer string")
    jobs = spark.createDataFrame([("j",), ("k",), ("l",)], "job string")
    texts = spark.createDataFrame([("c", "ro", "g", "same", True), ("c", "ro", "h", "Same", False)], "category string, locale string, group_id string, text string, is_new boolean")
    none = spark.createDataFrame([], "collision string")
    summary, state, blockers = api.corpus_state(jobs, log, texts, none)
    assert {tuple(r) for r in summary.collect()} == {("reviewed", 1), ("awaiting", 1), ("pending", 1)} and state.count() == 3
    assert sorted(r.blocker for r in blockers.collect()) == ["collision", "not reviewed", "not reviewed"]
    known = blockers.where("blocker = 'collision'").select(F.col("subject").alias("collision"))
    assert api.corpus_state(jobs, log, texts, known)[2].count() == 2
