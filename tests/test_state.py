"""Lineage, corpus state, reviews, reference data, sources and call sites."""

import json

import pytest

from lexmill.operators import callsites, corpus, drift, lineage, reference, reviews
from lexmill.sources import catalog
from lexmill.sources import reference as ref_source

QUOTE = "id string, category string, text string, language string, has_language boolean, status string, pair_id string, translation_of string"


def quote(i, **k):
    return tuple({"id": i, "category": "c", "text": "t", "language": "en", "has_language": True, "status": "authored", "pair_id": None, "translation_of": None, **k}.values())


def test_issues(spark):
    q = spark.createDataFrame([quote("a", has_language=False, language=None), quote("b", language=None), quote("c", translation_of="zz"), quote("d", translation_of="a", category="e"), quote("e", status="rejected"), quote("f", text=" ", pair_id=" ")], QUOTE)
    got = {(r.id, r.code) for r in lineage.record_issues(q).collect()}
    assert got == {("a", "assumed_english"), ("b", "invalid_language"), ("c", "missing_translation_target"), ("d", "cross_category_translation"), ("e", "excluded_status"), ("f", "invalid_text"), ("f", "invalid_pair_id")}


def test_components_and_cycles(spark):
    chain = [quote(f"n{i:03}", translation_of=f"n{i + 1:03}" if i < 40 else None) for i in range(41)]
    ring = [quote("r1", translation_of="r2"), quote("r2", translation_of="r3"), quote("r3", translation_of="r1"), quote("r4", translation_of="r1"), quote("s", translation_of="s")]
    q = spark.createDataFrame([*chain, *ring, quote("p1", pair_id="x"), quote("p2", pair_id="x"), quote("p3", pair_id="x", category="d")], QUOTE)
    roots = {r.id: r.root for r in lineage.components(q, lineage.lineage_edges(q)).collect()}
    assert {roots[f"n{i:03}"] for i in range(41)} == {"n000"} and roots["r4"] == "r1" and roots["p2"] == "p1" and roots["p3"] == "p3"
    assert {r.id for r in lineage.cycle_members(q).collect()} == {"r1", "r2", "r3", "s"}


def test_reviews_reduce_by_rule(spark):
    log = [
        ("j", 1, "candidate", None, "c1", None, None), ("j", 2, "review", "editor", "c1", "pass", "e"), ("j", 3, "candidate", None, "c2", None, None), ("j", 4, "review", "editor", "c2", "pass", "e"),
        ("j", 5, "review", "fidelity", "c2", "pass", "f"), ("j", 6, "review", "adjudicator", "c2", "pass", "a"), ("k", 1, "candidate", None, "c", None, None), ("k", 2, "review", "adjudicator", "c", "pass", "a"),
        ("k", 3, "review", "editor", "c", "pass", "e"), ("k", 4, "review", "fidelity", "c", "pass", "f"), ("k", 5, "review", "editor", "old", "fail", "e"),
    ]
    df = spark.createDataFrame(log, "job string, seq long, type string, role string, candidate string, verdict string, reviewer string")
    state = corpus.current_reviews(df)
    assert {(r.job, r.role, r.valid) for r in state.collect()} == {("j", "editor", True), ("j", "fidelity", True), ("j", "adjudicator", True), ("k", "editor", True), ("k", "fidelity", True), ("k", "adjudicator", False)}
    assert [r.job for r in corpus.passed(state).collect()] == ["j"]


def test_collisions_change_their_name(spark):
    row = "category string, locale string, group_id string, text string, is_new boolean"
    one = [("c", "ro", "g1", "Un text", True), ("c", "ro", "g2", " un  TEXT ", False), ("c", "ro", "g3", "altul", True)]
    a = corpus.collisions(spark.createDataFrame(one, row)).collect()
    b = corpus.collisions(spark.createDataFrame([*one, ("c", "ro", "g4", "UN text", False)], row)).collect()
    assert len(a) == len(b) == 1 and a[0].collision != b[0].collision


def test_export_is_all_or_nothing(spark):
    jobs = spark.createDataFrame([("g", "ro", "c", "t", "s")], "group_id string, locale string, category string, text string, source_id string")
    none = spark.createDataFrame([], "x string")
    first, second = corpus.export_rows(jobs, none).collect(), corpus.export_rows(jobs, none).collect()
    assert first == second and len(first) == 1
    assert corpus.export_rows(jobs, spark.createDataFrame([("b",)], "x string")).count() == 0


def test_coverage_and_findings(spark):
    e, g = spark.createDataFrame([("a",), ("b",)], "id string"), spark.createDataFrame([("b",), ("b",), ("c",)], "id string")
    assert {(r.id, r.problem) for r in reviews.id_coverage(e, g, "id").collect()} == {("a", "missing"), ("b", "duplicate"), ("c", "extra")}
    v = spark.createDataFrame([("a", "pass", "not_checked", []), ("b", "odd", "not_checked", ["why"])], "id string, x string, y string, reasons array<string>")
    assert {(r.id, r.column, r.error) for r in reviews.verdict_errors(v, ["x", "y"]).collect()} == {("a", "y", "no reason"), ("b", "x", "unknown verdict")}
    c = spark.createDataFrame([("a", "t"), ("b", "")], "id string, text string")
    h = spark.createDataFrame([("a", None)], "id string, reason string")
    assert {r.problem for r in reviews.translator_errors(e, c, h).collect()} == {"candidate and hold", "hold without reason", "empty text"}


def test_ranges(spark):
    refs = spark.createDataFrame([("Gen 1:1-2",), ("Gen 1:3",), ("Gen 1:5-4",), ("nothing",), ("Gen 1:2-4",)], "reference string")
    verses = spark.createDataFrame([("Gen", 1, i, f"v{i}") for i in (1, 2, 3)], "book string, chapter int, verse int, text string")
    parsed = reference.parse_references(refs)
    assert {r.reference: r.error for r in parsed.collect()} == {"Gen 1:1-2": None, "Gen 1:3": None, "Gen 1:5-4": "reversed", "nothing": "unreadable", "Gen 1:2-4": None}
    assert {r.reference: (r.text, r.missing) for r in reference.select_ranges(parsed, verses).collect()} == {"Gen 1:1-2": ("v1 v2", 0), "Gen 1:3": ("v3", 0), "Gen 1:2-4": (None, 1)}


def test_markdown(spark):
    docs = spark.createDataFrame([(1, "intro\n## A\nx\n\n## B\nNative-speaker reviewed.\nNot native-speaker reviewed.\nsee a.b.c and q.w.e, a.b.md"), (2, None)], "id long, body string")
    lines = reference.markdown_lines(docs, "id", "body")
    assert {(r.heading, r.n_filled) for r in reference.section_sizes(lines).collect()} == {("A", 1), ("B", 3)}
    assert [r.sentence for r in reference.honesty_findings(lines).collect()] == ["Native-speaker reviewed."]
    known = spark.createDataFrame([("a.b.c.d",)], "key string")
    assert [r.token for r in reference.cited_keys(lines, known, ["a", "q"]).collect()] == ["q.w.e"]
    assert reference.heading_order_errors(lines, ["A", "B"]).count() == 0 and reference.heading_order_errors(lines, ["B"]).count() == 1


CATALOG = {
    "sourceLanguage": "en",
    "strings": {
        "z.first": {"comment": "c", "localizations": {"en": {"stringUnit": {"state": "translated", "value": "%#@n@ left"}, "substitutions": {"n": {"argNum": 1, "formatSpecifier": "lld", "variations": {"plural": {"one": {"stringUnit": {"state": "new", "value": "%arg day"}}}}}}}}},
        "a.second": {"localizations": {"ro": {"variations": {"plural": {"one": {"stringUnit": {"state": "new", "value": "o zi"}}, "few": {"stringUnit": {"state": "new", "value": "zile"}}}}}}},
        "empty": {},
    },
    "version": "1.0",
}


def test_catalog_round_trip(spark, tmp_path):
    path = tmp_path / "x.xcstrings"
    catalog.write_atomic(str(path), catalog.dump_catalog(CATALOG))
    text = path.read_text()
    assert '"sourceLanguage" : "en"' in text and '"empty" : {\n\n    }' in text and json.loads(text) == CATALOG and catalog.dump_catalog(json.loads(text)) == text
    rows = {(r.key, r.pos, r.locale, r.unit_path, r.variation, r.value) for r in catalog.read_units(spark, str(path)).collect()}
    assert ("z.first", 0, "en", "", "", "%1$lld left") in rows and ("a.second", 1, "ro", "plural:few", "plural:few", "zile") in rows and ("empty", 2, None, None, None, None) in rows
    assert ("z.first", 0, "en", "substitution:n/plural:one", None, "%arg day") in rows
    assert list(catalog.subset_catalog(CATALOG, ["empty", "z.first"], ["ro"])["strings"]) == ["z.first", "empty"]
    with pytest.raises(ValueError):
        catalog.guard_output(str(path), [str(path)])


def test_keys_and_shields(spark, tmp_path):
    f = tmp_path / "keys"
    f.write_text("a.b # x\n\n# y\nc.d\n")
    assert catalog.read_keys_file(str(f)) == ["a.b", "c.d"]
    src = spark.createDataFrame([("p", 'x = [.init(id: "s1", style: .calm, titleEnglish: "Say \\"no\\"", titleRomanian: "Spune", bodyEnglish: "B")]')], "path string, text string")
    got = {(r.key, r.locale, r.value, r.style) for r in catalog.shield_units(src).collect()}
    assert got == {("shield.s1.title", "en", 'Say "no"', "calm"), ("shield.s1.title", "ro", "Spune", "calm"), ("shield.s1.body", "en", "B", "calm")}
    keys = spark.createDataFrame([("shield.s1",), ("shield.k",), ("z",)], "key string")
    assert {r.key for r in catalog.expand_shield_ids(keys, spark.createDataFrame([("shield.k",)], "key string")).collect()} == {"shield.s1.title", "shield.s1.body", "shield.k", "z"}


def test_verdict_files(spark, tmp_path):
    import os

    for i, (d, v) in enumerate((("r1", "pass"), ("r2", "finding"))):
        (tmp_path / d).mkdir()
        p = tmp_path / d / "verdict.json"
        p.write_text(json.dumps({"keys": {"k": {"verdict": v, "source_hash": "h"}, f"only{i}": {"verdict": "pass"}}}))
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    (tmp_path / "r3").mkdir()
    (tmp_path / "r3" / "verdict.json").write_text("{broken")
    assert {(r.key, r.verdict) for r in catalog.latest_verdicts(spark, str(tmp_path)).collect()} == {("k", "finding"), ("only0", "pass"), ("only1", "pass")}


def test_osis(spark, tmp_path):
    p = tmp_path / "b.xml"
    p.write_text('<osis xmlns="x"><verse osisID="Gen.1.1">In the <w>start</w><note>no</note> of it</verse><verse osisID="Gen.1.2">Then</verse></osis>')
    assert {(r.book, r.chapter, r.verse, r.text) for r in ref_source.read_osis(spark, str(p)).collect()} == {("Gen", 1, 1, "In the start of it"), ("Gen", 1, 2, "Then")}
    for bad in ('<o><verse osisID="Gen.1.1 Gen.1.2">x</verse></o>', '<o><verse osisID="Gen.1.1"> </verse></o>', '<o><verse>x</verse></o>'):
        with pytest.raises(ValueError):
            ref_source.osis_verses(bad.encode())
    assert ref_source.expand_braces("a/{b,c}.md") == ["a/b.md", "a/c.md"] and sorted(set(ref_source.expand_braces("a/{b,c{d,e}}.md"))) == ["a/b.md", "a/cd.md", "a/ce.md"]


def test_quotes_keep_presence(spark, tmp_path):
    p = tmp_path / "q.json"
    p.write_text(json.dumps({"quotes": [{"id": "1", "category": "c", "text": "t", "verification": {"status": "sourced"}}, {"id": "2", "category": "c", "text": "t", "language": None, "verification": "authored"}]}))
    assert {(r.id, r.has_language, r.status) for r in ref_source.read_quotes(spark, str(p)).collect()} == {("1", False, "sourced"), ("2", True, "authored")}


SWIFT = """struct Card: View {
    var body: some View {
        Text("home.title")
            .lineLimit(1)
            .font(.title)
        // Text("home.comment")
        #if DEBUG
        Text("home.debug")
        #endif
    }
}
#Preview {
    Label("home.preview", systemImage: "x")
}
"""


def test_call_sites(spark):
    files = spark.createDataFrame([("a.swift", SWIFT), ("b.swift", None)], "path string, text string")
    sites = callsites.scan_sites(files)
    got = {r.key: (r.view, r.construct, r.modifiers, r.unreachable) for r in sites.collect()}
    assert got["home.title"] == ("Card", "Text", {"lineLimit": "1", "font": ".title"}, False)
    assert "home.comment" not in got and got["home.debug"][3] and got["home.preview"][3]
    keys = spark.createDataFrame([("home.title",), ("home.none",)], "key string")
    assert [r.key for r in callsites.unresolved(keys, sites).collect()] == ["home.none"]


def glossary_file(no, rev, body, locale="ro"):
    import datetime

    return (no, 1, locale, rev, body if body is None or isinstance(body, str) else json.dumps(body), datetime.datetime(2026, 1, rev))


FILE = "file_no long, app_no long, locale string, rev int, body string, received_at timestamp"


def test_drift(spark):
    a = {"locale": "ro", "rev_name": "x", "terms": {"t": {"p": "a", "n": 1, "gone": True}, "u": {"p": "b", "n": 2}}, "open": [{"id": "i", "why": "w", "role_forms": {"one": "o", "two": "p"}}]}
    b = {"locale": "ro", "terms": {"t": {"q": "a", "n": "1", "new": None}, "v": {"q": "z", "n": "2"}}, "open": [{"id": "i", "role_forms": {"uno": "o", "two": 5}, "why": None}], "version": 2}
    c = {"locale": "ro", "terms": {"t": {"q": "a", "n": "1", "new": None}}, "open": [{"id": "i", "why": 3}], "version": 2.5}
    rows = [glossary_file(1, 1, a), glossary_file(3, 4, b), glossary_file(2, 9, c), glossary_file(2, 9, c), glossary_file(5, 2, "no json"), glossary_file(6, 3, None), glossary_file(7, 1, c, "tr")]
    files = spark.createDataFrame(rows, FILE).withColumn("field_path", __import__("pyspark.sql.functions", fromlist=["lit"]).lit("clash"))
    got = {(r.file_no, r.field_path, r.change) for r in drift.field_changes(files).collect()}
    assert got == {
        (3, "rev_name", "removed"), (3, "version", "added"), (3, "terms.q", "renamed"), (3, "terms.n", "type_changed"), (3, "terms.gone", "removed"), (3, "terms.new", "added"),
        (3, "open.role_forms.uno", "renamed"), (3, "open.role_forms.two", "type_changed"), (2, "version", "type_changed"), (2, "open.role_forms", "removed"),
    }
    assert drift.field_changes(files.limit(0)).count() == 0
    d = [{"open": [{"id": "i", "role_forms": {"one": "o"}, "who": {"x": 1}}]}, {"open": [{"id": "i", "forms": {"one": "o"}, "who": {"y": 2}}]}, {"open": [{"id": "i", "forms": {"one": 1, "two": "p"}, "who": {"z": 2}}]}]
    followed = spark.createDataFrame([glossary_file(i, i + 1, x) for i, x in enumerate(d)], FILE)
    assert {(r.file_no, r.field_path, r.change) for r in drift.field_changes(followed).collect()} == {(1, "open.forms", "renamed"), (2, "open.forms.one", "type_changed"), (2, "open.forms.two", "added")}
    forms = drift.canonical_names(drift.field_changes(followed))
    got = {(r.file_no, r.field_path, r.value) for r in drift.consistent_values(followed, forms).where("field_path like 'open.role_forms.%'").collect()}
    assert got == {(0, "open.role_forms.one", "o"), (1, "open.role_forms.one", "o"), (2, "open.role_forms.one", "1"), (2, "open.role_forms.two", "p")}
    names = drift.canonical_names(drift.field_changes(files))
    assert names == {"terms.q": "terms.p", "open.role_forms.uno": "open.role_forms.one"}
    table = drift.consistent_table(files, "terms", names, ["p", "n"], {"terms.n": "int"})
    assert {(r.file_no, r.item, r.p, r.n) for r in table.collect()} == {(1, "t", "a", 1), (1, "u", "b", 2), (3, "t", "a", 1), (3, "v", "z", 2), (2, "t", "a", 1), (7, "t", "a", 1)}
    bad = drift.consistent_table(files, "open", names, ["why"], {"open.why": "int"})
    assert {(r.file_no, tuple(r.failed)) for r in bad.collect()} >= {(1, ("why",)), (2, ())}
