"""Operators on edge rows, and properties of the incremental core."""

from collections import Counter
from xml.etree import ElementTree

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billstream.functions import arrow
from billstream.operators import bills as B
from billstream.operators import documents as D
from billstream.operators import keywords as KW
from billstream.operators import links as K
from billstream.operators import logs as L
from billstream.operators import quality as Q
from billstream.operators import routine as R
from billstream.operators import tagging as G
from billstream.operators.common import top_per_key
from billstream.rules.routine_values import DENIED_CLASSES, DENIED_PHRASES

ACTIONS = "bill_id STRING, ord INT, description STRING, date STRING"
STORED = f"{ACTIONS}, created STRING"


# -- routine rules -----------------------------------------------------------------------


@pytest.mark.parametrize(
    "locale, classes, text, kept",
    [
        ("ak", [], "(H) EDC, FIN", False),
        ("ak", [], "(H) ññññññ, x", False),
        ("ak", [], "(H) ññññññññññ, x", True),  # the bound counts bytes
        ("ak", [], "(H) EDC", True),
        ("ak", ["filing"], None, False),
        ("ak", None, None, True),
        ("ca", [], "June 4 set for first hearing", False),
        ("ca", [], "July 4 set for first hearing", True),
        ("ca", [], "Set for hearing", False),
        ("ar", [], "Read first time, rules suspended, referred to X", False),
        ("ar", [], "Read first time, referred to X", True),
        ("ky", [], "to Health (H)", False),
        ("tx", ["introduction"], "Filed", True),
        ("??", ["filing"], "Filed", True),
        ("wy", ["referral-committee"], "x", False),
    ],
)
def test_routine_rules(spark, locale, classes, text, kept):
    df = spark.createDataFrame([(locale, classes, text)], "locale STRING, classes ARRAY<STRING>, description STRING")
    assert R.routine_filter(df).count() == int(kept)
    assert R.routine_filter(df, alias="none").count() == 1


def test_rules_of_further_locales_come_from_a_file(spark, tmp_path):
    path = tmp_path / "rules.json"
    path.write_text('{"locale":"zz","equals":"Noted"}\n{"locale":"zz","prefix":"To ","contains":["A","B"]}\n')
    rules = R.builtin_rules(spark).unionByName(R.load_rules(spark, str(path)))
    df = spark.createDataFrame(
        [("zz", [], "Noted"), ("zz", [], "To BA"), ("zz", [], "To B"), ("al", [], "Filed")],
        "locale STRING, classes ARRAY<STRING>, description STRING",
    )
    assert [r.description for r in R.routine_filter(df, rules).collect()] == ["To B"]


def test_rule_tables_are_consistent():
    assert len(DENIED_CLASSES) == 44 and list(DENIED_CLASSES) == sorted(DENIED_CLASSES)
    assert len(DENIED_PHRASES) == 49 and list(DENIED_PHRASES) == sorted(DENIED_PHRASES)
    assert all(r.get("equals") or r.get("prefix") or r.get("contains") for rs in DENIED_PHRASES.values() for r in rs)


@pytest.mark.parametrize(
    ("locale", "text", "kept"),
    [
        ("wy", "Bill Number Assigned", False), ("wy", "S Received for Concurrence", True),
        ("wv", "To House Finance", False), ("wv", "To Governor 3/2", True),
        ("nv", "Prefiled. Referred to Committee on Rules.", False), ("nv", "Prefiled.", True),
        ("la", "Prefiled and under the rules provisionally referred to the Committee on Health", False),
    ],
)
def test_rules_of_all_locales_ship(spark, locale, text, kept):
    df = spark.createDataFrame([(locale, [], text)], "locale STRING, classes ARRAY<STRING>, description STRING")
    assert (R.routine_filter(df).count() == 1) == kept


def test_every_substring_of_a_rule_counts(spark):
    rules = spark.createDataFrame([("zz", ["a", "b", "c", "NEVER"])], "locale STRING, contains ARRAY<STRING>")
    rules = rules.selectExpr("locale", "cast(null as string) as deny_class", "cast(null as string) as equals", "cast(null as string) as prefix", "contains", "cast(null as int) as shorter_than")
    df = spark.createDataFrame([("zz", [], "a b c")], "locale STRING, classes ARRAY<STRING>, description STRING")
    assert R.routine_filter(df, rules).count() == 1


# -- bills -------------------------------------------------------------------------------


def actions(spark, rows, schema=ACTIONS):
    return spark.createDataFrame(rows, schema)


def test_merge_takes_the_last_stored_duplicate_and_drops_vanished(spark):
    stored = actions(spark, [("b", 1, "A", "d", "x"), ("b", 2, "A", "d", "y"), ("b", 3, "Gone", "d", "z")], STORED)
    incoming = actions(spark, [("b", 1, "N", None), ("b", 2, "A", "d"), ("b", 3, "A", "d")])
    rows = B.merge_actions(stored, incoming, ["created"]).orderBy("ord").collect()
    assert [(r.description, r.created, r.is_new) for r in rows] == [("N", None, True), ("A", "y", False), ("A", "y", False)]


def test_missing_key_parts_count_as_empty(spark):
    stored = actions(spark, [("b", 1, "A", None, "x")], STORED)
    assert B.new_actions(stored, actions(spark, [("b", 1, "A", "")])).count() == 0


def test_equal_counts_hide_edits_unless_hashed(spark):
    old = actions(spark, [("b", 1, "A", "d")])
    new = actions(spark, [("b", 1, "B", "d")])
    assert B.changed_bills(old, new).count() == 0
    assert B.changed_bills(old, new, compare="hash").count() == 1


rows_of_bills = st.lists(
    st.tuples(st.sampled_from("pq"), st.sampled_from("ABC"), st.sampled_from(["1", "2"])), min_size=1, max_size=8
)


def numbered(rows):
    seen = Counter()
    out = []
    for b, d, t in rows:
        seen[b] += 1
        out.append((b, seen[b], d, t))
    return out


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows_of_bills, rows_of_bills)
def test_a_repeated_run_changes_nothing(spark, first, second):
    empty = actions(spark, [], STORED)
    one = B.incremental_bills(empty, actions(spark, numbered(first)), F.lit("r1"))
    state = one
    expected = {}
    stored = [tuple(r) for r in one.collect()]
    known = {}
    for b, o, d, t, c in sorted(stored, key=lambda r: r[1]):
        known[(b, d, t)] = c
    two = B.incremental_bills(actions(spark, stored, STORED), actions(spark, numbered(second)), F.lit("r2"))
    got = sorted(tuple(r) for r in two.collect())
    again = B.incremental_bills(actions(spark, got, STORED), actions(spark, numbered(second)), F.lit("r3"))
    assert sorted(tuple(r) for r in again.collect()) == got
    counts = Counter(r[0] for r in stored)
    for b, o, d, t in numbered(second):
        expected.setdefault(b, []).append((b, o, d, t, known.get((b, d, t), "r2")))
    want = []
    for b in set(counts) | set(expected):
        want += [r for r in stored if r[0] == b] if b not in expected or len(expected[b]) == counts.get(b) else expected[b]
    assert got == sorted(want)
    assert state is one


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("xy"), st.integers(0, 99)), min_size=1, max_size=12, unique_by=lambda r: r[2]))
def test_last_write_wins_property(spark, rows):
    df = spark.createDataFrame(rows, "bill_id STRING, name STRING, ord INT")
    got = {(r.bill_id, r.name): r.ord for r in B.last_write_wins(df, ["bill_id", "name"], ["ord"]).collect()}
    want = {}
    for b, n, o in rows:
        want[(b, n)] = max(o, want.get((b, n), -1))
    assert got == want


# -- links, marks, orphans -------------------------------------------------------------------


def test_link_takes_the_first_bill_that_resolves(spark):
    agenda = spark.createDataFrame(
        [(1, 1, "bill", " HB 9"), (1, 2, "bill", "HB 1"), (2, 1, "person", "HB 1"), (3, 1, "bill", "HB 9")],
        "event_id INT, pos INT, entity_type STRING, name STRING",
    )
    sessions = spark.createDataFrame([("HB1", "2025", "2025-2026")], "bill_id STRING, session_id STRING, date_folder STRING")
    linked, rest = K.pending_after_run(agenda.limit(0), agenda, sessions)
    assert [(r.event_id, r.bill_id, r.session_id) for r in linked.collect()] == [(1, "HB1", "2025")]
    assert {r.event_id for r in K.pending_events(agenda, linked).collect()} == {3}
    assert {r.event_id for r in rest.collect()} == {2, 3}


def test_a_bill_in_two_sessions_takes_the_latest(spark):
    bills = spark.createDataFrame([("HB1", "a"), ("HB1", "b")], "bill_id STRING, session_id STRING")
    sessions = spark.createDataFrame(
        [("a", "A", "2025-01-01", "2026"), ("b", "B", "2023-01-01", "2024")],
        "session_id STRING, name STRING, start_date STRING, end_date STRING",
    )
    assert [tuple(r) for r in K.bill_session_map(bills, sessions).select("session_id", "date_folder").collect()] == [("a", "2025-2026")]


def test_marks_are_strict_unless_told_otherwise(spark):
    items = spark.createDataFrame(
        [(1, "v", "2024-01-01T00:00:00"), (2, "v", "2024-01-01T00:00:01"), (3, "v", ""), (4, "v", "bad"), (5, "w", "2024-01-01")],
        "id INT, category STRING, start_date STRING",
    )
    marks = spark.sql("SELECT 'v' AS category, timestamp'2024-01-01 00:00:00' AS mark")
    got = {r.id: r.outcome for r in K.newer_than_mark(items, marks).collect()}
    assert got == {2: "newer", 3: "missing_date", 5: "newer"}
    assert 1 in {r.id for r in K.newer_than_mark(items, marks, allow_equal=True).collect()}


def test_orphans_over_three_runs(spark):
    def run(state, votes, bills, name):
        cur = spark.createDataFrame([(b, n, 0) for b, n in votes], "bill_id STRING, vote_count BIGINT, event_count BIGINT")
        arrived = spark.createDataFrame([(b,) for b in bills], "bill_id STRING")
        return K.update_orphans(state, cur, arrived, F.lit(name))

    state = spark.createDataFrame([], K.ORPHAN_STATE)
    state = run(state, [("A", 1), ("B", 1)], [], "r1")
    state = run(state, [("A", 2), ("B", 1), ("C", 1)], ["B"], "r2")
    state = run(state, [("C", 5)], ["B"], "r3")
    rows = {r.bill_id: tuple(r)[1:] for r in state.collect()}
    # A vanished from the third run: its entry stays as it was.
    assert rows == {"A": ("r1", "r2", 2, 2, 0), "C": ("r2", "r3", 2, 5, 0)}


# -- limits and quality ------------------------------------------------------------------------


def test_large_limits(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.col("id"))
    got = top_per_key(df, ["k"], [F.desc("id")], 1200)
    assert got.groupBy("k").count().filter("count <> 1200").count() == 0
    assert got.agg(F.min("id")).first()[0] == 4999 - 3 * 1200 + 1
    mapped = df.withColumn("tags", F.create_map(F.lit("a"), "id"))
    assert top_per_key(mapped, ["k"], [F.desc("id")], 1500).count() == 4500


def test_a_bill_id_in_two_sessions(spark):
    logs = spark.createDataFrame([("s", "1", "HB1", 1), ("s", "2", "HB1", 2)], "state string, session_id string, bill_id string, event_id int")
    bills = spark.createDataFrame([("s", "1", "HB1", "old"), ("s", "2", "HB1", "new")], "state string, session_id string, bill_id string, title string")
    tags = spark.createDataFrame(
        [("1", "HB1", "water", 0.2), ("1", "HB1", "water", 0.7), ("2", "HB1", "water", 0.4), ("2", "HB1", None, 0.1)],
        "session_id string, bill_id string, tag string, score double",
    )
    got = {r.event_id: (r.title, r.tags) for r in L.join_multi(logs, "bill,tags", bills, tags).collect()}
    assert got == {1: ("old", {"water": 0.7}), 2: ("new", {"water": 0.4})}
    assert L.tag_filter(logs, tags.filter("session_id = '1'"), ["water"]).count() == 1


def test_join_options():
    assert L.parse_join_specs("bill, tags,,people") == (["bill", "tags"], ["people"])
    with pytest.raises(ValueError):
        L.join_field(F.lit("{}"), "bill")


def test_dedup_names_against_earlier_runs(spark):
    schema = "category STRING, name STRING, file_name STRING"
    errors = spark.createDataFrame([("c", "n", "2"), ("c", "n", "1"), ("c", "", "3"), ("c", None, "4"), ("c", "old", "5")], schema)
    filed = spark.createDataFrame([("c", "old", "0")], schema)
    got = {r.file_name for r in Q.dedup_name_quarantine(errors, filed).collect()}
    assert got == {"1", "3", "4"}


# -- documents and tags ----------------------------------------------------------------------


def structure(spark, text):
    return D.line_structure(spark.createDataFrame([(text,)], "t STRING"), "t").first()


def test_line_structure(spark):
    row = structure(spark, "State\n\n  AN ACT on water \nintro\nSection 1. A\nmore\n2. B\n§ 3 C")
    assert row.title == "AN ACT on water"
    assert row.sections == ["State\nintro", "Section 1. A\nmore", "2. B", "§ 3 C"]
    row = structure(spark, "only\nshort")
    assert (row.title, row.official_title, row.sections) == ("PDF Document", "", ["only\nshort"])
    row = structure(spark, "Section 1 of the bill\nx")  # a title line is no header
    assert (row.title, row.sections) == ("Section 1 of the bill", ["x"])
    assert structure(spark, " \n ").sections == [" \n "]
    assert structure(spark, "A BILL").sections == ["A BILL"]


def test_best_link_rules(spark):
    links = spark.createDataFrame(
        [
            (1, 0, "u0", "application/pdf"), (1, 1, "u1", "text/html; x"), (1, 2, "u2", "TEXT/HTML"),
            (2, 0, "u", "application/xml"), (3, 0, None, "text/xml"), (3, 1, "u", "text/plain"),
        ],
        "version_id INT, pos INT, url STRING, media_type STRING",
    )
    assert {(r.version_id, r.url, r.pos) for r in D.best_links(links).collect()} == {(1, "u1", 1), (3, "u", 1)}
    assert D.best_links(links, accept_application_xml=True).filter("version_id = 2").count() == 1
    docs = D.best_links(links).withColumn("content", F.lit("x"))
    assert {r.version_id for r in D.extract_dispatch(docs).collect()} == {1}


def test_xml_text(spark):
    xml = "<b><title> T </title><official-title>O</official-title><section>a <i>b</i></section><section> </section></b>"
    df = spark.createDataFrame([(xml,), ("<b>",), (None,)], "x STRING")
    rows = df.select(D.xml_bill_text(F.col("x")).alias("r")).select("r.*").collect()
    assert tuple(rows[0])[:3] == ("T", "O", ["a b"]) and rows[0].error is None
    assert rows[1].error and rows[2].error


XML_CASES = [
    "<b><section>a<section>b <i>c</i></section>d<section/>e</section> x <section k='>'>f</section></b>",
    "<section><title>in root</title>r<section> inner </section></section>",
    "<b><title/><official-title>O<i>x</i></official-title>&amp;&lt;sec&gt;<x><title>late</title></x></b>",
    "<b><sections>no</sections><section\n>\u00a0é\n</section ></b>", "<b/>", "<?xml version='1.0'?><b>t</b>",
    "<b><section>1<section>2<section>3</section></section>4</section><section>5</section></b>",
    "<s><section>b</section>c<x/>d</s>", "<s><section>a<section>b</section>tail<i>x</i>y</section>z<!-- no --> w<i/>v</s>",
    "<b><![CDATA[<section> x]]> &amp; <![CDATA[a]]>b<section>s<![CDATA[</section>]]>t</section></b>",
    "<!DOCTYPE bill [<!ENTITY who 'the <i>house</i>'><!ENTITY all \"&who; and &#x53;enate\"> <!ELEMENT a (b)> <!-- > ] -->]><bill><section>&all;</section>&who;</bill>",
    "<!DOCTYPE bill SYSTEM 'bill.dtd'>\n<bill><section>x</section></bill>\n<!-- end -->", "<?xml version='1.0'?>\n<?style a='<section>'?><b><!-- <section>no</section> --><section>y</section></b>",
    "<b xmlns='urn:x'><title>t</title><section>z</section></b>", "<b xmlns:p='urn:x'><p:section>q</p:section><title>t<!-- c -->u</title></b>",
    "<b>line\r\nbreak &#13; &#233;&#x1F600; &quot;&apos;</b>", "<b a='>' c=\"' > \"><section d='/>'>e</section></b>",
]


@pytest.mark.parametrize("xml", XML_CASES)
def test_xml_parts_equal_a_plain_parser(spark, xml):
    root = ElementTree.fromstring(xml)
    got = spark.createDataFrame([(xml,)], "x STRING").select(D.xml_bill_text(F.col("x")).alias("r")).first().r
    # The plain way: a section's text goes on to the next tag.
    texts = [ElementTree.tostring(s, encoding="unicode", method="text").strip() for s in root.iterfind(".//section")]
    assert got.sections == [t for t in texts if t]
    assert got.raw_text == "".join(root.itertext()).strip() and got.error is None
    assert got.title == (root.findtext(".//title") or "").strip()
    assert got.official_title == (root.findtext(".//official-title") or "").strip()


@pytest.mark.parametrize("xml", ["", " ", "no xml", "<a><b></a>", "<a>", "<a/><b/>", "<a/><b>", f"<a/></{D.OUTER}><{D.OUTER}>", "<a/>x", "<a/>x<!-- y -->", "<a>&nosuch;</a>", "<a x=1/>", "<a>x</a", "<a>]]></a>x<",
    "<!DOCTYPE bill><bill>x</bill><junk", "<!DOCTYPE bill><bill>x</bill><junk/>", "<!DOCTYPE b [<!ENTITY a 'x'><b>&a;</b>", "<a/><!DOCTYPE a>", "<a><!DOCTYPE a></a>",
    "<!DOCTYPE b [<!ENTITY a 'x'>]><b>&c;</b>", "<a><![CDATA[x</a>", "<a><!-- x</a>", "<![CDATA[x]]><a/>", "<a>\x01</a>", "<a>&#1;</a>", "<p:a/>", "<a x='1' x='2'/>", "<a x='<'/>", " <?xml version='1.0'?><a/>",
    "<!DOCTYPE b [<!ENTITY a '" + "x" * 1000 + "'>" + "".join(f"<!ENTITY {b} '{f'&{a};' * 100}'>" for a, b in zip("abcdef", "bcdefg")) + "]><b>&g;</b>"])
def test_damaged_xml_is_an_error(spark, xml):
    got = spark.createDataFrame([(xml,), ("<a>good</a>",)], "x STRING").select(D.xml_bill_text(F.col("x")).alias("r")).collect()
    assert got[0].r.error and got[0].r.raw_text is None and got[1].r.raw_text == "good"


@pytest.mark.parametrize(
    "text, keyword, hit",
    [
        ("a trans act", "trans", True), ("transport", "trans", False), ("LGBTQ+ rights", "lgbtq", True),
        ("xlgbtq", "lgbtq", False), ("ñtrans", "trans", False), ("clean  water", "clean water", False),
        ("unclean water", "clean water", True), ("c++ x", "c++", False), ("c++x", "c++", True), ("a.b", "a.b", True), ("axb", "a.b", False),
    ],
)
def test_keywords(spark, text, keyword, hit):
    df = spark.createDataFrame([(text.lower(),)], "t STRING")
    assert df.select(KW.keyword_hit(F.col("t"), keyword)).first()[0] is hit
    assert df.select(G.matched_keywords(F.col("t"), [keyword])).first()[0] == ([keyword] if hit else [])


@pytest.mark.parametrize(
    "base, example, negative, hit, threshold, want",
    [
        (0.8, 0.6, None, False, 0.5, (0.8 * 0.5 + 0.6 * 0.35) / 0.85),
        (0.8, None, None, False, 0.5, 0.8),
        (0.2, 0.1, None, True, 0.9, 0.9),
        (0.8, 0.6, 0.8, True, 0.5, 0.8 * 0.35 + 0.6 * 0.25 + 0.4 - 0.2),
        (-0.9, None, 0.4, False, 0.5, 0.0),
    ],
)
def test_composite_score(spark, base, example, negative, hit, threshold, want):
    cols = [F.lit(x).cast("double") for x in (base, example, negative)]
    got = spark.range(1).select(G.composite_score(*cols, F.lit(hit), F.lit(threshold))).first()[0]
    assert got == pytest.approx(want)


VECTORS = "tag STRING, vector ARRAY<DOUBLE>, examples ARRAY<ARRAY<DOUBLE>>, negatives ARRAY<ARRAY<DOUBLE>>"


@pytest.mark.parametrize("kept", [0, 1 << 20])
def test_vectors_are_read_in_blocks(spark, monkeypatch, kept):
    for name, value in (("KEPT_BYTES", kept), ("VECTORS_AT_ONCE", 2), ("CELLS", 7)):
        monkeypatch.setattr(arrow, name, value)
    rows = [(str(i), [1.0, float(i)], [[1.0, 1.0], [0.0, 1.0], [1.0, 0.0]] if i == 1 else None, [[-1.0, 0.0]] if i == 2 else []) for i in range(5)]
    entries = spark.createDataFrame([(n, "x", [1.0, 0.0]) for n in range(9)], "id INT, text STRING, vector ARRAY<DOUBLE>")
    tags = [G.Tag(str(i), threshold=0.0) for i in range(5)]
    table = spark.createDataFrame([*rows, ("unknown", [1.0, 0.0], None, None)], VECTORS)
    got = G.score_entries(entries, "text", "vector", G.store_tag_vectors(table, tags), tags).collect()
    assert len(got) == 45 and {r.id for r in got} == set(range(9))
    want = {str(i): round(1 / (1 + i * i) ** 0.5, 4) for i in range(5)}
    want["1"] = round((0.5 * want["1"] + 0.35) / 0.85, 4)
    assert {r.tag: round(r.final_score, 4) for r in got} == pytest.approx(want, abs=2e-4)


def test_scores_come_out_sparse(spark):
    rows = [(str(i), [1.0, float(i)], None, None) for i in range(50)]
    tags = [G.Tag(str(i), threshold=0.99) for i in range(50)]
    vectors = G.store_tag_vectors(spark.createDataFrame(rows, VECTORS), tags)
    entries = spark.createDataFrame([(n, "x", [1.0, 0.0]) for n in range(20)], "id INT, text STRING, vector ARRAY<DOUBLE>")
    df = G.score_entries(entries, "text", "vector", vectors, tags)
    assert df.count() == 20 and "Generate" not in df._jdf.queryExecution().executedPlan().toString()


def test_scores_agree_with_the_column_form(spark):
    grid = [(b, e, n, h, t) for b in (None, -0.4, 0.7) for e in (None, 0.0, 0.9) for n in (None, 0.0, 0.8) for h in (True, False) for t in (0.2, 0.9)]
    df = spark.createDataFrame(grid, "b DOUBLE, e DOUBLE, n DOUBLE, h BOOLEAN, t DOUBLE").coalesce(1)
    want = [r.s for r in df.select(G.composite_score(*(F.col(c) for c in "bent"[:3]), F.col("h"), F.col("t")).alias("s")).collect()]
    columns = [np.array([np.nan if x is None else x for x in c], float) for c in list(zip(*grid))[:3]]
    got = arrow.composite(*columns, np.array([g[3] for g in grid]), np.array([g[4] for g in grid]))
    assert got.tolist() == pytest.approx(want)


def test_missing_vectors_take_keywords(spark):
    tags = [G.Tag("a", include_keywords=["water"], threshold=0.5)]
    vectors = G.store_tag_vectors(spark.createDataFrame([("a", [1.0, 0.0], None, None)], VECTORS), tags)
    rows = [(1, "no word", [2.0, 0.0]), (2, "some water", None), (3, "dry", None), (4, "water", [1.0]), (5, "water", [1.0, None]), (6, "water", [0.0, 1.0])]
    entries = spark.createDataFrame(rows, "id INT, text STRING, vector ARRAY<DOUBLE>").coalesce(1)
    got = {r.id: r for r in G.semantic_or_keyword_tags(entries, "text", "vector", vectors, tags).collect()}
    assert set(got) == {1, 2, 4, 5, 6} and round(got[1].final_score, 4) == 1.0
    assert all(got[i].keyword_match == ["water"] and got[i].base_embedding is None for i in (2, 4, 5))
    bare = {r.id: r.base_embedding for r in G.score_entries(entries, "text", "vector", vectors, tags, keep_all=True).collect()}
    assert bare == {1: 1.0, 2: None, 3: None, 4: None, 5: None, 6: 0.0}


def test_embedder_hook(spark):
    def embedder(batches):
        for b in batches:
            b["vector"] = [[float(len(t)), 1.0] for t in b["text"]]
            yield b

    df = spark.createDataFrame([(1, "abc")], "id INT, text STRING")
    assert G.embed_texts(df, embedder).first().vector == [3.0, 1.0]


def test_overwrite_scores_tagged_bills_again(spark):
    entries = spark.createDataFrame([("s", "b", "the water")], "session_id STRING, bill_id STRING, text STRING")
    stored = spark.createDataFrame([("s", "old", "b", "h", 0.9)], "session_id STRING, tag STRING, bill_id STRING, text_hash STRING, final_score DOUBLE")
    tags = [G.Tag("wet", include_keywords=["water"])]
    assert G.tag_job(entries, stored, tags).count() == 1
    assert {r.tag for r in G.tag_job(entries, stored, tags, overwrite=True).collect()} == {"old", "wet"}
    assert {r.tag for r in G.tag_job(entries, stored, tags, only="wet").collect()} == {"old", "wet"}


def literal_hits(df, tags):
    """The form with one expression per keyword."""
    low = F.lower("text")
    rows = []
    for tag in tags:
        found = F.array_compact(F.array(*[F.when(KW.keyword_hit(low, k), F.lit(k)) for k in tag.include_keywords]))
        blocked = F.exists(F.array(F.lit(False), *[KW.keyword_hit(low, k) for k in tag.exclude_keywords]), lambda x: x)
        hits = df.select("id", found.alias("found")).filter((F.size("found") > 0) & ~blocked)
        rows += [(r.id, tag.name, tuple(r.found)) for r in hits.collect()]
    return sorted(rows)


def index_hits(df, tags):
    return sorted((r.id, r.tag, tuple(r.keyword_match)) for r in G.keyword_tags(df, "text", tags).collect())


def test_the_index_agrees_with_the_patterns(spark):
    texts = [
        "the trans-act", "transport", "LGBTQ+ Rights", "ñtrans", "clean water; c++x", "", "trans_it a.b", "WATER water", None,
        "musique dehors", "a b c", "x  y", " lead", "trail ", "r&d tax", "+-+", "a  b", "covid-19 and COVID-190", "Ärger über",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING")
    tags = [
        G.Tag("a", include_keywords=["trans", "LGBTQ", "clean water", "c++", "Water", "water"], exclude_keywords=["port"]),
        G.Tag("b", include_keywords=["water", "a.b", "transport"], exclude_keywords=["rights", "clean"]),
        G.Tag("c", include_keywords=["que de", "b c", "a b c", "a b", "x  y", " lead", "trail ", "  ", " ", "x "]),
        G.Tag("d", include_keywords=["r&d", "+-", "covid-19", "ärger", "a  b"], exclude_keywords=["b c"]),
        G.Tag("none"),
    ]
    got = index_hits(df, tags)
    assert got == literal_hits(df, tags)
    assert (4, "a", ("clean water", "c++", "Water", "water")) in got and (9, "c", ("que de", " ")) in got


def test_five_thousand_tags_are_one_plan(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("id"), "text")
    parts = ["th", "an", "er", "re", "en", "in", "on", "es", "ti", "ou", "ed", "or", "nd", "ha", "at", "de", "la", "que"]
    words = [a + b + c for a in parts for b in parts for c in ["", *parts]][:5000]
    few = [G.Tag(w, include_keywords=[w, f"{w} {v}"], exclude_keywords=[f"{v} the"]) for w, v in zip(words, reversed(words))]
    assert len(few) == 5000
    got = index_hits(docs, few)
    some = few[::500] + [t for t in few if t.name in {r[1] for r in got[:5]}]
    chosen = {t.name for t in some}
    assert [r for r in got if r[1] in chosen] == literal_hits(docs, list({t.name: t for t in some}.values())) and len(got) > 1000
    plans = [str(G.keyword_tags(docs, "text", few[:n])._jdf.queryExecution().analyzed().numberedTreeString()).count("lambda") for n in (10, 5000)]
    assert plans[0] == plans[1]


def test_extraction_prunes_contents_first(spark):
    bills = spark.createDataFrame([(1, None, None, 0)], "bill_key INT, logs_update TIMESTAMP_NTZ, text_update TIMESTAMP_NTZ, files INT")
    links = spark.createDataFrame([(1, 7, 0, "http://x/a.xml", "text/xml", "As passed")], "bill_key INT, version_id INT, pos INT, url STRING, media_type STRING, note STRING")
    stored = spark.createDataFrame([(7, "xml", "<a><title>T</title><section>s</section></a>"), (8, "xml", "<a/>")], "version_id INT, ext STRING, content STRING")
    after, done = D.extract_batch(bills, links, stored, F.lit("2030-01-01").cast("timestamp_ntz"))
    row = done.first()
    assert (row.file_name, row.text_name, row.sections, row.error) == ("a_As_passed.xml", "a_As_passed_extracted.txt", ["s"], None)
    assert row.document.startswith("Title: T\nOfficial Title: \nNumber of Sections: 1\nSource: versions - As passed\nMedia Type: text/xml\n")
    assert "LeftSemi" in done._jdf.queryExecution().optimizedPlan().toString() and after.first().status == "ok"
    assert D.extraction_failures(done).count() == 0


@pytest.mark.parametrize("part", [1, 3, 1000])
def test_blocks_do_not_depend_on_the_parts(spark, part):
    lines = ["x", D.TRACEBACK_HEAD, *[f" l{i}" for i in range(12)], D.TRACEBACK_HEAD, "ValueError: a", D.TRACEBACK_HEAD, "KeyError: b"]
    rows = [(1, 10 * i, c) for i, c in enumerate(lines)] + [(2, 5, "plain"), (3, 1, " l"), (3, 2, D.TRACEBACK_HEAD)]
    df = spark.createDataFrame(rows, "run INT, line BIGINT, content STRING").repartition(4)
    placed = D.with_blocks(df, {"head": F.col("content").startswith("Traceback")}, part)
    got = {(r.run, r.line): (r.place, r.head) for r in placed.collect()}
    assert got[1, 0] == (1, None) and got[1, 10] == (2, 2) and got[1, 130] == (14, 2) and got[1, 150] == (16, 15)
    assert got[2, 5] == (1, None) and got[3, 2] == (2, 2) and len(got) == len(rows)


def test_error_blocks_are_whole_tracebacks(spark):
    lines = [D.TRACEBACK_HEAD, *[f" l{i}" for i in range(12)], D.TRACEBACK_HEAD, "ValueError: a"]
    runs = {1: lines, 2: ["ValueError: z", "ERROR y"], 3: ["fine", "bills scrape:", "a", "duration: 0:01:02", "duration: 9"], 4: ["duration: 7"]}
    rows = [(run, i, c) for run, content in runs.items() for i, c in enumerate(content)]
    df = spark.createDataFrame(rows, "run INT, line BIGINT, content STRING")
    got = {(r.run, r.line): r.content for r in D.error_blocks(df).collect()}
    assert got == {(1, 0): "\n".join(lines[:11]), (1, 13): "\n".join(lines[13:]), (2, 0): "ValueError: z"}
    summary = {r.run: (r.duration, r.error_count, len(r.errors)) for r in D.run_summary(df).collect()}
    assert summary == {1: ("unknown", 2, 2), 2: ("unknown", 1, 1), 3: ("0:01:02", 0, 0), 4: ("unknown", 0, 0)}


def test_struck_documents(spark):
    def line(doc, page, no, text):
        """Capital letters are struck."""
        return [(doc, page, no, i, float(i), i + 1.0, c, "Strike" if c.isupper() else "Times", 1.0) for i, c in enumerate(text)]

    rows = line(1, 1, 1, "abC") + line(1, 1, 2, "DeFg") + line(1, 2, 1, "plain") + line(1, 3, 1, "XY") + line(2, 1, 1, "none")
    df = spark.createDataFrame(rows, "doc INT, page INT, line INT, pos INT, x0 DOUBLE, x1 DOUBLE, ch STRING, font STRING, gray DOUBLE").repartition(3)
    got = {r.doc: r for r in D.struck_documents(df).collect()}
    assert got[1].text == "abC\nDeFg\n\nplain\n\nXY\n\n[DELETED: CDF]\n[DELETED: XY]" and got[1].struck_pages == 2
    assert [got[1].text[r.begin : r.end] for r in got[1].struck] == ["C", "D", "F", "XY"]
    assert (got[2].text, got[2].struck_pages, got[2].struck) == ("none", 0, [])
