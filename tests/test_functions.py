"""Column functions on hand-written edge rows."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from billstream.functions import entries as E
from billstream.functions import names as N
from billstream.functions import nested, paths as P
from billstream.functions import stamps as S
from billstream.functions import text as X


def one(spark, column, **values):
    schema = ", ".join(f"{k} STRING" for k in values) or "x STRING"
    return spark.createDataFrame([tuple(values.values()) or ("",)], schema).select(column).first()[0]


@pytest.mark.parametrize(
    "date, want",
    [
        ("2025-01-31T00:14:23+00:00", "20250131T001423Z"),
        ("2025-01-31T04:00:00+05:00", "20250131T040000Z"),
        ("2025-01-31T04:00:00.123-0700", "20250131T040000Z"),
        ("2025-01-31T04:00:00Z", "20250131T040000Z"),
        ("2025-01-31 04:05", "20250131T040500Z"),
        ("2025-01-31T04:05+02:00", "20250131T040500Z"),
        ("2025-01-31", "20250131T000000Z"),
        ("2025-02-30", None),
        ("2025-01-31T25:00:00", None),
        ("soon", None),
        ("", None),
        (None, None),
    ],
)
def test_fmt_timestamp(spark, date, want):
    assert one(spark, S.fmt_timestamp(F.col("d")), d=date) == want


def test_event_instant_applies_the_offset(spark):
    text = F.date_format(S.event_instant(F.col("d")), "HH:mm")
    assert one(spark, text, d="2025-01-31T04:00:00+05:00") == "23:00"


@pytest.mark.parametrize(
    "text, want",
    [
        ("S COW:Passed", "s_cowpassed"),
        ("  a--b  c ", "ab_c"),
        ("Ñandú 2nd_reading!", "ñandú_2nd_reading"),
        ("x" * 150, "x" * 100),
        ("...", ""),
    ],
)
def test_slugify(spark, text, want):
    assert one(spark, X.slugify(F.col("t")), t=text) == want


def test_clean_event_name_trims_before_the_cut(spark):
    name = "a" * 39 + " b"
    assert one(spark, X.clean_event_name(F.col("t")), t=f" {name}!") == "a" * 39 + "_"


@pytest.mark.parametrize(
    "date, classes, org, description, want",
    [
        ("2025-01-31T00:14:23+00:00", "introduction", '~{"classification": "upper"}', "x", "20250131T001423Z.classification.introduction.upper.json"),
        ("2025-02-04T00:29:49+00:00", "", '~{"classification": "upper"}', "S COW:Passed", "20250204T002949Z_s_cowpassed.json"),
        (None, "passage", "", "x", "unknown.classification.passage.unknown.json"),
        ("bad", "filing", '~{"broken', None, "unknown_no_description.json"),
        ("2025-02-04", "became-law,passage", '~{"classification"', "x", "20250204T000000Z.classification.became-law.unknown.json"),
    ],
)
def test_action_log_name(spark, date, classes, org, description, want):
    listed = F.filter(F.split("c", ","), lambda c: c != "")
    got = one(
        spark, N.action_log_name(F.col("d"), listed, F.col("o"), F.col("t")), d=date, c=classes, o=org, t=description
    )
    assert got == want


def test_vote_log_names(spark):
    name = N.vote_log_name(F.col("d"), F.col("r"), F.col("o"))
    upper = '~{"classification": "upper"}'
    assert one(spark, name, d="2025-02-05T17:21:10+00:00", r="pass", o=upper) == "20250205T172110Z.vote_event.pass.upper.json"
    assert one(spark, name, d="2025-02-05T17:30:55+00:00", r="fail", o=upper) == "20250205T173055Z_vote_event_fail.json"
    assert one(spark, name, d=None, r=None, o="") == "unknown_vote_event_unknown.json"


def test_path_functions(spark):
    path = "wy-legislation/country:us/state:wy/sessions/2025/bills/SF1/logs/20250205T172110Z.vote_event.Tie.upper.json"
    assert one(spark, P.vote_result(F.col("p")), p=path) == "unknown"
    assert one(spark, P.vote_result(F.col("p")), p="a/logs/x.json") is None
    # The literal rule runs on to the next underscore; the strict one gives nothing.
    assert one(spark, P.path_stamp(F.col("p")), p=path) == "20250205T172110Z.vote"
    assert one(spark, P.path_stamp_strict(F.col("p")), p=path) is None
    assert one(spark, P.log_stamp(F.col("p")), p=path) == "20250205T172110Z"
    assert one(spark, P.is_session_log(F.col("p")), p=path) is True
    assert one(spark, P.is_session_log(F.col("p")), p=path.replace("/state:", "/st:")) is False
    assert one(spark, P.relative_path(F.col("p"), "/r"), p="/r/a\\b.json") == "a/b.json"


def test_template(spark):
    cols = P.parse_template(F.col("p"), "country:{c}/state:{s}/bills/{a}-{n}/metadata.json")
    row = spark.createDataFrame([("country:us/state:wy/bills/HB-7/metadata.json",)], "p STRING").select(
        *[v.alias(k) for k, v in cols.items()]
    )
    assert row.first().asDict() == {"c": "us", "s": "wy", "a": "HB", "n": "7"}


def test_safe_filename(spark):
    name = X.safe_filename(F.col("u"), F.col("n"), F.col("e"))
    assert one(spark, name, u="https://a/b/HB1.pdf", n=" As  Enrolled-Act (2) ", e="pdf") == "HB1_As_Enrolled_Act_2.pdf"
    assert one(spark, name, u="https://a/b/", n=None, e="xml") == "bill_content.xml"
    text = X.extracted_name(F.col("f"), F.col("e"))
    assert one(spark, text, f="a.HTML", e="html") == "a_extracted.txt"
    assert one(spark, text, f="a.htm", e="html") == "a_extracted.txt"


@pytest.mark.parametrize(
    "size, want", [(0, "0 B"), (1023, "1023 B"), (1024, "1.0 KB"), (19712, "19.2 KB"), (1 << 50, "1024.0 TB")]
)
def test_human_size(spark, size, want):
    assert one(spark, X.human_size(F.lit(size).cast("bigint"))) == want


def test_html_to_text(spark):
    html = "<p>a  b</p>\n <script>x<1</script><style>p{}</style><!-- c --> d&amp;e &lt;f&gt;"
    assert one(spark, X.html_to_text(F.col("h")), h=html) == "a b d&e <f>"


def test_escape_order(spark):
    assert one(spark, X.escape_html(F.col("h")), h="<a href='x'>&") == "&lt;a href=&#39;x&#39;&gt;&amp;"


def test_feed_texts_fall_back(spark):
    schema = (
        "id STRING, log STRUCT<action STRUCT<description STRING, date STRING, classification ARRAY<STRING>, organization_id STRING>, bill_id STRING>, "
        "bill STRUCT<title STRING, abstracts ARRAY<STRUCT<abstract STRING, note STRING>>, subject ARRAY<STRING>, identifier STRING, legislative_session STRING, from_organization STRING>, "
        "tags MAP<STRING, DOUBLE>, sources STRUCT<log STRING, bill STRING>, timestamp STRING"
    )
    df = spark.createDataFrame([(None, None, None, None, (None, None), None)], schema)
    c = F.col
    row = df.select(
        E.item_title(c("id"), c("log"), c("bill"), c("tags"), c("sources")),
        E.item_description(c("id"), c("log"), c("bill")),
        E.guid(c("sources"), c("timestamp"), c("id"), c("log")),
        E.item_link(c("sources"), F.lit(None).cast("string"), F.lit("https://x")),
        E.extract_text(c("log"), c("bill")),
    ).first()
    assert list(row) == ["untagged - unknown - Legislative Update", "Legislative update", "_", None, ""]


def test_json_field_and_readable(spark):
    doc = '{"a":[{"b":1},{"b":"x"}]}'
    assert one(spark, nested.json_field(F.col("d"), "a.1.b"), d=doc) == "x"
    assert one(spark, nested.json_field(F.col("d"), "a.7.b"), d=doc) is None
    assert one(spark, nested.json_field(F.col("d"), "a"), d="{") is None
    assert one(spark, nested.readable(F.col("d")), d='[1,"a",null,{"x":1},true]') == "1, a, null, [object], true"
    assert one(spark, nested.readable(F.col("d")), d="null") == "null"


def prune(value):
    """Plain restatement of the pruning rule for the property test."""
    if isinstance(value, dict):
        kept = {k: p for k, v in value.items() if (p := prune(v)) is not None}
        return kept or None
    if isinstance(value, list):
        kept = [p for v in value if (p := prune(v)) is not None]
        return kept or None
    return None if value in ("", None) else value


words = st.one_of(st.none(), st.just(""), st.text("ab", min_size=1, max_size=3))
docs = st.fixed_dictionaries(
    {
        "s": words,
        "l": st.one_of(st.none(), st.lists(words, max_size=3)),
        "n": st.fixed_dictionaries({"i": st.one_of(st.none(), st.integers(0, 3)), "t": words}),
    }
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(docs, min_size=1, max_size=20))
def test_deep_prune_property(spark, rows):
    schema = "i INT, d STRUCT<s STRING, l ARRAY<STRING>, n STRUCT<i INT, t STRING>>"
    df = spark.createDataFrame([(i, d) for i, d in enumerate(rows)], schema)
    got = df.select("i", nested.deep_prune(F.col("d"), df.schema["d"].dataType).alias("d")).orderBy("i").collect()

    def strip(row):
        if row is None:
            return None
        return {k: (strip(v) if hasattr(v, "asDict") else v) for k, v in row.asDict().items() if v is not None}

    assert [strip(r.d) for r in got] == [prune(d) for d in rows]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("&sect;5 &mdash; &#8217;&#x2014;&#X41;", "§5 — ’—A"), ("&amp;lt; &nosuch; &#0; &#xD800; &", "&lt; &nosuch; &#0; &#xD800; &"),
        ("", ""), ("no entity", "no entity"), ("&lt;&gt;&quot;&apos;&nbsp;", "<>\"' "), ("&#128512;", "\U0001f600"), ("&lt", "&lt"),
    ],
)
def test_entities(spark, text, want):
    from billstream.functions.text import decode_entities

    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(decode_entities(F.col("t"))).first()[0] == want


def test_entities_of_html_5(spark):
    from html import unescape
    from html.entities import html5

    from billstream.functions.text import decode_entities

    names = [n for n in html5 if n.endswith(";")]
    texts = [f"a&{n}b" for n in names] + [f"&#{n};&#x{n:x};" for n in range(128, 160) if n not in (0x81, 0x8D, 0x8F, 0x90, 0x9D)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in df.select("t", decode_entities(F.col("t"))).collect()}
    assert len(names) > 2000 and got == {t: unescape(t) for t in texts} and got["&#150;&#x96;"] == "\u2013\u2013"


def test_mean_pool_shuffles_one_row_per_task_and_key(spark):
    from billstream.functions.vectors import mean_pool

    rows = [(i % 3, [float(i), 1.0, -float(i)][: 2 + (i % 3 > 0)]) for i in range(300)] + [(1, []), (2, None), (7, [None, 2.0])]
    df = spark.createDataFrame(rows, "k INT, v ARRAY<DOUBLE>").repartition(5)
    got = {r.k: r.v for r in mean_pool(df, "k", "v").collect()}
    assert got == {0: [148.5, 1.0], 1: [149.5, 1.0, -149.5], 2: [150.5, 1.0, -150.5], 7: [None, 2.0]}
    plan = mean_pool(df, "k", "v", 3)._jdf.queryExecution().executedPlan().toString()
    # Partial and final aggregate, nothing exploded in between.
    assert "Generate" not in plan and plan.count("HashAggregate(keys=[k") == 2 and "partial_avg" in plan
    assert mean_pool(df.limit(0), "k", "v").collect() == []


def test_deep_prune_plan_grows_with_the_depth_alone(spark):
    def size(depth):
        kind = "STRING"
        for _ in range(depth):
            kind = f"STRUCT<a: {kind}, b: STRING>"
        df = spark.createDataFrame([], f"d {kind}")
        pruned = df.select(nested.deep_prune(F.col("d"), df.schema["d"].dataType).alias("d"))
        return len(pruned._jdf.queryExecution().optimizedPlan().toString())

    four, eight = size(4), size(8)
    assert eight < 4 * four
