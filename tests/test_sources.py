"""Readers and writers on small JSON trees."""

import json
from xml.etree import ElementTree

from pyspark.sql import functions as F

from billstream.functions.nested import sanitize_keys
from billstream.operators import bills as B
from billstream.operators.aggregates import record_kind
from billstream.sources import readers as R
from billstream.sources import writers as W

BILL = {
    "_id": "b1",
    "scraped_at": "2025",
    "identifier": "HB 1",
    "title": "Water",
    "legislative_session": "2025",
    "classification": ["bill"],
    "actions": [
        {"description": "Filed", "date": "2025-01-01T04:00:00+05:00", "classification": ["filing"], "organization_id": '~{"classification": "lower"}'},
        {"description": "Passed", "date": None, "classification": []},
    ],
    "sponsorships": [{"name": "A", "primary": True}],
    "extras": {"x": [1, {"y": 2}]},
    "jurisdiction": {"id": "ocd/wy", "name": "Wyoming"},
}


def put(folder, name, value):
    path = folder / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def test_scan_splits_types_and_keeps_damaged_files(spark, tmp_path):
    put(tmp_path, "bill_1.json", BILL)
    put(tmp_path, "bill_2.json", '{"identifier": ')
    put(tmp_path, "vote_event_1.json", {"identifier": "v", "result": "pass", "counts": [{"option": "yes", "value": 3}]})
    good, bad = R.split_corrupt(R.scan_scraped_json(spark, str(tmp_path), "bill").cache())
    assert [(r.identifier, len(r.actions), r.file_name) for r in good.collect()] == [("HB 1", 2, "bill_1.json")]
    assert [(r.category, r.file_name, r.raw) for r in bad.collect()] == [("invalid_json", "bill_2.json", '{"identifier": ')]
    votes = R.scan_scraped_json(spark, str(tmp_path), "vote_event")
    assert votes.select("counts.value").first()[0] == [3]


def test_open_parts_are_variants(spark, tmp_path):
    put(tmp_path, "bill_1.json", BILL)
    df = R.scan_scraped_json(spark, str(tmp_path), "bill")
    assert df.select(F.variant_get("extras", "$.x[1].y", "int")).first()[0] == 2


def test_sanitize_removes_keys_at_any_depth(spark):
    df = spark.createDataFrame(
        [("x", [{"_id": "y", "name": "n"}], {"scraped_at": "t", "k": 1})],
        "_id STRING, list ARRAY<STRUCT<_id STRING, name STRING>>, inner STRUCT<scraped_at STRING, k INT>",
    )
    clean = sanitize_keys(df)
    assert clean.schema.simpleString() == "struct<list:array<struct<name:string>>,inner:struct<k:int>>"
    assert clean.first().inner.k == 1


def test_routing_order(spark):
    names = ["bill_vote_event_1.json", "vote_event_1.json", "event_1.json", "organization_1.json"]
    df = spark.createDataFrame([(n,) for n in names], "n STRING")
    assert [r[0] for r in df.select(record_kind(F.col("n"))).collect()] == ["bill", "vote_event", "event", "unrecognised"]


def test_log_tree_lists_only_its_roots(spark, tmp_path):
    log = {"action": {"description": "Filed", "date": "2025-01-01"}, "bill_id": "HB1"}
    put(tmp_path, "wy/country:us/state:wy/sessions/2025/bills/HB1/logs/20250101T000000Z_filed.json", log)
    put(tmp_path, "wy/country:us/state:wy/sessions/2025/bills/HB1/metadata.json", BILL)
    put(tmp_path, "il/country:us/state:il/sessions/2025/bills/HB2/logs/20250101T000000Z_filed.json", log)
    rows = R.read_log_tree(spark, [str(tmp_path / "wy")]).collect()
    assert len(rows) == 1 and rows[0].path.endswith("/HB1/logs/20250101T000000Z_filed.json")
    bills = R.read_bills(spark, str(tmp_path)).select("source_file", "identifier").collect()
    assert len(bills) == 1 and "country:us" in bills[0].source_file


def test_bills_summary_of_documents(spark, tmp_path):
    put(tmp_path, "a/metadata.json", BILL)
    put(tmp_path, "b/metadata.json", {"identifier": "HB 2", "title": "None"})
    rows = {r.identifier: r for r in B.bills_summary(R.read_bills(spark, str(tmp_path))).collect()}
    assert (rows["HB 1"].action_count, rows["HB 1"].sponsor_count, rows["HB 1"].jurisdiction_name) == (2, 1, "Wyoming")
    assert (rows["HB 2"].action_count, rows["HB 2"].sponsor_count) == (0, 0)


def test_jsonl_counts(spark, tmp_path):
    put(tmp_path, "in.jsonl", '{"k": 1}\n\n{"k": \n{"k": 2}\n')
    assert [r.doc.k for r in R.read_jsonl(spark, str(tmp_path / "in.jsonl"), "k INT").collect()] == [1, 2]
    counts = R.jsonl_counts(spark.read.text(str(tmp_path / "in.jsonl"))).first()
    assert (counts.lines, counts.blank, counts.malformed) == (4, 1, 1)


def test_sessions(spark, tmp_path):
    put(
        tmp_path,
        "jurisdiction_1.json",
        {
            "id": "ocd/wy",
            "legislative_sessions": [
                {"identifier": "2025", "name": "General", "start_date": "2025-01-01", "end_date": "2026-01-01"},
                {"identifier": "2024", "name": "", "start_date": "2024-01-01", "end_date": "2025-01-01"},
                {"identifier": "2023", "name": "Old", "start_date": "2023-01-01"},
            ],
        },
    )
    rows = R.session_rows(R.scan_scraped_json(spark, str(tmp_path), "jurisdiction"))
    assert [tuple(r) for r in rows.collect()] == [("2025", "General", "2025-2026")]
    cached = spark.createDataFrame([("1999", "Cached", "1999-2000")], rows.schema)
    assert R.sessions_dim(rows, cached).first().session_id == "2025"
    assert R.sessions_dim(rows.limit(0), cached).first().session_id == "1999"
    assert R.sessions_dim(rows.limit(0), cached.limit(0)).count() == 0


def test_tag_config_defaults(spark, tmp_path):
    put(tmp_path, "tags.json", {"tags": {"water": {"description": "d", "threshold": 0.7}, "air": None}})
    rows = {r.name: r for r in R.read_tag_config(spark, str(tmp_path / "tags.json")).collect()}
    assert rows["water"].threshold == 0.7 and rows["water"].examples == []
    assert rows["air"].threshold == 0.5 and rows["air"].description == ""
    assert R.feed_config({"build": {"a": 1}, "publish": {"a": 2}}) == {"a": 1}
    assert R.feed_config({"publish": {"a": 2}}) == {"a": 2}


def test_writers(spark, tmp_path):
    bills = spark.createDataFrame(
        [("wy", "2025", "HB 1", "HB1"), ("il", "2024", "SB 2", "SB2")], "state STRING, session_id STRING, identifier STRING, bill_id STRING"
    )
    W.write_keyed(W.with_bill_path(bills), str(tmp_path / "tree"))
    assert (tmp_path / "tree/country=us/state=wy/session_id=2025").is_dir()
    back = spark.read.parquet(str(tmp_path / "tree")).filter("state = 'wy'").first()
    assert back.path == "country:us/state:wy/sessions/2025/bills/HB1"
    W.write_jsonl(bills.select("bill_id", F.lit(None).cast("string").alias("gone")), str(tmp_path / "lines"))
    assert sorted(r.value for r in spark.read.text(str(tmp_path / "lines")).collect()) == ['{"bill_id":"HB1"}', '{"bill_id":"SB2"}']


def test_feed_is_rss_in_order(spark, tmp_path):
    rows = [
        ("old", None, "D & <E>", "g1", ["a", "b"], "Mon, 1 Jan 2024 00:00:00 +0000", "20240101T000000Z"),
        ("T", "https://x.org/?a=1&b=2", "D", "g3", [], None, None),
        ("new\x02", "https://x.org", None, "g2", ["c"], "Tue, 2 Jan 2024 00:00:00 +0000", "20240102T000000Z"),
        ("new", "https://x.org", None, "g0", None, "Tue, 2 Jan 2024 00:00:00 +0000", "20240102T000000Z"),
    ]
    items = spark.createDataFrame(rows, "title STRING, link STRING, description STRING, guid STRING, category ARRAY<STRING>, pubDate STRING, timestamp STRING")
    W.write_feed(items.repartition(3), str(tmp_path / "feed"), "Water & Air", "https://example.org", limit=3)
    files = list((tmp_path / "feed").glob("part*"))
    root = ElementTree.fromstring("".join(p.read_text() for p in files).strip())
    channel = root.find("channel")
    assert (root.tag, root.get("version"), channel.find("title").text) == ("rss", "2.0", "Water & Air")
    assert {"link", "description", "language", "lastBuildDate"} <= {e.tag for e in channel}
    found = channel.findall("item")
    assert [i.find("guid").text for i in found] == ["g0", "g2", "g1"]
    assert found[0].find("guid").get("isPermaLink") == "false" and found[1].find("title").text == "new"
    assert found[2].find("description").text == "D & <E>" and found[2].find("link") is None
    assert [c.text for c in found[2].findall("category")] == ["a", "b"]
    W.write_feed(items.limit(0), str(tmp_path / "none"), "T", "L")
    assert "<channel>" in "".join(p.read_text() for p in (tmp_path / "none").glob("part*"))
