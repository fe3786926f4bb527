"""The tag job over its store: gate by place, configuration, untouched files, repeated runs."""

import json
import os

import pytest
from pyspark.sql import functions as F

from billstream.operators import tagging as G
from billstream.operators.tag_store import TagStore, tag_run

TAGS = [G.Tag("wet", include_keywords=["water"]), G.Tag("road", include_keywords=["road"], threshold=0.9)]
ENTRIES = "state STRING, session_id STRING, bill_id STRING, text STRING, line_no BIGINT"


def run(spark, store, rows, tags=TAGS, name="r1", **more):
    out = tag_run(spark.createDataFrame(rows, ENTRIES), store, tags, name, **more)
    return sorted((r.state, r.session_id, r.bill_id, r.line_no) for r in out.collect())


def bills(store):
    return {(r.state, r.session_id, r.tag, r.bill_id): (r.final_score, r.keyword_match) for r in store.read("bills").collect()}


def heads(store):
    return {(r.state, r.session_id, r.tag): (r.last_run, json.loads(r.tag_config)["threshold"], r.tag_config_hash) for r in store.read("heads").collect()}


def files(path):
    return {os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_one_id_in_two_sessions(spark, tmp_path):
    store = TagStore(spark, str(tmp_path / "tags"))
    assert run(spark, store, [("wy", "2024", "HB1", "water", 1)]) == [("wy", "2024", "HB1", 1)]
    # The same id elsewhere is another bill: it is scored, and only if it has a tag does it come out.
    rows = [("wy", "2025", "HB1", "road", 1), ("il", "2024", "HB1", "dry", 2), ("wy", "2024", "HB1", "dry", 3), (None, "2024", "HB1", "water", 4), ("wy", None, "HB9", "water", 5)]
    assert run(spark, store, rows, name="r2") == [("wy", "2024", "HB1", 3), ("wy", "2025", "HB1", 1)]
    assert bills(store) == {("wy", "2024", "wet", "HB1"): (0.6, ["water"]), ("wy", "2025", "road", "HB1"): (0.9, ["road"])}
    gate = G.already_tagged(spark.createDataFrame(rows[:3], ENTRIES), store.read("bills"))
    assert {(r.state, r.session_id): r.gate for r in gate.collect()} == {("wy", "2025"): "matched", ("il", "2024"): "todo", ("wy", "2024"): "matched"}


def test_lines_of_one_bill(spark, tmp_path):
    store = TagStore(spark, str(tmp_path / "tags"))
    rows = [("wy", "1", "A", "dry", 1), ("wy", "1", "A", "water", 2), ("wy", "1", "A", "road", 3), ("wy", "1", None, "road x", 4)]
    out = run(spark, store, rows)
    made = "entry_" + spark.range(1).select(F.sha2(F.lit("road x"), 256)).first()[0][:8]
    assert out == [("wy", "1", "A", 2), ("wy", "1", "A", 3), ("wy", "1", made, 4)]
    assert set(bills(store)) == {("wy", "1", "wet", "A"), ("wy", "1", "road", made)}
    # With overwrite every line counts, and the last one of each tag stays.
    assert run(spark, store, rows[:3], name="r2", overwrite=True) == [("wy", "1", "A", 2), ("wy", "1", "A", 3)]
    assert {k[2] for k in bills(store) if k[3] == "A"} == {"wet", "road"}


def test_single_tag(spark, tmp_path):
    store = TagStore(spark, str(tmp_path / "tags"))
    rows = [("wy", "1", "A", "water on the road", 1), ("wy", "1", "B", "road", 2)]
    assert run(spark, store, rows, only="wet") == [("wy", "1", "A", 1)]
    assert run(spark, store, rows, only="road", name="r2") == [("wy", "1", "A", 1), ("wy", "1", "B", 2)]
    assert set(bills(store)) == {("wy", "1", "wet", "A"), ("wy", "1", "road", "A"), ("wy", "1", "road", "B")}
    with pytest.raises(ValueError, match="not configured"):
        run(spark, store, rows, only="unknown")


def test_configuration_and_untouched_files(spark, tmp_path):
    path = str(tmp_path / "tags")
    store = TagStore(spark, path)
    run(spark, store, [("wy", "1", "A", "water", 1), ("wy", "2", "B", "water", 2), ("wy", "1", "C", "road", 3)])
    before, old = files(path), heads(store)
    changed = [G.Tag("wet", include_keywords=["water"], threshold=0.7), TAGS[1]]
    run(spark, store, [("wy", "1", "D", "water", 1)], tags=changed, name="r2")
    gone = before - files(path)
    # Only the one partition that has a new row is written anew, in all three tables.
    assert len(gone) == 3 and all("session_id=1/tag=wet" in f for f in gone)
    new = heads(store)
    assert new["wy", "1", "wet"][:2] == ("r2", 0.7) and new["wy", "1", "wet"][2] != old["wy", "1", "wet"][2]
    assert new["wy", "2", "wet"] == old["wy", "2", "wet"] and new["wy", "1", "road"] == old["wy", "1", "road"]
    run(spark, store, [("wy", "1", "E", "water", 1)], tags=changed, name="r3")
    assert heads(store)["wy", "1", "wet"] == ("r3", *new["wy", "1", "wet"][1:])
    assert {r.text for r in TagStore(spark, path).read("texts").collect()} == {"water", "road"}


def test_a_run_that_died_is_done_again(spark, tmp_path):
    store = TagStore(spark, str(tmp_path / "tags"))
    write = store._replace
    store._replace = lambda name, rows: write(name, rows) if name != "bills" else None
    rows = [("wy", "1", "A", "water", 1)]
    run(spark, store, rows)
    assert bills(store) == {}
    store._replace = write
    assert run(spark, store, rows, name="r2") == [("wy", "1", "A", 1)]
    assert set(bills(store)) == {("wy", "1", "wet", "A")} and store.read("texts").count() == 1


def test_texts_move_once(spark, tmp_path, monkeypatch):
    """Texts lie in no copy besides the gate's, and the task that writes a file drops its repeats."""
    from billstream.operators import tag_store

    copies, saved = {}, tag_store.saved
    monkeypatch.setattr(tag_store, "saved", lambda df, name="run": copies.setdefault(name, df.columns) and saved(df, name))
    store = TagStore(spark, str(tmp_path / "tags"), files=3)
    rows = [("wy", "2024", "HB1", "water", 1), ("wy", "2024", "HB2", "water", 2), ("wy", "2024", "HB3", "water road", 3)]
    run(spark, store, rows)
    run(spark, store, [("wy", "2024", "HB4", "water", 4), ("wy", "2024", "HB5", "wet water", 5)], name="r2")
    assert "text" not in copies["tag-rows"]
    got = sorted((r.tag, r.text) for r in store.read("texts").collect())
    assert got == [("road", "water road"), ("wet", "water"), ("wet", "water road"), ("wet", "wet water")]
