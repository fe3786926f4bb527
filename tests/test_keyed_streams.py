"""State store forms: equal to the batch forms, restartable, no larger than what is open."""

import pytest
from pyspark.sql import functions as F

from billstream.operators import links as K
from billstream.streaming import keyed

ROWS = "kind STRING, bill_id STRING"
AGENDA = "event_id BIGINT, pos INT, entity_type STRING, name STRING"
BILLS = "bill_id STRING, session_id STRING, date_folder STRING"


def label(run):
    return F.concat(F.lit("r"), run.cast("string"))


class Source:
    """A folder that a stream reads; each run adds a slice."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema = spark, str(folder), schema
        self.add([])

    def add(self, rows):
        self.spark.createDataFrame(rows, self.schema).coalesce(1).write.mode("append").parquet(self.folder)

    def stream(self):
        return self.spark.readStream.schema(self.schema).parquet(self.folder)


def batch_state(spark, runs):
    """The full-outer form over the same runs."""
    state = spark.createDataFrame([], K.ORPHAN_STATE)
    for n in range(1, len(runs) + 1):
        seen = [r for rows in runs[:n] for r in rows]
        counts = {}
        for kind, bill in seen:
            if kind != "bill":
                vote, event = counts.get(bill, (0, 0))
                counts[bill] = (vote + (kind == "vote"), event + (kind == "event"))
        current = spark.createDataFrame([(b, *c) for b, c in counts.items()], "bill_id STRING, vote_count BIGINT, event_count BIGINT")
        arrived = spark.createDataFrame([(b,) for kind, b in seen if kind == "bill"], "bill_id STRING")
        state = K.update_orphans(state, current, arrived, F.lit(f"r{n}"))
    return sorted(map(tuple, state.collect()))


RUNS = [
    [("vote", "A"), ("vote", "A"), ("event", "B"), ("bill", "D"), ("vote", "D"), ("vote", "E")],
    [("bill", "B"), ("vote", "C"), ("vote", "A"), ("vote", "D"), ("event", "D")],
    [("bill", "X"), ("bill", "E"), ("vote", "E")],
    [("vote", "F")],
]


def test_orphans_equal_the_batch_form(spark, tmp_path):
    table, checkpoint = str(tmp_path / "changes"), str(tmp_path / "check")
    source = Source(spark, tmp_path / "in", ROWS)
    for n, rows in enumerate(RUNS, 1):
        source.add(rows)
        known = spark.createDataFrame([(b,) for r in RUNS[: n - 1] for k, b in r if k == "bill"], "bill_id STRING")
        # Every run starts the stream anew on its checkpoint.
        keyed.track_orphans(source.stream(), known, n, table, checkpoint)
        got = keyed.open_orphans(spark, checkpoint, n, label)
        assert sorted(map(tuple, got.collect())) == batch_state(spark, RUNS[:n]), n
        # What is resolved is out of the state store.
        assert keyed._state(spark, checkpoint, "orphan").count() == got.count()
    changes = {(r.bill_id, r.change, r.run) for r in keyed.orphan_changes(spark, table).collect()}
    assert {("A", "new", 1), ("A", "seen", 2), ("B", "resolved", 2), ("E", "resolved", 3), ("F", "new", 4)} <= changes
    assert not any(bill in ("D", "X") for bill, _, _ in changes)


def test_a_run_without_news_changes_nothing(spark, tmp_path):
    table, checkpoint = str(tmp_path / "changes"), str(tmp_path / "check")
    source = Source(spark, tmp_path / "in", ROWS)
    source.add(RUNS[0])
    none = spark.createDataFrame([], "bill_id STRING")
    for n in (1, 2):
        keyed.track_orphans(source.stream(), none, n, table, checkpoint)
    assert keyed.orphan_changes(spark, table).filter("run = 2").count() == 0
    ages = {r.bill_id: r.occurrence_count for r in keyed.open_orphans(spark, checkpoint, 2, label).collect()}
    assert ages == {"A": 2, "B": 2, "E": 2}


def test_a_failed_run_is_repeated(spark, tmp_path, monkeypatch):
    """The batch dies in its sink after the state was computed; the next start gives the same tables."""
    table, checkpoint = str(tmp_path / "changes"), str(tmp_path / "check")
    source = Source(spark, tmp_path / "in", ROWS)
    source.add(RUNS[0])
    none = spark.createDataFrame([], "bill_id STRING")
    blocked = tmp_path / "changes"
    blocked.write_text("a file where the table should be")
    with pytest.raises(Exception):
        keyed.track_orphans(source.stream(), none, 1, table, checkpoint)
    blocked.unlink()
    keyed.track_orphans(source.stream(), none, 1, table, checkpoint)
    assert sorted(map(tuple, keyed.open_orphans(spark, checkpoint, 1, label).collect())) == batch_state(spark, RUNS[:1])
    assert {r.change for r in keyed.orphan_changes(spark, table).collect()} == {"new"}


def test_hearings(spark, tmp_path):
    table, checkpoint = str(tmp_path / "links"), str(tmp_path / "check")
    agenda, bills = Source(spark, tmp_path / "agenda", AGENDA), Source(spark, tmp_path / "bills", BILLS)
    runs = [
        # 1: known at once. 2, 3: wait. 4: names no bill. 5: two bills, the later one is there.
        ([(1, 1, "bill", "HB 1"), (2, 1, "bill", "HB 2"), (3, 1, "bill", "HB 3"), (4, 1, "person", "HB 1"), (5, 1, "bill", "HB 2"), (5, 2, "bill", "HB 1")], [("HB1", "s1", "f")]),
        ([(6, 3, "bill", "HB 2"), (6, 1, "bill", "HB 2"), (7, 1, "bill", "HB 1")], [("HB2", "s2", "f")]),
        ([], [("HB9", "s9", "f")]),
    ]
    known = []
    waits = []
    for n, (rows, arrived) in enumerate(runs, 1):
        agenda.add(rows)
        bills.add(arrived)
        before = spark.createDataFrame(known, BILLS)
        keyed.link_hearings(agenda.stream(), bills.stream(), before, n, table, checkpoint)
        waits.append({r.event_id for r in keyed.missing_sessions(spark, table, checkpoint).collect()})
        known += arrived
    got = {r.event_id: (r.run, r.pos, r.bill_id, r.session_id, r.cleared) for r in keyed.linked_hearings(spark, table).collect()}
    assert got == {
        1: (1, 1, "HB1", "s1", False), 2: (2, 1, "HB2", "s2", True), 5: (1, 2, "HB1", "s1", False),
        6: (2, 1, "HB2", "s2", False), 7: (2, 1, "HB1", "s1", False),
    }
    assert waits == [{2, 3}, {3}, {3}]
    assert keyed._state(spark, checkpoint, "waiting").count() == 1


def test_calls_to_the_state_store_follow_buckets(spark, tmp_path, monkeypatch):
    """Bills share a key of the state; with one bucket all of them do, and the runs give the same."""
    monkeypatch.setattr(keyed, "BUCKETS", 1)
    check = str(tmp_path / "check")
    agenda, bills = Source(spark, tmp_path / "agenda", AGENDA), Source(spark, tmp_path / "bills", BILLS)
    # HB1 comes at once, HB2 later; hearing 3 is named twice, and HB2's first row comes again.
    runs = [
        ([(1, 1, "bill", "HB 1"), (2, 1, "bill", "HB 2"), (3, 1, "bill", "HB 3"), (3, 2, "bill", "HB 3")], [("HB1", "s1", "f")]),
        ([(2, 1, "bill", "HB 2"), (4, 1, "bill", "HB 4"), (5, 1, None, "HB 4")], []),
        ([], [("HB2", "s2", "f")]),
    ]
    known = []
    for n, (rows, arrived) in enumerate(runs, 1):
        agenda.add(rows)
        bills.add(arrived)
        keyed.link_hearings(agenda.stream(), bills.stream(), spark.createDataFrame(known, BILLS), n, str(tmp_path / "links"), check)
        known += arrived
        # One element for each append, not one for each row that waits.
        assert keyed._state(spark, check, "waiting").count() == (1, 2, 1)[n - 1]
    got = {r.event_id: (r.run, r.bill_id, r.cleared) for r in keyed.linked_hearings(spark, str(tmp_path / "links")).collect()}
    assert got == {1: (1, "HB1", False), 2: (3, "HB2", True)}
    assert {(r.event_id, r.since) for r in keyed.missing_sessions(spark, str(tmp_path / "links"), check).collect()} == {(3, 1), (4, 2)}


def test_orphans_share_a_bucket(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "BUCKETS", 1)
    check = str(tmp_path / "check")
    source = Source(spark, tmp_path / "in", ROWS)
    for n, rows in enumerate(RUNS, 1):
        source.add(rows)
        known = spark.createDataFrame([(b,) for r in RUNS[: n - 1] for k, b in r if k == "bill"], "bill_id STRING")
        keyed.track_orphans(source.stream(), known, n, str(tmp_path / "changes"), check)
        got = keyed.open_orphans(spark, check, n, label)
        assert sorted(map(tuple, got.collect())) == batch_state(spark, RUNS[:n]), n
    assert keyed._state(spark, check, "orphan").select("key").distinct().count() == 1
