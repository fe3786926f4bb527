"""Votes and hearings: links to bills, orphans, pending events, marks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billstream.functions.paths import bill_folder_id
from billstream.functions.stamps import fmt_timestamp, parse_stamp
from billstream.operators.common import top_per_key


def bill_session_map(bills: DataFrame, sessions: DataFrame) -> DataFrame:
    """bill_id to session; a bill id used in two sessions takes the latest one."""
    dim = sessions.select(
        "session_id",
        "name",
        F.concat_ws("-", F.substring("start_date", 1, 4), F.substring("end_date", 1, 4)).alias("date_folder"),
        F.col("start_date").alias("_start"),
    )
    joined = bills.select("bill_id", "session_id").distinct().join(dim, "session_id")
    return top_per_key(joined, ["bill_id"], [F.desc("_start"), F.desc("session_id")], 1).drop("_start")


def bill_entities(agenda: DataFrame) -> DataFrame:
    """Agenda entities that name a bill, ids without blanks."""
    return agenda.filter(F.col("entity_type") == "bill").select(
        "event_id", "pos", bill_folder_id(F.col("name")).alias("bill_id")
    )


def link_events(agenda: DataFrame, bill_sessions: DataFrame) -> DataFrame:
    """The first agenda bill that resolves decides the session of the event."""
    resolved = bill_entities(agenda).join(
        bill_sessions.select("bill_id", "session_id", "date_folder"), "bill_id"
    )
    return top_per_key(resolved, ["event_id"], [F.asc("pos"), F.asc("bill_id")], 1)


def pending_events(agenda: DataFrame, linked: DataFrame) -> DataFrame:
    """Events that name bills of which none resolved yet."""
    named = bill_entities(agenda).select("event_id").distinct()
    return named.join(linked.select("event_id"), "event_id", "left_anti")


def pending_after_run(pending: DataFrame, incoming: DataFrame, bill_sessions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(linked, pending) after one run over old pending and new agenda rows."""
    work = pending.unionByName(incoming)
    linked = link_events(work, bill_sessions)
    rest = work.join(linked.select("event_id"), "event_id", "left_anti")
    return linked, rest


def placeholders(votes: DataFrame, bills: DataFrame, keys: Sequence[str] = ("bill_id",)) -> DataFrame:
    """Bills that votes refer to but that do not exist."""
    return votes.select(*keys).distinct().join(bills.select(*keys), list(keys), "left_anti")


def resolved_placeholders(known: DataFrame, bills: DataFrame, keys: Sequence[str] = ("bill_id",)) -> DataFrame:
    return known.join(bills.select(*keys), list(keys), "left_semi")


def orphan_log_counts(logs: DataFrame, keys: Sequence[str] = ("bill_id",)) -> DataFrame:
    """Vote logs, else event logs, by file name."""
    vote = F.col("name").contains("vote")
    event = F.col("name").contains("event")
    return logs.groupBy(*keys).agg(
        F.count_if(vote).alias("vote_count"), F.count_if(~vote & event).alias("event_count")
    )


def update_orphans(state: DataFrame, current: DataFrame, arrived: DataFrame, run: Column, keys: Sequence[str] = ("bill_id",)) -> DataFrame:
    """Orphan state after a run.

    ``first_seen`` never moves; ``last_seen`` and the count follow the run.
    Entries leave when their bill arrives, and only then.
    """
    keys = list(keys)
    seen = current.join(arrived.select(*keys).distinct(), keys, "left_anti")
    kept = state.join(arrived.select(*keys).distinct(), keys, "left_anti")
    hit = F.col("_now").isNotNull()
    return (
        kept.alias("s")
        .join(seen.withColumn("_now", F.lit(True)).alias("c"), keys, "full_outer")
        .select(
            *keys,
            F.coalesce(F.col("s.first_seen"), run).alias("first_seen"),
            F.when(hit, run).otherwise(F.col("s.last_seen")).alias("last_seen"),
            (F.coalesce(F.col("s.occurrence_count"), F.lit(0)) + hit.cast("bigint")).alias("occurrence_count"),
            F.when(hit, F.col("c.vote_count")).otherwise(F.col("s.vote_count")).alias("vote_count"),
            F.when(hit, F.col("c.event_count")).otherwise(F.col("s.event_count")).alias("event_count"),
        )
    )


ORPHAN_STATE = (
    "bill_id STRING, first_seen STRING, last_seen STRING, occurrence_count BIGINT, "
    "vote_count BIGINT, event_count BIGINT"
)


def chronic_orphans(state: DataFrame, at_least: int = 3, shown: int = 5) -> DataFrame:
    """The first few orphans seen in many runs."""
    return (
        state.filter(F.col("occurrence_count") >= at_least)
        .orderBy(F.desc("occurrence_count"), F.asc("bill_id"))
        .limit(shown)
    )


def cleanup_stats(state_before: DataFrame, current: DataFrame, arrived: DataFrame, keys: Sequence[str] = ("bill_id",)) -> DataFrame:
    """Counts of one clean-up run in a single aggregate."""
    keys = list(keys)
    joined = (
        current.select(*keys).distinct().withColumn("_c", F.lit(True))
        .join(state_before.select(*keys).distinct().withColumn("_s", F.lit(True)), keys, "full_outer")
        .join(arrived.select(*keys).distinct().withColumn("_b", F.lit(True)), keys, "left")
    )
    c, s, b = (F.col(x).isNotNull() for x in ("_c", "_s", "_b"))
    return joined.agg(
        F.count_if(c).alias("placeholders_found"),
        F.count_if(c & b).alias("placeholders_deleted"),
        F.count_if(~b).alias("orphans_found"),
        F.count_if(c & ~b & ~s).alias("new_orphans"),
        F.count_if(c & s & b).alias("resolved_orphans"),
    )


# -- marks ---------------------------------------------------------------------

EPOCH_MARK = "1900-01-01 00:00:00"


def newer_than_mark(items: DataFrame, marks: DataFrame, date: str = "start_date", allow_equal: bool = False) -> DataFrame:
    """Items with an ``outcome``: ``newer``, or ``missing_date`` for the quarantine.

    Unreadable dates and items at or before the mark of their category are
    dropped. The comparison is strict unless ``allow_equal``; the caller then
    removes known ids by an anti-join.
    """
    ts = parse_stamp(fmt_timestamp(F.col(date)))
    mark = F.coalesce(F.col("mark"), F.lit(EPOCH_MARK).cast("timestamp"))
    after = F.col("_ts") >= mark if allow_equal else F.col("_ts") > mark
    empty = F.coalesce(F.col(date), F.lit("")) == ""
    return (
        items.withColumn("_ts", ts)
        .join(marks.select("category", "mark"), "category", "left")
        .withColumn("outcome", F.when(empty, "missing_date").when(after, "newer"))
        .filter(F.col("outcome").isNotNull())
        .drop("_ts", "mark")
    )


def advance_marks(marks: DataFrame, items: DataFrame, ts: str = "ts") -> DataFrame:
    """max(old, newest seen) per category."""
    seen = items.groupBy("category").agg(F.max(ts).alias("mark"))
    return marks.select("category", "mark").unionByName(seen).groupBy("category").agg(F.max("mark").alias("mark"))


def replay_runs(items: DataFrame, run: str = "run", ts: str = "ts") -> DataFrame:
    """Items each of several runs takes in, against the mark left by the runs before.

    A mark only ever grows to the newest time seen, so all marks follow from one
    aggregate per (run, category) and a running maximum over that small table.
    """
    before = Window.partitionBy("category").orderBy(run).rowsBetween(Window.unboundedPreceding, -1)
    marks = (
        items.groupBy(run, "category")
        .agg(F.max(ts).alias("_top"))
        .withColumn("mark", F.max("_top").over(before))
        .drop("_top")
    )
    return items.join(marks, [run, "category"]).filter(
        F.col("mark").isNull() | (F.col(ts) > F.col("mark"))
    )
