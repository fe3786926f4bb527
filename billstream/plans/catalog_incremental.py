"""Incremental and stateful jobs, in batch and in stream form."""

import uuid

from pyspark.sql import functions as F

from billstream.operators import bills as B
from billstream.operators import links as K
from billstream.operators.routine import routine_filter
from billstream.operators.tagging import Tag, keyword_tags
from billstream.plans.registry import query
from billstream.session import saved, state_dir
from billstream.streaming import jobs as J
from billstream.streaming import keyed

RUN_SQL = "CASE WHEN {0} < TIMESTAMP '2024-01-11' THEN 1 WHEN {0} < TIMESTAMP '2024-01-21' THEN 2 ELSE 3 END"


def run_of(column):
    ts = F.col(column)
    return (
        F.when(ts < F.lit("2024-01-11").cast("timestamp_ntz"), 1)
        .when(ts < F.lit("2024-01-21").cast("timestamp_ntz"), 2)
        .otherwise(3)
    )


@query(
    "incremental_votes_events",
    f"""WITH e AS (SELECT event_id, event_type AS category, ts, least(3, {RUN_SQL.format('ts')} + CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END) AS run FROM events),
  m AS (SELECT e.run, e.category, max(p.ts) AS mark FROM (SELECT DISTINCT run, category FROM e) e LEFT JOIN e p ON p.category = e.category AND p.run < e.run GROUP BY 1, 2)
  SELECT event_id, category, CAST(run AS BIGINT) AS run FROM e JOIN m USING (run, category) WHERE mark IS NULL OR ts > mark""",
)
def incremental_votes_events(t):
    # Some items arrive one run late and fall behind the mark.
    late = F.when(F.col("event_id") % 29 == 0, 1).otherwise(0)
    items = t("events").select(
        "event_id", F.col("event_type").alias("category"), "ts", F.least(F.lit(3), run_of("ts") + late).alias("run")
    )
    return K.replay_runs(items).select("event_id", "category", F.col("run").cast("bigint"))


BILLS_SQL = """WITH one AS (SELECT bill_id, ord, description, date FROM b_action WHERE ord <= 3),
  two AS (SELECT bill_id, ord, CASE WHEN ord % 5 = 2 THEN description || ' (amended)' ELSE description END AS description, date FROM b_action WHERE CAST(substring(bill_id, 3, 20) AS BIGINT) % 7 <> 0),
  ch AS (SELECT bill_id FROM (SELECT bill_id, count(*) AS n FROM two GROUP BY 1) a LEFT JOIN (SELECT bill_id, count(*) AS p FROM one GROUP BY 1) b USING (bill_id) WHERE p IS NULL OR p <> n),
  kn AS (SELECT DISTINCT bill_id, description, date, 1 AS k FROM one)
  SELECT bill_id, CAST(ord AS BIGINT) AS ord, description, date, 'run1' AS created FROM one WHERE bill_id NOT IN (SELECT bill_id FROM ch)
  UNION ALL SELECT bill_id, CAST(ord AS BIGINT), description, date, CASE WHEN k = 1 THEN 'run1' ELSE 'run2' END FROM two LEFT JOIN kn USING (bill_id, description, date) WHERE bill_id IN (SELECT bill_id FROM ch)"""


def bill_runs(t):
    """Two deliveries of whole bills: some bills grow, some keep their number, some are missing."""
    a = saved(t("b_action").select("bill_id", "ord", "description", "date"))
    first = a.filter("ord <= 3")
    text = F.when(F.col("ord") % 5 == 2, F.concat("description", F.lit(" (amended)"))).otherwise(F.col("description"))
    second = a.filter(F.substring("bill_id", 3, 20).cast("bigint") % 7 != 0).select("bill_id", "ord", text.alias("description"), "date")
    return first, second


@query("incremental_bills", BILLS_SQL)
def incremental_bills(t):
    first, second = bill_runs(t)
    empty = t.spark.createDataFrame([], "bill_id STRING, ord INT, description STRING, date STRING, created STRING")
    after_one = saved(B.incremental_bills(empty, first, F.lit("run1")))
    after_two = B.incremental_bills(after_one, second, F.lit("run2"))
    return after_two.select("bill_id", F.col("ord").cast("bigint"), "description", "date", "created")


@query("incremental_bills_table", BILLS_SQL)
def incremental_bills_table(t):
    table = B.BillTable(t.spark, state_dir(t.spark, f"bills-{uuid.uuid4().hex}"))
    for run, bills in zip(("run1", "run2"), bill_runs(t)):
        table.update(bills, F.lit(run))
    return table.rows().select("bill_id", F.col("ord").cast("bigint"), "description", "date", "created")


ORPHAN_SQL = f"""WITH v AS (SELECT bill_id, {RUN_SQL.format('start_date')} AS run FROM b_vote),
  b AS (SELECT bill_id, 1 + CAST(substring(bill_id, 3, 20) AS BIGINT) % 3 AS arrived FROM b_bill),
  s AS (SELECT bill_id, r.run, count(*) AS votes FROM v JOIN (VALUES (1), (2), (3)) r(run) ON v.run <= r.run GROUP BY 1, 2),
  o AS (SELECT s.* FROM s LEFT JOIN b USING (bill_id) WHERE arrived IS NULL OR arrived > run)"""


def orphan_inputs(t, run):
    votes = t("b_vote").filter(run_of("start_date") <= run)
    current = votes.groupBy("bill_id").agg(
        F.count("*").alias("vote_count"), F.lit(0).cast("bigint").alias("event_count")
    )
    arrived = t("b_bill").filter(1 + F.substring("bill_id", 3, 20).cast("bigint") % 3 <= run).select("bill_id")
    return current, arrived


def orphan_runs(t, runs):
    state = t.spark.createDataFrame([], K.ORPHAN_STATE)
    for run in range(1, runs + 1):
        current, arrived = orphan_inputs(t, run)
        state = saved(K.update_orphans(state, current, arrived, F.lit(f"run{run}")))
    return state


@query(
    "orphan_state",
    ORPHAN_SQL
    + """ SELECT bill_id, 'run' || min(run) AS first_seen, 'run' || max(run) AS last_seen, count(*) AS occurrence_count, max(votes) AS vote_count, 0 AS event_count
  FROM o WHERE bill_id NOT IN (SELECT bill_id FROM b WHERE arrived <= 3) GROUP BY 1""",
)
def orphan_state(t):
    return orphan_runs(t, 3)


@query(
    "chronic_orphans",
    ORPHAN_SQL
    + """ SELECT bill_id, count(*) AS occurrence_count FROM o WHERE bill_id NOT IN (SELECT bill_id FROM b WHERE arrived <= 3) GROUP BY 1 HAVING count(*) >= 3 ORDER BY 2 DESC, 1 LIMIT 5""",
)
def chronic_orphans(t):
    return K.chronic_orphans(orphan_runs(t, 3)).select("bill_id", "occurrence_count")


@query(
    "cleanup_stats",
    ORPHAN_SQL
    + """, p AS (SELECT DISTINCT bill_id FROM o WHERE run <= 2 AND bill_id NOT IN (SELECT bill_id FROM b WHERE arrived <= 2)),
  c AS (SELECT DISTINCT bill_id FROM v), a AS (SELECT bill_id FROM b WHERE arrived <= 3)
  SELECT (SELECT count(*) FROM c) AS placeholders_found, (SELECT count(*) FROM c SEMI JOIN a USING (bill_id)) AS placeholders_deleted,
  (SELECT count(*) FROM c ANTI JOIN a USING (bill_id)) AS orphans_found, (SELECT count(*) FROM (SELECT * FROM c ANTI JOIN a USING (bill_id)) x ANTI JOIN p USING (bill_id)) AS new_orphans,
  (SELECT count(*) FROM p SEMI JOIN a USING (bill_id)) AS resolved_orphans""",
)
def cleanup_stats(t):
    current, arrived = orphan_inputs(t, 3)
    return K.cleanup_stats(orphan_runs(t, 2), current, arrived)


def run_slices(t, name, frames, step):
    """A folder that grows by one slice per run; ``step`` gets it as a stream."""
    folder = state_dir(t.spark, f"{name}-{uuid.uuid4().hex}")
    for run, frame in enumerate(frames, 1):
        frame.write.mode("append").parquet(f"{folder}/in")
        step(t.spark.readStream.schema(frame.schema).parquet(f"{folder}/in"), run, f"{folder}/out", f"{folder}/check")
    return f"{folder}/out", f"{folder}/check"


@query(
    "orphan_state_store",
    ORPHAN_SQL
    + """ SELECT bill_id, 'run' || min(run) AS first_seen, 'run' || max(run) AS last_seen, count(*) AS occurrence_count, max(votes) AS vote_count, 0 AS event_count
  FROM o WHERE bill_id NOT IN (SELECT bill_id FROM b WHERE arrived <= 3) GROUP BY 1""",
)
def orphan_state_store(t):
    votes = t("b_vote").select("bill_id", F.lit("vote").alias("kind"), run_of("start_date").alias("run"))
    bills = t("b_bill").select("bill_id", F.lit("bill").alias("kind"), (1 + F.substring("bill_id", 3, 20).cast("bigint") % 3).cast("int").alias("run"))
    rows = saved(votes.unionByName(bills))
    known = rows.filter("kind = 'bill'").select("bill_id", "run")

    def step(stream, run, table, checkpoint):
        keyed.track_orphans(stream, known.filter(F.col("run") < run), run, table, checkpoint)

    _, checkpoint = run_slices(t, "orphans", [rows.filter(F.col("run") == n).select("kind", "bill_id") for n in (1, 2, 3)], step)
    return keyed.open_orphans(t.spark, checkpoint, 3, lambda run: F.concat(F.lit("run"), run.cast("string")))


PENDING_SQL = """WITH a AS (SELECT event_id, pos, replace(name, ' ', '') AS bill_id FROM b_agenda WHERE entity_type = 'bill'),
  s AS (SELECT bill_id, CASE WHEN CAST(substring(bill_id, 3, 20) AS BIGINT) % 97 = 0 THEN 1 WHEN CAST(substring(bill_id, 3, 20) AS BIGINT) % 31 = 0 THEN 2 ELSE 3 END AS seen FROM b_billsession),
  e AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 1 ELSE 2 END AS born FROM (SELECT DISTINCT event_id FROM a) x),
  l AS (SELECT event_id, greatest(born, seen) AS run FROM a JOIN s USING (bill_id) JOIN e USING (event_id) WHERE seen <= 2)"""


@query(
    "event_pending_state",
    PENDING_SQL
    + """ SELECT event_id, 'linked' AS state, min(run) AS run FROM l GROUP BY 1 UNION ALL SELECT event_id, 'pending', NULL FROM e WHERE event_id NOT IN (SELECT event_id FROM l)""",
)
def event_pending_state(t):
    agenda = t("b_agenda").filter("entity_type = 'bill'")
    number = F.substring("bill_id", 3, 20).cast("bigint")
    sessions = t("b_billsession").withColumn("seen", F.when(number % 97 == 0, 1).when(number % 31 == 0, 2).otherwise(3))
    even = F.col("event_id") % 2 == 0
    agenda = saved(agenda)
    one, rest = map(saved, K.pending_after_run(agenda.limit(0), agenda.filter(even), sessions.filter("seen = 1")))
    two, rest = map(saved, K.pending_after_run(rest, agenda.filter(~even), sessions.filter("seen <= 2")))
    linked = one.withColumn("run", F.lit(1)).unionByName(two.withColumn("run", F.lit(2)))
    done = linked.select("event_id", F.lit("linked").alias("state"), F.col("run").cast("bigint"))
    waiting = rest.select("event_id").distinct().select("event_id", F.lit("pending").alias("state"), F.lit(None).cast("bigint").alias("run"))
    return done.unionByName(waiting)


@query(
    "event_pending_store",
    PENDING_SQL
    + """, w AS (SELECT event_id, min(run) AS run FROM l GROUP BY 1)
  SELECT event_id, 'linked' AS state, run, run > born AS cleared FROM w JOIN e USING (event_id)
  UNION ALL SELECT event_id, 'pending', NULL, FALSE FROM e WHERE event_id NOT IN (SELECT event_id FROM l)""",
)
def event_pending_store(t):
    agenda = t("b_agenda").filter("entity_type = 'bill'")
    born = F.when(F.col("event_id") % 2 == 0, 1).otherwise(2)
    number = F.substring("bill_id", 3, 20).cast("bigint")
    seen = F.when(number % 97 == 0, 1).when(number % 31 == 0, 2)
    rows = saved(agenda.withColumn("run", born))
    bills = saved(t("b_billsession").withColumn("run", seen).filter("run IS NOT NULL"))
    folder = state_dir(t.spark, f"hearings-{uuid.uuid4().hex}")
    table, checkpoint = f"{folder}/links", f"{folder}/check"
    for run in (1, 2):
        sources = []
        for name, slices in (("agenda", rows), ("bills", bills)):
            slices.filter(F.col("run") == run).drop("run").write.mode("append").parquet(f"{folder}/{name}")
            sources.append(t.spark.readStream.schema(slices.drop("run").schema).parquet(f"{folder}/{name}"))
        keyed.link_hearings(*sources, bills.filter(F.col("run") < run), run, table, checkpoint)
    run = F.col("run").cast("bigint")
    done = keyed.linked_hearings(t.spark, table).select("event_id", F.lit("linked").alias("state"), run.alias("run"), "cleared")
    waiting = keyed.missing_sessions(t.spark, table, checkpoint)
    none = F.lit(None).cast("bigint")
    return done.unionByName(waiting.select("event_id", F.lit("pending").alias("state"), none.alias("run"), F.lit(False).alias("cleared")))


# -- streams -------------------------------------------------------------------------


@query(
    "log_stream",
    """SELECT event_id, bill_id, description FROM (SELECT event_id, 'HB' || user_id AS bill_id, CASE event_type WHEN 'view' THEN 'Referred to Rules' WHEN 'click' THEN 'Filed' ELSE 'Passed ' || event_type END AS description FROM events) x
  WHERE description NOT IN ('Referred to Rules', 'Filed')""",
)
def log_stream(t):
    def plan(events):
        kind = F.col("event_type")
        text = F.when(kind == "view", "Referred to Rules").when(kind == "click", "Filed").otherwise(F.concat(F.lit("Passed "), kind))
        logs = events.select(
            "event_id",
            F.concat(F.lit("HB"), F.col("user_id").cast("string")).alias("bill_id"),
            text.alias("description"),
            F.array(kind).alias("classes"),
            F.lit("fl").alias("locale"),
        )
        return routine_filter(logs).select("event_id", "bill_id", "description")

    return J.run_append(t.spark, t.path("events"), plan)


@query("stream_dedup_guid", "SELECT DISTINCT user_id || '/' || strftime(ts, '%Y%m%dT%H') AS guid FROM events")
def stream_dedup_guid(t):
    def plan(events):
        hour = F.date_format("ts", "yyyyMMdd'T'HH")
        keyed = events.select(
            F.concat_ws("/", F.col("user_id").cast("string"), hour).alias("guid"), F.col("ts").cast("timestamp").alias("ts")
        )
        return J.dedup_within(keyed, "guid", "ts", "31 days").select("guid")

    return J.run_append(t.spark, t.path("events"), plan)


@query(
    "daily_activity",
    "SELECT 'HB' || user_id AS bill_id, strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events GROUP BY 1, 2",
)
def daily_activity(t):
    def plan(events):
        logs = events.select(F.concat(F.lit("HB"), F.col("user_id").cast("string")).alias("bill_id"), F.col("ts").cast("timestamp").alias("ts"))
        return J.daily_counts(logs, "bill_id", "ts", "31 days")

    return J.run_upsert(t.spark, t.path("events"), plan, ["bill_id", "day"])


STREAM_TAGS = [
    Tag("health", include_keywords=["then", "entier"], exclude_keywords=["zzz"]),
    Tag("water", include_keywords=["the", "que"], threshold=0.8),
]


@query(
    "stream_tagging",
    """SELECT doc_id, tag, score FROM (SELECT doc_id, 'health' AS tag, 0.6 AS score, text FROM documents WHERE regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])(then|entier)($|[^\\p{L}\\p{N}_])')
  UNION ALL SELECT doc_id, 'water', 0.8, text FROM documents WHERE regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])(the|que)($|[^\\p{L}\\p{N}_])')) x
  WHERE tag = 'water' OR NOT regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])zzz($|[^\\p{L}\\p{N}_])')""",
)
def stream_tagging(t):
    def plan(docs):
        return keyword_tags(docs.select("doc_id", "text"), "text", STREAM_TAGS).select(
            "doc_id", "tag", F.col("final_score").alias("score")
        )

    return J.run_upsert(t.spark, t.path("documents"), plan, ["doc_id", "tag"])
