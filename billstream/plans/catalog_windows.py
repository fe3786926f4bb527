"""Ranking, ordering and limits."""

from pyspark.sql import functions as F

from billstream.functions.names import action_log_name
from billstream.functions.paths import file_name, log_stamp, session_of
from billstream.operators import aggregates as A
from billstream.operators import bills as B
from billstream.operators import documents as D
from billstream.operators import logs as L
from billstream.plans.catalog_functions import ACTION_NAME_SQL
from billstream.plans.registry import query

STAMP_SQL = "CASE WHEN path LIKE '%/unknown_%' THEN NULL ELSE strftime(ts, '%Y%m%dT%H%M%SZ') END"


def stamped(t):
    return t("b_log").withColumn("log_ts", log_stamp(F.col("path")))


@query(
    "last_write_wins",
    f"""SELECT bill_id, log_name, CAST(ord AS BIGINT) AS ord FROM (SELECT *, row_number() OVER (PARTITION BY bill_id, log_name ORDER BY ord DESC) AS rn
  FROM (SELECT bill_id, ord, {ACTION_NAME_SQL} AS log_name FROM b_action) x) y WHERE rn = 1""",
)
def last_write_wins(t):
    name = action_log_name(F.col("date"), F.split("classes", ","), F.col("org"), F.col("description"))
    logs = t("b_action").select("bill_id", "ord", name.alias("log_name"))
    return B.last_write_wins(logs, ["bill_id", "log_name"], ["ord"]).select("bill_id", "log_name", F.col("ord").cast("bigint"))


@query(
    "dedup_guid",
    """WITH x AS (SELECT event_id AS pos, event_id, path FROM b_log UNION ALL SELECT event_id + 1000000, event_id, path FROM b_log)
  SELECT path AS guid, min(pos) AS pos, arg_min(event_id, pos) AS event_id FROM x GROUP BY 1""",
)
def dedup_guid(t):
    logs = t("b_log").select(F.col("event_id").alias("pos"), "event_id", F.col("path").alias("guid"))
    twice = logs.unionByName(logs.withColumn("pos", F.col("pos") + 1000000))
    return L.dedup_guid(twice, [F.asc("pos")]).select("guid", "pos", "event_id")


@query(
    "per_repo_limit",
    f"""SELECT event_id, repo, path, log_ts FROM (SELECT *, row_number() OVER (PARTITION BY repo ORDER BY log_ts DESC NULLS LAST, path, event_id) AS rn
  FROM (SELECT event_id, repo, path, {STAMP_SQL} AS log_ts FROM b_log) x) y WHERE rn <= 100""",
)
def per_repo_limit(t):
    return L.per_repo_limit(stamped(t), 100, tie=["event_id"]).select("event_id", "repo", "path", "log_ts")


@query(
    "best_link",
    """SELECT version_id, CAST(pos AS BIGINT) AS pos, url, media_type FROM (SELECT *, row_number() OVER (PARTITION BY version_id ORDER BY
  CASE WHEN media_type = 'text/xml' THEN 0 WHEN media_type LIKE 'text/html%' THEN 1 ELSE 2 END, pos) AS rn FROM b_link WHERE url <> '' AND media_type <> 'application/xml') x WHERE rn = 1""",
)
def best_link(t):
    return D.best_links(t("b_link")).select("version_id", F.col("pos").cast("bigint"), "url", "media_type")


@query(
    "latest_run_duration",
    """SELECT repo, run_id, conclusion, minutes, minutes > 40 AS slow FROM (SELECT repo, run_id, conclusion,
  CAST(floor((epoch(date_trunc('second', updated_at)) - epoch(date_trunc('second', started_at))) / 60) AS BIGINT) AS minutes,
  row_number() OVER (PARTITION BY repo ORDER BY started_at DESC, run_id DESC) AS rn FROM (SELECT *, started_at AS s FROM b_run WHERE updated_at > started_at) r) x WHERE rn = 1""",
)
def latest_run_duration(t):
    # The newest run of a user has no end yet.
    return A.latest_run(t("b_run").filter("updated_at > started_at"))


@query(
    "flat_log_names",
    """WITH x AS (SELECT DISTINCT bill_id, regexp_extract(path, '([^/]*)$', 1) AS name FROM b_log)
  SELECT '2024' AS session_id, bill_id, name, CASE WHEN bill_id = min(bill_id) OVER (PARTITION BY name) THEN name ELSE replace(name, '.json', '_' || bill_id || '.json') END AS flat_name FROM x""",
)
def flat_log_names(t):
    files = t("b_log").select("bill_id", session_of(F.col("path")).alias("session_id"), file_name(F.col("path")).alias("name"))
    named = L.flat_log_names(files)
    return named.select("session_id", "bill_id", "name", "flat_name")


@query(
    "strike_gap",
    """SELECT page, CAST(line AS BIGINT) AS line, CAST(pos AS BIGINT) AS pos, coalesce(a IS NOT NULL AND b IS NOT NULL AND (a > 2 OR b > 2), FALSE) AS gap FROM (
  SELECT page, line, pos, x0 - lag(x1) OVER w AS a, lead(x0) OVER w - x1 AS b FROM b_char WINDOW w AS (PARTITION BY page, line ORDER BY x0, pos)) x""",
)
def strike_gap(t):
    return D.strike_gaps(t("b_char")).select("page", F.col("line").cast("bigint"), F.col("pos").cast("bigint"), "gap")


@query(
    "action_order",
    """SELECT doc_id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS BIGINT) AS ordinal, unnest(string_split(text, chr(10))) AS description FROM documents""",
)
def action_order(t):
    # The lines of a document stand for the stored list of a bill.
    return B.action_order(t("documents").select("doc_id", F.split("text", "\n").alias("actions"))).select(
        "doc_id", F.col("ordinal").cast("bigint"), F.col("action").alias("description")
    )


@query("sort_logs_desc", f"SELECT event_id, path, {STAMP_SQL} AS log_ts FROM b_log ORDER BY log_ts DESC NULLS LAST, path")
def sort_logs_desc(t):
    return L.sort_logs(stamped(t)).select("event_id", "path", "log_ts")


@query("sort_logs_asc", f"SELECT event_id, path, {STAMP_SQL} AS log_ts FROM b_log ORDER BY log_ts ASC NULLS LAST, path")
def sort_logs_asc(t):
    return L.sort_logs(stamped(t), descending=False).select("event_id", "path", "log_ts")


@query(
    "top_k_logs",
    f"SELECT event_id, path, {STAMP_SQL} AS log_ts FROM b_log ORDER BY log_ts DESC NULLS LAST, path, event_id LIMIT 250",
)
def top_k_logs(t):
    rows = stamped(t).select("event_id", "path", "log_ts")
    return rows.orderBy(*L.newest_first(), F.asc("event_id")).limit(250)
