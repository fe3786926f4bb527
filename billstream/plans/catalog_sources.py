"""Sources, sinks and snapshot steps."""

from pyspark.sql import functions as F

from billstream.operators import aggregates as A
from billstream.operators import logs as L
from billstream.operators.common import top_per_key
from billstream.operators.tagging import with_tag_defaults
from billstream.plans.registry import query
from billstream.sources import readers as R
from billstream.sources import writers as W


@query(
    "scan_scraped_json",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events",
)
def scan_scraped_json(t):
    docs = R.parse_jsonl(t("events"), "k BIGINT", "props")
    return docs.select("event_id", "doc.k")


@query(
    "route_by_type",
    """SELECT event_id, file_name, CASE WHEN contains(file_name, 'bill_') THEN 'bill' WHEN contains(file_name, 'vote_event') THEN 'vote_event'
  WHEN contains(file_name, 'event') THEN 'event' ELSE 'unrecognised' END AS kind FROM b_doc""",
)
def route_by_type(t):
    return t("b_doc").select("event_id", "file_name", A.record_kind(F.col("file_name")).alias("kind"))


@query(
    "corrupt_quarantine",
    "SELECT event_id, 'invalid_json' AS category, file_name, body AS raw FROM b_doc WHERE NOT json_valid(body)",
)
def corrupt_quarantine(t):
    return t("b_doc").filter(R.is_damaged(F.col("body"))).select(
        "event_id", F.lit("invalid_json").alias("category"), "file_name", F.col("body").alias("raw")
    )


@query(
    "scan_log_tree",
    """SELECT event_id, repo, path, nullif(regexp_extract(path, '/logs/([0-9]{8}T[0-9]{6}Z)_', 1), '') AS log_ts FROM b_log
  WHERE contains(path, '/logs/') AND ends_with(path, '.json')""",
)
def scan_log_tree(t):
    return L.scan_log_tree(t("b_log")).select("event_id", "repo", "path", "log_ts")


@query(
    "scan_path_list",
    """WITH f AS (SELECT path, min(event_id) AS file_id FROM b_log GROUP BY path),
  l AS (SELECT event_id, CASE WHEN event_id % 5 = 0 THEN replace(path, '.json', '.tmp') WHEN event_id % 7 = 0 THEN replace(path, '/logs/', '/files/') ELSE path END AS path FROM b_log)
  SELECT event_id, file_id, regexp_replace(path, '^[^/]*/', '') AS relative, nullif(regexp_extract(path, '/logs/([0-9]{8}T[0-9]{6}Z)_', 1), '') AS log_ts
  FROM l JOIN f USING (path)""",
)
def scan_path_list(t):
    path, i = F.col("path"), F.col("event_id")
    # Some listed lines name other file types or folders and must drop out.
    listed = t("b_log").select(
        "event_id",
        F.when(i % 5 == 0, F.replace(path, F.lit(".json"), F.lit(".tmp")))
        .when(i % 7 == 0, F.replace(path, F.lit("/logs/"), F.lit("/files/")))
        .otherwise(path)
        .alias("path"),
    )
    files = t("b_log").groupBy("path").agg(F.min("event_id").alias("file_id"))
    scanned = L.scan_path_list(listed, files, "")
    return scanned.select("event_id", "file_id", F.regexp_replace("path", "^[^/]*/", "").alias("relative"), "log_ts")


@query(
    "scan_session_logs",
    "SELECT event_id, path, 'us' AS country, locale AS state, '2024' AS session_id FROM b_log WHERE event_id % 6 <> 0",
)
def scan_session_logs(t):
    # Every sixth path lacks the sessions segment and must drop out.
    broken = F.replace("path", F.lit("/sessions/"), F.lit("/files/"))
    files = t("b_log").withColumn("path", F.when(F.col("event_id") % 6 == 0, broken).otherwise(F.col("path")))
    return L.scan_session_logs(files).select("event_id", "path", "country", "state", "session_id")


@query(
    "scan_jsonl",
    "SELECT event_id, CAST(json_extract_string(body, '$.k') AS BIGINT) AS k FROM b_doc WHERE json_valid(body)",
)
def scan_jsonl(t):
    return R.parse_jsonl(t("b_doc"), "k BIGINT", "body").select("event_id", "doc.k")


@query(
    "scan_jsonl_counts",
    """SELECT count(*) AS lines, count(*) FILTER (event_id % 13 = 0) AS blank, count(*) FILTER (event_id % 13 <> 0 AND NOT json_valid(body)) AS malformed FROM b_doc""",
)
def scan_jsonl_counts(t):
    body = F.when(F.col("event_id") % 13 == 0, F.lit("  ")).otherwise(F.col("body"))
    return R.jsonl_counts(t("b_doc").withColumn("body", body), "body")


@query(
    "load_bills_table",
    """SELECT bill_id, session_id, title, CASE WHEN CAST(session_id AS INT) % 2 = 1 THEN status END AS status,
  CASE WHEN CAST(session_id AS INT) % 2 = 0 THEN classification END AS classification,
  state || '/' || bill_id || '/metadata.json' AS source_file FROM b_bill""",
)
def load_bills_table(t):
    b = t("b_bill").withColumn("source_file", F.concat_ws("/", "state", "bill_id", F.lit("metadata.json")))
    even = F.col("session_id").cast("int") % 2 == 0
    old = b.filter(even).select("bill_id", "session_id", "title", "classification", "source_file")
    new = b.filter(~even).select("bill_id", "session_id", "title", "status", "source_file")
    return R.load_bills(old, new).select("bill_id", "session_id", "title", "status", "classification", "source_file")


@query(
    "sessions_dim",
    """SELECT session_id, name, substring(start_date, 1, 4) || '-' || substring(end_date, 1, 4) AS date_folder, 'file' AS origin FROM b_session""",
)
def sessions_dim(t):
    fresh = R.complete_sessions(t("b_session")).withColumn("origin", F.lit("file"))
    cached = t("b_bill").select("session_id").distinct().select(
        "session_id", F.lit("old").alias("name"), F.lit("").alias("date_folder"), F.lit("cache").alias("origin")
    )
    return R.sessions_dim(fresh, cached)


@query(
    "sessions_dim_fallback",
    "SELECT DISTINCT session_id, 'cached' AS name, '' AS date_folder, 'cache' AS origin FROM b_bill",
)
def sessions_dim_fallback(t):
    # Sessions without an end date are incomplete, so the file yields none.
    none = R.complete_sessions(t("b_session").withColumn("end_date", F.lit(None).cast("string")))
    cached = t("b_bill").select("session_id").distinct().select(
        "session_id", F.lit("cached").alias("name"), F.lit("").alias("date_folder"), F.lit("cache").alias("origin")
    )
    return R.sessions_dim(none.withColumn("origin", F.lit("file")), cached)


@query(
    "tagdefs_source",
    """SELECT 'tag_' || item_id AS name, CASE WHEN item_id % 4 = 0 THEN '' ELSE text END AS description,
  CASE WHEN item_id % 3 = 0 THEN 0.5 ELSE 0.7 END AS threshold, CASE WHEN item_id % 2 = 0 THEN 0 ELSE 2 END AS n_examples, 0 AS n_exclude FROM benchmark""",
)
def tagdefs_source(t):
    i = F.col("item_id")
    raw = t("benchmark").select(
        F.concat(F.lit("tag_"), i.cast("string")).alias("name"),
        F.to_json(
            F.struct(
                F.when(i % 4 != 0, F.col("text")).alias("description"),
                F.when(i % 3 != 0, F.lit(0.7)).alias("threshold"),
                F.when(i % 2 != 0, F.array(F.lit("a"), F.lit("b"))).alias("examples"),
            )
        ).alias("raw"),
    )
    schema = (
        "description STRING, examples ARRAY<STRING>, include_keywords ARRAY<STRING>, "
        "exclude_keywords ARRAY<STRING>, negative_examples ARRAY<STRING>, threshold DOUBLE"
    )
    tags = with_tag_defaults(R.parse_jsonl(raw, schema, "raw").select("name", "doc.*"))
    return tags.select(
        "name",
        "description",
        "threshold",
        F.size("examples").cast("bigint").alias("n_examples"),
        F.size("exclude_keywords").cast("bigint").alias("n_exclude"),
    )


@query(
    "sink_bill_tree",
    """SELECT bill_id, 'us' AS country, state, session_id, 'country:us/state:' || state || '/sessions/' || session_id || '/bills/' || bill_id AS path FROM b_bill""",
)
def sink_bill_tree(t):
    return W.with_bill_path(t("b_bill")).select("bill_id", F.lit("us").alias("country"), "state", "session_id", "path")


@query(
    "sink_jsonl",
    """SELECT event_id, '{"event_id":' || event_id || ',"bill_id":"' || bill_id || '"' || CASE WHEN event_id % 10 = 0 THEN '' ELSE ',"kind":"' || event_type || '"' END || '}' AS line FROM b_log""",
)
def sink_jsonl(t):
    kind = F.when(F.col("event_id") % 10 != 0, F.col("event_type"))
    rows = t("b_log").select("event_id", "bill_id", kind.alias("kind"))
    lines = W.json_lines(rows)
    return lines.select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"), F.col("value").alias("line"))


@query(
    "sample_per_type",
    """SELECT event_id, event_type, path FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY path, event_id) AS rn FROM b_log) x WHERE rn <= 20""",
)
def sample_per_type(t):
    return top_per_key(t("b_log"), ["event_type"], [F.asc("path"), F.asc("event_id")], 20).select(
        "event_id", "event_type", "path"
    )


@query(
    "snapshot_manifest",
    """WITH l AS (SELECT source, sha256(text) AS d FROM documents),
  a AS (SELECT source, substring(d, 1, 2) AS p2, substring(d, 3, 2) AS p4, sha256(string_agg(d, '' ORDER BY d)) AS d, count(*) AS n FROM l GROUP BY 1, 2, 3),
  b AS (SELECT source, p2, sha256(string_agg(d, '' ORDER BY d)) AS d, sum(n) AS n FROM a GROUP BY 1, 2)
  SELECT source, CAST(sum(n) AS BIGINT) AS files, sha256(string_agg(d, '' ORDER BY d)) AS sha256 FROM b GROUP BY 1""",
)
def snapshot_manifest(t):
    return A.snapshot_manifest(t("documents"), "source", "text")


@query(
    "fresh_or_fallback",
    """WITH x AS (SELECT event_id, repo, strftime(ts, '%Y-%m-%d') AS day, event_type FROM b_log),
  f AS (SELECT DISTINCT repo, day FROM x WHERE event_type = 'purchase')
  SELECT event_id, repo, day, 'fresh' AS origin FROM x WHERE event_type = 'purchase'
  UNION ALL SELECT event_id, repo, day, 'fallback' FROM x ANTI JOIN f USING (repo, day) WHERE event_type <> 'purchase'""",
)
def fresh_or_fallback(t):
    logs = t("b_log").select("event_id", "repo", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_type")
    fresh, nightly = logs.filter("event_type = 'purchase'"), logs.filter("event_type <> 'purchase'")
    return L.fresh_or_fallback(fresh, nightly, ["repo", "day"]).select("event_id", "repo", "day", "origin")


@query(
    "dataset_footprint",
    """WITH s AS (SELECT source, CAST(sum(n_chars) AS BIGINT) AS bytes FROM documents GROUP BY 1)
  SELECT source, bytes, CASE WHEN bytes < 1024 THEN bytes || ' B' WHEN bytes < 1048576 THEN format('{:.1f} KB', bytes / 1024) ELSE format('{:.1f} MB', bytes / 1048576) END AS size_text FROM s""",
)
def dataset_footprint(t):
    return A.footprint(t("documents"), "source", "n_chars")


@query("available_locales", "SELECT DISTINCT locale FROM b_log WHERE locale NOT LIKE '%9'")
def available_locales(t):
    # Repositories of one locale group have the old suffix, another group an unknown one.
    repo, loc = F.col("repo"), F.col("locale")
    name = (
        F.when(loc.endswith("9"), F.concat(loc, F.lit("-other")))
        .when(loc.endswith("8"), F.concat(loc, F.lit("-data-pipeline")))
        .otherwise(repo)
    )
    return L.available_locales(t("b_log").select(name.alias("repo")))
