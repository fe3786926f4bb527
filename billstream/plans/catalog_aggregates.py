"""Aggregations."""

from pyspark.sql import functions as F

from billstream.functions.paths import file_name
from billstream.functions.vectors import mean_pool
from billstream.operators import aggregates as A
from billstream.operators import bills as B
from billstream.operators import documents as D
from billstream.operators import links as K
from billstream.operators import quality as Q
from billstream.operators.tagging import text_cache
from billstream.plans.registry import query


@query(
    "run_counts",
    """SELECT count(*) FILTER (contains(file_name, 'bill_')) AS bills, count(*) FILTER (contains(file_name, 'vote_event')) AS vote_events,
  count(*) FILTER (starts_with(file_name, 'event_')) AS events FROM b_doc""",
)
def run_counts(t):
    return A.run_counts(t("b_doc"))


@query("count_bills", "SELECT count(*) AS bills FROM b_bill")
def count_bills(t):
    return t("b_bill").agg(F.count("*").alias("bills"))


@query(
    "bills_summary",
    """WITH a AS (SELECT bill_id, count(*) AS n FROM b_action GROUP BY 1)
  SELECT b.identifier, b.title, b.session_id AS session, 'ocd/' || b.state AS jurisdiction_id, upper(b.state) AS jurisdiction_name,
  coalesce(a.n, 0) AS action_count, CASE WHEN b.status = 'F' THEN 0 ELSE 2 END AS sponsor_count FROM b_bill b LEFT JOIN a ON a.bill_id = b.bill_id""",
)
def bills_summary(t):
    bills = t("b_bill").select(
        "bill_id",
        "identifier",
        "title",
        F.col("session_id").alias("session"),
        F.concat(F.lit("ocd/"), "state").alias("jurisdiction_id"),
        F.upper("state").alias("jurisdiction_name"),
    )
    sponsors = t("b_bill").filter("status <> 'F'").select("bill_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("name"))
    return B.bills_summary_flat(bills, t("b_action"), sponsors).drop("bill_id")


@query("count_by_bill", "SELECT bill_id, count(*) AS n FROM b_action GROUP BY 1")
def count_by_bill(t):
    return A.count_by(t("b_action"), "bill_id")


@query(
    "classification_histogram",
    "SELECT classification, count(*) AS n FROM (SELECT unnest(string_split(classes, ',')) AS classification FROM b_action) x GROUP BY 1 ORDER BY n DESC, 1",
)
def classification_histogram(t):
    return A.classification_histogram(t("b_action").select(F.split("classes", ",").alias("classes")))


@query(
    "same_stamp_groups",
    """SELECT bill_id, CAST(ord AS BIGINT) AS ord, date, group_size FROM (SELECT bill_id, ord, date, count(*) OVER (PARTITION BY bill_id, date) AS group_size FROM b_action) x WHERE group_size > 1""",
)
def same_stamp_groups(t):
    out = A.same_stamp_groups(t("b_action"), ["bill_id", "date"])
    return out.select("bill_id", F.col("ord").cast("bigint"), "date", "group_size")


@query(
    "max_mark",
    """SELECT event_type AS category, strftime(max(greatest(ts, TIMESTAMP '2024-01-15')), '%Y-%m-%d %H:%M:%S') AS mark FROM events
  WHERE event_type <> 'view' OR ts < TIMESTAMP '2024-01-05' GROUP BY 1""",
)
def max_mark(t):
    e = t("events").withColumnRenamed("event_type", "category")
    old = e.select("category").distinct().withColumn("mark", F.lit("2024-01-15").cast("timestamp_ntz"))
    # One category has early items only, so its old mark stays.
    fresh = e.filter("category <> 'view' or ts < timestamp_ntz'2024-01-05'")
    return K.advance_marks(old, fresh).select("category", F.date_format("mark", "yyyy-MM-dd HH:mm:ss").alias("mark"))


@query(
    "orphan_counts",
    """SELECT bill_id, count(*) FILTER (path LIKE '%/logs/%vote%') AS vote_count, count(*) FILTER (path NOT LIKE '%/logs/%vote%' AND event_type = 'click') AS event_count
  FROM b_log WHERE bill_id NOT IN (SELECT bill_id FROM b_bill WHERE status = 'P') GROUP BY 1""",
)
def orphan_counts(t):
    # Hearing logs carry the word event in their name.
    name = F.when(F.col("event_type") == "click", F.lit("20240101T000000Z_event_x.json")).otherwise(file_name(F.col("path")))
    logs = t("b_log").withColumn("name", name)
    orphan = logs.join(t("b_bill").filter("status = 'P'").select("bill_id"), "bill_id", "left_anti")
    return K.orphan_log_counts(orphan)


@query(
    "extraction_stats",
    """WITH s AS (SELECT CASE WHEN text_update IS NOT NULL AND NOT logs_update > text_update AND files > 0 THEN 'skipped' WHEN bill_key % 8 = 0 THEN 'error' ELSE 'ok' END AS s FROM b_extract)
  SELECT count(*) AS total, count(s) AS processed, count(*) FILTER (s = 'ok') AS successful, count(*) FILTER (s = 'error') AS errors, count(*) FILTER (s = 'skipped') AS skipped FROM s""",
)
def extraction_stats(t):
    need = D.needs_extraction(F.col("logs_update"), F.col("text_update"), F.col("files"))
    status = F.when(~need, "skipped").when(F.col("bill_key") % 8 == 0, "error").otherwise("ok")
    return D.extraction_stats(t("b_extract").select(status.alias("status")))


@query(
    "failure_report",
    """WITH f AS (SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'download' WHEN 1 THEN 'parsing' ELSE 'save' END AS error_type, props AS error_message FROM events WHERE event_type = 'error')
  SELECT event_id, error_type, error_message, count(*) OVER (PARTITION BY error_type) AS type_count FROM f""",
)
def failure_report(t):
    i = F.col("event_id") % 3
    kind = F.when(i == 0, "download").when(i == 1, "parsing").otherwise("save")
    failures = t("events").filter("event_type = 'error'").select("event_id", kind.alias("error_type"), F.col("props").alias("error_message"))
    return D.failure_report(failures).select("event_id", "error_type", "error_message", "type_count")


@query(
    "dedup_name_quarantine",
    """WITH x AS (SELECT event_id, name, file_name, CASE WHEN contains(file_name, 'bill_') THEN 'from_bill' ELSE 'from_other' END AS category FROM b_doc)
  SELECT event_id, category, name FROM (SELECT *, row_number() OVER (PARTITION BY category, name ORDER BY file_name) AS rn FROM x) y
  WHERE name = '' OR (rn = 1 AND NOT (category = 'from_bill' AND name LIKE '%7'))""",
)
def dedup_name_quarantine(t):
    category = F.when(F.contains("file_name", F.lit("bill_")), "from_bill").otherwise("from_other")
    errors = t("b_doc").withColumn("category", category)
    filed = errors.filter("category = 'from_bill' and name like '%7'")
    return Q.dedup_name_quarantine(errors, filed).select("event_id", "category", "name")


@query("tag_histogram", "SELECT tag, count(DISTINCT bill_id) AS bills FROM b_tagged GROUP BY 1")
def tag_histogram(t):
    return A.tag_histogram(t("b_tagged"))


ERROR_LINES = """(SELECT run, line, content, CASE WHEN content LIKE 'Traceback%' THEN 1 WHEN content LIKE 'ValueError:%' THEN 2
  WHEN content LIKE 'ERROR scrape%' THEN 3 END AS priority FROM b_runlog)"""


@query(
    "scrape_summary",
    f"""WITH e AS (SELECT * FROM {ERROR_LINES} x WHERE priority IS NOT NULL), m AS (SELECT run, min(priority) AS priority FROM e GROUP BY 1),
  n AS (SELECT run, count(*) AS n, list(content ORDER BY line)[1:5] AS first5 FROM e JOIN m USING (run, priority) GROUP BY 1),
  c AS (SELECT run, line, trim(content) AS s FROM b_runlog)
  SELECT run, coalesce(arg_max(TRY_CAST(split_part(s, ':', 2) AS BIGINT), line) FILTER (starts_with(s, 'bill:')), 0) AS bill_count,
  coalesce(arg_max(TRY_CAST(split_part(s, ':', 2) AS BIGINT), line) FILTER (starts_with(s, 'vote_event:')), 0) AS vote_event_count,
  coalesce(arg_max(TRY_CAST(split_part(s, ':', 2) AS BIGINT), line) FILTER (starts_with(s, 'event:')), 0) AS event_count,
  coalesce(arg_max(TRY_CAST(split_part(s, ':', 2) AS BIGINT), line) FILTER (starts_with(s, 'jurisdiction:')), 0) AS jurisdiction_count,
  coalesce(arg_max(TRY_CAST(split_part(s, ':', 2) AS BIGINT), line) FILTER (starts_with(s, 'organization:')), 0) AS organization_count,
  coalesce(arg_max(trim(substring(s, 10, 30)), line) FILTER (starts_with(s, 'duration:')), 'unknown') AS duration,
  coalesce(any_value(n), 0) AS error_count, coalesce(any_value(first5), []) AS errors FROM c LEFT JOIN n USING (run) GROUP BY run""",
)
def scrape_summary(t):
    return D.scrape_summary(t("b_runlog"))


@query(
    "error_classify",
    f"""WITH e AS (SELECT * FROM {ERROR_LINES} x WHERE priority IS NOT NULL), m AS (SELECT run, min(priority) AS priority FROM e GROUP BY 1)
  SELECT run, line, content, CAST(priority AS BIGINT) AS priority FROM e JOIN m USING (run, priority)""",
)
def error_classify(t):
    return D.classify_errors(t("b_runlog")).select("run", "line", "content", F.col("priority").cast("bigint"))


# The run log with heads of the bills block, durations near them, and more tracebacks.
BLOCK_LINES = """(SELECT run, line, CASE WHEN line % 7 = 1 THEN 'bills scrape:' WHEN line % 7 = 3 THEN concat('  duration: 0:', lpad(CAST(line % 60 AS STRING), 2, '0'), ':07')
  WHEN run % 2 = 0 AND line % 23 = 5 THEN 'Traceback (most recent call last):' ELSE content END AS content FROM b_runlog)"""
BLOCK_SQL = f"""WITH r AS (SELECT run, line, content, row_number() OVER (PARTITION BY run ORDER BY line) AS place FROM {BLOCK_LINES} x),
  h AS (SELECT *, max(CASE WHEN starts_with(content, 'Traceback (most recent call last):') THEN place END) OVER w AS head, max(CASE WHEN contains(content, 'bills scrape:') THEN place END) OVER w AS bills
    FROM r WINDOW w AS (PARTITION BY run ORDER BY place ROWS UNBOUNDED PRECEDING)),
  k AS (SELECT run, 1 AS priority, min(line) AS line, string_agg(content, chr(10) ORDER BY place) AS content FROM h WHERE place - head <= 10 GROUP BY run, head),
  e AS (SELECT * FROM {{}} x WHERE priority > 1 AND run NOT IN (SELECT run FROM k)), m AS (SELECT run, min(priority) AS priority FROM e GROUP BY 1),
  a AS (SELECT run, priority, line, content FROM k UNION ALL SELECT run, priority, line, content FROM e JOIN m USING (run, priority))"""


def block_lines(t):
    line, run = F.col("line"), F.col("run")
    text = (
        F.when(line % 7 == 1, "bills scrape:")
        .when(line % 7 == 3, F.concat(F.lit("  duration: 0:"), F.lpad((line % 60).cast("string"), 2, "0"), F.lit(":07")))
        .when((run % 2 == 0) & (line % 23 == 5), D.TRACEBACK_HEAD)
        .otherwise(F.col("content"))
    )
    return t("b_runlog").withColumn("content", text)


@query(
    "error_blocks",
    BLOCK_SQL.format(ERROR_LINES.replace("b_runlog", BLOCK_LINES)) + " SELECT run, line, content, CAST(priority AS BIGINT) AS priority FROM a",
)
def error_blocks(t):
    return D.error_blocks(block_lines(t)).select("run", "line", "content", F.col("priority").cast("bigint"))


@query(
    "run_summary",
    BLOCK_SQL.format(ERROR_LINES.replace("b_runlog", BLOCK_LINES))
    + """, d AS (SELECT run, arg_max(trim(substring(trim(content), 10, 30)), place) AS duration FROM h WHERE place - bills <= 2 AND starts_with(trim(content), 'duration:') GROUP BY run),
  n AS (SELECT run, count(*) AS n, list(content ORDER BY line)[1:5] AS first5 FROM a GROUP BY 1),
  c AS (SELECT run, arg_max(TRY_CAST(split_part(trim(content), ':', 2) AS BIGINT), line) FILTER (starts_with(trim(content), 'bill:')) AS bills FROM r GROUP BY 1)
  SELECT run, coalesce(c.bills, 0) AS bill_count, coalesce(duration, 'unknown') AS duration, coalesce(n, 0) AS error_count, coalesce(first5, []) AS errors
  FROM c LEFT JOIN d USING (run) LEFT JOIN n USING (run)""",
)
def run_summary(t):
    return D.run_summary(block_lines(t)).select("run", "bill_count", "duration", "error_count", "errors")


@query(
    "mean_pool",
    """WITH x AS (SELECT label, unnest(CAST(embedding AS DOUBLE[])) AS x, generate_subscripts(embedding, 1) AS i FROM embeddings)
  SELECT CAST(label AS BIGINT) AS label, CAST(i - 1 AS BIGINT) AS dim, round(avg(x), 6) AS mean FROM x GROUP BY 1, 2""",
)
def mean_pool_query(t):
    pooled = mean_pool(t("embeddings"), "label", "embedding")
    cells = pooled.select(F.col("label").cast("bigint"), F.posexplode("embedding").alias("dim", "mean"))
    return cells.select("label", F.col("dim").cast("bigint"), F.round("mean", 6).alias("mean"))


@query("text_cache", "SELECT DISTINCT sha256(text) AS text_hash, text FROM documents")
def text_cache_query(t):
    return text_cache(t("documents"))


@query("vote_counts", "SELECT vote_id, opt, count(*) AS n FROM b_ballot GROUP BY 1, 2")
def vote_counts(t):
    return A.vote_counts(t("b_ballot"))


@query(
    "vote_counts_reconcile",
    """WITH c AS (SELECT vote_id, opt, count(*) AS n FROM b_ballot GROUP BY 1, 2)
  SELECT vote_id, opt, n AS counted, n + 1 AS stated FROM c WHERE vote_id % 5 = 0 AND opt <> 'excused' UNION ALL SELECT vote_id, opt, n, NULL FROM c WHERE opt = 'excused'""",
)
def vote_counts_reconcile(t):
    stated = A.vote_counts(t("b_ballot")).filter("opt <> 'excused'").select(
        "vote_id", "opt", (F.col("n") + F.when(F.col("vote_id") % 5 == 0, 1).otherwise(0)).alias("value")
    )
    return A.reconcile_counts(t("b_ballot"), stated)
