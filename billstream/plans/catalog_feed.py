"""The feed: latest activity with bill titles."""

from pyspark.sql import functions as F

from billstream.functions.paths import log_stamp
from billstream.operators import feed as Fd
from billstream.operators import logs as L
from billstream.operators.routine import routine_filter
from billstream.plans.registry import query
from billstream.plans.shared import bill_docs
from billstream.sources import writers as W

DESCRIPTION_SQL = "CASE event_type WHEN 'view' THEN 'Referred to Rules' WHEN 'click' THEN 'Filed' ELSE 'Passed ' || event_type END"
STAMP_SQL = "CASE WHEN path LIKE '%/unknown_%' THEN '' ELSE strftime(ts, '%Y%m%dT%H%M%SZ') END"
LOGS_SQL = f"""(SELECT *, {DESCRIPTION_SQL} AS description, {STAMP_SQL} AS stamp FROM b_log)"""
FIRST_SQL = """(SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY path ORDER BY event_id) AS rn FROM {0} g) h WHERE rn = 1)"""
BILLS_SQL = "(SELECT * FROM b_bill WHERE CAST(substring(bill_id, 3, 20) AS BIGINT) % 4 <> 1)"


def activity(t):
    """Session logs with a description; the locale of the rule set is mapped per group."""
    kind = F.col("event_type")
    text = F.when(kind == "view", "Referred to Rules").when(kind == "click", "Filed").otherwise(F.concat(F.lit("Passed "), kind))
    rules = F.when(F.substring("locale", 3, 1).isin("0", "5"), F.lit("fl")).otherwise(F.col("locale"))
    return L.scan_session_logs(t("b_log")).select(
        "event_id",
        "repo",
        "bill_id",
        "path",
        text.alias("description"),
        F.array(kind).alias("classes"),
        rules.alias("locale"),
        log_stamp(F.col("path")).alias("log_ts"),
    )


@query(
    "feed_latest_activity",
    f"""WITH x AS (SELECT * FROM {LOGS_SQL} a WHERE NOT (substring(locale, 3, 1) IN ('0', '5') AND event_type IN ('view', 'click'))),
  n AS (SELECT * FROM {FIRST_SQL.format('x')} f ORDER BY stamp DESC, path LIMIT 100)
  SELECT n.path AS guid, nullif(stamp, '') AS timestamp, description, n.bill_id, trim(b.title) AS title, 'untagged - ' || repo || ' - ' || coalesce(nullif(trim(b.title), ''), n.bill_id) AS item_title
  FROM n LEFT JOIN {BILLS_SQL} b ON b.bill_id = n.bill_id""",
)
def feed_latest_activity(t):
    top = Fd.top_entries(routine_filter(activity(t)))
    items = L.join_bill_few(top, bill_docs(t), ["bill_id"]).orderBy(*Fd.newest_items())
    entry = feed_entry(items, F.create_map().cast("map<string,double>"))
    kept = [
        F.col("log.action.description").alias("activity"),
        F.col("id").alias("bill_id"),
        F.trim("bill.title").alias("bill_title"),
    ]
    return Fd.feed_items(entry, "https://example.org/data", kept).select(
        "guid",
        "timestamp",
        F.col("activity").alias("description"),
        "bill_id",
        F.col("bill_title").alias("title"),
        F.col("title").alias("item_title"),
    )


def feed_entry(rows, tags):
    root = F.regexp_extract("path", "^(.*)/logs/", 1)
    none = F.lit(None).cast("string")
    return rows.select(
        F.col("bill_id").alias("id"),
        F.struct(
            F.struct(
                "description", none.alias("date"), F.col("classes").alias("classification"), none.alias("organization_id")
            ).alias("action"),
            "bill_id",
        ).alias("log"),
        "bill",
        tags.alias("tags"),
        F.struct(
            F.col("path").alias("log"), F.when(F.col("bill").isNotNull(), F.concat(root, F.lit("/metadata.json"))).alias("bill")
        ).alias("sources"),
        F.col("log_ts").alias("timestamp"),
    )


@query(
    "feed_top_n",
    f"""WITH x AS (SELECT * FROM {LOGS_SQL} a SEMI JOIN (SELECT bill_id FROM b_tagged WHERE tag IN ('flagged', 'quality')) q USING (bill_id))
  SELECT event_id, path, nullif(stamp, '') AS log_ts FROM {FIRST_SQL.format('x')} f ORDER BY stamp DESC, path LIMIT 100""",
)
def feed_top_n(t):
    return Fd.top_entries(activity(t), t("b_tagged"), ["flagged", "quality"], keys=["bill_id"]).select("event_id", "path", "log_ts")


@query(
    "sink_feed_xml",
    f"""WITH g AS (SELECT bill_id, string_agg(tag, ', ' ORDER BY tag) AS tags FROM b_tagged GROUP BY 1),
  x AS (SELECT * FROM {LOGS_SQL} a SEMI JOIN g USING (bill_id)), n AS (SELECT * FROM {FIRST_SQL.format('x')} f ORDER BY stamp DESC, path LIMIT 100)
  SELECT row_number() OVER (ORDER BY stamp DESC, n.path) AS position, n.path AS guid, g.tags || ' - ' || repo || ' - ' || coalesce(nullif(trim(b.title), ''), n.bill_id) AS title,
  CASE WHEN b.bill_id IS NOT NULL THEN 'https://example.org/data/' || repo || '/country:us/state:' || locale || '/sessions/2024/bills/' || n.bill_id || '/metadata.json' END AS link,
  CASE WHEN stamp <> '' THEN strftime(ts, '%a, %-d %b %Y %H:%M:%S +0000') END AS "pubDate", g.tags AS category
  FROM n JOIN g USING (bill_id) LEFT JOIN {BILLS_SQL} b ON b.bill_id = n.bill_id""",
)
def sink_feed_xml(t):
    tags = t("b_tagged").select("bill_id", "tag", F.col("evidence").cast("double").alias("score"))
    top = Fd.top_entries(activity(t), tags, keys=["bill_id"])
    rows = L.join_bill_few(L.join_tags(top, tags, ["bill_id"]), bill_docs(t), ["bill_id"])
    items = Fd.feed_items(feed_entry(rows, F.col("tags")), "https://example.org/data/")
    # Positions as the items stand in the written document.
    document = W.feed_document(items, "Tagged Legislation", "https://example.org/data")
    parts = F.slice(F.split("value", "<item>", -1), 2, Fd.FEED_LIMIT)
    text = lambda name: F.nullif(F.xpath_string(F.concat(F.lit("<item>"), F.regexp_replace("item", "</channel></rss>$", "")), F.lit(f"item/{name}")), F.lit(""))
    one = document.select(F.posexplode(parts).alias("at", "item"))
    return one.select(
        (F.col("at") + 1).cast("long").alias("position"),
        text("guid").alias("guid"),
        text("title").alias("title"),
        text("link").alias("link"),
        text("pubDate").alias("pubDate"),
        F.array_join(F.xpath(F.concat(F.lit("<item>"), F.regexp_replace("item", "</channel></rss>$", "")), F.lit("item/category/text()")), ", ").alias("category"),
    )
