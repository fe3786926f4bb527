"""Log entries over the test tables, shared by several catalog queries."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billstream.functions.paths import log_stamp

# Flat form of the entries for the checks. Bills are joined by id alone.
ENTRY_SQL = """
SELECT l.event_id, l.event_type, l.repo, l.locale, l.bill_id, l.path, CASE WHEN l.path LIKE '%/unknown_%' THEN NULL ELSE strftime(l.ts, '%Y%m%dT%H%M%SZ') END AS stamp,
  'Event ' || l.event_type AS description, strftime(l.ts, '%Y-%m-%d') AS date, '~{"classification": "upper"}' AS org,
  b.title, b.identifier, b.session_id AS session, b.status, b.classification AS priority, CASE WHEN b.bill_id IS NOT NULL THEN 'house' END AS chamber,
  l.repo || '/country:us/state:' || l.locale || '/sessions/2024/bills/' || l.bill_id || '/metadata.json' AS bill_path
FROM b_log l LEFT JOIN (SELECT * FROM b_bill WHERE CAST(substring(bill_id, 3, 20) AS BIGINT) % 4 <> 1) b ON l.bill_id = b.bill_id"""


def bill_docs(t) -> DataFrame:
    """Nested bills; every fourth one is missing so that joins have misses."""
    b = t("b_bill").filter(F.substring("bill_id", 3, 20).cast("bigint") % 4 != 1)
    return b.select(
        "bill_id",
        F.struct(
            "title",
            F.array(
                F.struct(F.concat(F.lit("About "), "classification").alias("abstract"), F.lit("short").alias("note"))
            ).alias("abstracts"),
            F.array("classification", "status").alias("subject"),
            "identifier",
            F.col("session_id").alias("legislative_session"),
            F.lit("house").alias("from_organization"),
        ).alias("bill"),
    )


def entries(t) -> DataFrame:
    """Nested entries with every part of the entry schema filled."""
    name = F.col("event_type")
    third = F.col("event_id") % 3
    score = F.lit(0.6)
    tags = (
        F.when(third == 1, F.create_map(name, score))
        .when(third == 2, F.create_map(name, score, F.lit("budget"), score))
        .otherwise(F.create_map().cast("map<string,double>"))
    )
    logs = t("b_log").select(
        "event_id",
        "event_type",
        "repo",
        "locale",
        "bill_id",
        F.struct(
            F.struct(
                F.concat(F.lit("Event "), name).alias("description"),
                F.date_format("ts", "yyyy-MM-dd").alias("date"),
                F.array(name, F.lit("routine")).alias("classification"),
                F.lit('~{"classification": "upper"}').alias("organization_id"),
            ).alias("action"),
            "bill_id",
        ).alias("log"),
        tags.alias("tags"),
        F.col("path"),
        log_stamp(F.col("path")).alias("timestamp"),
    )
    root = F.regexp_extract("path", "^(.*)/logs/", 1)
    joined = logs.join(bill_docs(t), "bill_id", "left")
    source = F.when(F.col("bill").isNotNull(), F.concat(root, F.lit("/metadata.json")))
    return joined.select(
        "event_id",
        "event_type",
        "repo",
        "locale",
        F.col("bill_id").alias("id"),
        "log",
        "bill",
        "tags",
        F.struct(F.col("path").alias("log"), source.alias("bill")).alias("sources"),
        "timestamp",
    )
