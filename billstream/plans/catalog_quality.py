"""Data quality checks."""

from pyspark.sql import functions as F

from billstream.operators import quality as Q
from billstream.operators.schema_checks import schema_violations
from billstream.plans.catalog_filters import GATE_SQL, gated_bills
from billstream.plans.registry import query
from billstream.rules.record_schemas import SCHEMAS
from billstream.sources.writers import with_bill_path


@query(
    "q_required",
    """SELECT bill_id, concat_ws(',', CASE WHEN status = 'O' THEN 'classification' END, CASE WHEN trim(title) = '' THEN 'title' END) AS missing FROM b_bill WHERE status = 'O' OR trim(title) = ''""",
)
def q_required(t):
    bills = t("b_bill").withColumn("classification", F.when(F.col("status") != "O", F.col("classification")))
    missing = Q.missing_fields(["identifier", "session_id", "classification", "title"])
    return bills.withColumn("missing", missing).filter(F.size("missing") > 0).select(
        "bill_id", F.array_join("missing", ",").alias("missing")
    )


@query("q_enum", "SELECT vote_id, result FROM b_vote WHERE result NOT IN ('pass', 'fail', 'tie', 'other')")
def q_enum(t):
    return t("b_vote").filter(Q.outside_domain(F.col("result"), Q.VOTE_RESULTS)).select("vote_id", "result")


@query(
    "q_unknown_fields",
    """SELECT event_id, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 3 = 0 THEN 'extra,k' WHEN event_id % 3 = 1 THEN 'k' ELSE '' END AS unknown FROM b_doc""",
)
def q_unknown_fields(t):
    i = F.col("event_id")
    body = F.when(i % 3 == 0, F.replace("body", F.lit('{"k"'), F.lit('{"extra":1,"k"'))).when(
        i % 3 == 1, F.col("body")
    ).otherwise(F.replace("body", F.lit('{"k"'), F.lit('{"name"')))
    unknown = Q.unknown_fields(body, ["name", "date"])
    return t("b_doc").select("event_id", F.array_join(unknown, ",").alias("unknown"))


@query(
    "q_format",
    """SELECT page_id, page_id % 4 = 0 AS bad_url, page_id % 5 IN (1, 2) AS bad_date FROM pages""",
)
def q_format(t):
    i = F.col("page_id")
    url = F.when(i % 8 == 0, F.replace("url", F.lit("://"), F.lit(":/"))).when(i % 8 == 4, F.lit(None)).otherwise(F.col("url"))
    date = F.when(i % 5 == 0, F.lit("2024-02-29")).when(i % 5 == 1, F.lit("2023-02-29")).when(i % 5 == 2, F.lit("today"))
    return t("pages").select("page_id", Q.bad_url(url).alias("bad_url"), Q.bad_date(date).alias("bad_date"))


SCHEMA_FAULTS = [
    ("vote_event", 1, "bill", "required"), ("vote_event", 2, "result", "enum"), ("vote_event", 2, "start_date", "format"),
    ("vote_event", 3, "counts[0].value", "minimum"), ("vote_event", 3, "counts[0].extra", "additional"),
    ("organization", 1, "parent_id", "required"), ("organization", 2, "classification", "enum"), ("organization", 3, "links", "type"),
    ("jurisdiction", 1, "legislative_sessions[0].end_date", "required"), ("jurisdiction", 2, "legislative_sessions[0].start_date", "format"),
    ("jurisdiction", 2, "url", "format"), ("jurisdiction", 3, "legislative_sessions[0].classification", "type"),
    ("bill", 1, "title", "required"), ("bill", 2, "classification[0]", "type"), ("bill", 3, "more", "additional"),
    ("action_log", 1, "bill_id", "required"), ("action_log", 2, "action.date", "format"), ("action_log", 3, "action.z", "additional"),
]


@query(
    "q_schema",
    f"""SELECT event_id, r.kind, path, rule FROM b_record r JOIN (VALUES {', '.join(map(str, SCHEMA_FAULTS))}) f(kind, v, path, rule) ON f.kind = r.kind AND f.v = r.v WHERE event_id % 97 <> 0
  UNION ALL SELECT event_id, kind, '', 'json' FROM b_record WHERE event_id % 97 = 0""",
)
def q_schema(t):
    return schema_violations(t("b_record").drop("v"), SCHEMAS).select("event_id", "kind", "path", "rule")


@query("q_unique_identifier", "SELECT bill_id, date, description, count(*) AS n FROM b_action GROUP BY 1, 2, 3 HAVING count(*) > 1")
def q_unique_identifier(t):
    return Q.duplicate_keys(t("b_action"), ["bill_id", "date", "description"])


@query(
    "q_session_coverage",
    f"SELECT gate, count(*) AS n, round(count(*) / (SELECT count(*) FROM b_bill), 6) AS share FROM ({GATE_SQL}) g GROUP BY 1",
)
def q_session_coverage(t):
    return Q.coverage(gated_bills(t))


@query(
    "q_path_params",
    """SELECT bill_id, state, session_id AS session, 'HB' AS chamber_code, substring(bill_id, 3, 20) AS number, length(bill_id) <= 6 AND state NOT LIKE '%7' AS valid FROM b_bill""",
)
def q_path_params(t):
    path = F.replace("path", F.lit("/bills/HB"), F.lit("/bills/HB-"))
    bills = with_bill_path(t("b_bill")).select("bill_id", F.concat(path, F.lit("/metadata.json")).alias("path"))
    template = "country:us/state:{state}/sessions/{session}/bills/{chamber_code}-{number}/metadata.json"
    patterns = {"state": "n[0-9]*[0-689]", "session": "[0-9]{4}", "number": "[0-9]{1,4}"}
    out = Q.path_params(bills, "path", template, patterns)
    return out.select("bill_id", "state", "session", "chamber_code", "number", "valid")
