"""Projections, gates and filters."""

from pyspark.sql import functions as F

from billstream.functions import nested
from billstream.operators import bills as B
from billstream.operators import logs as L
from billstream.operators import quality as Q
from billstream.operators import routine as R
from billstream.operators.documents import needs_extraction
from billstream.operators.links import newer_than_mark
from billstream.operators.tagging import already_tagged
from billstream.plans.registry import query
from billstream.plans.shared import ENTRY_SQL, entries


@query(
    "select_default",
    f"""SELECT bill_id AS id, bill_id AS log_bill, description, title, priority || '|' || status AS subjects, identifier, session, path AS log_source, stamp AS timestamp FROM ({ENTRY_SQL}) e""",
)
def select_default(t):
    flat = entries(t).select("*", "log.action", F.col("log.bill_id").alias("bill_id")).drop("log")
    shaped = L.select_default(flat)
    return shaped.select(
        "id",
        F.col("log.bill_id").alias("log_bill"),
        F.col("log.action.description").alias("description"),
        F.col("bill.title").alias("title"),
        F.array_join("bill.subject", "|").alias("subjects"),
        F.col("bill.identifier").alias("identifier"),
        F.col("bill.legislative_session").alias("session"),
        F.col("sources.log").alias("log_source"),
        "timestamp",
    )


@query(
    "join_field_path",
    """SELECT event_id, CASE WHEN event_id % 9 = 0 THEN NULL ELSE json_extract_string(props, '$.k') END AS "bill.votes.1.k" FROM events""",
)
def join_field_path(t):
    # Every ninth document is damaged and gives null.
    doc = F.concat(F.lit('{"votes":['), F.col("event_id").cast("string"), F.lit(","), F.col("props"), F.lit("]}"))
    doc = F.when(F.col("event_id") % 9 == 0, F.substring(doc, 1, 9)).otherwise(doc)
    return t("events").select("event_id", L.join_field(doc, "bill.votes.1.k"))


@query(
    "deep_prune",
    """SELECT event_id, '{' || concat_ws(',', '"id":' || event_id, CASE WHEN event_id % 3 <> 0 THEN '"kind":"' || event_type || '"' END,
  CASE WHEN event_id % 2 = 0 THEN '"names":["' || bill_id || '"]' END,
  CASE WHEN event_id % 5 <> 0 THEN '"inner":{"flag":false,"deep":{"text":"' || locale || '"}}' ELSE '"inner":{"flag":false}' END) || '}' AS pruned FROM b_log""",
)
def deep_prune(t):
    i = F.col("event_id")
    blank = F.lit("")
    entry = F.struct(
        i.alias("id"),
        F.when(i % 3 == 0, blank).otherwise(F.col("event_type")).alias("kind"),
        F.array(blank, F.when(i % 2 == 0, F.col("bill_id"))).alias("names"),
        F.struct(
            F.lit(False).alias("flag"),
            F.struct(F.when(i % 5 != 0, F.col("locale")).otherwise(blank).alias("text"), F.array().cast("array<string>").alias("list")).alias("deep"),
            F.struct(blank.alias("a"), F.lit(None).cast("string").alias("b")).alias("gone"),
        ).alias("inner"),
    )
    df = t("b_log").select("event_id", entry.alias("entry"))
    return df.select("event_id", F.to_json(nested.deep_prune(F.col("entry"), df.schema["entry"].dataType)).alias("pruned"))


ROUTINE_SQL = """
SELECT action_no, locale, classes, description FROM b_routine WHERE NOT (
  (locale = 'ak' AND (contains(classes, 'filing') OR contains(classes, 'referral-committee') OR description = '(H) EDC, FIN' OR description LIKE 'FN%: ZERO%'))
  OR (locale = 'al' AND (classes = 'filing' OR description = 'Filed'))
  OR (locale = 'ca' AND (contains(classes, 'referral-committee') OR description LIKE 'Set for hearing%' OR description = 'June 4 set for first hearing'))
  OR (locale = 'de' AND (contains(classes, 'introduction') OR description = 'Assigned to Health Committee'))
  OR (locale = 'fl' AND (classes = 'filing' OR description = 'Filed' OR description LIKE 'Referred to%' OR description = 'Added to House agenda'))
  OR (locale = 'hi' AND (contains(classes, 'introduction') OR description LIKE 'Referred to%' OR description LIKE '%Notice of%hearing%'))
  OR (locale = 'wy' AND (contains(classes, 'introduction') OR contains(classes, 'referral-committee')
    OR description IN ('Bill Number Assigned', 'H Placed on General File')))
  OR (locale = 'wv' AND (contains(classes, 'introduction') OR classes = 'filing' OR description = 'To House Judiciary'))
  OR (locale = 'nv' AND description IN ('Prefiled. Referred to Committee on Rules', 'Taken from General File. Placed on General File for later')))"""


@query("routine_filter", ROUTINE_SQL)
def routine_filter(t):
    rows = t("b_routine").withColumn("list", F.split("classes", ","))
    return R.routine_filter(rows, classes="list").select("action_no", "locale", "classes", "description")


@query("routine_filter_none", "SELECT action_no, locale, description FROM b_routine")
def routine_filter_none(t):
    return R.routine_filter(t("b_routine"), alias="none").select("action_no", "locale", "description")


@query(
    "rule_classification",
    "SELECT bill_id, CAST(ord AS BIGINT) AS ord, classes FROM b_action WHERE NOT (contains(classes, 'referral-committee') OR classes = 'filing')",
)
def rule_classification(t):
    test = R.denied_class(F.split("classes", ","), ["referral-committee", "filing"])
    return t("b_action").filter(R.keep_unless(test)).select("bill_id", F.col("ord").cast("bigint"), "classes")


@query(
    "rule_desc_equals",
    "SELECT bill_id, CAST(ord AS BIGINT) AS ord, description FROM b_action WHERE description NOT IN ('Read second time.', 'Floor vote, roll 7')",
)
def rule_desc_equals(t):
    test = R.equals_any(F.col("description"), ["Read second time.", "Floor vote, roll 7"])
    return t("b_action").filter(R.keep_unless(test)).select("bill_id", F.col("ord").cast("bigint"), "description")


@query(
    "rule_desc_prefix",
    "SELECT bill_id, CAST(ord AS BIGINT) AS ord, description FROM b_action WHERE description NOT LIKE 'Referred to%' AND description NOT LIKE 'Floor vote, roll 1%'",
)
def rule_desc_prefix(t):
    test = R.prefix_any(F.col("description"), ["Referred to", "Floor vote, roll 1"])
    return t("b_action").filter(R.keep_unless(test)).select("bill_id", F.col("ord").cast("bigint"), "description")


@query(
    "rule_desc_contains",
    "SELECT bill_id, CAST(ord AS BIGINT) AS ord, description FROM b_action WHERE NOT contains(description, 'second') AND NOT contains(description, 'Panel-3')",
)
def rule_desc_contains(t):
    test = R.contains_any(F.col("description"), ["second", "Panel-3"])
    return t("b_action").filter(R.keep_unless(test)).select("bill_id", F.col("ord").cast("bigint"), "description")


@query(
    "rule_conjunction",
    """SELECT bill_id, CAST(ord AS BIGINT) AS ord, description FROM b_action WHERE NOT (starts_with(description, 'Floor vote')
  AND (contains(description, '3') OR contains(description, '4')) AND strlen(description) < 19)""",
)
def rule_conjunction(t):
    test = R.conjunction(F.col("description"), "Floor vote", ["3", "4"], shorter_than=19)
    return t("b_action").filter(R.keep_unless(test)).select("bill_id", F.col("ord").cast("bigint"), "description")


@query(
    "tag_filter",
    "SELECT event_id, bill_id FROM b_log SEMI JOIN (SELECT bill_id FROM b_tagged WHERE tag IN ('flagged', 'other')) g USING (bill_id)",
)
def tag_filter(t):
    return L.tag_filter(t("b_log"), t("b_tagged"), ["flagged", "other"], ["bill_id"]).select("event_id", "bill_id")


@query("tag_filter_any", "SELECT event_id, bill_id FROM b_log SEMI JOIN b_tagged USING (bill_id)")
def tag_filter_any(t):
    return L.tag_filter(t("b_log"), t("b_tagged"), keys=["bill_id"]).select("event_id", "bill_id")


@query(
    "require_field",
    "SELECT event_id, file_name, CASE WHEN name = '' THEN 'missing_name' ELSE 'accepted' END AS category FROM b_doc",
)
def require_field(t):
    good, bad = Q.require_field(t("b_doc"), "name", "missing_name")
    both = good.withColumn("category", F.lit("accepted")).unionByName(bad)
    return both.select("event_id", "file_name", "category")


GATE_SQL = """SELECT bill_id, CASE WHEN status = 'P' THEN 'missing_session' WHEN CAST(session_id AS INT) % 4 = 0 THEN 'unknown_session' ELSE 'pass' END AS gate FROM b_bill"""


def gated_bills(t):
    # Bills of one status have lost their session.
    b = t("b_bill").withColumn("session_id", F.when(F.col("status") != "P", F.col("session_id")))
    return Q.session_gate(b, t("b_session"))


@query("session_gate", GATE_SQL)
def session_gate(t):
    return gated_bills(t).select("bill_id", "gate")


@query(
    "newer_than_mark",
    """WITH m AS (SELECT event_type, max(date_trunc('second', ts)) AS mark FROM events WHERE ts < TIMESTAMP '2024-01-11' GROUP BY 1)
  SELECT event_id, event_type AS category, CASE WHEN event_id % 19 = 0 THEN 'missing_date' ELSE 'newer' END AS outcome FROM events JOIN m USING (event_type)
  WHERE event_id % 19 = 0 OR (event_id % 23 <> 0 AND date_trunc('second', ts) > mark)""",
)
def newer_than_mark_query(t):
    e = t("events").withColumnRenamed("event_type", "category")
    whole = F.date_trunc("second", F.col("ts").cast("timestamp"))
    marks = e.filter(F.col("ts") < F.lit("2024-01-11").cast("timestamp_ntz")).groupBy("category").agg(F.max(whole).alias("mark"))
    i = F.col("event_id")
    date = F.when(i % 19 == 0, "").when(i % 23 == 0, "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return newer_than_mark(e.withColumn("start_date", date), marks).select("event_id", "category", "outcome")


@query(
    "changed_bill_gate",
    """WITH p AS (SELECT bill_id, count(*) AS n_previous FROM b_action WHERE date < '1998' GROUP BY 1), i AS (SELECT bill_id, count(*) AS n_incoming FROM b_action GROUP BY 1)
  SELECT bill_id, n_previous, n_incoming, n_previous IS NULL AS is_new FROM i LEFT JOIN p USING (bill_id) WHERE n_previous IS NULL OR n_previous <> n_incoming""",
)
def changed_bill_gate(t):
    actions = t("b_action")
    return B.changed_bills(actions.filter("date < '1998'"), actions)


@query(
    "extraction_gate",
    """SELECT bill_key, NOT (text_update IS NOT NULL AND NOT coalesce(logs_update > text_update, FALSE) AND files > 0) AS process FROM b_extract""",
)
def extraction_gate(t):
    process = needs_extraction(F.col("logs_update"), F.col("text_update"), F.col("files"))
    return t("b_extract").select("bill_key", process.alias("process"))


@query(
    "already_tagged_gate",
    """SELECT doc_id, bill_id, CASE WHEN bill_id IN (SELECT bill_id FROM b_tagged WHERE tag = 'quality') THEN 'matched' ELSE 'todo' END AS gate FROM b_text""",
)
def already_tagged_gate(t):
    return already_tagged(t("b_text"), t("b_tagged"), "quality").select("doc_id", "bill_id", "gate")


@query(
    "sanitize_keys",
    """SELECT event_id, '{"name":"' || name || '","votes":[{"k":' || event_id || '}],"source":{"file":"' || file_name || '"}}' AS clean FROM b_doc""",
)
def sanitize_keys(t):
    ident = F.col("event_id")
    docs = t("b_doc").select(
        "event_id",
        F.lit("x").alias("_id"),
        F.lit("2024").alias("scraped_at"),
        "name",
        F.array(F.struct(F.lit("v").alias("_id"), ident.alias("k"))).alias("votes"),
        F.struct(F.col("file_name").alias("file"), F.lit("2024").alias("scraped_at")).alias("source"),
    )
    clean = nested.sanitize_keys(docs)
    return clean.select("event_id", F.to_json(F.struct(*clean.columns[1:])).alias("clean"))


@query(
    "analytics_class_select",
    "SELECT bill_id, CAST(ord AS BIGINT) AS ord, date FROM b_action WHERE list_contains(string_split(classes, ','), 'passage')",
)
def analytics_class_select(t):
    return t("b_action").filter(F.array_contains(F.split("classes", ","), "passage")).select(
        "bill_id", F.col("ord").cast("bigint"), "date"
    )


@query(
    "analytics_project",
    "SELECT bill_id, date AS action_date, description AS action, split_part(classes, ',', 1) AS first_class FROM b_action",
)
def analytics_project(t):
    logs = t("b_action").select(
        F.struct(F.struct("date", "description", F.split("classes", ",").alias("classification")).alias("action"), "bill_id").alias("log")
    )
    return logs.select(
        "log.bill_id",
        F.col("log.action.date").alias("action_date"),
        F.col("log.action.description").alias("action"),
        F.get("log.action.classification", F.lit(0)).alias("first_class"),
    )


@query(
    "analytics_date_range",
    """SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM b_log WHERE path NOT LIKE '%/unknown_%'
  AND strftime(ts, '%Y%m%dT%H%M%SZ') BETWEEN '20240105T000000Z' AND '20240120T235959Z'""",
)
def analytics_date_range(t):
    from billstream.functions.paths import log_stamp

    rows = t("b_log").withColumn("stamp", log_stamp(F.col("path")))
    return rows.filter(F.col("stamp").between("20240105T000000Z", "20240120T235959Z")).select("event_id", "stamp")


@query("repo_select", "SELECT event_id, locale FROM b_log WHERE locale IN (SELECT locale FROM b_jur WHERE country = 'asia')")
def repo_select(t):
    return L.select_repos(t("b_log"), t("b_jur").filter("country = 'asia'")).select("event_id", "locale")


@query(
    "repo_select_missing",
    "SELECT locale || 'x' AS locale FROM b_jur WHERE label = '' UNION ALL SELECT locale FROM b_jur WHERE label <> '' AND locale NOT IN (SELECT locale FROM b_log)",
)
def repo_select_missing(t):
    wanted = t("b_jur").select(
        F.when(F.col("label") == "", F.concat("locale", F.lit("x"))).otherwise(F.col("locale")).alias("locale")
    )
    return L.missing_repos(wanted, t("b_log"))


@query("working_locales", "SELECT locale, name FROM b_jur WHERE label = 'working' ORDER BY locale")
def working_locales(t):
    labelled = t("b_jur").withColumn("labels", F.split("label", ","))
    return labelled.filter(F.array_contains("labels", "working")).orderBy("locale").select("locale", "name")
