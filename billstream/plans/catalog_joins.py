"""Joins and set operations."""

from pyspark.sql import functions as F

from billstream.functions.paths import log_stamp
from billstream.operators import bills as B
from billstream.operators import links as K
from billstream.operators import logs as L
from billstream.operators.tagging import Tag, keyword_tags
from billstream.plans.registry import query
from billstream.session import saved

SCORES = "(SELECT bill_id, string_agg(tag || '=' || evidence, ',' ORDER BY tag) AS tags FROM b_tagged GROUP BY 1)"


def tag_scores(t):
    return t("b_tagged").select("bill_id", "tag", F.col("evidence").alias("score"))


def tag_text(column):
    return F.array_join(
        F.transform(F.map_entries(column), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ","
    )


@query(
    "join_log_bill",
    "SELECT l.event_id, l.bill_id, b.title, b.session_id FROM b_log l LEFT JOIN (SELECT * FROM b_bill WHERE status <> 'P') b ON l.bill_id = b.bill_id",
)
def join_log_bill(t):
    bills = t("b_bill").filter("status <> 'P'").select("bill_id", "title", "session_id")
    return L.join_bill(t("b_log"), bills, ["bill_id"]).select("event_id", "bill_id", "title", "session_id")


@query("join_log_tags", f"SELECT l.event_id, l.bill_id, g.tags FROM b_log l LEFT JOIN {SCORES} g USING (bill_id)")
def join_log_tags(t):
    return L.join_tags(t("b_log"), tag_scores(t), ["bill_id"]).select("event_id", "bill_id", tag_text(F.col("tags")).alias("tags"))


@query(
    "join_multi",
    f"SELECT l.event_id, l.bill_id, b.title, g.tags FROM b_log l LEFT JOIN b_bill b ON l.bill_id = b.bill_id LEFT JOIN {SCORES} g ON l.bill_id = g.bill_id",
)
def join_multi(t):
    bills = t("b_bill").select("bill_id", "title")
    joined = L.join_multi(t("b_log"), "bill, people,tags", bills, tag_scores(t), ["bill_id"], ["bill_id"])
    return joined.select("event_id", "bill_id", "title", tag_text(F.col("tags")).alias("tags"))


LINK_SQL = """SELECT event_id, pos, bill_id, session_id FROM (SELECT a.event_id, CAST(a.pos AS BIGINT) AS pos, s.bill_id, s.session_id,
  row_number() OVER (PARTITION BY a.event_id ORDER BY a.pos) AS rn FROM b_agenda a JOIN b_billsession s ON replace(a.name, ' ', '') = s.bill_id
  WHERE a.entity_type = 'bill' {where}) x WHERE rn = 1"""


@query("link_event_bill", LINK_SQL.format(where=""))
def link_event_bill(t):
    linked = K.link_events(t("b_agenda"), t("b_billsession"))
    return linked.select("event_id", F.col("pos").cast("bigint"), "bill_id", "session_id")


@query(
    "event_pending",
    """SELECT DISTINCT event_id FROM b_agenda WHERE entity_type = 'bill' AND event_id NOT IN (
  SELECT a.event_id FROM b_agenda a JOIN b_billsession s ON replace(a.name, ' ', '') = s.bill_id WHERE a.entity_type = 'bill' AND s.session_id = '1999' AND s.bill_id LIKE '%77')""",
)
def event_pending(t):
    few = t("b_billsession").filter("session_id = '1999' and bill_id like '%77'")
    agenda = t("b_agenda")
    return K.pending_events(agenda, K.link_events(agenda, few))


@query(
    "relink_second_pass",
    """WITH a AS (SELECT event_id, pos, replace(name, ' ', '') AS bill_id FROM b_agenda WHERE entity_type = 'bill'),
  one AS (SELECT event_id, min(pos) AS pos FROM a JOIN b_billsession s USING (bill_id) WHERE s.session_id = '1999' AND bill_id LIKE '%7' GROUP BY 1),
  two AS (SELECT event_id, min(pos) AS pos FROM a JOIN b_billsession s USING (bill_id) WHERE event_id NOT IN (SELECT event_id FROM one) GROUP BY 1)
  SELECT event_id, CAST(pos AS BIGINT) AS pos, 1 AS pass FROM one UNION ALL SELECT event_id, CAST(pos AS BIGINT), 2 FROM two""",
)
def relink_second_pass(t):
    agenda, full = t("b_agenda"), t("b_billsession")
    some = full.filter("session_id = '1999' and bill_id like '%7'")
    first, rest = map(saved, K.pending_after_run(agenda.limit(0), agenda, some))
    second, _ = K.pending_after_run(rest, agenda.limit(0), full)
    both = first.withColumn("pass", F.lit(1)).unionByName(second.withColumn("pass", F.lit(2)))
    return both.select("event_id", F.col("pos").cast("bigint"), F.col("pass").cast("bigint").alias("pass"))


@query("vote_placeholder", "SELECT DISTINCT bill_id FROM b_vote WHERE bill_id NOT IN (SELECT bill_id FROM b_bill)")
def vote_placeholder(t):
    return K.placeholders(t("b_vote"), t("b_bill"))


ALL_SQL = "(SELECT DISTINCT bill_id FROM b_vote)"


@query("orphans", f"SELECT bill_id FROM {ALL_SQL} p ANTI JOIN b_bill USING (bill_id)")
def orphans(t):
    known = t("b_vote").select("bill_id").distinct()
    return known.join(t("b_bill").select("bill_id"), "bill_id", "left_anti")


@query("resolved_orphans", f"SELECT bill_id FROM {ALL_SQL} p SEMI JOIN b_bill USING (bill_id)")
def resolved_orphans(t):
    return K.resolved_placeholders(t("b_vote").select("bill_id").distinct(), t("b_bill"))


@query("session_enrich", "SELECT bill_id, session_id, name, date_folder FROM b_billsession")
def session_enrich(t):
    return K.bill_session_map(t("b_bill"), t("b_session")).select("bill_id", "session_id", "name", "date_folder")


# Two versions of the actions: the stored one has the early ordinals; the incoming one
# has all but the first ordinal, and a changed text in every fifth place.
STORED = "(SELECT bill_id, ord, description, date, 's' || ord AS created FROM b_action WHERE ord <= 3)"
INCOMING = "(SELECT bill_id, ord, CASE WHEN ord % 5 = 2 THEN description || ' (amended)' ELSE description END AS description, date FROM b_action WHERE ord > 1)"


def stored_actions(t):
    a = t("b_action").filter("ord <= 3")
    return a.select("bill_id", "ord", "description", "date", F.concat(F.lit("s"), F.col("ord").cast("string")).alias("created"))


def incoming_actions(t):
    text = F.when(F.col("ord") % 5 == 2, F.concat("description", F.lit(" (amended)"))).otherwise(F.col("description"))
    return t("b_action").filter("ord > 1").select("bill_id", "ord", text.alias("description"), "date")


@query(
    "new_actions",
    f"SELECT i.bill_id, CAST(i.ord AS BIGINT) AS ord, i.description, i.date FROM {INCOMING} i ANTI JOIN {STORED} s USING (bill_id, description, date)",
)
def new_actions(t):
    return B.new_actions(stored_actions(t), incoming_actions(t)).select(
        "bill_id", F.col("ord").cast("bigint"), "description", "date"
    )


@query(
    "merge_actions",
    f"""WITH s AS (SELECT bill_id, description, date, arg_max(created, ord) AS created FROM {STORED} x GROUP BY 1, 2, 3)
  SELECT i.bill_id, CAST(i.ord AS BIGINT) AS ord, i.description, i.date, s.created, s.created IS NULL AS is_new FROM {INCOMING} i LEFT JOIN s USING (bill_id, description, date)""",
)
def merge_actions(t):
    merged = B.merge_actions(stored_actions(t), incoming_actions(t), ["created"])
    return merged.select("bill_id", F.col("ord").cast("bigint"), "description", "date", "created", "is_new")


@query(
    "ownership_merge",
    """WITH s AS (SELECT o_orderkey AS bill_key, o_orderstatus AS status, 'scraper' AS text_stamp FROM orders WHERE o_orderkey % 10 < 7),
  x AS (SELECT o_orderkey AS bill_key, 'stale' AS status, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'text' END AS text_stamp FROM orders WHERE o_orderkey % 10 > 4)
  SELECT bill_key, coalesce(s.status, x.status) AS status, coalesce(x.text_stamp, s.text_stamp) AS text_stamp FROM s FULL JOIN x USING (bill_key)""",
)
def ownership_merge(t):
    o = t("orders").select(F.col("o_orderkey").alias("bill_key"), F.col("o_orderstatus").alias("status"))
    k = F.col("bill_key")
    scraped = o.filter(k % 10 < 7).withColumn("text_stamp", F.lit("scraper"))
    extracted = o.filter(k % 10 > 4).select("bill_key", F.lit("stale").alias("status"), F.when(k % 3 != 0, "text").alias("text_stamp"))
    return B.ownership_merge(scraped, extracted, ["bill_key"], ["status"], ["text_stamp"])


@query(
    "tag_match_join",
    """WITH tags AS (SELECT * FROM (VALUES ('health', 'then'), ('water', 'the'), ('road', 'que')) v(tag, kw))
  SELECT doc_id, tag FROM documents, tags WHERE regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}_])' || kw || '($|[^\\p{L}\\p{N}_])')""",
)
def tag_match_join(t):
    tags = [Tag(n, include_keywords=[k]) for n, k in (("health", "then"), ("water", "the"), ("road", "que"))]
    return keyword_tags(t("documents"), "text", tags).select("doc_id", "tag")




def bills_of(t, *rests):
    """All bills whose number leaves one of the rests by 3: two overlapping halves of the table."""
    return t("b_bill").filter((F.substring("bill_id", 3, 20).cast("bigint") % 3).isin(*rests)).select("bill_id")


OLD_SQL = "(SELECT bill_id FROM b_bill WHERE CAST(substring(bill_id, 3, 20) AS BIGINT) % 3 IN (0, 1))"
NEW_SQL = "(SELECT bill_id FROM b_bill WHERE CAST(substring(bill_id, 3, 20) AS BIGINT) % 3 IN (1, 2))"


@query(
    "reconcile_sets",
    f"""WITH e AS (SELECT bill_id, 1 AS e FROM {OLD_SQL} x), a AS (SELECT bill_id, 1 AS a FROM {NEW_SQL} y)
  SELECT bill_id, CASE WHEN a IS NULL THEN 'create' WHEN e IS NULL THEN 'delete' ELSE 'update' END AS verb FROM e FULL JOIN a USING (bill_id)""",
)
def reconcile_sets(t):
    return B.reconcile(bills_of(t, 0, 1), bills_of(t, 1, 2), "bill_id")


@query("set_create", f"{OLD_SQL} EXCEPT {NEW_SQL}")
def set_create(t):
    return bills_of(t, 0, 1).subtract(bills_of(t, 1, 2))


@query("set_delete", f"{NEW_SQL} EXCEPT {OLD_SQL}")
def set_delete(t):
    return bills_of(t, 1, 2).subtract(bills_of(t, 0, 1))


@query("set_update", f"{OLD_SQL} INTERSECT {NEW_SQL}")
def set_update(t):
    return bills_of(t, 0, 1).intersect(bills_of(t, 1, 2))


@query(
    "union_logs",
    """SELECT bill_id, 'action' AS kind, description, NULL AS result FROM b_action UNION ALL SELECT bill_id, 'vote', NULL, result FROM b_vote""",
)
def union_logs(t):
    actions = t("b_action").select("bill_id", F.lit("action").alias("kind"), "description")
    votes = t("b_vote").select("bill_id", F.lit("vote").alias("kind"), "result")
    return actions.unionByName(votes, allowMissingColumns=True)


@query("union_repos", "SELECT repo, event_id, CASE WHEN path LIKE '%/unknown_%' THEN NULL ELSE strftime(ts, '%Y%m%dT%H%M%SZ') END AS stamp FROM b_log")
def union_repos(t):
    # All repositories are partitions of one table, so their union is one scan.
    return L.select_repos(t("b_log"), "all").select("repo", "event_id", log_stamp(F.col("path")).alias("stamp"))
