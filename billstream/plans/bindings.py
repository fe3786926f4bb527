"""Views that let the operators run on the test tables.

One SQL text serves both engines. ``@name@`` stands for a base table and
``@STAMP(x)@`` for the compact UTC stamp of a timestamp.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from billstream.session import apply_settings

BASE = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

VIEWS: dict[str, str] = {
    "b_jur": """
SELECT concat('n', lpad(CAST(n_nationkey AS STRING), 2, '0')) AS locale, lower(r_name) AS country, n_name AS name,
  CASE WHEN n_nationkey % 5 = 0 THEN '' ELSE 'working' END AS label
FROM @nation@ JOIN @region@ ON n_regionkey = r_regionkey""",
    "b_session": """
SELECT DISTINCT CAST(year(o_orderdate) AS STRING) AS session_id,
  concat('Session ', CAST(year(o_orderdate) AS STRING)) AS name,
  concat(CAST(year(o_orderdate) AS STRING), '-01-01') AS start_date,
  concat(CAST(year(o_orderdate) + 1 AS STRING), '-12-31') AS end_date
FROM @orders@ WHERE year(o_orderdate) % 4 <> 0""",
    "b_bill": """
SELECT concat('n', lpad(CAST(c_nationkey AS STRING), 2, '0')) AS state, CAST(year(o_orderdate) AS STRING) AS session_id,
  concat('HB ', CAST(o_orderkey AS STRING)) AS identifier, concat('HB', CAST(o_orderkey AS STRING)) AS bill_id,
  CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE concat('An act on ', lower(c_mktsegment), ' no ', CAST(o_orderkey AS STRING)) END AS title,
  o_orderpriority AS classification, o_orderstatus AS status, o_orderdate AS introduced
FROM @orders@ JOIN @customer@ ON o_custkey = c_custkey""",
    "b_action": """
SELECT concat('HB', CAST(l_orderkey AS STRING)) AS bill_id,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_shipdate, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax) AS ord,
  concat(CAST(CAST(l_shipdate AS DATE) AS STRING), 'T', lpad(CAST(l_linenumber AS STRING), 2, '0'), ':00:00+05:00') AS date,
  CASE l_returnflag WHEN 'R' THEN concat('Referred to Committee on Panel-', CAST(l_suppkey % 7 AS STRING)) WHEN 'A' THEN 'Read second time.' ELSE concat('Floor vote, roll ', CAST(l_partkey % 50 AS STRING)) END AS description,
  CASE l_returnflag WHEN 'R' THEN 'introduction,referral-committee' WHEN 'A' THEN 'reading-2' ELSE CASE l_linestatus WHEN 'O' THEN 'passage' ELSE 'filing' END END AS classes,
  CASE l_linestatus WHEN 'O' THEN '~{"classification": "upper"}' ELSE '~{"classification": "lower"}' END AS org
FROM @lineitem@""",
    "b_log": """
SELECT event_id, locale, repo, bill_id, event_type, ts,
  concat(repo, '/country:us/state:', locale, '/sessions/2024/bills/', bill_id, '/logs/', name) AS path FROM (
  SELECT event_id, event_type, ts, concat('HB', CAST(user_id AS STRING)) AS bill_id,
    concat('n', lpad(CAST(user_id % 25 AS STRING), 2, '0')) AS locale,
    concat('n', lpad(CAST(user_id % 25 AS STRING), 2, '0'), '-legislation') AS repo,
    CASE event_type WHEN 'purchase' THEN concat(@STAMP(ts)@, '.vote_event.pass.upper.json') WHEN 'error' THEN concat(@STAMP(ts)@, '_vote_event_fail.json')
      WHEN 'signup' THEN concat(@STAMP(ts)@, '.classification.introduction.lower.json') WHEN 'click' THEN concat(@STAMP(ts)@, '_read_second_time.json')
      ELSE CASE WHEN event_id % 10 = 0 THEN 'unknown_minutes.json' ELSE concat(@STAMP(ts)@, '_minutes.json') END END AS name
  FROM @events@) e""",
    "b_vote": """
SELECT event_id AS vote_id, concat('HB', CAST(user_id * 211 AS STRING)) AS bill_id, ts AS start_date,
  CASE event_type WHEN 'purchase' THEN 'pass' WHEN 'error' THEN 'fail' ELSE 'Not Voting' END AS result,
  CASE WHEN user_id % 2 = 0 THEN '~{"classification": "upper"}' ELSE '' END AS org
FROM @events@ WHERE event_type <> 'view'""",
    "b_ballot": """
SELECT conv_id AS vote_id, turn AS voter, CASE role WHEN 'user' THEN 'yes' WHEN 'assistant' THEN 'no' ELSE 'excused' END AS opt
FROM @conversations@""",
    "b_doc": """
SELECT event_id, CASE event_type WHEN 'purchase' THEN concat('vote_event_', CAST(event_id AS STRING), '.json') WHEN 'view' THEN concat('event_', CAST(event_id AS STRING), '.json')
  WHEN 'error' THEN concat('organization_', CAST(event_id AS STRING), '.json') ELSE concat('bill_', CAST(event_id AS STRING), '.json') END AS file_name,
  CASE WHEN event_id % 17 = 0 THEN substring(props, 1, 3) ELSE props END AS body,
  CASE WHEN event_id % 13 = 0 THEN '' ELSE concat('org', CAST(user_id AS STRING)) END AS name
FROM @events@""",
    "b_agenda": """
SELECT l_suppkey AS event_id, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity, l_discount, l_tax) AS pos,
  CASE WHEN l_linenumber = 1 THEN 'person' ELSE 'bill' END AS entity_type, concat(' HB ', CAST(l_orderkey AS STRING)) AS name
FROM @lineitem@""",
    "b_tagged": """
SELECT concat('HB', CAST(doc_id AS STRING)) AS bill_id, CASE WHEN toxic = 1 THEN 'flagged' WHEN quality = 1 THEN 'quality' ELSE 'other' END AS tag, max(doc_id) AS evidence
FROM @labels@ GROUP BY 1, 2""",
    "b_link": """
SELECT page_id AS version_id, 0 AS pos, url, 'application/pdf' AS media_type FROM @pages@
UNION ALL SELECT page_id, 1, url, CASE WHEN page_id % 3 = 0 THEN 'text/xml' ELSE 'application/xml' END FROM @pages@
UNION ALL SELECT page_id, 2, CASE WHEN page_id % 4 = 0 THEN '' ELSE url END, 'text/html; charset=utf-8' FROM @pages@""",
    "b_run": """
SELECT concat('repo', CAST(user_id AS STRING)) AS repo, event_id AS run_id, ts AS started_at,
  coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) AS updated_at, event_type AS conclusion
FROM @events@""",
    "b_char": """
SELECT l_orderkey AS page, l_linenumber AS line, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_extendedprice, l_partkey, l_suppkey, l_shipdate, l_quantity, l_discount, l_tax) AS pos,
  l_extendedprice AS x0, l_extendedprice + l_quantity AS x1, substring(l_returnflag, 1, 1) AS ch, CASE WHEN l_suppkey % 9 = 0 THEN 'Times-Strike' ELSE 'Times' END AS font, l_discount AS gray
FROM @lineitem@""",
    "b_extract": """
SELECT o_orderkey AS bill_key, o_orderdate AS logs_update, CASE o_orderstatus WHEN 'F' THEN NULL ELSE l.first_ship END AS text_update,
  CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE 1 END AS files
FROM @orders@ LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship FROM @lineitem@ GROUP BY l_orderkey) l ON l_orderkey = o_orderkey""",
    "b_text": """
SELECT doc_id, concat('HB', CAST(doc_id AS STRING)) AS bill_id, text, lang, source FROM @documents@""",
    "b_billsession": """
SELECT b.bill_id, b.session_id, s.name, concat(substring(s.start_date, 1, 4), '-', substring(s.end_date, 1, 4)) AS date_folder
FROM b_bill b JOIN b_session s ON b.session_id = s.session_id""",
    # Lines of a scrape log: one run per user, one line per event.
    "b_runlog": """
SELECT user_id AS run, event_id AS line, CASE event_type
    WHEN 'purchase' THEN concat('  bill: ', CAST(event_id % 97 AS STRING))
    WHEN 'signup' THEN concat('vote_event:  ', CAST(event_id % 31 AS STRING))
    WHEN 'click' THEN concat(' event: ', CAST(event_id % 13 AS STRING))
    WHEN 'error' THEN CASE WHEN user_id % 3 = 0 AND event_id % 4 = 0 THEN 'Traceback (most recent call last):'
      WHEN user_id % 3 <> 2 AND event_id % 4 = 1 THEN concat('ValueError: bad row ', CAST(event_id AS STRING))
      WHEN event_id % 4 = 2 THEN concat('ERROR scrape of page ', CAST(event_id AS STRING))
      ELSE 'HTTPError: retrying' END
    ELSE CASE WHEN event_id % 50 = 0 THEN concat('duration:  0:', lpad(CAST(event_id % 60 AS STRING), 2, '0'), ':07')
      WHEN event_id % 50 = 1 THEN 'jurisdiction: 1' WHEN event_id % 50 = 2 THEN 'organization: 3'
      ELSE '04:05:06 INFO scrape: ERROR free' END END AS content
FROM @events@""",
    # Open JSON of several shapes, one of them as deep as the row number says, one damaged.
    "b_json": """
SELECT event_id, event_type, user_id, CASE event_id % 6
    WHEN 0 THEN concat('{"id":"e","bill":{"title":"Act ', CAST(event_id AS STRING), '","subject":["tax",["', event_type, '"]],"abstracts":[{"note":"short","abstract":"about it","_at":"x"}],"legislative_session":"2024","from_organization":7},"log":{"action":{"description":"Read ', event_type, '","date":"d"},"bill_id":"HB', CAST(user_id AS STRING), '"},"note":{"by":{"name":"ann"},"title":"hidden"}}')
    WHEN 1 THEN concat('{"action":"Filed ', event_type, '","log":{"action":"Sent up","bill_identifier":"HB ', CAST(user_id AS STRING), '"},"zeta":["z"],"alpha":{"subject":["kept"]},"_x":"no","timestamp":"t","count":3}')
    WHEN 2 THEN concat(repeat('{"next":[', CAST(event_id % 40 AS INT)), '"end ', event_type, '"', repeat(']}', CAST(event_id % 40 AS INT)))
    WHEN 3 THEN concat('["', event_type, '",1,null,{"z":"last","b":"first"},[]]')
    WHEN 4 THEN concat('"just ', event_type, '"')
    ELSE '{"bill":' END AS body
FROM @events@""",
    # Records of five types; three of four have faults, some are no JSON.
    "b_record": """
SELECT event_id, kind, v, CASE WHEN event_id % 97 = 0 THEN substring(body, 1, 20) ELSE body END AS body FROM (
SELECT event_id, v, 'vote_event' AS kind, CASE v WHEN 1 THEN replace(b, '"bill":"b",', '') WHEN 2 THEN replace(replace(b, '"pass"', '"Passed"'), '2025-01-22T15:00:00+00:00', '2025-01-22') WHEN 3 THEN replace(b, '"value":3', '"value":-3,"extra":1') ELSE b END AS body
  FROM (SELECT event_id, CAST(floor(event_id / 5) AS BIGINT) % 4 AS v, '{"motion_text":"m","start_date":"2025-01-22T15:00:00+00:00","result":"pass","organization":null,"legislative_session":"2025","bill":"b","bill_identifier":"HB1","votes":[{"option":"yes","voter_name":"A","voter_id":"","note":""}],"counts":[{"option":"yes","value":3}],"sources":[{"url":"https://x.gov/a"}],"extras":{},"_id":"e1"}' AS b FROM @events@ WHERE event_id % 5 = 0) e
UNION ALL SELECT event_id, v, 'organization', CASE v WHEN 1 THEN replace(b, '"parent_id":null,', '') WHEN 2 THEN replace(b, '"upper"', '"chamber"') WHEN 3 THEN replace(b, '[{}]', '{}') ELSE b END
  FROM (SELECT event_id, CAST(floor(event_id / 5) AS BIGINT) % 4 AS v, '{"_id":"o","name":"n","classification":"upper","parent_id":null,"links":[{}],"sources":[],"extras":{}}' AS b FROM @events@ WHERE event_id % 5 = 1) e
UNION ALL SELECT event_id, v, 'jurisdiction', CASE v WHEN 1 THEN replace(b, ',"end_date":"2025-12-31"', '') WHEN 2 THEN replace(replace(b, '2025-01-01', '2025-02-30'), 'https://x.gov', 'x gov') WHEN 3 THEN replace(b, '"primary"', '7') ELSE b END
  FROM (SELECT event_id, CAST(floor(event_id / 5) AS BIGINT) % 4 AS v, '{"_id":"j","id":"j","name":"n","url":"https://x.gov","division_id":"d","classification":"state","legislative_sessions":[{"_scraped_name":"s","classification":"primary","identifier":"1","name":"One","start_date":"2025-01-01","end_date":"2025-12-31"}],"extras":{}}' AS b FROM @events@ WHERE event_id % 5 = 2) e
UNION ALL SELECT event_id, v, 'bill', CASE v WHEN 1 THEN replace(b, '"title":"t",', '') WHEN 2 THEN replace(b, '["bill"]', '[1]') WHEN 3 THEN replace(b, '"_id":"b"', '"_id":"b","more":1') ELSE b END
  FROM (SELECT event_id, CAST(floor(event_id / 5) AS BIGINT) % 4 AS v, '{"legislative_session":"2025","identifier":"HB1","title":"t","classification":["bill"],"jurisdiction":{},"scraped_at":"2025-01-22T15:00:00Z","_id":"b"}' AS b FROM @events@ WHERE event_id % 5 = 3) e
UNION ALL SELECT event_id, v, 'action_log', CASE v WHEN 1 THEN replace(b, ',"bill_id":"HB1"', '') WHEN 2 THEN replace(b, '2025-01-22T15:00:00Z', 'soon') WHEN 3 THEN replace(b, '"related_entities":[]', '"related_entities":[],"z":0') ELSE b END
  FROM (SELECT event_id, CAST(floor(event_id / 5) AS BIGINT) % 4 AS v, '{"action":{"description":"d","date":"2025-01-22T15:00:00Z","organization_id":"o","classification":[],"related_entities":[]},"bill_id":"HB1"}' AS b FROM @events@ WHERE event_id % 5 = 4) e) x""",
    # Routine-filter input: real locales and real phrases spread over the action rows.
    "b_routine": """
SELECT l_orderkey * 10 + l_linenumber AS action_no,
  CASE l_suppkey % 11 WHEN 8 THEN 'wy' WHEN 9 THEN 'wv' WHEN 10 THEN 'nv' WHEN 0 THEN 'ak' WHEN 1 THEN 'al' WHEN 2 THEN 'ca' WHEN 3 THEN 'de' WHEN 4 THEN 'fl' WHEN 5 THEN 'hi' WHEN 6 THEN 'az' ELSE 'zz' END AS locale,
  CASE l_returnflag WHEN 'R' THEN 'introduction,referral-committee' WHEN 'A' THEN 'reading-2' ELSE CASE l_linestatus WHEN 'O' THEN 'passage' ELSE 'filing' END END AS classes,
  CASE l_partkey % 18 WHEN 12 THEN 'Bill Number Assigned' WHEN 13 THEN 'To House Judiciary' WHEN 14 THEN 'To Governor' WHEN 15 THEN 'Prefiled. Referred to Committee on Rules' WHEN 16 THEN 'Taken from General File. Placed on General File for later' WHEN 17 THEN 'H Placed on General File' WHEN 0 THEN '(H) EDC, FIN' WHEN 1 THEN '(H) EDC, FIN and other panels' WHEN 2 THEN 'Filed' WHEN 3 THEN 'June 4 set for first hearing'
    WHEN 4 THEN 'Referred to Rules' WHEN 5 THEN 'Assigned to Health Committee' WHEN 6 THEN 'Assigned to nobody' WHEN 7 THEN 'Notice of a hearing'
    WHEN 8 THEN 'FN 2: ZERO(DPS)' WHEN 9 THEN 'Added to House agenda' WHEN 10 THEN 'Set for hearing May 2' ELSE 'Passed the House' END AS description
FROM @lineitem@""",
}

_REF = re.compile(r"\bb_[a-z]+\b")


def view_closure(sql: str) -> list[str]:
    """Names of the views a text needs, dependencies first."""
    ordered: list[str] = []

    def visit(text: str) -> None:
        for name in dict.fromkeys(_REF.findall(text)):
            if name in VIEWS and name not in ordered:
                visit(VIEWS[name])
                ordered.append(name)

    visit(sql)
    return ordered


def _render(sql: str, stamp: str, table) -> str:
    sql = re.sub(r"@STAMP\(([^)]*)\)@", lambda m: stamp.format(m.group(1)), sql)
    return re.sub(r"@([a-z]+)@", lambda m: table(m.group(1)), sql)


def duckdb_sql(sql: str) -> str:
    """The text with the views it uses as common table expressions."""
    names = view_closure(sql)
    head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in names)
    body = sql.strip()
    if names:
        body = f"WITH {head}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {head} {body}"
    return _render(body, "strftime({}, '%Y%m%dT%H%M%SZ')", str)


class Tables:
    """``t("events")`` or ``t("b_log")`` as DataFrames over one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = apply_settings(spark)
        self.folder = folder.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.folder}/{name}.parquet"

    def __call__(self, name: str) -> DataFrame:
        if name in VIEWS:
            sql = VIEWS[name]
            head = ", ".join(f"{n} AS ({VIEWS[n]})" for n in view_closure(sql))
            text = f"WITH {head} {sql}" if head else sql
            return self.spark.sql(
                _render(text, "date_format({}, \"yyyyMMdd'T'HHmmss'Z'\")", lambda n: f"parquet.`{self.path(n)}`")
            )
        return self.spark.read.parquet(self.path(name))
