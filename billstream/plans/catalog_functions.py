"""Scalar functions over the test tables."""

from pyspark.sql import functions as F

from billstream.functions import entries as E
from billstream.functions import names as N
from billstream.functions import nested, paths as P
from billstream.functions import stamps as S
from billstream.functions import text as X
from billstream.functions.vectors import cosine, mean_pool
from billstream.operators.feed import feed_title
from billstream.plans.registry import query
from billstream.plans.shared import ENTRY_SQL, entries
from billstream.sources.readers import complete_sessions

# ISO strings of every edge form, made from the action dates.
DATES_SQL = """
SELECT bill_id, ord, CASE ord % 6 WHEN 0 THEN date WHEN 1 THEN substring(date, 1, 10) WHEN 2 THEN concat(substring(date, 1, 19), 'Z')
  WHEN 3 THEN NULL WHEN 4 THEN concat(substring(date, 1, 16), '') ELSE concat(substring(date, 1, 5), '13-45') END AS date FROM b_action"""

SLUG_SQL = """substring(trim(regexp_replace(regexp_replace(lower({0}), '[^\\p{{L}}\\p{{N}}_\\s\\p{{Z}}]', '', 'g'), '[\\s\\p{{Z}}]+', '_', 'g'), '_'), 1, 100)"""


def slug_sql(expr: str) -> str:
    return SLUG_SQL.format(expr)


def stamp_sql(expr: str) -> str:
    """Compact stamp of an ISO text in DuckDB."""
    return (
        f"CASE WHEN try_cast(substring({expr}, 1, 10) AS DATE) IS NULL THEN NULL "
        f"WHEN length({expr}) = 10 THEN concat(replace({expr}, '-', ''), 'T000000Z') "
        f"ELSE concat(replace(substring({expr}, 1, 10), '-', ''), 'T', rpad(replace(rtrim(substring({expr}, 12, 8), 'Z'), ':', ''), 6, '0'), 'Z') END"
    )


def _edge_dates(t):
    i = F.col("ord") % 6
    d = F.col("date")
    return t("b_action").select(
        "bill_id",
        "ord",
        F.when(i == 0, d)
        .when(i == 1, F.substring(d, 1, 10))
        .when(i == 2, F.concat(F.substring(d, 1, 19), F.lit("Z")))
        .when(i == 3, F.lit(None))
        .when(i == 4, F.substring(d, 1, 16))
        .otherwise(F.concat(F.substring(d, 1, 5), F.lit("13-45")))
        .alias("date"),
    )


@query("fmt_timestamp", f"SELECT bill_id, CAST(ord AS BIGINT) AS ord, {stamp_sql('date')} AS stamp FROM ({DATES_SQL}) d")
def fmt_timestamp(t):
    return _edge_dates(t).select("bill_id", F.col("ord").cast("bigint"), S.fmt_timestamp(F.col("date")).alias("stamp"))


@query("slugify", f"SELECT doc_id, {slug_sql('text')} AS slug FROM documents")
def slugify(t):
    return t("documents").select("doc_id", X.slugify(F.col("text")).alias("slug"))


@query(
    "clean_event_name",
    "SELECT doc_id, substring(trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}_]+', '_', 'g'), '_'), 1, 40) AS name FROM documents",
)
def clean_event_name(t):
    return t("documents").select("doc_id", X.clean_event_name(F.col("text")).alias("name"))


@query("bill_folder_id", "SELECT identifier, replace(identifier, ' ', '') AS folder FROM b_bill")
def bill_folder_id(t):
    return t("b_bill").select("identifier", P.bill_folder_id(F.col("identifier")).alias("folder"))


@query(
    "build_path",
    "SELECT identifier, 'country:us/state:' || lower(state) || '/sessions/' || session_id || '/bills/' || bill_id AS path FROM b_bill",
)
def build_path(t):
    return t("b_bill").select(
        "identifier", P.build_path(F.col("state"), F.col("session_id"), F.lit("bills"), F.col("bill_id")).alias("path")
    )


@query(
    "org_class",
    """SELECT bill_id, CAST(ord AS BIGINT) AS ord, CASE WHEN ord % 4 = 0 THEN 'unknown' WHEN org LIKE '%upper%' THEN 'upper' ELSE 'lower' END AS chamber FROM b_action""",
)
def org_class(t):
    # Every fourth reference is damaged and must come out as unknown.
    org = F.when(F.col("ord") % 4 == 0, F.concat(F.lit("~{"), F.col("org"))).otherwise(F.col("org"))
    return t("b_action").select("bill_id", F.col("ord").cast("bigint"), N.org_class(org).alias("chamber"))


ACTION_NAME_SQL = f"""coalesce({stamp_sql('date')}, 'unknown') || CASE WHEN split_part(classes, ',', 1) IN ('introduction', 'passage')
  THEN '.classification.' || split_part(classes, ',', 1) || '.' || CASE WHEN org LIKE '%upper%' THEN 'upper' ELSE 'lower' END || '.json'
  ELSE '_' || {slug_sql('description')} || '.json' END"""


@query("action_log_name", f"SELECT bill_id, CAST(ord AS BIGINT) AS ord, {ACTION_NAME_SQL} AS name FROM b_action")
def action_log_name(t):
    return t("b_action").select(
        "bill_id",
        F.col("ord").cast("bigint"),
        N.action_log_name(F.col("date"), F.split("classes", ","), F.col("org"), F.col("description")).alias("name"),
    )


@query(
    "vote_log_name",
    """SELECT vote_id, CASE WHEN vote_id % 9 = 0 THEN 'unknown' ELSE strftime(start_date, '%Y%m%dT%H%M%SZ') END ||
  CASE result WHEN 'pass' THEN '.vote_event.pass.' || CASE WHEN org = '' THEN 'unknown' ELSE 'upper' END || '.json'
  WHEN 'fail' THEN '_vote_event_fail.json' ELSE '_vote_event_not_voting.json' END AS name FROM b_vote""",
)
def vote_log_name(t):
    iso = F.when(F.col("vote_id") % 9 != 0, F.date_format("start_date", "yyyy-MM-dd'T'HH:mm:ss"))
    return t("b_vote").select("vote_id", N.vote_log_name(iso, F.col("result"), F.col("org")).alias("name"))


@query(
    "event_log_name",
    """SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') || '_' || replace(event_type, ' ', '_') || '_hearing_' || user_id || '.json' AS name FROM events""",
)
def event_log_name(t):
    title = F.concat(F.lit(" "), F.initcap("event_type"), F.lit(" hearing, #"), F.col("user_id").cast("string"), F.lit("!"))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return t("events").select("event_id", N.event_log_name(iso, title).alias("name"))


@query(
    "vote_result_enum",
    """SELECT event_id, CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 3 = 0 THEN 'unknown' ELSE 'pass' END END AS result FROM b_log""",
)
def vote_result_enum(t):
    # A third of the votes has a result outside the enum, another third is in capitals.
    word = F.element_at(F.array(*[F.lit(w) for w in ("tie", "PASS", "pass")]), (F.col("event_id") % 3 + 1).cast("int"))
    path = F.replace(F.col("path"), F.lit(".vote_event.pass."), F.concat(F.lit(".vote_event."), word, F.lit(".")))
    return t("b_log").select("event_id", P.vote_result(path).alias("result"))


@query("is_vote_log", "SELECT event_id, path LIKE '%.vote_event.%' AS is_vote FROM b_log")
def is_vote_log(t):
    return t("b_log").select("event_id", P.is_vote_log(F.col("path")).alias("is_vote"))


@query("path_stamp", "SELECT event_id, nullif(regexp_extract(path, '/logs/([^_]+)_', 1), '') AS stamp FROM b_log")
def path_stamp(t):
    return t("b_log").select("event_id", P.path_stamp(F.col("path")).alias("stamp"))


@query(
    "path_stamp_strict",
    "SELECT event_id, nullif(regexp_extract(path, '/logs/([0-9]{8}T[0-9]{6}Z)_', 1), '') AS stamp FROM b_log",
)
def path_stamp_strict(t):
    return t("b_log").select("event_id", P.path_stamp_strict(F.col("path")).alias("stamp"))


@query("path_info", "SELECT event_id, 'us' AS country, locale AS state, '2024' AS session_id FROM b_log")
def path_info(t):
    p = F.col("path")
    return t("b_log").select(
        "event_id",
        P.country_of(p).alias("country"),
        P.state_of(p).alias("state"),
        P.session_of(p).alias("session_id"),
    )


@query("relative_path", "SELECT event_id, path AS relative FROM b_log")
def relative_path(t):
    full = F.replace(F.concat(F.lit("/data/repos/"), F.col("path")), F.lit("/logs/"), F.lit("\\logs\\"))
    return t("b_log").select("event_id", P.relative_path(full, "/data/repos/").alias("relative"))


@query(
    "parse_stamp",
    """SELECT event_id, CASE WHEN path LIKE '%/unknown_%' THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS at FROM b_log""",
)
def parse_stamp(t):
    stamp = F.substring(P.file_name(F.col("path")), 1, 16)
    return t("b_log").select("event_id", F.date_format(S.parse_stamp(stamp), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "parse_mark",
    "SELECT event_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS at FROM events",
)
def parse_mark(t):
    i = F.col("event_id")
    text = (
        F.when(i % 7 == 0, F.lit("soon"))
        .when(i % 2 == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format("ts", "yyyyMMdd'T'HHmmss'Z'"))
    )
    return t("events").select("event_id", F.date_format(S.parse_mark(text), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query(
    "session_folder",
    """SELECT session_id, name, substring(start_date, 1, 4) || '-' || substring(end_date, 1, 4) AS date_folder
  FROM b_session WHERE CAST(session_id AS INT) % 3 <> 0""",
)
def session_folder(t):
    # Every third session lacks its end date and is left out.
    whole = F.col("session_id").cast("int") % 3 != 0
    return complete_sessions(t("b_session").withColumn("end_date", F.when(whole, F.col("end_date"))))


@query(
    "action_key",
    "SELECT bill_id, CAST(ord AS BIGINT) AS ord, description || '|' || CASE WHEN ord % 5 = 0 THEN '' ELSE date END AS key FROM b_action",
)
def action_key(t):
    date = F.when(F.col("ord") % 5 != 0, F.col("date"))
    return t("b_action").select("bill_id", F.col("ord").cast("bigint"), N.action_key(F.col("description"), date).alias("key"))


@query(
    "extract_text",
    f"""SELECT event_id, concat_ws(' ', title, CASE WHEN title IS NOT NULL THEN priority || ' ' || status END,
  CASE WHEN title IS NOT NULL THEN 'About ' || priority || ' short' END, session, chamber, description, bill_id, 'ann ' || event_type) AS text
  FROM ({ENTRY_SQL}) e""",
)
def extract_text(t):
    extra = F.create_map(F.lit("note"), F.col("event_type"), F.lit("author"), F.lit("ann"))
    return entries(t).select("event_id", E.extract_text(F.col("log"), F.col("bill"), extra).alias("text"))


@query(
    "extract_text_json",
    """SELECT event_id, CASE event_id % 6 WHEN 0 THEN concat('Act ', event_id, ' tax ', event_type, ' about it short 2024 Read ', event_type, ' HB', user_id, ' ann')
  WHEN 1 THEN concat('Sent up HB ', user_id, ' Filed ', event_type, ' kept z') WHEN 2 THEN concat('end ', event_type)
  WHEN 3 THEN concat(event_type, '   first last ') WHEN 4 THEN concat('just ', event_type) END AS text FROM b_json""",
)
def extract_text_json(t):
    return t("b_json").select("event_id", E.select_text(F.try_parse_json("body")).alias("text"))


@query("text_hash", "SELECT doc_id, sha256(text) AS text_hash FROM documents")
def text_hash(t):
    return t("documents").select("doc_id", X.text_hash(F.col("text")).alias("text_hash"))


@query(
    "entry_id",
    "SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'entry_' || substring(sha256(text), 1, 8) ELSE 'HB' || doc_id END AS entry_id FROM documents",
)
def entry_id(t):
    ident = F.when(F.col("doc_id") % 3 != 0, F.concat(F.lit("HB"), F.col("doc_id").cast("string")))
    return t("documents").select("doc_id", X.entry_id(ident, F.col("text")).alias("entry_id"))


@query(
    "guid",
    f"SELECT event_id, CASE WHEN event_id % 4 = 0 THEN coalesce(stamp, '') || '_' || bill_id ELSE path END AS guid FROM ({ENTRY_SQL}) e",
)
def guid(t):
    # Every fourth entry has no log source.
    source = F.struct(F.when(F.col("event_id") % 4 != 0, F.col("sources.log")).alias("log"), F.col("sources.bill").alias("bill"))
    return entries(t).select(
        "event_id", E.guid(source, F.col("timestamp"), F.lit(None).cast("string"), F.col("log")).alias("guid")
    )


@query(
    "item_title",
    f"""SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'untagged' WHEN 1 THEN event_type ELSE 'budget, ' || event_type END || ' - ' || repo || ' - ' ||
  coalesce(nullif(trim(title), ''), bill_id) AS item_title FROM ({ENTRY_SQL}) e""",
)
def item_title(t):
    return entries(t).select(
        "event_id",
        E.item_title(F.lit(None).cast("string"), F.col("log"), F.col("bill"), F.col("tags"), F.col("sources")).alias("item_title"),
    )


@query(
    "item_description",
    f"""SELECT event_id, concat_ws(chr(10) || chr(10), 'id: ' || bill_id,
  'log:' || chr(10) || '  action:' || chr(10) || '    description: ' || description || chr(10) || '    date: ' || date ||
    chr(10) || '    classification:' || chr(10) || '      - ' || event_type || chr(10) || '      - routine' ||
    chr(10) || '    organization_id: ' || org || chr(10) || '  bill_id: ' || bill_id,
  'bill:' || chr(10) || '  identifier: ' || identifier || chr(10) || '  title: ' || title || chr(10) || '  legislative_session: ' || session ||
    chr(10) || '  subject:' || chr(10) || '    - ' || priority || chr(10) || '    - ' || status ||
    chr(10) || '  abstract (short): About ' || priority) AS item_description FROM ({ENTRY_SQL}) e""",
)
def item_description(t):
    return entries(t).select(
        "event_id", E.item_description(F.col("id"), F.col("log"), F.col("bill")).alias("item_description")
    )


@query(
    "item_link",
    f"""SELECT event_id, CASE WHEN identifier IS NOT NULL THEN 'https://example.org/data/' || bill_path ELSE 'https://example.org/b/' || bill_id END AS link
  FROM ({ENTRY_SQL}) e""",
)
def item_link(t):
    fallback = F.concat(F.lit("https://example.org/b/"), F.col("log.bill_id"))
    return entries(t).select(
        "event_id", E.item_link(F.col("sources"), fallback, F.lit("https://example.org/data//")).alias("link")
    )


@query(
    "pub_date",
    """SELECT event_id, strftime(ts, '%a, %-d %b %Y %H:%M:%S +0000') AS rss_date, strftime(ts, '%B %d, %Y at %I:%M %p UTC') AS page_date FROM events""",
)
def pub_date(t):
    ts = F.col("ts").cast("timestamp")
    return t("events").select("event_id", S.pub_date_rss(ts).alias("rss_date"), S.pub_date_page(ts).alias("page_date"))


@query(
    "escape_html",
    """SELECT page_id, replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '"', '&quot;'), '''', '&#39;') AS escaped FROM pages""",
)
def escape_html(t):
    return t("pages").select("page_id", X.escape_html(F.col("html")).alias("escaped"))


@query(
    "feed_title",
    """WITH tags AS (SELECT lower(c_mktsegment) AS seg, 'topic_' || lower(c_mktsegment) AS name, 'Activity of ' || lower(c_mktsegment) || ' customers' AS d FROM customer GROUP BY 1)
  SELECT string_agg('Topic ' || upper(substring(seg, 1, 1)) || substring(seg, 2), ' & ' ORDER BY name) || ' Legislation' AS title,
  string_agg('Topic ' || upper(substring(seg, 1, 1)) || substring(seg, 2) || ': ' || d, ' | ' ORDER BY name) AS description FROM tags""",
)
def feed_title_query(t):
    seg = F.lower("c_mktsegment")
    tags = t("customer").select(seg.alias("seg")).distinct().select(
        F.concat(F.lit("topic_"), "seg").alias("name"),
        F.concat(F.lit("Activity of "), "seg", F.lit(" customers")).alias("description"),
    )
    return feed_title(tags)


@query(
    "safe_filename",
    """WITH b AS (SELECT page_id, url, CASE page_id % 3 WHEN 0 THEN 'xml' WHEN 1 THEN 'html' ELSE 'pdf' END AS ext FROM pages),
  n AS (SELECT page_id, ext, CASE WHEN contains(regexp_extract(url, '([^/]*)$', 1), '.') THEN regexp_extract(url, '([^/]*)$', 1) ELSE 'bill_content.' || ext END AS f FROM b),
  m AS (SELECT page_id, ext, CASE WHEN page_id % 4 = 0 THEN f ELSE regexp_extract(f, '^(.*)[.]([^.]*)$', 1) || '_As_passed_v' || page_id % 10 || '.' || regexp_extract(f, '^(.*)[.]([^.]*)$', 2) END AS filename FROM n)
  SELECT page_id, filename, CASE WHEN ends_with(filename, '.' || ext) THEN replace(filename, '.' || ext, '_extracted.txt')
    ELSE regexp_replace(filename, '[.][^.]*$', '') || '_extracted.txt' END AS text_name FROM m""",
)
def safe_filename(t):
    i = F.col("page_id")
    ext = F.when(i % 3 == 0, "xml").when(i % 3 == 1, "html").otherwise("pdf")
    note = F.when(i % 4 != 0, F.concat(F.lit(" As passed -- (v"), (i % 10).cast("string"), F.lit(") ")))
    return (
        t("pages")
        .withColumn("ext", ext)
        .withColumn("filename", X.safe_filename(F.col("url"), note, F.col("ext")))
        .select("page_id", "filename", X.extracted_name(F.col("filename"), F.col("ext")).alias("text_name"))
    )


@query(
    "media_ext",
    "SELECT version_id, CAST(pos AS BIGINT) AS pos, CASE WHEN media_type LIKE '%xml%' THEN 'xml' WHEN media_type LIKE '%html%' THEN 'html' ELSE 'pdf' END AS ext FROM b_link",
)
def media_ext(t):
    return t("b_link").select("version_id", F.col("pos").cast("bigint"), X.media_ext(F.col("media_type")).alias("ext"))


@query(
    "cosine",
    """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e),
  c AS (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2), p AS (SELECT label, list(m ORDER BY i) AS m FROM c GROUP BY 1)
  SELECT vec_id, round(list_dot_product(v, m) / greatest(sqrt(list_dot_product(v, v)) * sqrt(list_dot_product(m, m)), 1e-9), 5) AS similarity
  FROM e JOIN p USING (label)""",
)
def cosine_query(t):
    e = t("embeddings")
    centers = mean_pool(e, "label", "embedding").withColumnRenamed("embedding", "center")
    return e.join(centers, "label").select(
        "vec_id", F.round(cosine(F.col("embedding"), F.col("center")), 5).alias("similarity")
    )


@query(
    "join_list",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN '[object]' WHEN 1 THEN json_extract_string(props, '$.k') || ', ' || event_type || ', true, [object]'
  WHEN 2 THEN event_type ELSE json_extract_string(props, '$.k') END AS readable FROM events""",
)
def join_list(t):
    k = F.get_json_object("props", "$.k")
    quoted = F.concat(F.lit('"'), F.col("event_type"), F.lit('"'))
    i = F.col("event_id") % 4
    doc = (
        F.when(i == 0, F.col("props"))
        .when(i == 1, F.concat(F.lit("["), k, F.lit(","), quoted, F.lit(",true,"), F.col("props"), F.lit("]")))
        .when(i == 2, quoted)
        .otherwise(k)
    )
    return t("events").select("event_id", nested.readable(doc).alias("readable"))
