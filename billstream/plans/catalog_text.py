"""Document jobs: mark-up, structure, struck text, extraction."""

from pyspark.sql import functions as F

from billstream.functions.text import escape_html, html_title, html_to_text
from billstream.operators import documents as D
from billstream.plans.registry import query

SPACE = "[\\s\\p{Z}]"


def _nested(expr: str, steps: list[tuple[str, str]]) -> str:
    for pattern, to in steps:
        expr = f"regexp_replace({expr}, '{pattern}', '{to}', 'g')"
    return expr


def _replaced(expr: str, pairs: list[tuple[str, str]]) -> str:
    for a, b in pairs:
        expr = f"replace({expr}, '{a}', '{b}')"
    return expr


ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&copy;", "©"), ("&middot;", "·"), ("&sect;", "§"), ("&mdash;", "—"), ("&#8217;", "’"), ("&#x2014;", "—"), ("&eacute;", "é"), ("&amp;", "&")]
#: Added to every page: named and numeric entities, an unknown one, and one that is escaped twice.
MORE_ENTITIES = "<p>&sect;&mdash;&#8217;&#x2014;&eacute;&nosuch;&amp;lt;&amp;sect;</p>"
MORE_PAGE = f"(html || '{MORE_ENTITIES}')"


def _html_sql(html: str) -> str:
    return _nested(
        _replaced(
            _nested(
                html,
                [
                    ("(?is)<script\\b.*?</script\\s*>", ""),
                    ("(?is)<style\\b.*?</style\\s*>", ""),
                    ("(?s)<!--.*?-->", ""),
                    ("(?s)<[!/?a-zA-Z][^>]*>", ""),
                ],
            ),
            ENTITIES,
        ),
        [
            (SPACE + "*[\\r\\n\\x0b\\x0c]" + SPACE + "*|  " + SPACE + "*", " "),
            ("^" + SPACE + "+|" + SPACE + "+$", ""),
        ],
    )


HTML_SQL = _html_sql("html")
TITLE_SQL = _replaced("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)", ENTITIES)


@query("html_to_text", f"SELECT page_id, {TITLE_SQL} AS title, {_html_sql(MORE_PAGE)} AS raw_text FROM pages")
def html_to_text_query(t):
    html = F.concat("html", F.lit(MORE_ENTITIES))
    return t("pages").select("page_id", html_title(html).alias("title"), html_to_text(html).alias("raw_text"))


def bill_xml(t):
    """Bill XML made of the whole documents; every tenth is damaged."""
    text = F.regexp_replace("text", "[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\r\\ufffe\\uffff]", " ")
    body = F.concat(
        F.lit("<bill><title> T"), F.col("doc_id").cast("string"), F.lit(" </title><official-title>Act</official-title><section>"),
        escape_html(text), F.lit("</section><section> </section><section><b>End</b> of it</section>"),
        F.when(F.col("doc_id") % 10 == 0, F.lit("</bil>")).otherwise(F.lit("</bill>")),
    )
    return t("documents").select("doc_id", body.alias("xml"), text.alias("clean"))


@query(
    "xml_bill_text",
    """SELECT doc_id, CASE WHEN doc_id % 10 <> 0 THEN 'T' || doc_id END AS title, CASE WHEN doc_id % 10 <> 0 THEN 'Act' END AS official_title,
  CASE WHEN doc_id % 10 <> 0 THEN 'End of it' END AS last_section, doc_id % 10 = 0 AS failed FROM documents""",
)
def xml_bill_text(t):
    parsed = bill_xml(t).withColumn("x", D.xml_bill_text(F.col("xml")))
    return parsed.select(
        "doc_id",
        "x.title",
        "x.official_title",
        F.element_at("x.sections", -1).alias("last_section"),
        F.col("x.error").isNotNull().alias("failed"),
    )


CLEAN_SQL = "regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\r\\x{fffe}\\x{ffff}]', ' ', 'g')"


@query(
    "xml_bill_parts",
    f"""WITH c AS (SELECT doc_id, {CLEAN_SQL} AS clean, doc_id % 10 IN (0, 7) AS failed, CASE WHEN doc_id % 10 = 5 THEN ' by the house' ELSE '' END AS who FROM documents)
  SELECT doc_id, failed, CASE WHEN NOT failed THEN array_to_string(list_filter([trim(clean, '{D.BLANKS}'), 'End of it' || who || ' tail'], lambda x: x <> ''), '@@') END AS sections,
  CASE WHEN NOT failed THEN trim(' T' || doc_id || ' Act' || clean || ' End of it' || who || ' tail', '{D.BLANKS}') END AS raw_text FROM c""",
)
def xml_bill_parts(t):
    # Every way of writing the same bill: a document type, CDATA with tags in comments, an own entity; two kinds are damaged.
    kind = F.col("doc_id") % 10
    made = bill_xml(t).select("doc_id", F.regexp_replace("xml", "</bil>|</bill>", "").alias("xml"), "clean")
    made = made.withColumn("xml", F.when(kind == 3, F.concat(F.substring_index("xml", "<section>", 1), F.lit("<section><![CDATA["), "clean", F.lit("]]><!-- <section>no</section> --></section><section> </section><section><b>End</b> of it</section>"))).otherwise(F.col("xml")))
    made = made.withColumn("xml", F.when(kind == 5, F.replace("xml", F.lit("</b> of it"), F.lit("</b> of it by &who;"))).otherwise(F.col("xml")))
    head = F.when(kind == 5, "<!DOCTYPE bill [<!ENTITY who 'the house'>]>").when(kind % 4 == 3, "<!DOCTYPE bill>").otherwise("")
    end = F.when(kind == 0, "</bil>").when(kind == 7, "</bill><junk").otherwise("</bill>")
    whole = F.concat(head, F.col("xml"), F.lit(" tail"), end)
    parsed = made.select("doc_id", D.xml_bill_text(whole).alias("x"))
    return parsed.select("doc_id", F.col("x.error").isNotNull().alias("failed"), F.array_join("x.sections", "@@").alias("sections"), "x.raw_text")


# Structure of whole texts: trimmed lines, the title line taken out, a running section number.
BLANKS_SQL = D.BLANKS
STRUCTURE_CTE = """l AS (SELECT doc_id, i, line FROM (SELECT doc_id, generate_subscripts(string_split(text, chr(10)), 1) AS i,
    trim(unnest(string_split(text, chr(10))), '{BLANKS_SQL}') AS line FROM documents) x WHERE line <> ''),
  tl AS (SELECT doc_id, min(i) AS i FROM l WHERE contains(upper(line), 'AN ACT') OR contains(upper(line), 'BILL') OR length(line) > 50 GROUP BY 1),
  t AS (SELECT l.doc_id, line AS title FROM l JOIN tl USING (doc_id, i)),
  b AS (SELECT l.doc_id, l.i, l.line, sum(CASE WHEN regexp_matches(line, '(?i)^(section|§|\\d+\\.)') THEN 1 ELSE 0 END) OVER (PARTITION BY l.doc_id ORDER BY l.i) AS sec
    FROM l LEFT JOIN tl ON tl.doc_id = l.doc_id AND tl.i = l.i WHERE tl.i IS NULL),
  s AS (SELECT doc_id, sec, string_agg(line, chr(10) ORDER BY i) AS section FROM b GROUP BY 1, 2),
  d AS (SELECT doc_id, count(*) AS n, string_agg(section, '@@' ORDER BY sec) AS joined FROM s GROUP BY 1),
  z AS (SELECT doc_id, text, coalesce(title, 'PDF Document') AS title, coalesce(title, '') AS official_title, coalesce(n, 1) AS n_sections, coalesce(joined, text) AS sections
    FROM documents LEFT JOIN t USING (doc_id) LEFT JOIN d USING (doc_id))""".replace("{BLANKS_SQL}", BLANKS_SQL)


@query("pdf_lines_structure", f"WITH {STRUCTURE_CTE} SELECT doc_id, title, official_title, n_sections, sections FROM z")
def pdf_lines_structure(t):
    return D.line_structure(t("documents"), "text").select(
        "doc_id",
        "title",
        "official_title",
        F.size("sections").cast("bigint").alias("n_sections"),
        F.array_join("sections", "@@").alias("sections"),
    )


@query(
    "section_split",
    f"""WITH {STRUCTURE_CTE} SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY sec) AS BIGINT) AS section_no, section FROM s
  UNION ALL SELECT doc_id, 1, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM s)""",
)
def section_split(t):
    return D.section_rows(t("documents"), "text").select("doc_id", "section_no", "section")


FLAG_SQL = """f AS (SELECT page, line, pos, x0, ch, font LIKE '%Strike%' OR coalesce(a > 2 OR b > 2, FALSE) AND a IS NOT NULL AND b IS NOT NULL OR gray < 0.03 AS struck FROM (
  SELECT *, x0 - lag(x1) OVER w AS a, lead(x0) OVER w - x1 AS b FROM b_char WINDOW w AS (PARTITION BY page, line ORDER BY x0, pos)) x)"""


def chars(t):
    # Discounts reach 0.1; scaled so that the gray bound of 0.8 splits them.
    return t("b_char").withColumn("gray", F.when(F.col("gray") < 0.03, F.lit(0.5)).otherwise(F.lit(0.9)))


@query("strike_flags", f"WITH {FLAG_SQL} SELECT page, CAST(line AS BIGINT) AS line, CAST(pos AS BIGINT) AS pos, struck FROM f")
def strike_flags(t):
    return D.strike_flags(chars(t)).select("page", F.col("line").cast("bigint"), F.col("pos").cast("bigint"), "struck")


@query(
    "strike_text",
    f"WITH {FLAG_SQL} SELECT page, '[DELETED: ' || string_agg(ch, '' ORDER BY line, x0, pos) || ']' AS struck_text FROM f WHERE struck GROUP BY 1",
)
def strike_text(t):
    return D.strike_text(chars(t))


@query(
    "struck_documents",
    f"""WITH {FLAG_SQL}, g AS (SELECT *, CAST(floor(page / 8) AS BIGINT) AS doc, struck AND NOT coalesce(lag(struck) OVER (PARTITION BY page, line ORDER BY x0, pos), FALSE) AS begins FROM f),
  n AS (SELECT doc, page, line, string_agg(ch, '' ORDER BY x0, pos) AS text FROM g GROUP BY ALL), p AS (SELECT doc, page, string_agg(text, chr(10) ORDER BY line) AS text FROM n GROUP BY ALL),
  s AS (SELECT doc, page, '[DELETED: ' || string_agg(ch, '' ORDER BY line, x0, pos) || ']' AS cut FROM g WHERE struck GROUP BY ALL),
  r AS (SELECT doc, count(*) FILTER (begins) AS n_runs, count(*) FILTER (struck) AS n_struck FROM g GROUP BY 1),
  w AS (SELECT doc, string_agg(text, chr(10) || chr(10) ORDER BY page) AS text FROM p GROUP BY 1), x AS (SELECT doc, string_agg(cut, chr(10) ORDER BY page) AS cuts, count(*) AS struck_pages FROM s GROUP BY 1)
  SELECT doc, text || coalesce(chr(10) || chr(10) || cuts, '') AS text, coalesce(struck_pages, 0) AS struck_pages, n_runs, n_struck FROM w LEFT JOIN x USING (doc) JOIN r USING (doc)""",
)
def struck_documents(t):
    found = D.struck_documents(chars(t).withColumn("doc", F.floor(F.col("page") / 8)))
    lengths = F.transform("struck", lambda r: F.length(F.substr(F.col("text"), r["begin"] + 1, r["end"] - r["begin"])))
    total = F.aggregate(lengths, F.lit(0), lambda a, x: a + x)
    return found.select("doc", "text", F.col("struck_pages").cast("bigint"), F.size("struck").cast("bigint").alias("n_runs"), total.cast("bigint").alias("n_struck"))


@query(
    "extract_dispatch",
    f"""WITH {STRUCTURE_CTE}, k AS (SELECT page_id, html, CASE WHEN page_id % 3 = 0 THEN 'xml' WHEN page_id % 4 <> 0 THEN 'html' ELSE 'pdf' END AS ext FROM pages)
  SELECT page_id AS version_id, ext, CASE ext WHEN 'html' THEN {TITLE_SQL} WHEN 'xml' THEN CASE WHEN page_id % 2 = 1 THEN 'Page' END ELSE title END AS title,
  CASE ext WHEN 'html' THEN {HTML_SQL} WHEN 'xml' THEN CASE WHEN page_id % 2 = 1 THEN 'Page No ' || page_id END ELSE text END AS raw_text,
  ext = 'xml' AND page_id % 2 = 0 AS failed FROM k LEFT JOIN z ON z.doc_id = k.page_id WHERE ext <> 'pdf' OR z.doc_id IS NOT NULL""",
)
def extract_dispatch(t):
    done = D.extract_dispatch(
        D.best_links(t("b_link"))
        .withColumn("ext", D.media_ext(F.col("media_type")))
        .join(contents(t), ["version_id", "ext"])
        .drop("ext")
    )
    return done.select("version_id", "ext", "title", "raw_text", F.col("error").isNotNull().alias("failed"))


def contents(t):
    """Stored content per version and format; XML of even pages is damaged."""
    i = F.col("page_id")
    pages = t("pages")
    end = F.when(i % 2 == 1, F.lit("</bill>")).otherwise(F.lit("</page>"))
    xml = F.concat(F.lit("<bill><title>Page</title> <section>No "), i.cast("string"), F.lit("</section>"), end)
    html = pages.select(i.alias("version_id"), F.lit("html").alias("ext"), F.col("html").alias("content"))
    xmls = pages.select(i.alias("version_id"), F.lit("xml").alias("ext"), xml.alias("content"))
    pdf = t("documents").select(F.col("doc_id").alias("version_id"), F.lit("pdf").alias("ext"), F.col("text").alias("content"))
    return html.unionByName(xmls).unionByName(pdf)


@query(
    "extracted_document",
    f"""WITH {STRUCTURE_CTE}, n AS (SELECT doc_id, string_agg('Section ' || i || ':' || chr(10) || s || chr(10) || chr(10), '' ORDER BY i) AS body FROM (
    SELECT doc_id, unnest(CASE WHEN d.n IS NULL THEN [text] ELSE lst END) AS s, generate_subscripts(CASE WHEN d.n IS NULL THEN [text] ELSE lst END, 1) AS i FROM documents
    LEFT JOIN d USING (doc_id) LEFT JOIN (SELECT doc_id, list(section ORDER BY sec) AS lst FROM s GROUP BY 1) q USING (doc_id)) y GROUP BY 1)
  SELECT doc_id, 'Title: ' || title || chr(10) || 'Official Title: ' || official_title || chr(10) || 'Number of Sections: ' || n_sections || chr(10) ||
  'Source: versions - ' || source || chr(10) || 'Media Type: application/pdf' || chr(10) || chr(10) || repeat('=', 80) || chr(10) || chr(10) || body ||
  chr(10) || repeat('=', 80) || chr(10) || chr(10) || 'Raw Text:' || chr(10) || z.text AS document FROM z JOIN n USING (doc_id) JOIN (SELECT doc_id, source FROM documents) o USING (doc_id)""",
)
def extracted_document(t):
    parts = D.line_structure(t("documents"), "text")
    document = D.extracted_document(
        F.col("title"),
        F.col("official_title"),
        F.col("sections"),
        F.concat(F.lit("versions - "), "source"),
        F.lit("application/pdf"),
        F.col("text"),
    )
    return parts.select("doc_id", document.alias("document"))


#: Partitions of bills and their shipments. A stated number is not merged by adaptive execution, so a task's
#: share, which it sorts and aggregates in memory, does not depend on the session's number of partitions.
BILL_PARTS = 96


def extract_bills(t):
    """The rows of ``b_extract``, dealt out before they are aggregated and joined."""
    items = t("lineitem").select("l_orderkey", "l_shipdate").repartition(BILL_PARTS, "l_orderkey")
    shipped = items.groupBy(F.col("l_orderkey").alias("bill_key")).agg(F.min("l_shipdate").alias("first_ship"))
    orders = t("orders").select(F.col("o_orderkey").alias("bill_key"), "o_orderdate", "o_orderstatus")
    joined = orders.repartition(BILL_PARTS, "bill_key").join(shipped, "bill_key", "left")
    return joined.select(
        "bill_key",
        F.col("o_orderdate").alias("logs_update"),
        F.when(F.col("o_orderstatus") == "F", F.lit(None)).otherwise(F.col("first_ship")).alias("text_update"),
        F.when(F.col("bill_key") % 6 == 0, 0).otherwise(1).alias("files"),
    )


@query(
    "extract_batch",
    """WITH e AS (SELECT bill_key, NOT (text_update IS NOT NULL AND NOT coalesce(logs_update > text_update, FALSE) AND files > 0) AS need FROM b_extract),
  v AS (SELECT page_id // 2 AS bill_key, max(CASE WHEN page_id % 6 = 0 THEN 0 ELSE 1 END) AS good FROM pages WHERE page_id % 7 <> 0 GROUP BY 1)
  SELECT bill_key, CASE WHEN NOT need THEN 'skipped' WHEN coalesce(good, 1) = 1 THEN 'ok' ELSE 'error' END AS status,
  need AND coalesce(good, 1) = 1 AS stamped FROM e LEFT JOIN v USING (bill_key)""",
)
def extract_batch(t):
    # Two versions per bill; some versions are not stored.
    links = t("b_link").filter("version_id % 7 <> 0").withColumn("bill_key", F.expr("version_id div 2"))
    run = F.lit("2030-01-01").cast("timestamp_ntz")
    after, _ = D.extract_batch(extract_bills(t), links, contents(t), run)
    return after.select("bill_key", "status", (F.coalesce(F.year("text_update"), F.lit(0)) == 2030).alias("stamped"))


RULE_SQL = "chr(10) || repeat('=', 80) || chr(10) || chr(10)"
NEED_SQL = "NOT (text_update IS NOT NULL AND NOT coalesce(logs_update > text_update, FALSE) AND files > 0)"
# Links of pages with their choice; a bill has two versions.
CHOSEN_SQL = f"""c AS (SELECT page_id, page_id // 2 AS bill_key, url, html,
    CASE WHEN page_id % 3 = 0 THEN 'xml' WHEN page_id % 4 <> 0 THEN 'html' ELSE 'pdf' END AS ext,
    CASE WHEN page_id % 3 = 0 THEN 'text/xml' WHEN page_id % 4 <> 0 THEN 'text/html; charset=utf-8' ELSE 'application/pdf' END AS media_type
    FROM pages WHERE page_id // 2 IN (SELECT bill_key FROM b_extract WHERE {NEED_SQL}))"""


def extraction(t):
    links = t("b_link").withColumn("bill_key", F.expr("version_id div 2"))
    return D.extract_batch(extract_bills(t), links, contents(t), F.lit("2030-01-01").cast("timestamp_ntz"))[1]


@query(
    "extract_documents",
    f"""WITH {STRUCTURE_CTE}, {CHOSEN_SQL}, n AS (SELECT doc_id, list(section ORDER BY sec) AS lst FROM s GROUP BY 1),
  p AS (SELECT page_id, bill_key, ext, media_type, CASE WHEN contains(regexp_extract(url, '([^/]*)$', 1), '.') THEN regexp_extract(url, '([^/]*)$', 1) ELSE 'bill_content.' || ext END AS f,
    CASE ext WHEN 'html' THEN {TITLE_SQL} WHEN 'xml' THEN 'Page' ELSE title END AS title, CASE ext WHEN 'pdf' THEN official_title ELSE '' END AS official,
    CASE ext WHEN 'html' THEN [{HTML_SQL}] WHEN 'xml' THEN ['No ' || page_id] ELSE coalesce(lst, [text]) END AS parts,
    CASE ext WHEN 'html' THEN {HTML_SQL} WHEN 'xml' THEN 'Page No ' || page_id ELSE text END AS raw
    FROM c LEFT JOIN z ON z.doc_id = c.page_id LEFT JOIN n ON n.doc_id = c.page_id
    WHERE (ext = 'html') OR (ext = 'xml' AND page_id % 2 = 1) OR (ext = 'pdf' AND z.doc_id IS NOT NULL))
  SELECT bill_key, page_id AS version_id, CASE WHEN ends_with(f, '.' || ext) THEN replace(f, '.' || ext, '_extracted.txt') ELSE regexp_replace(f, '[.][^.]*$', '') || '_extracted.txt' END AS text_name,
  'Title: ' || title || chr(10) || 'Official Title: ' || official || chr(10) || 'Number of Sections: ' || len(parts) || chr(10) || 'Source: versions - ' || chr(10) ||
  'Media Type: ' || media_type || chr(10) || {RULE_SQL} || array_to_string(list_transform(parts, lambda x, i: 'Section ' || i || ':' || chr(10) || x || chr(10) || chr(10)), '') ||
  {RULE_SQL} || 'Raw Text:' || chr(10) || raw AS document FROM p""",
)
def extract_documents(t):
    return extraction(t).filter("error is null").select("bill_key", "version_id", "text_name", "document")


@query(
    "extract_failures",
    f"""WITH {CHOSEN_SQL} SELECT bill_key, page_id AS version_id, CASE ext WHEN 'xml' THEN 'parsing' ELSE 'download' END AS error_type, url, media_type, '' AS item_note
  FROM c WHERE ext = 'xml' AND page_id % 2 = 0 OR ext = 'pdf' AND page_id NOT IN (SELECT doc_id FROM documents)""",
)
def extract_failures(t):
    # The newest bills refer to documents that are not stored.
    return D.extraction_failures(extraction(t)).drop("error_message")
