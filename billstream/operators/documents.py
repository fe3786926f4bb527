"""Stored bill documents: choice of link, text extraction, structure, reports."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billstream.functions.text import decode_xml_entities, extracted_name, html_title, html_to_text, media_ext, safe_filename
from billstream.functions.variants import bound
from billstream.operators.common import top_per_key
from billstream.session import saved

# Media types from best to worst.
MEDIA_PREFERENCE = ["text/xml", "text/html", "application/pdf", "text/plain"]


def media_rank(media_type: Column, accept_application_xml: bool = False) -> Column:
    """Position in the preference list; null for types never chosen."""
    kind = F.lower(media_type)
    if accept_application_xml:
        kind = F.replace(kind, F.lit("application/xml"), F.lit("text/xml"))
    out = F.lit(None).cast("int")
    for i, name in reversed(list(enumerate(MEDIA_PREFERENCE))):
        out = F.when(kind.contains(name), F.lit(i)).otherwise(out)
    return out


def best_links(links: DataFrame, accept_application_xml: bool = False) -> DataFrame:
    """Per document version the best link; the first wins among equals."""
    ranked = links.filter(F.coalesce(F.col("url"), F.lit("")) != "").withColumn(
        "_rank", media_rank(F.col("media_type"), accept_application_xml)
    )
    ranked = ranked.filter(F.col("_rank").isNotNull())
    return top_per_key(ranked, ["version_id"], [F.asc("_rank"), F.asc("pos")], 1).drop("_rank")


def needs_extraction(logs_update: Column, text_update: Column, files: Column) -> Column:
    """False only if a text stamp exists, no newer log exists and files are there."""
    done = text_update.isNotNull() & ~F.coalesce(logs_update > text_update, F.lit(False)) & (files > 0)
    return ~done


# -- structure of plain text -----------------------------------------------------------

# Blank signs stripped from line ends.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
HEADER = r"(?i)^(section|§|\d+\.)"
#: Starts a section in joined text; trimmed lines never start with it.
MARK = "\x1e"


def text_lines(text: Column) -> Column:
    """Trimmed lines that are not empty."""
    trimmed = F.transform(F.split(text, "\n"), lambda x: F.trim(x, F.lit(BLANKS)))
    return F.filter(trimmed, lambda x: x != "")


def _title_like(line: Column) -> Column:
    upper = F.upper(line)
    return (F.length(line) > 50) | upper.contains("AN ACT") | upper.contains("BILL")


def line_structure(df: DataFrame, text: str) -> DataFrame:
    """Adds ``title`` and ``sections`` of whole texts, row by row and without a shuffle.

    The first title-like line is the title and leaves the body; a header line
    starts a new section.
    """
    df = df.withColumn("_lines", text_lines(F.col(text)))
    df = df.withColumn("_title", F.get(F.filter("_lines", _title_like), F.lit(0)))
    at = F.array_position("_lines", F.col("_title"))
    body = F.when(
        F.col("_title").isNotNull(),
        F.concat(
            F.slice("_lines", F.lit(1), F.greatest(at - 1, F.lit(0)).cast("int")),
            F.slice("_lines", (at + 1).cast("int"), F.size("_lines")),
        ),
    ).otherwise(F.col("_lines"))
    df = df.withColumn("_body", body)
    marked = F.transform(
        "_body", lambda x, i: F.when(x.rlike(HEADER) & (i > 0), F.concat(F.lit(MARK), x)).otherwise(x)
    )
    sections = F.when(F.size("_body") > 0, F.split(F.array_join(marked, "\n"), f"\n{MARK}"))
    return df.withColumns(
        {
            "title": F.coalesce("_title", F.lit("PDF Document")),
            "official_title": F.coalesce("_title", F.lit("")),
            "sections": F.coalesce(sections, F.array(F.col(text))),
        }
    ).drop("_lines", "_title", "_body")


def section_rows(df: DataFrame, text: str) -> DataFrame:
    """One row per section with its number. A text always has one section, so the
    outer explode adds no rows; it spares a second evaluation in a filter."""
    keep = [c for c in df.columns if c != text]
    return line_structure(df, text).select(
        *keep, F.posexplode_outer("sections").alias("_i", "section")
    ).select(*keep, (F.col("_i") + 1).cast("bigint").alias("section_no"), "section")


def extracted_document(title: Column, official: Column, sections: Column, source: Column, media_type: Column, raw: Column) -> Column:
    """The stored text file: head, numbered sections, raw text."""
    rule = "\n" + "=" * 80 + "\n\n"
    numbered = F.array_join(
        F.transform(
            sections,
            lambda s, i: F.concat(F.lit("Section "), (i + 1).cast("string"), F.lit(":\n"), s, F.lit("\n\n")),
        ),
        "",
    )
    return F.concat(
        F.lit("Title: "), title,
        F.lit("\nOfficial Title: "), official,
        F.lit("\nNumber of Sections: "), F.size(sections).cast("string"),
        F.lit("\nSource: "), source,
        F.lit("\nMedia Type: "), media_type,
        F.lit("\n" + rule), numbered,
        F.lit(rule + "Raw Text:\n"), raw,
    )


# -- struck characters ------------------------------------------------------------------

def strike_gaps(chars: DataFrame) -> DataFrame:
    """Inner characters of a line with a gap above 2 on one side."""
    line = Window.partitionBy("page", "line").orderBy("x0", "pos")
    before = F.col("x0") - F.lag("x1").over(line)
    after = F.lead("x0").over(line) - F.col("x1")
    inner = before.isNotNull() & after.isNotNull()
    return chars.withColumn("gap", inner & ((before > 2) | (after > 2)))


# Parts of font names that stand for struck text.
STRIKE_FONTS = ["strike", "delete", "removed"]


def strike_flags(chars: DataFrame) -> DataFrame:
    """Adds ``struck``: by font, by gap, or by gray below 0.8."""
    font = F.lower("font")
    by_font = F.lit(False)
    for part in STRIKE_FONTS:
        by_font = by_font | font.contains(part)
    return strike_gaps(chars).withColumn(
        "struck", by_font | F.col("gap") | F.coalesce(F.col("gray") < 0.8, F.lit(False))
    )


def strike_text(chars: DataFrame) -> DataFrame:
    """Struck characters per page in reading order, joined line by line first."""
    ordered = F.array_sort(F.collect_list(F.struct("x0", "pos", "ch")))
    lines = (
        strike_flags(chars)
        .filter("struck")
        .groupBy("page", "line")
        .agg(F.array_join(F.transform(ordered, lambda c: c["ch"]), "").alias("text"))
    )
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda c: c["text"]), "")
    return lines.groupBy("page").agg(
        F.concat(F.lit("[DELETED: "), whole, F.lit("]")).alias("struck_text")
    )


def _struck_runs(flags: Column) -> Column:
    """Runs of struck characters as begin and end (exclusive), from 0."""
    size = F.size(flags)
    edges = lambda sign: F.filter(
        F.transform(F.concat(flags, F.array(F.lit(False))), lambda f, i: F.when((f != (F.coalesce(F.get(flags, i - 1), F.lit(False)))) & (f if sign else ~f), i)),
        lambda i: i.isNotNull(),
    )
    runs = F.zip_with(edges(True), edges(False), lambda a, b: F.struct(a.alias("begin"), b.alias("end")))
    return F.when(size > 0, runs).otherwise(F.array().cast("array<struct<begin:int,end:int>>"))


def _strung(parts: Column, between: str) -> Column:
    """Texts joined, with their runs moved to where they stand in the whole; empty texts are left out."""
    first = F.struct(F.lit("").alias("text"), F.array().cast("array<struct<begin:int,end:int>>").alias("runs"))

    def add(seen: Column, part: Column) -> Column:
        head = F.when(seen["text"] == "", "").otherwise(F.concat(seen["text"], F.lit(between)))
        moved = F.transform(part["runs"], lambda r: F.struct((r["begin"] + F.length(head)).alias("begin"), (r["end"] + F.length(head)).alias("end")))
        return F.when(part["text"] == "", seen).otherwise(F.struct(F.concat(head, part["text"]).alias("text"), F.concat(seen["runs"], moved).alias("runs")))

    return F.aggregate(parts, first, add)


def struck_documents(chars: DataFrame, key: str = "doc") -> DataFrame:
    """One row per document: ``text`` with its deletions behind it, ``struck_pages``, and where they stand.

    ``struck`` holds begin and end of every run of struck characters within the text. Characters of
    a line, lines of a page and pages of a document are each joined in order, so that a task holds
    one document at most.
    """
    by_line = F.array_sort(F.collect_list(F.struct("x0", "pos", "ch", "struck")))
    lines = strike_flags(chars).groupBy(key, "page", "line").agg(by_line.alias("_c")).select(
        key, "page", "line",
        F.struct(F.array_join(F.transform("_c", lambda c: c["ch"]), "").alias("text"), _struck_runs(F.transform("_c", lambda c: c["struck"])).alias("runs")).alias("part"),
    )
    in_order = lambda column: F.transform(F.array_sort(F.collect_list(F.struct(column, "text", "runs"))), lambda x: F.struct(x["text"].alias("text"), x["runs"].alias("runs")))
    pages = lines.select(key, "page", "line", "part.*").groupBy(key, "page").agg(_strung(in_order("line"), "\n").alias("_p")).select(key, "page", "_p.*")
    whole = pages.groupBy(key).agg(_strung(in_order("page"), "\n\n").alias("_d"), F.array_sort(F.collect_list(F.struct("page", "text", "runs"))).alias("_pages"))
    cut = lambda p: F.array_join(F.transform(p["runs"], lambda r: F.substr(p["text"], r["begin"] + 1, r["end"] - r["begin"])), "")
    deleted = F.transform(F.filter("_pages", lambda p: F.size(p["runs"]) > 0), lambda p: F.concat(F.lit("[DELETED: "), cut(p), F.lit("]")))
    return whole.withColumn("_deleted", deleted).select(
        key,
        F.concat(F.col("_d.text"), F.when(F.size("_deleted") > 0, F.concat(F.lit("\n\n"), F.array_join("_deleted", "\n"))).otherwise("")).alias("text"),
        F.size("_deleted").alias("struck_pages"),
        F.col("_d.runs").alias("struck"),
    )


# -- mark-up ------------------------------------------------------------------------------

#: Signs that stand for tags in a text; none of them can stand in XML.
SECTION_OPEN, SECTION_CLOSE, TITLE_OPEN, OFFICIAL_OPEN, TAG = "\x01", "\x02", "\x03", "\x04", "\x05"
MARKS = SECTION_OPEN + SECTION_CLOSE + TITLE_OPEN + OFFICIAL_OPEN + TAG
NAMED_OPEN = {"section": SECTION_OPEN, "title": TITLE_OPEN, "official-title": OFFICIAL_OPEN}
#: An element around a document, so that a parse sees what follows the document's own.
OUTER = "outer-element-of-the-check"
QUOTED = r"""(?:[^<>"']++|"[^"]*+"|'[^']*+')*+"""
DOCTYPE = r"""<!DOCTYPE(?:[^\[>"']++|"[^"]*+"|'[^']*+'|\[(?:[^\]"'<]++|"[^"]*+"|'[^']*+'|<!--.*?-->|<(?!!--)(?:[^>"']++|"[^"]*+"|'[^']*+')*+>)*+\])*+>"""
#: Comments, CDATA, instructions, the document type, tags and the text between them.
TOKEN = rf"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>|{DOCTYPE}|</?[^\s<>/!?]{QUOTED}>|[^<]+|<"
ENTITY_OF_TYPE = r"""<!ENTITY\s+([^\s%"']+)\s+(?:"([^"]*)"|'([^']*)')\s*>"""
#: Characters that a document may grow to by its own entities, beyond ten times its size.
MOST_GROWTH = 1_000_000


def _until_mark(text: Column) -> Column:
    return F.regexp_extract(text, f"^[^{MARKS}]*", 0)


def _sections(marked: Column) -> Column:
    """Texts of sections in document order, each with the text that follows it up to the next tag; an
    outer section holds its inner ones."""
    plain = lambda part: F.trim(F.translate(part, MARKS, ""), F.lit(BLANKS))

    def with_tail(part: Column, closes: Column) -> Column:
        """A part up to its end mark of that number, and the text after it."""
        own = F.call_function("substring_index", part, F.lit(SECTION_CLOSE), closes)
        return F.concat(own, _until_mark(F.substr(part, F.length(own) + 2)))

    def of(parts: Column) -> Column:
        def section(part: Column, i: Column) -> Column:
            def outer() -> Column:
                # Inner sections follow: up to the end mark that brings the depth back to none.
                closes = lambda x: F.length(x) - F.length(F.replace(x, F.lit(SECTION_CLOSE), F.lit("")))
                first = F.struct(F.lit(0).alias("depth"), F.lit("").alias("text"), F.lit(False).alias("ended"))

                def add(seen: Column, x: Column) -> Column:
                    depth = seen.depth + 1 - closes(x)
                    text = F.concat(seen.text, F.when(depth <= 0, with_tail(x, seen.depth + 1)).otherwise(x))
                    return F.when(seen.ended, seen).otherwise(F.struct(depth.alias("depth"), text.alias("text"), (depth <= 0).alias("ended")))

                return F.aggregate(F.slice(parts, i + 1, F.size(parts)), first, add).text

            return F.when(F.contains(part, F.lit(SECTION_CLOSE)), with_tail(part, F.lit(1))).otherwise(outer())

        return F.filter(F.transform(F.slice(F.transform(parts, section), 2, F.size(parts)), plain), lambda x: x != "")

    return bound(F.split(marked, SECTION_OPEN, -1), of)


def _corrupt(xml: Column) -> Column:
    """Whether a permissive parse stumbles; it never fails."""
    return F.from_xml(xml, "_none STRING, _corrupt_record STRING", {"mode": "PERMISSIVE"})["_corrupt_record"].isNotNull()


def _is(token: Column, kind: str) -> Column:
    return F.startswith(token, F.lit(kind))


def _name(token: Column) -> Column:
    return F.regexp_extract(token, r"^</?([^\s<>/]+)", 1)


def _is_start(token: Column) -> Column:
    return _is(token, "<") & ~_is(token, "<!") & ~_is(token, "<?") & ~_is(token, "</")


def _read(token: Column) -> Column:
    """The text of a token, or the mark that stands for a tag."""
    name, ended = _name(token), F.endswith(token, F.lit("/>"))
    closing = F.when(name == "section", SECTION_CLOSE).otherwise(TAG)
    opening = F.lit(TAG)
    for known, mark in NAMED_OPEN.items():
        opening = F.when(name == known, mark).otherwise(opening)
    return (
        F.when(~_is(token, "<"), decode_xml_entities(token))
        .when(_is(token, "<![CDATA["), F.substr(token, F.lit(10), F.length(token) - 12))
        .when(_is(token, "<!") | _is(token, "<?"), "")
        .when(_is(token, "</"), closing)
        .otherwise(F.concat(opening, F.when(ended, closing).otherwise("")))
    )


def _one_root(tokens: Column) -> Column:
    """Whether one element holds all text, and the document type stands before it."""

    def add(seen: Column, token: Column) -> Column:
        start = _is_start(token)
        top = seen.depth == 0
        change = F.when(_is(token, "</"), -1).when(start & ~F.endswith(token, F.lit("/>")), 1).otherwise(0)
        text = ~_is(token, "<") & (F.trim(token, F.lit(" \t\r\n")) != "")
        stray = (top & (text | _is(token, "<![CDATA["))) | (_is(token, "<!DOCTYPE") & (~top | (seen.roots > 0)))
        return F.struct(
            (seen.depth + change).alias("depth"), (seen.roots + (start & top).cast("int")).alias("roots"), (seen.stray | stray).alias("stray")
        )

    first = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("roots"), F.lit(False).alias("stray"))
    return F.aggregate(tokens, first, add, lambda s: (s.roots == 1) & (s.depth == 0) & ~s.stray)


def _prefixes_known(tokens: Column) -> Column:
    """Whether every prefix of an element is declared by some element."""
    starts = F.filter(tokens, lambda t: _is_start(t) & F.contains(t, F.lit(":")))
    used = F.filter(F.transform(starts, lambda t: F.regexp_extract(t, r"^<([^\s<>/:]+):", 1)), lambda p: p != "")
    declared = F.flatten(F.transform(starts, lambda t: F.regexp_extract_all(t, F.lit(r"\sxmlns:([^\s=]+)\s*="), F.lit(1))))
    return F.size(F.array_except(used, F.concat(declared, F.array(F.lit("xml"))))) == 0


def _with_own_entities(doc: Column) -> Column:
    """The document with the entities put in that its type declares, the last one first."""

    def put_in(kind: Column) -> Column:
        names, one, two = (F.regexp_extract_all(kind, F.lit(ENTITY_OF_TYPE), F.lit(i)) for i in (1, 2, 3))
        pairs = F.reverse(F.zip_with(names, F.zip_with(one, two, lambda a, b: F.concat(a, b)), lambda n, v: F.struct(F.concat(F.lit("&"), n, F.lit(";")).alias("ref"), v.alias("value"))))
        most = F.length(doc) * 10 + MOST_GROWTH

        def replaced(text: Column, pair: Column) -> Column:
            uses = (F.length(text) - F.length(F.replace(text, pair["ref"], F.lit("")))) / F.length(pair["ref"])
            fits = F.length(text) + uses * F.length(pair["value"]) <= most
            # What does not fit stays a reference, which no parse knows.
            return F.when(fits, F.replace(text, pair["ref"], pair["value"])).otherwise(text)

        return F.aggregate(pairs, F.replace(doc, kind, F.lit("<!DOCTYPE x>")), replaced)

    kind = F.regexp_extract(doc, rf"(?s){DOCTYPE}", 0)
    return F.when(F.contains(doc, F.lit("<!ENTITY")), bound(kind, lambda k: F.when(k != "", put_in(k)).otherwise(doc))).otherwise(doc)


def xml_bill_text(xml: Column) -> Column:
    """Titles, sections and text of bill XML; ``error`` is set for damaged or missing input.

    Tags are told apart from text by one pass of a pattern, and one permissive parse tells whether
    the document is sound, so that no document can fail a job. A section's text goes on to the tag
    after its end; a title's ends with its first element. Elements in a default namespace of the root
    have other names and are not found.
    """

    def read(tokens: Column) -> Column:
        # The root itself is neither a title nor a section.
        joined = F.regexp_replace(F.array_join(F.transform(tokens, _read), ""), f"^([^{MARKS}]*)[{MARKS}]", f"$1{TAG}")
        root = F.get(F.filter(tokens, _is_start), F.lit(0))
        named = F.regexp_like(root, F.lit(r"""\sxmlns\s*=\s*(?:"[^"]|'[^'])"""))
        marked = F.when(named, F.translate(joined, MARKS, TAG * len(MARKS))).otherwise(joined)

        def parts(text: Column) -> Column:
            first = lambda mark: F.trim(F.regexp_extract(text, f"{mark}([^{MARKS}]*)", 1), F.lit(BLANKS))
            return F.struct(
                first(TITLE_OPEN).alias("title"),
                first(OFFICIAL_OPEN).alias("official_title"),
                _sections(text).alias("sections"),
                F.trim(F.translate(text, MARKS, ""), F.lit(BLANKS)).alias("raw_text"),
                F.lit(None).cast("string").alias("error"),
            )

        return bound(marked, parts)

    nothing = F.struct(
        *[F.lit(None).cast("string").alias(n) for n in ("title", "official_title")],
        F.lit(None).cast("array<string>").alias("sections"),
        F.lit(None).cast("string").alias("raw_text"),
        F.lit("not well-formed").alias("error"),
    )

    def checked(tokens: Column) -> Column:
        inner = F.array_join(F.filter(tokens, lambda t: ~_is(t, "<!DOCTYPE")), "")
        wrapped = F.concat(F.lit(f"<{OUTER}>"), F.regexp_replace(inner, r"(?s)^<\?xml\s.*?\?>", ""), F.lit(f"</{OUTER}>"))
        sound = ~F.exists(tokens, lambda t: _is(t, f"</{OUTER}")) & _one_root(tokens) & _prefixes_known(tokens)
        return F.when(F.when(sound, ~_corrupt(wrapped)).otherwise(False), read(tokens)).otherwise(nothing)

    text = F.regexp_replace(F.coalesce(xml, F.lit("")), "\r\n?", "\n")
    return bound(_with_own_entities(text), lambda doc: bound(F.regexp_extract_all(doc, F.lit(TOKEN), F.lit(0)), checked))


def extract_texts(docs: DataFrame) -> DataFrame:
    """Adds ``ext, title, official_title, sections, raw_text, error`` to ``(media_type, content)`` in one pass.

    Each format sees only its own contents; for other rows its input is null, which
    costs next to nothing. So the input is read once, not once per format.
    """
    kind = F.lower("media_type")
    known = kind.contains("xml") | kind.contains("html") | kind.contains("pdf")

    def only(ext: str) -> Column:
        return F.when(F.col("ext") == ext, F.col("content"))

    df = docs.withColumn("ext", F.when(known, media_ext(F.col("media_type"))))
    df = df.withColumns({"_html": only("html"), "_xml": only("xml"), "_pdf": only("pdf")})
    df = df.withColumn("_x", F.when(F.col("_xml").isNotNull(), xml_bill_text(F.col("_xml"))))
    df = df.withColumn("_page", html_to_text(F.col("_html")))
    df = line_structure(df, "_pdf")
    missing = F.when(F.col("ext").isNull(), "unsupported media type").when(F.col("content").isNull(), "download failed")
    result = {
        "title": F.when(F.col("ext") == "html", html_title(F.col("_html")))
        .when(F.col("ext") == "xml", F.col("_x.title"))
        .when(F.col("_pdf").isNotNull(), F.col("title")),
        "official_title": F.when(F.col("ext") == "html", "")
        .when(F.col("ext") == "xml", F.col("_x.official_title"))
        .when(F.col("_pdf").isNotNull(), F.col("official_title")),
        "raw_text": F.when(F.col("ext") == "html", F.col("_page"))
        .when(F.col("ext") == "xml", F.col("_x.raw_text"))
        .otherwise(F.col("_pdf")),
        "sections": F.when(F.col("ext") == "html", F.array("_page"))
        .when(F.col("ext") == "xml", F.col("_x.sections"))
        .when(F.col("_pdf").isNotNull(), F.col("sections")),
        "error": F.coalesce(missing, F.col("_x.error")),
    }
    return df.withColumns(result).drop("_html", "_xml", "_pdf", "_x", "_page")


def extract_dispatch(docs: DataFrame) -> DataFrame:
    """Chosen documents ``(version_id, media_type, content)`` to ``(…, ext, title, raw_text, error)``.

    Plain text is a possible choice but not extracted.
    """
    done = extract_texts(docs).filter(F.col("ext").isNotNull())
    return done.select("version_id", "media_type", "ext", "title", "raw_text", "error")


def best_link_of(*keys: str, accept_application_xml: bool = False):
    """``best_links`` as an aggregate that keeps versions without a usable link."""
    rank = media_rank(F.col("media_type"), accept_application_xml)
    usable = rank.isNotNull() & (F.coalesce(F.col("url"), F.lit("")) != "")

    def pick(links: DataFrame) -> DataFrame:
        more = [c for c in ("note", "kind") if c in links.columns]
        best = F.min(F.when(usable, F.struct(rank.alias("rank"), "pos", "url", "media_type", *more))).alias("_l")
        return links.groupBy(*keys).agg(best).select(*keys, "_l.url", "_l.media_type", *[f"_l.{c}" for c in more])

    return pick


def extract_batch(bills: DataFrame, links: DataFrame, contents: DataFrame, run: Column) -> tuple[DataFrame, DataFrame]:
    """One extraction run: (bills with ``status`` and new stamp, extracted documents).

    ``bills(bill_key, logs_update, text_update, files)``, ``links(bill_key, version_id,
    pos, url, media_type)`` with an optional ``note`` and ``kind`` (versions or documents),
    ``contents(version_id, ext, content)``. A bill without versions is fine; one whose
    versions all fail is an error. Only contents of chosen versions take part.
    """
    need = needs_extraction(F.col("logs_update"), F.col("text_update"), F.col("files"))
    todo = bills.filter(need).select("bill_key")
    # Links first become one row a version: the bills then meet them in one join, not in one for each source of links.
    chosen = links.transform(best_link_of("bill_key", "version_id")).join(todo, "bill_key", "left_semi")
    chosen = chosen.withColumn("ext", media_ext(F.col("media_type")))
    for name, default in (("note", ""), ("kind", "versions")):
        chosen = chosen.withColumn(name, F.coalesce(name, F.lit(default)) if name in chosen.columns else F.lit(default))
    # Chosen once: every source of contents is cut down by them, and they are joined to what is left.
    chosen = saved(chosen, "chosen-links")
    wanted = contents.join(chosen.select("version_id", "ext").distinct(), ["version_id", "ext"], "left_semi")
    done = extract_texts(chosen.join(wanted, ["version_id", "ext"], "left").drop("ext"))
    outcome = done.groupBy("bill_key").agg(F.bool_or(F.col("error").isNull()).alias("_ok"))
    status = F.when(~need, "skipped").when(F.coalesce("_ok", F.lit(True)), "ok").otherwise("error")
    after = (
        bills.join(outcome, "bill_key", "left")
        .withColumn("status", status)
        .withColumn("text_update", F.when(F.col("status") == "ok", run).otherwise(F.col("text_update")))
        .drop("_ok")
    )
    file_name = safe_filename(F.col("url"), F.col("note"), F.col("ext"))
    source = F.concat("kind", F.lit(" - "), "note")
    document = extracted_document(
        F.col("title"), F.col("official_title"), F.col("sections"), source, F.col("media_type"), F.col("raw_text")
    )
    good = F.col("error").isNull()
    return after, done.select(
        "bill_key", "version_id", "url", "media_type", "note", "ext", "title", "official_title", "sections", "raw_text", "error",
        F.when(good, file_name).alias("file_name"),
        F.when(good, extracted_name(file_name, F.col("ext"))).alias("text_name"),
        F.when(good, document).alias("document"),
    )


def extraction_failures(done: DataFrame) -> DataFrame:
    """Failure records of an extraction run, in the shape of ``failure_report``.

    Versions without a usable link are passed over and leave no record.
    """
    lost = F.col("error") == "download failed"
    return done.filter(F.col("error").isNotNull() & F.col("ext").isNotNull()).select(
        "bill_key",
        "version_id",
        F.when(lost, "download").otherwise("parsing").alias("error_type"),
        F.when(lost, F.concat(F.lit("Failed to download content from "), "media_type")).otherwise(F.col("error")).alias("error_message"),
        "url",
        "media_type",
        F.col("note").alias("item_note"),
    )


def extraction_stats(status: DataFrame) -> DataFrame:
    """One row of counters over a per-bill ``status``; skipped bills count as processed,
    bills the run did not reach have no status."""
    s = F.col("status")
    return status.agg(
        F.count("*").alias("total"),
        F.count("status").alias("processed"),
        F.count_if(s == "ok").alias("successful"),
        F.count_if(s == "error").alias("errors"),
        F.count_if(s == "skipped").alias("skipped"),
    )


def failure_report(failures: DataFrame) -> DataFrame:
    """Failures with the count of their type next to each record; records stay rows."""
    counts = failures.groupBy("error_type").agg(F.count("*").alias("type_count"))
    return failures.join(counts, "error_type")


# -- scrape logs ----------------------------------------------------------------------------

# Errors that a summary lists, and object counters printed by a scrape.
FIRST_ERRORS = 5
COUNTERS = ["bill", "vote_event", "event", "jurisdiction", "organization"]


def error_priority(content: Column) -> Column:
    """1 traceback, 2 named exception, 3 other error words, null otherwise."""
    retry = content.rlike("(retry|retrying|resolved|recovered|succeeded after|^[0-9]+:[0-9]+:[0-9]+ INFO)")
    noise = content.rlike("(?i)( INFO |scrape attempt|retry|retrying|resolved|recovered|succeeded)")
    return (
        F.when(content.startswith("Traceback (most recent call last):"), 1)
        .when(content.rlike(r"(?i)^[A-Za-z0-9_]+(Error|Exception|Warning):") & ~retry, 2)
        .when(
            content.rlike("(ERROR|EXCEPTION|TRACEBACK|AssertionError|TimeoutError|ConnectionError|HTTPError)") & ~noise, 3
        )
    )


def classify_errors(lines: DataFrame) -> DataFrame:
    """Error lines of the best class each run has."""
    flagged = lines.withColumn("priority", error_priority(F.col("content"))).filter("priority is not null")
    best = flagged.groupBy("run").agg(F.min("priority").alias("priority"))
    return flagged.join(best, ["run", "priority"])


def scrape_summary(lines: DataFrame) -> DataFrame:
    """Per run the last value of every counter, the duration, the error count and the first errors."""
    text = F.col("content")
    found = {
        name: F.nullif(F.regexp_extract(text, rf"^\s*{name}:\s*(\d+)", 1), F.lit("")).cast("bigint")
        for name in COUNTERS
    }
    duration = F.nullif(F.regexp_extract(text, r"duration:\s*([\d:\.]+)", 1), F.lit(""))
    last = [
        F.coalesce(F.max_by(c, F.when(c.isNotNull(), F.col("line"))), F.lit(0)).alias(f"{n}_count")
        for n, c in found.items()
    ]
    counts = lines.groupBy("run").agg(
        *last,
        F.coalesce(F.max_by(duration, F.when(duration.isNotNull(), F.col("line"))), F.lit("unknown")).alias("duration"),
    )
    found_errors = classify_errors(lines)
    errors = found_errors.groupBy("run").agg(F.count("*").alias("error_count"))
    # A ranking keeps a few rows of each run, so the list that is collected has a bound.
    first = top_per_key(found_errors, ["run"], [F.asc("line"), F.asc("content")], FIRST_ERRORS)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("line", "content"))), lambda x: x.content)
    return (
        counts.join(errors, "run", "left")
        .join(first.groupBy("run").agg(listed.alias("errors")), "run", "left")
        .withColumn("error_count", F.coalesce("error_count", F.lit(0)))
        .withColumn("errors", F.coalesce("errors", F.array().cast("array<string>")))
    )


# Lines that a summary takes after a traceback's head and after the head of the bills block.
TRACEBACK_LINES, BILLS_LINES = 10, 2
TRACEBACK_HEAD, BILLS_HEAD = "Traceback (most recent call last):", "bills scrape:"
#: Line numbers that one task counts through; a longer run is counted in several.
RUN_PART = 100_000


def with_blocks(lines: DataFrame, heads: Mapping[str, Column], part: int = RUN_PART) -> DataFrame:
    """Lines ``(run, line, content)`` with ``place`` (1 for the first of its run) and, for every name in
    ``heads``, the place of the last head at or above the line.

    Two levels, so that one long run is not one task: places are counted within parts of a run, and
    the parts' totals and last heads, one row each, are added up along the run.
    """
    rows = lines.withColumn("_part", F.floor(F.col("line") / part)).withColumns({f"_is_{n}": c for n, c in heads.items()})
    within = Window.partitionBy("run", "_part").orderBy("line", "content")
    rows = rows.withColumn("_place", F.row_number().over(within))
    here = {n: F.when(F.col(f"_is_{n}"), F.col("_place")) for n in heads}
    rows = rows.withColumns({f"_last_{n}": F.max(c).over(within.rowsBetween(Window.unboundedPreceding, 0)) for n, c in here.items()})
    parts = rows.groupBy("run", "_part").agg(F.max("_place").alias("_rows"), *[F.max(f"_last_{n}").alias(f"_top_{n}") for n in heads])
    before = Window.partitionBy("run").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_start", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    parts = parts.withColumns({f"_before_{n}": F.max(F.col("_start") + F.col(f"_top_{n}")).over(before) for n in heads})
    joined = rows.join(parts.select("run", "_part", "_start", *[f"_before_{n}" for n in heads]), ["run", "_part"])
    return joined.select(
        *lines.columns,
        (F.col("_start") + F.col("_place")).alias("place"),
        *[F.coalesce(F.col("_start") + F.col(f"_last_{n}"), F.col(f"_before_{n}")).alias(n) for n in heads],
    )


def _blocks(lines: DataFrame) -> DataFrame:
    heads = {"traceback": F.col("content").startswith(TRACEBACK_HEAD), "bills": F.col("content").contains(BILLS_HEAD)}
    return with_blocks(lines.select("run", "line", "content"), heads)


def _traceback_blocks(placed: DataFrame) -> DataFrame:
    inside = placed.filter(F.col("place") - F.col("traceback") <= TRACEBACK_LINES)
    # At most a head and its fixed number of lines are collected.
    texts = F.transform(F.array_sort(F.collect_list(F.struct("place", "content"))), lambda x: x.content)
    return inside.groupBy("run", F.col("traceback").alias("place")).agg(F.min("line").alias("line"), F.array_join(texts, "\n").alias("content"))


def error_blocks(lines: DataFrame) -> DataFrame:
    """Errors of the best class each run has, with ``priority``: whole tracebacks, else single lines.

    A traceback is its head and the ten lines after it, up to the next head.
    """
    return _errors_of(lines, _blocks(lines))


def _errors_of(lines: DataFrame, placed: DataFrame) -> DataFrame:
    single = classify_errors(lines).filter("priority > 1").select("run", "priority", "line", "content")
    blocks = _traceback_blocks(placed).select("run", F.lit(1).alias("priority"), "line", "content")
    return blocks.unionByName(single)


def run_summary(lines: DataFrame) -> DataFrame:
    """``scrape_summary`` with errors as whole blocks and the duration of the bills block alone.

    That is the last duration printed in the two lines after a head of that block.
    """
    placed = _blocks(lines)
    counts = scrape_summary(lines).drop("duration", "errors", "error_count")
    printed = F.nullif(F.regexp_extract("content", r"duration:\s*([\d:\.]+)", 1), F.lit(""))
    timed = placed.filter(F.col("place") - F.col("bills") <= BILLS_LINES).withColumn("duration", printed).filter("duration IS NOT NULL")
    durations = timed.groupBy("run").agg(F.max_by("duration", "place").alias("duration"))
    errors = _errors_of(lines, placed)
    totals = errors.groupBy("run").agg(F.count("*").alias("error_count"))
    first = top_per_key(errors, ["run"], [F.asc("line"), F.asc("content")], FIRST_ERRORS)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("line", "content"))), lambda x: x.content)
    return (
        counts.join(durations, "run", "left").join(totals, "run", "left")
        .join(first.groupBy("run").agg(listed.alias("errors")), "run", "left")
        .withColumns(
            {
                "duration": F.coalesce("duration", F.lit("unknown")),
                "error_count": F.coalesce("error_count", F.lit(0)),
                "errors": F.coalesce("errors", F.array().cast("array<string>")),
            }
        )
    )
