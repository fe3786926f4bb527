"""String functions for names, hashes, mark-up and stored documents."""

from __future__ import annotations

import json
from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Word characters are written out because engines disagree on \w beyond ASCII.
WORD = r"\p{L}\p{N}_"
SPACE = r"\s\p{Z}"

# Entities of the feed page, ampersand first.
HTML_ENTITIES = [
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
    ("'", "&#39;"),
]


def slugify(text: Column, max_length: int = 100) -> Column:
    kept = F.regexp_replace(F.lower(text), f"[^{WORD}{SPACE}]", "")
    joined = F.regexp_replace(kept, f"[{SPACE}]+", "_")
    return F.substring(F.regexp_replace(joined, "^_+|_+$", ""), 1, max_length)


def clean_event_name(name: Column, max_length: int = 40) -> Column:
    """The trim happens before the cut, so a cut may end in an underscore."""
    joined = F.regexp_replace(F.lower(name), f"[^{WORD}]+", "_")
    return F.substring(F.regexp_replace(joined, "^_+|_+$", ""), 1, max_length)


def text_hash(text: Column) -> Column:
    return F.sha2(text, 256)


def entry_id(ident: Column, text: Column) -> Column:
    return F.coalesce(ident, F.concat(F.lit("entry_"), F.substring(text_hash(text), 1, 8)))


def escape_html(text: Column) -> Column:
    for char, entity in HTML_ENTITIES:
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def title_case_tag(tag: Column) -> Column:
    """``clean_air`` to ``Clean Air``; only first letters change."""
    words = F.filter(F.split(F.replace(tag, F.lit("_"), F.lit(" ")), r"\s+"), lambda w: w != "")
    return F.array_join(
        F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30))),
        " ",
    )


def media_ext(media_type: Column) -> Column:
    kind = F.lower(media_type)
    return (
        F.when(kind.contains("xml"), "xml").when(kind.contains("html"), "html").otherwise("pdf")
    )


def safe_filename(url: Column, note: Column, ext: Column) -> Column:
    base = F.element_at(F.split(url, "/"), -1)
    base = F.when(base.contains("."), base).otherwise(F.concat(F.lit("bill_content."), ext))
    note = F.regexp_replace(F.coalesce(note, F.lit("")), f"[^{WORD}{SPACE}-]", "")
    note = F.regexp_replace(note, f"^[{SPACE}]+|[{SPACE}]+$", "")
    note = F.regexp_replace(note, f"[{SPACE}-]+", "_")
    stem = F.regexp_extract(base, r"^(.*)\.([^.]*)$", 1)
    suffix = F.regexp_extract(base, r"^(.*)\.([^.]*)$", 2)
    return F.when(note == "", base).otherwise(F.concat(stem, F.lit("_"), note, F.lit("."), suffix))


def extracted_name(filename: Column, ext: Column) -> Column:
    """Name of the text file written next to a stored document."""
    tail = F.lit("_extracted.txt")
    dotted, upper = F.concat(F.lit("."), ext), F.concat(F.lit("."), F.upper(ext))
    return (
        F.when(F.endswith(filename, dotted), F.replace(filename, dotted, tail))
        .when(F.endswith(filename, upper), F.replace(filename, upper, tail))
        .otherwise(F.concat(F.regexp_replace(filename, r"\.[^.]*$", ""), tail))
    )


def html_title(html: Column) -> Column:
    return decode_entities(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


#: Sets entities off from the text around them; cannot stand in a text.
ENTITY_MARK = "\uffff"
ENTITY = r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]*);"


#: What the HTML standard reads the numbers 128 to 159 as: Windows-1252, where that has a character.
C1_CHARS = {n: c for n in range(128, 160) if (c := bytes([n]).decode("cp1252", "ignore"))}


def _fixed_map(pairs: dict) -> Column:
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _named_entities(name: Column) -> Column:
    """Characters of the HTML 5 entity; the few common names are looked up first."""
    every = {n[:-1]: chars for n, chars in html5.items() if n.endswith(";")}
    common = {n: every[n] for n in [*name2codepoint, "apos"]}
    return F.coalesce(F.try_element_at(_fixed_map(common), name), F.try_element_at(_fixed_map(every), name))


def decode_entities(text: Column) -> Column:
    """Named, decimal and hexadecimal entities to characters, each once; unknown ones stay."""
    parts = F.split(F.regexp_replace(F.replace(text, F.lit(ENTITY_MARK), F.lit("")), ENTITY, f"{ENTITY_MARK}$1{ENTITY_MARK}"), ENTITY_MARK, -1)

    def decoded(name: Column) -> Column:
        code = _entity_number(name)
        number = F.when(code.between(128, 159), F.coalesce(F.try_element_at(_fixed_map(C1_CHARS), code.cast("string")), _char(code))).otherwise(_char(code))
        found = F.when(F.startswith(name, F.lit("#")), number).otherwise(_named_entities(name))
        return F.coalesce(found, F.concat(F.lit("&"), name, F.lit(";")))

    # Entities stand at every second place.
    return F.array_join(F.transform(parts, lambda x, i: F.when(i % 2 == 1, decoded(x)).otherwise(x)), "")


def _entity_number(name: Column) -> Column:
    digits = F.when(F.lower(F.substring(name, 2, 1)) == "x", F.conv(F.substring(name, 3, 6), 16, 10)).otherwise(F.substring(name, 2, 7))
    return digits.cast("int")


def _char(code: Column) -> Column:
    valid = code.between(1, 0xD7FF) | code.between(0xE000, 0x10FFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_xml_entities(text: Column) -> Column:
    """The five names and the numbers of XML, each once, in text of a well-formed document."""
    parts = F.split(text, "&", -1)

    def decoded(part: Column) -> Column:
        name = F.substring_index(part, ";", 1)
        names = F.create_map(*[F.lit(x) for x in ("lt", "<", "gt", ">", "amp", "&", "quot", '"', "apos", "'")])
        found = F.when(F.startswith(name, F.lit("#")), _char(_entity_number(name))).otherwise(F.try_element_at(names, name))
        return F.concat(F.coalesce(found, F.concat(F.lit("&"), name, F.lit(";"))), F.substr(part, F.length(name) + 2))

    return F.when(text.contains("&"), F.array_join(F.transform(parts, lambda x, i: F.when(i == 0, x).otherwise(decoded(x))), "")).otherwise(text)


def html_to_text(html: Column) -> Column:
    """Readable text: scripts, styles, comments and tags out, blanks collapsed."""
    text = F.regexp_replace(html, r"(?is)<script\b.*?</script\s*>", "")
    text = F.regexp_replace(text, r"(?is)<style\b.*?</style\s*>", "")
    text = F.regexp_replace(text, r"(?s)<!--.*?-->", "")
    text = F.regexp_replace(text, r"(?s)<[!/?a-zA-Z][^>]*>", "")
    text = decode_entities(text)
    # A line break or a run of two blanks ends a chunk; chunks are joined by one blank.
    text = F.regexp_replace(text, rf"[{SPACE}]*[\r\n\x0b\x0c][{SPACE}]*|  [{SPACE}]*", " ")
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def human_size(size: Column) -> Column:
    """1024-based size; whole bytes below 1 KB, one decimal above."""
    units = F.array(*[F.lit(u) for u in ("B", "KB", "MB", "GB", "TB")])
    value = size.cast("double")
    step = (
        F.when(value < 1024.0, 0)
        .when(value < 1024.0**2, 1)
        .when(value < 1024.0**3, 2)
        .when(value < 1024.0**4, 3)
        .otherwise(4)
    )
    # Ties go to the even digit.
    scaled = F.format_string("%.1f", F.bround(value / F.pow(F.lit(1024.0), step), 1))
    number = F.when(step == 0, size.cast("string")).otherwise(scaled)
    return F.concat_ws(" ", number, F.element_at(units, step + 1))
