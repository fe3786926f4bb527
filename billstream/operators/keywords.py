"""Keywords found in texts through an inverted index.

Every keyword has a head that any text holding it shows: a plain word itself, a phrase the few
letters around its first blank, any other keyword its longest run of word characters. The index maps
heads to keywords, in buckets of a constant; a text looks up its own distinct words and blanks and
checks the few keywords it meets. The plan is the same for one keyword and for ten thousand.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from billstream.functions.text import WORD
from billstream.functions.variants import bound

PLAIN_WORD = re.compile(r"^\w+$")
WORD_RUN = re.compile(r"\w+")
#: Letters on each side of a blank that make the head of a phrase.
AROUND = 2
#: Keywords per bucket of the index on average.
PER_BUCKET = 2

#: ``owner`` and ``place`` tell which list a keyword belongs to and where in it; ``check`` is empty for plain
#: words, ``phrase``, or a pattern.
KEYWORD = "struct<head:string,owner:int,place:int,excludes:boolean,shown:string,lowered:string,check:string>"


def keyword_pattern(keyword: str) -> str:
    """Whole-word pattern; a plus sign may follow. Boundaries are written out."""
    edge = re.compile(r"^\w$")
    word = re.escape(keyword)
    # The literal comes first and is checked backwards, which is far cheaper than
    # trying a boundary at every place of the text.
    left = rf"(?<![{WORD}]{word})" if edge.match(keyword[0]) else rf"(?<=[{WORD}]{word})"
    right = rf"(?![{WORD}])" if edge.match(keyword[-1]) else rf"(?:\+|(?=[{WORD}]))"
    return word + left + right


def keyword_hit(lowered: Column, keyword: str) -> Column:
    """What a hit is, for one keyword: a phrase anywhere, a single word only as a whole word."""
    keyword = keyword.lower()
    if " " in keyword:
        return lowered.contains(keyword)
    # The plain search is cheap and spares most texts the pattern.
    return lowered.contains(keyword) & lowered.rlike(keyword_pattern(keyword))


def _blank_head(before: str, after: str) -> tuple[str, tuple[int, int]]:
    """Head of a phrase and the numbers of letters it takes before and after its first blank."""
    b, a = before[-AROUND:], after[:AROUND]
    return f"{b} {a}", (len(b), len(a))


def _entry(owner: int, place: int, excludes: bool, keyword: str) -> dict:
    lowered = keyword.lower()
    if " " in lowered:
        head, check = _blank_head(*lowered.split(" ")[:2])[0], "phrase"
    elif PLAIN_WORD.match(lowered):
        head, check = lowered, ""
    else:
        head, check = max(WORD_RUN.findall(lowered), key=len, default=""), keyword_pattern(lowered)
    return {"head": head, "owner": owner, "place": place, "excludes": excludes, "shown": keyword, "lowered": lowered, "check": check}


def keyword_hits(lowered: Column, lists: Sequence[tuple[Sequence[str], Sequence[str]]]) -> Column:
    """Entries of type ``KEYWORD`` found in a lower-case text, in no order.

    ``lists`` are (including, excluding) keywords of each owner; ``keyword_hit`` says what is found.
    A null text has no hit.
    """
    entries = [
        _entry(owner, place, excludes, keyword)
        for owner, both in enumerate(lists)
        for excludes, keywords in zip((False, True), both)
        for place, keyword in enumerate(keywords)
        if keyword
    ]
    size = max(1, len(entries) // PER_BUCKET)
    buckets: list[list[dict]] = [[] for _ in range(size)]
    for entry in entries:
        buckets[zlib.crc32(entry["head"].encode()) % size].append(entry)
    # A constant: folded once per plan, whatever its size.
    index = F.from_json(F.lit(json.dumps(buckets)), f"array<array<{KEYWORD}>>")

    heads = [F.regexp_extract_all(lowered, F.lit(f"[{WORD}]+"), F.lit(0))]
    kinds = sorted({_blank_head(*e["lowered"].split(" ")[:2])[1] for e in entries if e["check"] == "phrase"})
    # Looking ahead alone, so that neighbouring blanks may share letters.
    heads += [F.regexp_extract_all(lowered, F.lit(f"(?=([^ ]{{{b}}} [^ ]{{{a}}}))"), F.lit(1)) for b, a in kinds]
    if any(e["head"] == "" for e in entries):
        heads.append(F.array(F.lit("")))
    # Only heads that the index has are looked up.
    known = F.from_json(F.lit(json.dumps(sorted({e["head"] for e in entries}))), "array<string>")

    def met(head: Column) -> Column:
        return F.filter(F.get(index, F.pmod(F.crc32(head), F.lit(size)).cast("int")), lambda e: e["head"] == head)

    def holds(entry: Column) -> Column:
        return (
            F.when(entry["check"] == "", F.lit(True))
            .when(entry["check"] == "phrase", lowered.contains(entry["lowered"]))
            .otherwise(lowered.contains(entry["lowered"]) & F.regexp_like(lowered, entry["check"]))
        )

    found = F.filter(F.flatten(F.transform(F.array_intersect(F.concat(*heads), known), met)), holds)
    return F.coalesce(F.when(lowered.isNotNull(), found), F.array().cast(f"array<{KEYWORD}>"))


def matched_keywords(lowered: Column, keywords: Sequence[str]) -> Column:
    """Keywords found in the lower-case text, in configuration order."""
    found = F.array_sort(F.transform(keyword_hits(lowered, [(keywords, ())]), lambda h: F.struct(h["place"].alias("place"), h["shown"].alias("shown"))))
    return F.transform(found, lambda h: h["shown"])
