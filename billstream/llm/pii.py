"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstream.llm.common import in_arrow, slices, texts_of

#: Kinds that every match of the base patterns belongs to, in the order of the digests.
BASE_KINDS = ("email", "ip", "card", "phone")
#: Kinds found besides them; a span is kept from this score on.
MORE_KINDS = ("iban", "ssn")
LEAST_SCORE = 0.6
#: Characters before a span in which context words count.
CONTEXT_CHARS = 48

# Possessive repeats keep every pattern linear; a run is always taken whole, so they change no match.
# The run of an IBAN may go on into what follows it, so it only proposes; ``_ibans`` finds the end.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9]){15,}+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
WORD_END = re.compile(r"(?<=[A-Z0-9])(?![A-Za-z0-9])")
#: Characters of an IBAN by country (ISO 13616); of several possible ends this one is tried first.
IBAN_CHARS = {
    country: chars
    for chars, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
        25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
        29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items()
    for country in countries.split()
}
SSN = re.compile(r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])")

#: Words that make a kind likelier when they stand just before a span.
CONTEXT = {
    "email": re.compile(r"\b(?:e-?mail|mail|contact|write)\b", re.I),
    "ip": re.compile(r"\b(?:ip|host|server|address)\b", re.I),
    "card": re.compile(r"\b(?:card|credit|visa|mastercard|karte|carte|tarjeta)\b", re.I),
    "phone": re.compile(r"\b(?:phone|tel|call|mobile|telefon|téléphone|teléfono)\b", re.I),
    "iban": re.compile(r"\b(?:iban|bank|account|konto|compte|cuenta)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social|security)\b", re.I),
}
#: Score of a confirmed span without context, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.7, "card": 0.8, "phone": 0.6, "iban": 0.9, "ssn": 0.4}
CONTEXT_BONUS = 0.3


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Only the characters right before an ``@`` can be its local part, so the search goes by ``@``."""
    free, at = 0, text.find("@")
    while at >= 0:
        after = at + 1
        if domain := DOMAIN.match(text, after):
            start = at
            while start > free and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                yield start, domain.end()
                free = after = domain.end()
        at = text.find("@", after)


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """The confirmed end of each proposed run: its country's length, else the last word end that fits.

    The search goes on behind what was confirmed, or at the next word of a run that was not.
    """
    run = IBAN.search(text)
    while run:
        start, after = run.start(), run.start() + 4
        ends = [m.end() for m in WORD_END.finditer(text, start, run.end() + 1) if m.end() <= run.end()]
        fits = [(i, end) for end in ends if len(i := text[start:end].replace(" ", "")) >= 15]
        for iban, end in sorted(fits, key=lambda f: (len(f[0]) == IBAN_CHARS.get(f[0][:2]), len(f[0])), reverse=True):
            if mod97(iban):
                yield start, end
                after = end
                break
        run = IBAN.search(text, after)


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def spans_of(text: str) -> list[tuple[str, int, int, float]]:
    """All spans of a text as kind, start, end (code points), score; by kind, then start."""
    found: list[tuple[str, int, int]] = [("email", *span) for span in _emails(text)]
    if "." in text:
        found += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = _digits(m[0])
        if len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    found += [("iban", *span) for span in _ibans(text)]
    if "-" in text:
        found += [("ssn", *m.span()) for m in SSN.finditer(text)]
    scored = []
    for kind, start, end in found:
        near = CONTEXT[kind].search(text[max(0, start - CONTEXT_CHARS) : start])
        score = min(1.0, SCORES[kind] + (CONTEXT_BONUS if near else 0))
        if kind in BASE_KINDS or score >= LEAST_SCORE:
            scored.append((kind, start, end, score))
    return scored


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])


def _find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ("kind", "start", "end", "score")
    for part in slices(batches):
        found = [[dict(zip(names, s)) for s in spans_of(t)] for t in part["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([part["doc_id"], pa.array(found, pa.list_(SPAN))], ["doc_id", "spans"])


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``spans`` of every row, whole texts.

    Null and empty texts have no span. Each row stands for itself: repeated rows and null ids stay,
    an empty table gives none, further columns are ignored.
    """
    return in_arrow(
        texts_of(docs), _find, "doc_id long, spans array<struct<kind:string,start:long,end:long,score:double>>"
    )


def _redacted(text: str | None) -> str | None:
    if not text:
        return text
    out, done = [], 0
    for kind, start, end, _ in sorted(spans_of(text), key=lambda s: (s[1], -s[2])):
        if end <= done:
            continue
        # A span that overlaps the one before it lengthens that one's mark.
        if start >= done:
            out += [text[done:start], f"[{kind.upper()}]"]
        done = end
    return "".join([*out, text[done:]]) if done else text


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        at = part.schema.get_field_index("text")
        yield part.set_column(at, part.schema.field(at), pa.array([_redacted(t) for t in part["text"].to_pylist()], part.schema.field(at).type))


def redact_pii(docs: DataFrame) -> DataFrame:
    """The same rows and columns with every span replaced by its kind in brackets.

    Null text stays null. A column ``n_chars``, if there is one, counts the new text.
    """
    done = in_arrow(docs, _redact, docs.schema)
    if isinstance(docs.schema["n_chars"].dataType if "n_chars" in docs.columns else None, T.IntegralType):
        done = done.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(docs.schema["n_chars"].dataType))
    return done


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op2_pii(spark, sf_dir: str) -> DataFrame:
    found = find_pii(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    base = F.filter("spans", lambda s: s.kind.isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, BASE_KINDS),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )
