"""Texts of a log entry ``(id, log, bill, tags, sources, timestamp)``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billstream.functions.variants import bound, items, members


def _labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label), value)


def _bullets(label: str, values: Column, indent: str) -> Column:
    return F.when(
        F.size(values) > 0, F.concat(F.lit(f"{label}:{indent}"), F.array_join(values, indent))
    )


def _section(head: str, indent: str, parts: list[Column]) -> Column:
    body = F.concat_ws(indent, *parts)
    return F.when(body != "", F.concat(F.lit(head), body))


def extract_text(log: Column, bill: Column, extra: Column | None = None) -> Column:
    """Readable text used by the tagger; ``extra`` is a map of further text fields."""
    abstracts = F.array_join(
        F.transform(bill["abstracts"], lambda a: F.concat_ws(" ", a["abstract"], a["note"])), " "
    )
    parts = [
        bill["title"],
        F.array_join(bill["subject"], " "),
        abstracts,
        bill["legislative_session"],
        bill["from_organization"],
        log["action"]["description"],
        log["bill_id"],
    ]
    if extra is not None:
        # Names are sorted so that the text does not depend on map order.
        pairs = F.array_sort(F.map_entries(extra))
        parts.append(F.array_join(F.transform(pairs, lambda p: p["value"]), " "))
    return F.concat_ws(" ", *parts)


# -- open JSON -----------------------------------------------------------------------

# Parts of an object that are read by name, and keys the rest leaves out.
BILL_TEXTS = (("title", False), ("subject", True), ("abstracts", True), ("legislative_session", False), ("from_organization", False))
DENIED_KEYS = (
    "id", "sources", "timestamp", "bill", "log", "title", "action", "subjects", "abstracts", "legislative_session", "from_organization",
)
NODE = "struct<value:variant,text:string>"


def _holds_more(value: Column) -> Column:
    return members(value).isNotNull() | items(value).isNotNull()


def _string(value: Column) -> Column:
    """The value of a JSON string, null for anything else."""
    return F.when(~_holds_more(value) & (F.schema_of_variant(value) == "STRING"), F.try_variant_get(value, "$", "string"))


def _leaf(text: Column) -> Column:
    return F.struct(F.lit(None).cast("variant").alias("value"), text.alias("text"))


def _node(value: Column) -> Column:
    return F.struct(value.alias("value"), F.lit(None).cast("string").alias("text"))


def _no_nodes() -> Column:
    return F.array().cast(f"array<{NODE}>")


def _leaf_if(text: Column) -> Column:
    return F.coalesce(F.when(text.isNotNull(), F.array(_leaf(text))), _no_nodes())


def _text_at(own: Column, key: str) -> Column:
    return bound(_string(F.try_element_at(own, F.lit(key))), _leaf_if)


def _anything_at(own: Column, key: str) -> Column:
    value = F.try_element_at(own, F.lit(key))
    there = F.coalesce(F.map_contains_key(own, key), F.lit(False))
    # A JSON null is there, but has no text.
    return F.when(there, F.array(F.when(value.isNull(), _leaf(F.lit(""))).otherwise(_node(value)))).otherwise(_no_nodes())


def _action_at(own: Column) -> Column:
    action = F.try_element_at(own, F.lit("action"))
    return F.concat(_text_at(members(action), "description"), _text_at(own, "action"))


def _of_object(own: Column) -> Column:
    """What an object is made of, in reading order: bill, log, action, then all keys that are not denied."""

    def parts(m: Column, bill: Column, log: Column) -> Column:
        bill_id = F.when(F.map_contains_key(log, "bill_id"), _text_at(log, "bill_id")).otherwise(_text_at(log, "bill_identifier"))
        open_keys = F.filter(
            F.array_sort(F.map_keys(m)), lambda k: ~k.startswith("_") & ~k.isin(*DENIED_KEYS) & F.try_element_at(m, k).isNotNull()
        )
        others = F.transform(
            open_keys,
            lambda k: bound(
                F.try_element_at(m, k),
                lambda v: F.when(_holds_more(v), F.array(_node(v))).otherwise(bound(_string(v), _leaf_if)),
            ),
        )
        named = [_anything_at(bill, k) if whole else _text_at(bill, k) for k, whole in BILL_TEXTS]
        return F.concat(*named, _action_at(log), bill_id, _action_at(m), F.flatten(others))

    sub = lambda key: members(F.try_element_at(own, F.lit(key)))
    whole = F.struct(own.alias("m"), sub("bill").alias("bill"), sub("log").alias("log"))
    return bound(whole, lambda x: parts(x["m"], x["bill"], x["log"]))


def _opened(node: Column) -> Column:
    """A node one level deeper; what holds no text at all is one empty text."""
    value = node["value"]

    def filled(nodes: Column) -> Column:
        return bound(nodes, lambda n: F.when(F.size(n) > 0, n).otherwise(F.array(_leaf(F.lit("")))))

    def children(kinds: Column) -> Column:
        return (
            F.when(kinds["items"].isNotNull(), filled(F.transform(kinds["items"], lambda x: F.when(x.isNull(), _leaf(F.lit(""))).otherwise(_node(x)))))
            .when(kinds["members"].isNotNull(), filled(bound(kinds["members"], _of_object)))
            .otherwise(F.array(_leaf(F.coalesce(_string(value), F.lit("")))))
        )

    kinds = F.struct(items(value).alias("items"), members(value).alias("members"))
    return F.when(node["text"].isNotNull(), F.array(node)).otherwise(bound(kinds, children))


def select_text(value: Column) -> Column:
    """Readable text of any JSON value (``VARIANT``), however deep.

    Strings are themselves and arrays their members in order. An object gives the named texts of its
    ``bill``, its ``log`` and its ``action``, then those of all keys that are not denied, by key;
    nested values alike. Everything is joined by one blank; what holds no text leaves an empty place
    between two blanks, except other scalars of an object, which are left out. Null gives null.

    The walk opens all nodes of a row level by level within that row, so there is one expression for
    every depth, no explode and no shuffle. Levels are at most as many as there are brackets; once
    nothing is left to open, the remaining rounds hand the texts on.
    """
    rounds = F.length(F.regexp_replace(F.to_json(value), "[^\\[{]+", "")) + 1
    start = F.struct(F.array(_node(value)).alias("nodes"), F.lit(True).alias("open"))

    def step(state: Column, _: Column) -> Column:
        opened = F.flatten(F.transform(state["nodes"], _opened))
        after = bound(opened, lambda n: F.struct(n.alias("nodes"), F.exists(n, lambda x: x["text"].isNull()).alias("open")))
        return F.when(state["open"], after).otherwise(state)

    texts = F.aggregate(F.sequence(F.lit(1), rounds), start, step, lambda s: F.transform(s["nodes"], lambda n: n["text"]))
    return F.when(value.isNotNull(), F.array_join(texts, " "))


def repo_name(sources: Column) -> Column:
    source = F.coalesce(sources["log"], sources["bill"])
    return F.coalesce(F.split_part(source, F.lit("/"), F.lit(1)), F.lit("unknown"))


def guid(sources: Column, timestamp: Column, ident: Column, log: Column) -> Column:
    made = F.concat(
        F.coalesce(timestamp, F.lit("")),
        F.lit("_"),
        F.coalesce(ident, log["bill_id"], F.lit("")),
    )
    return F.coalesce(sources["log"], made)


def item_title(ident: Column, log: Column, bill: Column, tags: Column, sources: Column) -> Column:
    names = F.array_join(F.array_sort(F.map_keys(tags)), ", ")
    title = F.coalesce(
        F.nullif(F.trim(bill["title"]), F.lit("")),
        ident,
        log["bill_id"],
        F.lit("Legislative Update"),
    )
    return F.concat_ws(
        " - ", F.coalesce(F.nullif(names, F.lit("")), F.lit("untagged")), repo_name(sources), title
    )


def item_description(ident: Column, log: Column, bill: Column) -> Column:
    action = log["action"]
    action_part = _section(
        "  action:\n    ",
        "\n    ",
        [
            _labelled("description: ", action["description"]),
            _labelled("date: ", action["date"]),
            _bullets("classification", action["classification"], "\n      - "),
            _labelled("organization_id: ", action["organization_id"]),
        ],
    )
    log_part = _section("log:\n", "\n", [action_part, _labelled("  bill_id: ", log["bill_id"])])
    abstracts = F.transform(
        bill["abstracts"],
        lambda a: F.when(
            F.coalesce(a["note"], F.lit("")) != "",
            F.concat(F.lit("abstract ("), a["note"], F.lit("): "), a["abstract"]),
        ).otherwise(F.concat(F.lit("abstract: "), a["abstract"])),
    )
    bill_part = _section(
        "bill:\n  ",
        "\n  ",
        [
            _labelled("identifier: ", bill["identifier"]),
            _labelled("title: ", bill["title"]),
            _labelled("legislative_session: ", bill["legislative_session"]),
            _bullets("subject", bill["subject"], "\n    - "),
            F.nullif(F.array_join(abstracts, "\n  "), F.lit("")),
        ],
    )
    text = F.concat_ws("\n\n", _labelled("id: ", ident), log_part, bill_part)
    return F.coalesce(F.nullif(text, F.lit("")), F.lit("Legislative update"))


def item_link(sources: Column, bill_source_url: Column, base: Column) -> Column:
    joined = F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), sources["bill"])
    return F.coalesce(joined, bill_source_url)
