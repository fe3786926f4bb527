"""File names of action, vote and event logs, and the keys inside them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from billstream.functions.stamps import stamp_or_unknown
from billstream.functions.text import clean_event_name, slugify

# Classifications that get a name form of their own.
TRACKED_CLASSIFICATIONS = ["introduction", "passage", "executive-receipt", "became-law"]


def org_class(org: Column) -> Column:
    """Chamber inside ``~{"classification": "upper"}``; ``unknown`` if absent or broken."""
    chamber = F.get_json_object(F.regexp_replace(org, "^~+|~+$", ""), "$.classification")
    return F.coalesce(chamber, F.lit("unknown"))


def action_key(description: Column, date: Column) -> Column:
    return F.concat(
        F.coalesce(description, F.lit("")), F.lit("|"), F.coalesce(date, F.lit(""))
    )


def action_log_name(date: Column, classes: Column, org: Column, description: Column) -> Column:
    first = F.get(classes, F.lit(0))
    named = F.concat(F.lit(".classification."), first, F.lit("."), org_class(org))
    plain = F.concat(F.lit("_"), slugify(F.coalesce(description, F.lit("no_description"))))
    tail = F.when(first.isin(TRACKED_CLASSIFICATIONS), named).otherwise(plain)
    return F.concat(stamp_or_unknown(date), tail, F.lit(".json"))


def vote_log_name(date: Column, result: Column, org: Column) -> Column:
    result = F.coalesce(result, F.lit("unknown"))
    passed = F.concat(F.lit(".vote_event.pass."), org_class(org))
    other = F.concat(F.lit("_vote_event_"), slugify(result))
    tail = F.when(result == "pass", passed).otherwise(other)
    return F.concat(stamp_or_unknown(date), tail, F.lit(".json"))


def event_log_name(date: Column, name: Column) -> Column:
    return F.concat(stamp_or_unknown(date), F.lit("_"), clean_event_name(name), F.lit(".json"))
