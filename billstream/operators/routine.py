"""Removal of routine entries by locale rules.

Rules are rows, not code: one row is a conjunction of tests, the rows of a
locale are alternatives. The filter is one left-anti join on the locale, so no
plan grows with the number of locales, and Catalyst runs it before the joins to
bills and tags because it reads log columns only.
"""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billstream.rules.routine_values import DENIED_CLASSES, DENIED_PHRASES

RULE_SCHEMA = (
    "locale STRING, deny_class STRING, equals STRING, prefix STRING, "
    "contains ARRAY<STRING>, shorter_than INT"
)
RULE_ARROW = pa.schema(
    [
        ("locale", pa.string()),
        ("deny_class", pa.string()),
        ("equals", pa.string()),
        ("prefix", pa.string()),
        ("contains", pa.list_(pa.string())),
        ("shorter_than", pa.int32()),
    ]
)


def builtin_rules(spark: SparkSession) -> DataFrame:
    rows = [
        {"locale": loc, "deny_class": cls} for loc, classes in DENIED_CLASSES.items() for cls in classes
    ]
    rows += [{"locale": loc, **r} for loc, phrases in DENIED_PHRASES.items() for r in phrases]
    # An Arrow table becomes a local relation, so the planner knows its size.
    return spark.createDataFrame(pa.Table.from_pylist(rows, schema=RULE_ARROW))


def load_rules(spark: SparkSession, path: str) -> DataFrame:
    """Rules of further locales from JSON lines in the rule schema."""
    return spark.read.schema(RULE_SCHEMA).json(path)


def _holds(test: Column, given: Column) -> Column:
    return given.isNull() | test


def routine_filter(
    logs: DataFrame,
    rules: DataFrame | None = None,
    alias: str = "default",
    locale: str = "locale",
    description: str = "description",
    classes: str = "classes",
) -> DataFrame:
    """Entries no rule of their locale denies; unknown locales keep everything."""
    if alias.lower() == "none":
        return logs
    # The built-in table has a fixed size; for a table passed in the choice is left to its statistics.
    small = rules if rules is not None else F.broadcast(builtin_rules(logs.sparkSession))
    r = small.select(F.col("locale").alias("_locale"), "deny_class", "equals", "prefix", "shorter_than", "contains")
    text = F.col(description)
    match = (
        (F.col(locale) == F.col("_locale"))
        & _holds(F.array_contains(F.col(classes), F.col("deny_class")), F.col("deny_class"))
        & _holds(text == F.col("equals"), F.col("equals"))
        & _holds(F.startswith(text, F.col("prefix")), F.col("prefix"))
        & _holds(F.octet_length(text) < F.col("shorter_than"), F.col("shorter_than"))
    )
    match = match & _holds(F.forall("contains", lambda part: F.contains(text, part)), F.col("contains"))
    # An entry without a description only ever meets class rules.
    match = match & (F.col("deny_class").isNotNull() | text.isNotNull())
    return logs.join(r, match, "left_anti")


# -- single tests -----------------------------------------------------------------


def denied_class(classes: Column, deny: Iterable[str]) -> Column:
    return F.arrays_overlap(classes, F.array(*[F.lit(d) for d in deny]))


def equals_any(text: Column, values: Iterable[str]) -> Column:
    return text.isin(*values)


def _any(tests: list[Column]) -> Column:
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def prefix_any(text: Column, values: Iterable[str]) -> Column:
    return _any([text.startswith(v) for v in values])


def contains_any(text: Column, values: Iterable[str]) -> Column:
    return _any([text.contains(v) for v in values])


def conjunction(text: Column, prefix: str = "", any_of: Iterable[str] = (), shorter_than: int | None = None) -> Column:
    """Prefix and (one of several substrings) and a byte length bound."""
    test = text.startswith(prefix)
    if any_of:
        test = test & contains_any(text, any_of)
    if shorter_than is not None:
        test = test & (F.octet_length(text) < shorter_than)
    return test


def keep_unless(test: Column) -> Column:
    """Deny tests that cannot be decided keep the entry."""
    return ~F.coalesce(test, F.lit(False))
