"""Quality gates and checks; rejected rows become quarantine rows, never vanish."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from billstream.functions.paths import parse_template
from billstream.operators.common import top_per_key


def is_blank(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("")) == ""


def require_field(df: DataFrame, field: str, category: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, quarantine) by a required field that is null or empty."""
    blank = is_blank(F.col(field))
    return df.filter(~blank), df.filter(blank).withColumn("category", F.lit(category))


def session_gate(items: DataFrame, sessions: DataFrame) -> DataFrame:
    """Adds ``gate``: missing_session, unknown_session or pass."""
    known = sessions.select("session_id").distinct().withColumn("_known", F.lit(True))
    return (
        items.join(known, "session_id", "left")
        .withColumn(
            "gate",
            F.when(is_blank(F.col("session_id")), "missing_session")
            .when(F.col("_known").isNull(), "unknown_session")
            .otherwise("pass"),
        )
        .drop("_known")
    )


def dedup_name_quarantine(errors: DataFrame, filed: DataFrame | None = None) -> DataFrame:
    """One error record per (category, name); records without a name all stay.

    ``filed`` are records of earlier runs, whose names are not filed again.
    """
    named = errors.filter(~is_blank(F.col("name")))
    if filed is not None:
        named = named.join(filed.select("category", "name").distinct(), ["category", "name"], "left_anti")
    first = top_per_key(named, ["category", "name"], [F.asc("file_name")], 1)
    return first.unionByName(errors.filter(is_blank(F.col("name"))))


def missing_fields(required: Sequence[str]) -> Column:
    """Names of required fields that are blank."""
    return F.array_compact(F.array(*[F.when(is_blank(F.trim(F.col(f))), F.lit(f)) for f in required]))


# Enum domains of the record types.
VOTE_RESULTS = ["pass", "fail", "tie", "other"]


def outside_domain(value: Column, domain: Sequence[str]) -> Column:
    """True for a value that is set but not in the domain."""
    return value.isNotNull() & ~value.isin(*domain)


def unknown_fields(doc: Column, known: Sequence[str]) -> Column:
    """Top-level JSON keys outside the schema; null for damaged documents."""
    keys = F.json_object_keys(F.when(F.try_parse_json(doc).isNotNull(), doc))
    return F.array_sort(F.array_except(keys, F.array(*[F.lit(k) for k in known])))


def bad_url(url: Column) -> Column:
    return ~F.coalesce(url.rlike(r"^https?://[^\s/?#]+([/?#][^\s]*)?$"), F.lit(False))


def bad_date(value: Column) -> Column:
    return value.isNotNull() & F.try_to_date(value, "yyyy-MM-dd").isNull()


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def coverage(gated: DataFrame, column: str = "gate") -> DataFrame:
    """Rows and share per category."""
    counts = gated.groupBy(column).agg(F.count("*").alias("n"))
    # The window spans the handful of category rows, not the data.
    total = F.sum("n").over(Window.partitionBy())
    return counts.select(column, "n", F.round(F.col("n") / total, 6).alias("share"))


def path_params(df: DataFrame, path: str, template: str, patterns: Mapping[str, str]) -> DataFrame:
    """Template parameters as columns plus ``valid``, each tested by its pattern."""
    values = parse_template(F.col(path), template)
    valid = F.lit(True)
    for name, pattern in patterns.items():
        valid = valid & F.coalesce(values[name].rlike(f"^(?:{pattern})$"), F.lit(False))
    return df.select("*", *[c.alias(n) for n, c in values.items()], valid.alias("valid"))
