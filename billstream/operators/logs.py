"""Log entries: scans, projection, joins to bills and tags, order and limits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstream.functions import paths as P
from billstream.functions.nested import json_field
from billstream.operators.common import top_per_key


# -- scans over path columns -------------------------------------------------


def scan_log_tree(files: DataFrame, repos: Sequence[str] | None = None) -> DataFrame:
    """JSON files under any ``/logs/``; ``repos`` prunes roots before anything is read."""
    if repos is not None:
        files = files.filter(F.col("repo").isin(list(repos)))
    return files.filter(P.is_log_json(F.col("path"))).withColumn(
        "log_ts", P.path_stamp_strict(F.col("path"))
    )


def scan_path_list(listed: DataFrame, files: DataFrame, root: str) -> DataFrame:
    """Files named by a list of paths; entries that are no JSON logs are dropped."""
    kept = listed.filter(P.is_log_json(F.col("path")))
    return (
        kept.join(files, "path")
        .withColumn("relative", P.relative_path(F.col("path"), root))
        .withColumn("log_ts", P.path_stamp_strict(F.col("path")))
    )


def scan_session_logs(files: DataFrame) -> DataFrame:
    path = F.col("path")
    return files.filter(P.is_session_log(path)).select(
        "*",
        P.country_of(path).alias("country"),
        P.state_of(path).alias("state"),
        P.session_of(path).alias("session_id"),
    )


def select_repos(files: DataFrame, locales: Sequence[str] | str | DataFrame = "all") -> DataFrame:
    """``all``, a list of locales, or a table of them; each form can prune partitions."""
    if isinstance(locales, DataFrame):
        return files.join(locales.select("locale").distinct(), "locale", "left_semi")
    if locales == "all" or list(locales) == ["all"]:
        return files
    return files.filter(F.col("locale").isin(list(locales)))


def missing_repos(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """Requested locales without data, for the warning list."""
    return wanted.join(files.select("locale").distinct(), "locale", "left_anti")


def available_locales(repos: DataFrame, suffix: str = "-legislation") -> DataFrame:
    """Locale names from repository names, current suffix first, then the old one."""
    old = "-data-pipeline"
    repo = F.col("repo")
    locale = F.when(repo.endswith(suffix), F.expr(f"left(repo, length(repo) - {len(suffix)})")).when(
        repo.endswith(old), F.expr(f"left(repo, length(repo) - {len(old)})")
    )
    return repos.select(locale.alias("locale")).filter(F.col("locale").isNotNull()).distinct()


# -- projection ---------------------------------------------------------------


def select_default(entries: DataFrame) -> DataFrame:
    """The fixed nested shape of a log entry; other fields are never read."""
    return entries.select(
        F.col("bill_id").alias("id"),
        F.struct("action", "bill_id").alias("log"),
        F.struct(
            "bill.title",
            "bill.abstracts",
            "bill.subject",
            "bill.identifier",
            "bill.legislative_session",
            "bill.from_organization",
        ).alias("bill"),
        "tags",
        "sources",
        "timestamp",
    )


def join_field(doc: Column, spec: str) -> Column:
    """``bill.a.b.0`` names a dataset and a dotted path inside its document."""
    dataset, _, path = spec.partition(".")
    if not path:
        raise ValueError(f"join spec {spec!r} names no field")
    return json_field(doc, path).alias(spec)


# -- joins ----------------------------------------------------------------------


def join_bill(logs: DataFrame, bills: DataFrame, keys: Sequence[str] = ("state", "session_id", "bill_id")) -> DataFrame:
    """Left outer: a log without its bill stays, with a null bill."""
    return logs.join(bills, list(keys), "left")


def join_bill_few(few: DataFrame, bills: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``join_bill`` for a result of bounded size, such as a feed.

    The few keys cut the bills down first; their size is known at run time, so
    adaptive execution broadcasts them and whole bills never shuffle.
    """
    wanted = few.select(*keys).distinct()
    return join_bill(few, bills.join(wanted, list(keys), "left_semi"), keys)


#: A bill id is unique within a session only.
BILL_KEY = ("session_id", "bill_id")


def nest_tags(bill_tags: DataFrame, keys: Sequence[str] = BILL_KEY) -> DataFrame:
    """One row per bill with a map of tags to their best score, tag names sorted."""
    best = bill_tags.filter(F.col("tag").isNotNull()).groupBy(*keys, "tag").agg(F.max("score").alias("score"))
    pairs = F.array_sort(F.collect_list(F.struct("tag", "score")))
    return best.groupBy(*keys).agg(F.map_from_entries(pairs).alias("tags"))


def join_tags(logs: DataFrame, bill_tags: DataFrame, keys: Sequence[str] = BILL_KEY) -> DataFrame:
    return logs.join(nest_tags(bill_tags, keys), list(keys), "left")


JOINABLE = ("bill", "tags")


def parse_join_specs(option: str) -> tuple[list[str], list[str]]:
    """``bill,tags`` to (known, ignored) dataset names."""
    names = [s.strip() for s in option.split(",") if s.strip()]
    return [n for n in names if n in JOINABLE], [n for n in names if n not in JOINABLE]


def join_multi(
    logs: DataFrame,
    option: str,
    bills: DataFrame,
    bill_tags: DataFrame,
    bill_keys: Sequence[str] = ("state", *BILL_KEY),
    tag_keys: Sequence[str] = BILL_KEY,
) -> DataFrame:
    """Apply the named joins in the order given; unknown names are ignored."""
    for name in parse_join_specs(option)[0]:
        if name == "bill":
            logs = join_bill(logs, bills, bill_keys)
        else:
            logs = join_tags(logs, bill_tags, tag_keys)
    return logs


def tag_filter(logs: DataFrame, bill_tags: DataFrame, names: Sequence[str] = (), keys: Sequence[str] = BILL_KEY) -> DataFrame:
    """Entries with at least one tag, or with one of ``names``."""
    if names:
        bill_tags = bill_tags.filter(F.col("tag").isin(list(names)))
    return logs.join(bill_tags.select(*keys).distinct(), list(keys), "left_semi")


# -- order, limits, de-duplication ------------------------------------------------


def newest_first(ts: str = "log_ts", path: str = "path") -> list[Column]:
    return [F.desc_nulls_last(ts), F.asc(path)]


def sort_logs(logs: DataFrame, descending: bool = True) -> DataFrame:
    order = F.desc_nulls_last("log_ts") if descending else F.asc_nulls_last("log_ts")
    return logs.orderBy(order, F.asc("path"))


def per_repo_limit(logs: DataFrame, limit: int | None = 100, tie: Sequence[str] = ()) -> DataFrame:
    if limit is None:
        return logs
    return top_per_key(logs, ["repo"], [*newest_first(), *[F.asc(c) for c in tie]], limit)


def dedup_guid(entries: DataFrame, order: Sequence[Column], guid: str = "guid") -> DataFrame:
    """First entry per guid in input order."""
    return top_per_key(entries, [guid], order, 1)


def fresh_or_fallback(fresh: DataFrame, fallback: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per partition the fresh snapshot if there is one, else the fallback."""
    have = fresh.select(*keys).distinct()
    return fresh.withColumn("origin", F.lit("fresh")).unionByName(
        fallback.join(have, list(keys), "left_anti").withColumn("origin", F.lit("fallback"))
    )


def flat_log_names(files: DataFrame) -> DataFrame:
    """Names for one folder per session: later users of a name get their bill id appended."""
    one = files.select("session_id", "bill_id", "name").distinct()
    owner = one.groupBy("session_id", "name").agg(F.min("bill_id").alias("owner"))
    ext = F.regexp_extract("name", r"(\.[^.]*)$", 1)
    stem = F.left("name", F.length("name") - F.length(ext))
    return (
        one.join(owner, ["session_id", "name"])
        .withColumn(
            "flat_name",
            F.when(F.col("bill_id") == F.col("owner"), F.col("name")).otherwise(
                F.concat(stem, F.lit("_"), F.col("bill_id"), ext)
            ),
        )
        .drop("owner")
    )
