"""Counts, histograms and activity groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstream.functions.text import human_size


def record_kind(file_name: Column) -> Column:
    """Record type by file name; the first hit wins in this order."""
    return (
        F.when(file_name.contains("bill_"), "bill")
        .when(file_name.contains("vote_event"), "vote_event")
        .when(file_name.contains("event"), "event")
        .otherwise("unrecognised")
    )


def run_counts(files: DataFrame) -> DataFrame:
    """One row: bills, vote events and events handled by a run."""
    kind = record_kind(F.col("file_name"))
    return files.agg(
        F.count_if(kind == "bill").alias("bills"),
        F.count_if(kind == "vote_event").alias("vote_events"),
        F.count_if(kind == "event").alias("events"),
    )


def count_by(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def classification_histogram(actions: DataFrame, classes: str = "classes") -> DataFrame:
    return (
        actions.select(F.explode(classes).alias("classification"))
        .groupBy("classification")
        .agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), F.asc("classification"))
    )


def same_stamp_groups(actions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once; only counts are shuffled by key first."""
    repeated = actions.groupBy(*keys).agg(F.count("*").alias("group_size")).filter("group_size > 1")
    return actions.join(repeated, list(keys))


def tag_histogram(bill_tags: DataFrame) -> DataFrame:
    return (
        bill_tags.select("tag", "bill_id").distinct().groupBy("tag").agg(F.count("*").alias("bills"))
    )


def vote_counts(ballots: DataFrame) -> DataFrame:
    return ballots.groupBy("vote_id", "opt").agg(F.count("*").alias("n"))


def reconcile_counts(ballots: DataFrame, stated: DataFrame) -> DataFrame:
    """Stated counts that differ from the single votes."""
    return (
        vote_counts(ballots)
        .withColumnRenamed("n", "counted")
        .join(stated.select("vote_id", "opt", F.col("value").cast("bigint").alias("stated")), ["vote_id", "opt"], "full_outer")
        .filter(F.coalesce("counted", F.lit(0)) != F.coalesce("stated", F.lit(0)))
    )


def footprint(files: DataFrame, key: str, size: str) -> DataFrame:
    return files.groupBy(key).agg(F.sum(size).cast("bigint").alias("bytes")).withColumn(
        "size_text", human_size(F.col("bytes"))
    )


def snapshot_manifest(files: DataFrame, key: str, content: str, depth: int = 2) -> DataFrame:
    """Count of files and one digest per snapshot.

    Digests are combined in a tree over pairs of leading hex digits, so no task holds
    all digests of a large snapshot. ``depth`` is the number of levels and part of the
    manifest format; every level splits a snapshot by 256.
    """

    def combine(df: DataFrame, *keys: str) -> DataFrame:
        joined = F.array_join(F.array_sort(F.collect_list("digest")), "")
        return df.groupBy(*keys).agg(F.sha2(joined, 256).alias("digest"), F.sum("n").alias("n"))

    leaves = files.select(key, F.sha2(content, 256).alias("digest"), F.lit(1).cast("bigint").alias("n"))
    parts = [f"part{i}" for i in range(depth)]
    level = leaves.withColumns({p: F.substring("digest", 2 * i + 1, 2) for i, p in enumerate(parts)})
    for n in range(depth, 0, -1):
        level = combine(level, key, *parts[:n])
    return combine(level, key).select(key, F.col("n").alias("files"), F.col("digest").alias("sha256"))


def latest_run(runs: DataFrame, slow_minutes: int = 40) -> DataFrame:
    """Latest run per repository with its duration and a flag for slow ones."""
    newest = runs.groupBy("repo").agg(
        F.max_by(
            F.struct("run_id", "started_at", "updated_at", "conclusion"), F.struct("started_at", "run_id")
        ).alias("r")
    )
    seconds = F.unix_seconds(F.col("r.updated_at").cast("timestamp")) - F.unix_seconds(
        F.col("r.started_at").cast("timestamp")
    )
    minutes = F.floor(seconds / 60).cast("bigint")
    return newest.select(
        "repo", "r.run_id", "r.conclusion", minutes.alias("minutes"), (minutes > slow_minutes).alias("slow")
    )
