"""Orphans and waiting hearings in Spark's state store.

A run is one start of the stream on its checkpoint: it takes what came since the run before, as one
micro-batch, and ends. State is kept for buckets of bills, changes only where a bucket has input, and
goes when the bill arrives, so its size follows what is open. What a run changed is written to a folder of its own
in overwrite mode; the open entries are read from the state store itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billstream.operators.common import top_per_key
from billstream.operators.links import bill_entities
from billstream.streaming.processors import HearingWaiter, OrphanTracker

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
#: The store that keyed state with several variables and removal needs.
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

#: Keys of the state: bills share one by the hash of their id. Fixed for the life of a checkpoint.
BUCKETS = 1 << 14


def _run(rows: DataFrame, processor, schema: str, table: str, checkpoint: str) -> None:
    spark = rows.sparkSession
    bucket = F.pmod(F.xxhash64("bill_id"), F.lit(BUCKETS)).alias("bucket")
    out = rows.select(bucket, "*").groupBy("bucket").transformWithState(processor, outputStructType=schema, outputMode="Update", timeMode="None")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        started = (
            out.writeStream.foreachBatch(write)
            .outputMode("update")
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
    finally:
        # A stream keeps the settings it was started with.
        spark.conf.unset(PROVIDER) if before is None else spark.conf.set(PROVIDER, before)
    started.awaitTermination()


def _state(spark: SparkSession, checkpoint: str, variable: str) -> DataFrame:
    return spark.read.format("statestore").option("stateVarName", variable).load(checkpoint)


# -- orphans -----------------------------------------------------------------------------


def track_orphans(stream: DataFrame, known: DataFrame, run: int, table: str, checkpoint: str) -> None:
    """One run over new rows ``kind`` (vote, event, bill), ``bill_id``.

    ``known`` are the bills that earlier runs brought: votes and hearings for them are no orphans and
    never reach the state. Bills of this run come in the stream, in any order.
    """
    rows = stream.select("bill_id", "kind", F.lit(run).alias("run"))
    named = rows.filter(F.col("kind") != "bill").join(known.select("bill_id").distinct(), "bill_id", "left_anti")
    _run(named.unionByName(rows.filter(F.col("kind") == "bill")), OrphanTracker(), OrphanTracker.CHANGES, table, checkpoint)


def open_orphans(spark: SparkSession, checkpoint: str, run: int, label: Callable[[Column], Column]) -> DataFrame:
    """Orphans after a run, as the batch form has them; ``label`` names a run by its number."""
    return _state(spark, checkpoint, "orphan").select(
        F.col("user_map_key.bill_id").alias("bill_id"),
        label(F.col("user_map_value.first_run")).alias("first_seen"),
        label(F.lit(run)).alias("last_seen"),
        (F.lit(run) - F.col("user_map_value.first_run") + 1).cast("bigint").alias("occurrence_count"),
        F.col("user_map_value.vote_count").alias("vote_count"),
        F.col("user_map_value.event_count").alias("event_count"),
    )


def orphan_changes(spark: SparkSession, table: str) -> DataFrame:
    """What each run opened, saw again and resolved."""
    return spark.read.schema(f"{OrphanTracker.CHANGES}, batch BIGINT").parquet(table)


# -- hearings ----------------------------------------------------------------------------


def link_hearings(agenda: DataFrame, arrived: DataFrame, known: DataFrame, run: int, table: str, checkpoint: str) -> None:
    """One run over two streams: new agenda rows, and bills that arrive with their session.

    ``known`` (bill_id, session_id, date_folder) are the bills of earlier runs. An agenda row links at
    once if its bill is known, else it waits and a later run's bill wakes it.
    """
    sessions = known.select("bill_id", "session_id", "date_folder")
    named = bill_entities(agenda).join(sessions, "bill_id", "left").select(
        "bill_id", F.lit("agenda").alias("kind"), F.col("event_id").cast("bigint").alias("event_id"), F.col("pos").cast("int").alias("pos"),
        "session_id", "date_folder", F.lit(run).alias("run"),
    )
    bills = arrived.select(
        "bill_id", F.lit("bill").alias("kind"), F.lit(None).cast("bigint").alias("event_id"), F.lit(None).cast("int").alias("pos"),
        "session_id", "date_folder", F.lit(run).alias("run"),
    )
    _run(named.unionByName(bills), HearingWaiter(), HearingWaiter.LINKS, table, checkpoint)


def linked_hearings(spark: SparkSession, table: str) -> DataFrame:
    """One row per linked hearing: the first run that resolved a bill, and its first bill there.

    ``cleared`` tells that the hearing had been recorded under ``missing_session`` by an earlier run;
    the link takes that record away.
    """
    links = spark.read.schema(f"{HearingWaiter.LINKS}, batch BIGINT").parquet(table).drop("batch")
    first = top_per_key(links, ["event_id"], [F.asc("run"), F.asc("pos"), F.asc("bill_id")], 1)
    return first.withColumn("cleared", F.col("since") < F.col("run")).drop("since")


def missing_sessions(spark: SparkSession, table: str, checkpoint: str) -> DataFrame:
    """Hearings that wait for all bills they name: the ``missing_session`` records that stand."""
    waiting = _state(spark, checkpoint, "waiting").select("list_element.*")
    waiting = waiting.select(F.inline(F.arrays_zip("bill_id", "event_id", "pos", "since")))
    # A row that came again counts with its last run.
    waiting = waiting.groupBy("bill_id", "event_id", "pos").agg(F.max("since").alias("since"))
    links = spark.read.schema(HearingWaiter.LINKS).parquet(table).select("event_id").distinct()
    return waiting.groupBy("event_id").agg(F.min("since").alias("since")).join(links, "event_id", "left_anti")
