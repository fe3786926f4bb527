"""Streams over file sources; every job can be rerun and survives lost executors.

State sits in Spark's checkpoint and in tables of the shared state folder. A
batch writes to its own sub-folder in overwrite mode, so a repeated batch
replaces its earlier attempt.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstream.operators.common import top_per_key
from billstream.session import state_dir

Plan = Callable[[DataFrame], DataFrame]


def read_table_stream(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Stream over the files of a table; a file is read once."""
    schema = spark.read.format(fmt).load(path).schema
    # The file source wants a pattern where the table is one file.
    return spark.readStream.schema(schema).format(fmt).load(f"{path[:-1]}[{path[-1]}]")


def read_json_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return (
        spark.readStream.schema(schema)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .json(folder)
        .withColumn("path", F.col("_metadata.file_path"))
    )


def _folders(spark: SparkSession, folder: str | None) -> tuple[str, str]:
    root = folder or state_dir(spark, f"stream-{uuid.uuid4().hex}")
    return f"{root}/checkpoint", f"{root}/table"


def append_to_table(stream: DataFrame, table: str, checkpoint: str):
    """Append-only sink; the file sink's own log makes it exactly-once."""
    return (
        stream.writeStream.format("parquet")
        .option("path", table)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def upsert_to_table(stream: DataFrame, table: str, checkpoint: str):
    """Keyed updates: each batch is one folder, the newest batch of a key counts."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def latest_rows(spark: SparkSession, table: str, keys: Sequence[str]) -> DataFrame:
    """Current rows of an upsert table."""
    rows = spark.read.parquet(table)
    return top_per_key(rows, keys, [F.desc("batch")], 1).drop("batch")


def run_append(spark: SparkSession, source: str, plan: Plan, folder: str | None = None) -> DataFrame:
    """Run a stream over all files that are new to ``folder`` and return the table it wrote.

    A later run on the same folder takes up where the last one ended; without one all is new.
    """
    checkpoint, table = _folders(spark, folder)
    append_to_table(plan(read_table_stream(spark, source)), table, checkpoint).awaitTermination()
    return spark.read.parquet(table)


def run_upsert(spark: SparkSession, source: str, plan: Plan, keys: Sequence[str], folder: str | None = None) -> DataFrame:
    """The same for keyed updates."""
    checkpoint, table = _folders(spark, folder)
    upsert_to_table(plan(read_table_stream(spark, source)), table, checkpoint).awaitTermination()
    return latest_rows(spark, table, keys)


# -- plans -------------------------------------------------------------------------------


def dedup_within(stream: DataFrame, guid: str, ts: str, delay: str) -> DataFrame:
    """First entry per guid; the watermark bounds the state."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([guid])


def daily_counts(stream: DataFrame, key: str, ts: str, delay: str) -> DataFrame:
    counts = (
        stream.withWatermark(ts, delay).groupBy(F.window(ts, "1 day"), key).agg(F.count("*").alias("n"))
    )
    return counts.select(key, F.date_format("window.start", "yyyy-MM-dd").alias("day"), "n")


# -- persisted marks -----------------------------------------------------------------------


def take_newer(stream: DataFrame, marks_table: str, accepted_table: str, checkpoint: str, ts: str = "ts"):
    """Mark-driven intake: each batch is filtered by the marks of the batches before it.

    The mark is a constant of the run, not an event-time watermark, so it is read
    once per batch. Batch ``n`` reads the marks of batches below ``n`` only, which
    makes a repeated batch give the same result.
    """

    def intake(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = _marks_before(spark, marks_table, batch_id)
        new = batch.join(marks, "category", "left").filter(
            F.col("mark").isNull() | (F.col(ts) > F.col("mark"))
        ).drop("mark")
        new.write.mode("overwrite").parquet(f"{accepted_table}/batch={batch_id}")
        accepted = spark.read.parquet(f"{accepted_table}/batch={batch_id}")
        accepted.groupBy("category").agg(F.max(ts).alias("mark")).write.mode("overwrite").parquet(
            f"{marks_table}/batch={batch_id}"
        )

    return (
        stream.writeStream.foreachBatch(intake)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


MARKS = "category STRING, mark TIMESTAMP_NTZ, batch BIGINT"


def _marks_before(spark: SparkSession, table: str, batch_id: int) -> DataFrame:
    if batch_id == 0:
        rows = spark.createDataFrame([], MARKS)
    else:
        rows = spark.read.schema(MARKS).parquet(table).filter(F.col("batch") < batch_id)
    return rows.groupBy("category").agg(F.max("mark").alias("mark"))
