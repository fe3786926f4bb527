"""Bills as a stream of whole documents; orphans and hearings are in ``keyed``.

Batch ``n`` reads state written by batches below ``n`` and overwrites its own
folder, so a batch repeated after a failure gives the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billstream.operators import bills as B


def _start(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str):
    return (
        stream.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _before(spark: SparkSession, table: str, schema: str, batch_id: int, column: str) -> DataFrame:
    if batch_id == 0:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{schema}, {column} BIGINT").parquet(table)
    return rows.filter(F.col(column) < batch_id)


# -- bills ---------------------------------------------------------------------------

STORED = "bill_id STRING, ord INT, description STRING, date STRING, created STRING"


def newest_bills(rows: DataFrame) -> DataFrame:
    """Rows of the newest batch of every bill; only (bill, batch) pairs are aggregated."""
    newest = rows.groupBy("bill_id").agg(F.max("batch").alias("batch"))
    return rows.join(newest, ["bill_id", "batch"], "left_semi").drop("batch")


def bills_stream(stream: DataFrame, table: str, checkpoint: str, run: Callable[[int], Column]):
    """Whole bills in, changed bills out: a batch writes only the bills it changed."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows = _before(batch.sparkSession, table, STORED, batch_id, "batch")
        touched = rows.join(batch.select("bill_id").distinct(), "bill_id", "left_semi")
        out = B.merged_bills(newest_bills(touched) if batch_id else rows.drop("batch"), batch, run(batch_id))
        out.write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return _start(stream, handle, checkpoint)


def stored_bills(spark: SparkSession, table: str) -> DataFrame:
    return newest_bills(spark.read.schema(f"{STORED}, batch BIGINT").parquet(table))
