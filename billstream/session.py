"""Session settings the operators rely on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(app: str = "billstream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; anything set by the cluster stays as it is."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def apply_settings(spark: SparkSession) -> SparkSession:
    """Runtime settings that results depend on (stamps are wall-clock UTC)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def state_dir(spark: SparkSession, name: str) -> str:
    """Folder for state tables and stream checkpoints.

    The cluster names a shared folder in ``spark.checkpoint.dir``; a temporary
    folder is only taken where that is unset and the master is one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder for state tables")
        root = tempfile.mkdtemp(prefix="billstream-")
    return os.path.join(root, name) if "://" not in root else f"{root.rstrip('/')}/{name}"


def saved(df: DataFrame, name: str = "run") -> DataFrame:
    """Write a table to the shared state folder and read it back.

    Runs hand their state to the next run this way, so a chain of runs does not
    repeat the work of the earlier ones.
    """
    spark = df.sparkSession
    path = state_dir(spark, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
