"""Streams give the table of the batch form, also after a repeated batch."""

import uuid

from pyspark.sql import functions as F

from billstream.operators import bills as B
from billstream.operators import links as K
from billstream.streaming import jobs as J
from billstream.streaming import stateful as S


def slices(spark, tmp_path, frames):
    """One file per slice, read one per batch."""
    folder = tmp_path / f"in-{uuid.uuid4().hex}"
    for i, df in enumerate(frames):
        df.coalesce(1).write.mode("append").parquet(str(folder / f"part={i}"))
    schema = frames[0].schema
    return (
        spark.readStream.schema(schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", True)
        .parquet(str(folder))
    )


def test_marks(spark, tmp_path):
    schema = "id INT, category STRING, ts STRING"
    runs = [
        [(1, "a", "2024-01-02"), (2, "b", "2024-01-05")],
        [(3, "a", "2024-01-02"), (4, "a", "2024-01-03"), (5, "b", "2024-01-04")],
        [(6, "a", "2024-01-04"), (7, "b", "2024-01-06"), (8, "c", "2024-01-01")],
    ]
    frames = [spark.createDataFrame(r, schema).withColumn("ts", F.col("ts").cast("timestamp_ntz")) for r in runs]
    marks, taken, check = (str(tmp_path / n) for n in ("marks", "taken", "check"))
    stream = slices(spark, tmp_path, frames)
    J.take_newer(stream, marks, taken, check).awaitTermination()
    got = {r.id for r in spark.read.parquet(taken).collect()}
    batch = frames[0].withColumn("run", F.lit(0))
    for i in (1, 2):
        batch = batch.unionByName(frames[i].withColumn("run", F.lit(i)))
    assert got == {r.id for r in K.replay_runs(batch).collect()} == {1, 2, 4, 6, 7, 8}
    # Nothing new: a second start takes nothing.
    J.take_newer(stream, marks, taken, check).awaitTermination()
    assert spark.read.parquet(taken).count() == 6


def test_bills(spark, tmp_path):
    schema = "bill_id STRING, ord INT, description STRING, date STRING"
    one = spark.createDataFrame([("p", 1, "A", "1"), ("q", 1, "A", "1")], schema)
    two = spark.createDataFrame([("p", 1, "A", "1"), ("p", 2, "B", "2"), ("q", 1, "X", "1"), ("r", 1, "A", "1")], schema)
    table = str(tmp_path / "bills")
    S.bills_stream(slices(spark, tmp_path, [one, two]), table, str(tmp_path / "c"), lambda n: F.lit(f"r{n}")).awaitTermination()
    empty = spark.createDataFrame([], S.STORED)
    want = B.incremental_bills(B.incremental_bills(empty, one, F.lit("r0")), two, F.lit("r1"))
    assert sorted(map(tuple, S.stored_bills(spark, table).collect())) == sorted(map(tuple, want.collect()))


def test_upsert_keeps_the_newest_batch(spark, tmp_path):
    schema = "k STRING, v INT"
    frames = [spark.createDataFrame([("a", 1), ("b", 1)], schema), spark.createDataFrame([("a", 2)], schema)]
    table = str(tmp_path / "t")
    J.upsert_to_table(slices(spark, tmp_path, frames), table, str(tmp_path / "c")).awaitTermination()
    assert {tuple(r) for r in J.latest_rows(spark, table, ["k"]).collect()} == {("a", 2), ("b", 1)}


def test_state_folder_needs_a_shared_one_on_a_cluster(spark, monkeypatch):
    import pytest

    from billstream import session

    class Conf:
        def __init__(self, values):
            self.values = values

        def get(self, key, default=None):
            return self.values.get(key, default)

    class Fake:
        def __init__(self, **values):
            self.conf = Conf({k.replace("_", "."): v for k, v in values.items()})

    assert session.state_dir(Fake(spark_checkpoint_dir="hdfs://n/c"), "x") == "hdfs://n/c/x"
    with pytest.raises(ValueError):
        session.state_dir(Fake(spark_master="spark://host:7077"), "x")


def test_a_second_run_takes_only_what_is_new(spark, tmp_path):
    source, folder = str(tmp_path / "in"), str(tmp_path / "job")
    for n in (1, 2):
        spark.createDataFrame([(n,)], "id INT").coalesce(1).write.mode("append").parquet(source)
        got = J.run_append(spark, source, lambda df: df.select("id", F.current_timestamp().alias("at")), folder)
        assert sorted(r.id for r in got.collect()) == list(range(1, n + 1))
    assert got.select("at").distinct().count() == 2
