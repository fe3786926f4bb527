"""The bucketed bill table against the merge over whole tables."""

import os

from pyspark.sql import functions as F

from billstream.operators import bills as B

BILLS = "bill_id STRING, ord INT, description STRING, date STRING"


def bills(spark, *ids, actions=1, text="A"):
    return spark.createDataFrame([(i, n, f"{text}{n}", str(n)) for i in ids for n in range(1, actions + 1)], BILLS)


def rows(df):
    return sorted(map(tuple, df.collect()))


def files(path):
    return {os.path.join(at, f) for at, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_updates_equal_the_whole_merge(spark, tmp_path):
    table = B.BillTable(spark, str(tmp_path / "bills"), buckets=8)
    want = spark.createDataFrame([], B.BillTable.ROWS).drop("bucket")
    ids = [f"HB{i}" for i in range(40)]
    runs = [
        bills(spark, *ids, actions=2),
        bills(spark, *ids[:5], actions=3).unionByName(bills(spark, *ids[5:9], actions=2, text="edited")).unionByName(bills(spark, "SB1")),
        bills(spark, *ids[3:4], actions=1),
        bills(spark, *ids[:2], actions=3),
    ]
    for n, incoming in enumerate(runs):
        run = F.lit(f"r{n}")
        want = B.incremental_bills(want, incoming, run)
        table.update(incoming, run)
        assert rows(table.rows()) == rows(want), n


def test_only_touched_buckets_are_written(spark, tmp_path):
    path = str(tmp_path / "bills")
    table = B.BillTable(spark, path, buckets=16)
    table.update(bills(spark, *[f"HB{i}" for i in range(200)]), F.lit("r0"))
    before = files(path)
    touched = table.update(bills(spark, "HB7", actions=2), F.lit("r1"))
    assert len(touched) == 1
    gone = before - files(path)
    assert gone and all(f"bucket={touched[0]}/" in f for f in gone)
    after = files(path)
    assert table.update(bills(spark, "HB7", actions=2), F.lit("r2")) == [] and files(path) == after
    again = B.BillTable(spark, path, buckets=16)
    assert again.rows().count() == 201 and files(path) == after


def test_a_run_that_died_before_its_gate_is_merged_again(spark, tmp_path):
    table = B.BillTable(spark, str(tmp_path / "bills"), buckets=4)
    table.update(bills(spark, "A", "B"), F.lit("r0"))
    write = table._replace
    table._replace = lambda name, df: write(name, df) if name == "rows" else None
    table.update(bills(spark, "A", actions=2), F.lit("r1"))
    table._replace = write
    assert table.update(bills(spark, "A", actions=2), F.lit("r2"))
    created = {(r.bill_id, r.ord): r.created for r in table.rows().collect()}
    assert created == {("A", 1): "r0", ("A", 2): "r1", ("B", 1): "r0"}


def test_stored_is_cut_before_it_is_ranked(spark, tmp_path):
    stored = bills(spark, "A", "B").withColumn("created", F.lit("r"))
    path = str(tmp_path / "stored")
    stored.write.parquet(path)
    merged = B.merged_bills(spark.read.parquet(path), bills(spark, "A", actions=2), F.lit("r1"))
    plan = merged._jdf.queryExecution().optimizedPlan().toString()
    window = plan[plan.index("Window") :]
    assert "LeftSemi" in window and window.index("LeftSemi") < window.index("parquet")


def test_a_run_moves_its_rows_once(spark, tmp_path):
    table = B.BillTable(spark, str(tmp_path / "bills"), buckets=2)
    table.update(bills(spark, "A", "B"), F.lit("r0"))
    write, plans = table._replace, {}

    def seen(name, df):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        write(name, df)

    table._replace = seen
    table.update(bills(spark, "A", "C", actions=2), F.lit("r1"))
    assert {name: plan.count("Exchange") for name, plan in plans.items()} == {"rows": 1, "gate": 1}
    assert all("REPARTITION_BY_NUM" in plan for plan in plans.values())


def test_odd_rows_are_merged_as_over_whole_tables(spark, tmp_path):
    runs = [
        [("A", 1, None, "1"), ("A", 2, "x", None), ("A", 3, "x", None), ("B", 1, "y", "2"), (None, 1, "z", "3"), ("D", 1, "", "")],
        [("A", 1, "x", ""), ("A", 2, "", "1"), ("A", 3, "new", None), ("A", 4, "x", ""), ("B", 1, "edited", "2"), (None, 1, "z", "3")],
        [("B", 1, "y", "2"), ("B", 2, "y", "2"), ("C", None, "c", None), ("D", 1, None, None), ("D", 2, None, "")],
    ]
    table = B.BillTable(spark, str(tmp_path / "bills"), buckets=3, files=2)
    want = spark.createDataFrame([], B.BillTable.ROWS).drop("bucket")
    for n, incoming in enumerate(spark.createDataFrame(r, BILLS) for r in runs):
        run = F.lit(f"r{n}") if n else F.lit(None).cast("string")
        want = B.incremental_bills(want, incoming, run)
        table.update(incoming.withColumn("created", F.lit(7)), run)
        assert sorted(rows_of(table.rows()), key=repr) == sorted(rows_of(want), key=repr), n


def rows_of(df):
    return list(map(tuple, df.collect()))
