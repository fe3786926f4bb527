"""An extraction run over bills that are dear to compute: they are read once, in bounded shares."""

import datetime as dt

from pyspark.sql import functions as F

from billstream.operators import documents as D
from billstream.plans.bindings import Tables
from billstream.plans.catalog_text import BILL_PARTS, extract_bills


def day(n):
    return dt.datetime(2024, 1, n)


def test_bills_are_decided_once_for_all_sources_of_links(spark, tmp_path):
    rows = [(1, day(2), day(1), 1), (2, day(1), day(2), 1), (3, None, None, 0), (None, None, None, 0), (3, None, None, 0)]
    path = str(tmp_path / "bill_rows")
    spark.createDataFrame(rows, "bill_key INT, logs_update TIMESTAMP_NTZ, text_update TIMESTAMP_NTZ, files INT").write.parquet(path)
    schema = "bill_key INT, version_id INT, pos INT, url STRING, media_type STRING"
    first = [(1, 10, 0, "u/a.html", "text/html"), (2, 20, 0, "u/b.html", "text/html"), (None, 40, 0, "u/d.html", "text/html")]
    more = [(1, 10, 1, "u/a.xml", "text/xml"), (3, 30, 0, "u/c.html", "text/html"), (3, 30, 0, "u/c.html", "text/html")]
    links = spark.createDataFrame(first, schema).unionByName(spark.createDataFrame(more, schema))
    stored = [(10, "xml", "<bill><title>T</title></bill>"), (10, "html", "x"), (20, "html", "x"), (40, "html", "x")]
    contents = spark.createDataFrame(stored, "version_id INT, ext STRING, content STRING")
    after, done = D.extract_batch(spark.read.parquet(path), links, contents, F.lit("2030-01-01").cast("timestamp_ntz"))
    got = sorted((r.bill_key, r.version_id, r.ext, r.error) for r in done.collect())
    assert got == [(1, 10, "xml", None), (3, 30, "html", "download failed")]
    status = sorted((r.bill_key or 0, r.status) for r in after.collect())
    assert status == [(0, "ok"), (1, "ok"), (2, "skipped"), (3, "error"), (3, "error")]
    assert "bill_rows" not in "".join(done.inputFiles())


def test_dealt_out_bills_are_the_rows_of_the_view(spark, tmp_path):
    orders = [(1, "F", day(1)), (2, "O", day(2)), (2, "O", day(2)), (6, "P", None), (7, None, day(3)), (None, "O", day(4))]
    items = [(1, day(5)), (2, day(7)), (2, day(6)), (2, None), (6, None), (7, day(8)), (None, day(9)), (99, day(9))]
    spark.createDataFrame(orders, "o_orderkey LONG, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(items, "l_orderkey LONG, l_shipdate TIMESTAMP_NTZ").write.parquet(str(tmp_path / "lineitem.parquet"))
    t = Tables(spark, str(tmp_path))
    got, want = extract_bills(t), t("b_extract")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0 and got.count() == 6
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count(f", {BILL_PARTS}), REPARTITION_BY_NUM") == 2 == plan.count("Exchange hashpartitioning")
