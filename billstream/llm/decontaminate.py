"""Benchmark decontamination with DataFrame expressions only.

Items are partitioned by their number of distinct shingles. A document that holds at least 80 % of
an item's m shingles lacks at most m - ceil(0.8 m) of them, so it holds one of the
m - ceil(0.8 m) + 1 shingles with the smallest hashes: that bottom-k MinHash sketch, with k set by
the item's size, finds every such document. Candidates are then verified by exact containment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
LEAST = 0.8
#: Bits of each of the two filters that a task tests shingles against: half a megabyte, whatever the
#: tables hold. A fuller filter lets more through to the join, never fewer.
FILTER_BITS = 1 << 22


def words_of(text: Column) -> Column:
    """Lower-case runs of letters and digits."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _bound_once(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once, though the optimizer may inline columns."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column) -> Column:
    """Hashes of all shingles, repeats included; texts with fewer words have none."""

    def hashes(words: Column) -> Column:
        at = lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(SHINGLE)])
        none = F.array().cast("array<bigint>")
        return F.when(F.size(words) < SHINGLE, none).otherwise(F.transform(F.sequence(F.lit(0), F.size(words) - SHINGLE), at))

    return _bound_once(words_of(text), hashes)


def item_postings(items: DataFrame, least: float = LEAST) -> DataFrame:
    """``item_id``, ``h``, ``m`` (distinct shingles of the item), ``band`` (its size partition), ``sketched``."""
    each = items.select("item_id", F.explode(shingle_hashes(F.col("text"))).alias("h")).distinct()
    by_item = Window.partitionBy("item_id")
    sized = each.withColumn("m", F.count("*").over(by_item)).withColumn("rank", F.row_number().over(by_item.orderBy("h")))
    needed = F.ceil(F.col("m") * F.lit(least) - 1e-9)
    return sized.select(
        "item_id", "h", "m", F.floor(F.log2("m")).cast("int").alias("band"), (F.col("rank") <= F.col("m") - needed + 1).alias("sketched")
    )


def _place(h: Column) -> Column:
    return h.bitwiseAND(FILTER_BITS - 1)


def _filter_of(hashes: DataFrame) -> Column:
    """A bit for each hash modulo the filter's size, as a constant array of longs."""
    words = (
        hashes.select(F.shiftright(_place(F.col("h")), 6).alias("word"), F.expr("shiftleft(1L, cast(h & 63 AS INT))").alias("bit"))
        .groupBy("word").agg(F.bit_or("bit").alias("bits"))
    )
    # One row of fixed size goes to the driver: it is a constant of the plan that follows.
    dense = hashes.sparkSession.range(FILTER_BITS // 64).join(words, F.col("id") == F.col("word"), "left")
    text = dense.agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))), lambda x: x.bits.cast("string")), ",")
    ).first()[0]
    return F.from_json(F.lit(f"[{text}]"), "array<bigint>")


def _in_filter(bits: Column, h: Column) -> Column:
    word = F.get(bits, F.shiftright(_place(h), 6).cast("int"))
    return F.call_function("shiftrightunsigned", word, h.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1


def contaminated_pairs(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """``doc_id``, ``item_id``, ``n_shared``, ``n_item``, ``containment`` of all pairs from ``least`` on.

    Containment is the share of an item's distinct shingles that the document holds. Null and empty
    texts, and items of fewer than five words, are in no pair. Rows of one id (null ids too) count as
    one document or item with the shingles of all of them. Other columns are ignored; an empty table
    on either side gives no row. A pair is one row, however often the passage occurs.
    """
    from billstream.llm.common import stored

    postings = stored(item_postings(items, least), "decontaminate-items")
    sketches = postings.where("sketched")
    # Within a size partition no sketched hash lies above this limit.
    limit = sketches.groupBy("band").agg(F.max("h").alias("limit")).agg(F.max("limit")).first()[0]
    if limit is None:
        limit = -(1 << 63)
    narrow, wide = _filter_of(sketches), _filter_of(postings)

    def hits(all_hashes: Column) -> Column:
        candidate = F.exists(all_hashes, lambda h: (h <= F.lit(limit)) & _in_filter(narrow, h))
        none = F.array().cast("array<bigint>")
        return F.when(candidate, F.array_distinct(F.filter(all_hashes, lambda h: _in_filter(wide, h)))).otherwise(none)

    found = _bound_once(shingle_hashes(F.col("text")), hits)
    # An outer explode: a plain one would make the optimizer evaluate the array twice.
    doc_hits = docs.select("doc_id", F.explode_outer(found).alias("h")).where("h is not null")
    shared = (
        doc_hits.distinct().join(postings, "h")
        .groupBy("doc_id", "item_id", "m")
        .agg(F.count("*").alias("n_shared"), F.max("sketched").alias("candidate"))
    )
    containment = F.col("n_shared") / F.col("m")
    return shared.where(F.col("candidate") & (containment >= least)).select(
        "doc_id", "item_id", "n_shared", F.col("m").alias("n_item"), containment.alias("containment")
    )


def decontaminated(docs: DataFrame, items: DataFrame, least: float = LEAST) -> DataFrame:
    """The documents without any item; rows with a null id stay only if no null-id row has one."""
    bad = contaminated_pairs(docs, items, least).select(F.col("doc_id").alias("bad_id")).distinct()
    return docs.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")), "left_anti")


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    return contaminated_pairs(
        spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    )


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark
), ds AS (
  SELECT DISTINCT doc_id, s FROM (
    SELECT doc_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM d)
), i5 AS (
  SELECT DISTINCT item_id, s FROM (
    SELECT item_id, unnest(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) AS s FROM i)
), m AS (SELECT item_id, count(*) AS n_item FROM i5 GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*)::DOUBLE / n_item AS containment
FROM ds JOIN i5 USING (s) JOIN m USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item
"""
