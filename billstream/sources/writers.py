"""Tables, tag files, JSON lines and feed files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstream.functions.paths import bill_folder_id, build_path
from billstream.operators.feed import FEED_LIMIT


def with_bill_path(bills: DataFrame) -> DataFrame:
    return bills.withColumn(
        "path",
        build_path(F.col("state"), F.col("session_id"), F.lit("bills"), bill_folder_id(F.col("identifier"))),
    )


def write_keyed(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    """Tree ``country/state/session``; rows of one partition value may spread over files.

    ``repartition`` on the partition columns and a salt keeps the number of small
    files low without forcing a hot state into one task.
    """
    keyed = df.withColumn("country", F.lit("us")) if "country" not in df.columns else df
    spread = F.pmod(F.xxhash64("bill_id"), F.lit(16))
    (
        keyed.repartition("country", "state", "session_id", spread)
        .write.mode("overwrite")
        .partitionBy("country", "state", "session_id")
        .format(fmt)
        .save(target)
    )


def write_tag_rows(bill_tags: DataFrame, cache: DataFrame, target: str) -> None:
    bill_tags.write.mode("overwrite").partitionBy("session_id", "tag").parquet(f"{target}/bill_tags")
    cache.write.mode("overwrite").parquet(f"{target}/text_cache")


def json_lines(df: DataFrame) -> DataFrame:
    """Compact JSON per row, null fields left out."""
    return df.select(F.to_json(F.struct(*df.columns)).alias("value"))


def write_jsonl(df: DataFrame, target: str) -> None:
    json_lines(df).write.mode("overwrite").text(target)


def _escaped(text: Column) -> Column:
    for sign, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(sign), F.lit(entity))
    # Control characters cannot stand in XML at all.
    return F.regexp_replace(text, "[\\x00-\\x08\\x0B\\x0C\\x0E-\\x1F]", "")


def _element(name: str, value: Column, attributes: str = "") -> Column:
    """An element, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"<{name}{attributes}>"), _escaped(value), F.lit(f"</{name}>")), F.lit(""))


def feed_document(
    items: DataFrame,
    title: str,
    link: str,
    description: str = "Legislative updates",
    language: str = "en-us",
    limit: int = FEED_LIMIT,
) -> DataFrame:
    """One row ``value``: the newest items as an RSS 2.0 document, in feed order.

    At most ``limit`` items (newest first, missing stamps last, equal stamps by guid) meet in
    the one row, whatever the table holds.
    """
    newest = items.orderBy(F.desc(F.coalesce("timestamp", F.lit(""))), F.asc("guid")).limit(limit)
    item = F.concat(
        F.lit("<item>"),
        *[_element(c, F.col(c)) for c in ("title", "link", "description")],
        F.coalesce(F.array_join(F.transform("category", lambda c: _element("category", c)), ""), F.lit("")),
        _element("guid", F.col("guid"), ' isPermaLink="false"'),
        _element("pubDate", F.col("pubDate")),
        F.lit("</item>"),
    )
    stamp = F.coalesce("timestamp", F.lit(""))
    order = lambda a, b: F.when(a.stamp > b.stamp, -1).when(a.stamp < b.stamp, 1).when(a.guid < b.guid, -1).otherwise(1)
    rows = newest.agg(F.array_sort(F.collect_list(F.struct(stamp.alias("stamp"), "guid", item.alias("item"))), order).alias("rows"))
    head = F.concat(
        *[_element(n, F.lit(v)) for n, v in (("title", title), ("link", link), ("description", description), ("language", language))],
        _element("lastBuildDate", F.date_format(F.current_timestamp(), "EEE, d MMM yyyy HH:mm:ss '+0000'")),
    )
    return rows.select(
        F.concat(
            F.lit('<?xml version="1.0" encoding="utf-8"?><rss version="2.0"><channel>'),
            head,
            F.array_join(F.transform("rows", lambda r: r.item), ""),
            F.lit("</channel></rss>"),
        ).alias("value")
    )


def write_feed(items: DataFrame, target: str, title: str, link: str, description: str = "Legislative updates", limit: int = FEED_LIMIT) -> None:
    feed_document(items, title, link, description, limit=limit).write.mode("overwrite").text(target)
