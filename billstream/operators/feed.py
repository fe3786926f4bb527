"""De-duplicated, ranked feed of log entries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from billstream.functions import entries as E
from billstream.functions import stamps as S
from billstream.functions.text import title_case_tag
from billstream.operators.logs import BILL_KEY, tag_filter

FEED_LIMIT = 100


def feed_items(entries: DataFrame, base_url: str, keep: Sequence[Column] = ()) -> DataFrame:
    """Entries ``(id, log, bill, tags, sources, timestamp)`` to feed items, with ``keep``."""
    ident, log, bill, tags, sources, ts = (
        F.col(c) for c in ("id", "log", "bill", "tags", "sources", "timestamp")
    )
    return entries.select(
        E.item_title(ident, log, bill, tags, sources).alias("title"),
        E.item_description(ident, log, bill).alias("description"),
        E.item_link(sources, F.lit(None).cast("string"), F.lit(base_url)).alias("link"),
        E.guid(sources, ts, ident, log).alias("guid"),
        S.pub_date_rss(S.parse_stamp(ts)).alias("pubDate"),
        F.array_sort(F.map_keys(tags)).alias("category"),
        ts.alias("timestamp"),
        *keep,
    )


def newest_items(stamp: str = "log_ts", guid: str = "path") -> list[Column]:
    """The order of a feed: newest first, missing stamps last, equal stamps by guid."""
    return [F.desc(F.coalesce(F.col(stamp), F.lit(""))), F.asc(guid)]


def top_entries(
    logs: DataFrame,
    bill_tags: DataFrame | None = None,
    tag_names: Sequence[str] = (),
    limit: int = FEED_LIMIT,
    guid: str = "path",
    order: str = "event_id",
    keys: Sequence[str] = BILL_KEY,
) -> DataFrame:
    """Tag filter, first entry per guid, newest first, missing stamps last, top ``limit``.

    One aggregate per guid, combined before the shuffle, then the top rows of each task.
    """
    if bill_tags is not None:
        logs = tag_filter(logs, bill_tags, tag_names, keys)
    first = F.min_by(F.struct(*logs.columns), F.struct(order))
    return logs.groupBy(F.col(guid).alias("_guid")).agg(first.alias("_first")).select("_first.*").orderBy(*newest_items(guid=guid)).limit(limit)


def feed_title(tags: DataFrame) -> DataFrame:
    """Title and description of the whole feed from its (configured, few) tags."""
    named = tags.select(
        "name",
        title_case_tag(F.col("name")).alias("t"),
        # The first 200 bytes, cut back to whole characters.
        F.regexp_replace(
            F.decode(F.substring(F.encode("description", "UTF-8"), 1, 200), "UTF-8"), "�$", ""
        ).alias("d"),
    )
    rows = F.array_sort(F.collect_list(F.struct("name", "t", "d")))
    return named.agg(rows.alias("r")).select(
        F.concat(F.array_join(F.transform("r", lambda x: x["t"]), " & "), F.lit(" Legislation")).alias("title"),
        F.coalesce(
            F.nullif(
                F.array_join(F.transform("r", lambda x: F.concat(x["t"], F.lit(": "), x["d"])), " | "), F.lit("")
            ),
            F.lit("Legislative updates"),
        ).alias("description"),
    )
