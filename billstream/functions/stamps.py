"""Time stamps: ISO strings, compact stamps, marks and publication dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_SHAPE = (
    r"^\d{4}-\d{2}-\d{2}([T ]([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
COMPACT = "yyyyMMdd'T'HHmmss'Z'"


def fmt_timestamp(date: Column) -> Column:
    """Compact stamp of the wall clock; the offset is ignored, bad input gives null."""
    day = F.substring(date, 1, 10)
    clock = (
        F.when(F.length(date) == 10, F.lit("000000"))
        .when(date.rlike(r"^.{16}:"), F.replace(F.substring(date, 12, 8), F.lit(":"), F.lit("")))
        .otherwise(F.concat(F.replace(F.substring(date, 12, 5), F.lit(":"), F.lit("")), F.lit("00")))
    )
    valid = date.rlike(ISO_SHAPE) & F.try_to_date(day, "yyyy-MM-dd").isNotNull()
    return F.when(
        valid, F.concat(F.replace(day, F.lit("-"), F.lit("")), F.lit("T"), clock, F.lit("Z"))
    )


def stamp_or_unknown(date: Column) -> Column:
    return F.coalesce(fmt_timestamp(date), F.lit("unknown"))


def event_instant(date: Column) -> Column:
    """The true instant of an ISO string, offset applied."""
    return F.try_to_timestamp(date)


def parse_stamp(stamp: Column) -> Column:
    """16 characters ending in Z to a timestamp, anything else to null."""
    return F.when(
        (F.length(stamp) == 16) & stamp.endswith("Z"), F.try_to_timestamp(stamp, F.lit(COMPACT))
    )


def parse_mark(mark: Column) -> Column:
    """Stamp with or without dashes, with or without Z, to a timestamp."""
    bare = F.regexp_replace(mark, "Z+$", "")
    return F.when(
        bare.contains("-"), F.try_to_timestamp(bare, F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    ).otherwise(F.try_to_timestamp(bare, F.lit("yyyyMMdd'T'HHmmss")))


def pub_date_rss(ts: Column) -> Column:
    """RFC 2822 form used by feed items."""
    return F.date_format(ts, "EEE, d MMM yyyy HH:mm:ss '+0000'")


def pub_date_page(ts: Column) -> Column:
    return F.date_format(ts, "MMMM dd, yyyy 'at' hh:mm a 'UTC'")
