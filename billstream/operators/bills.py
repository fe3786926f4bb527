"""Bills and their actions: gates, merges, incremental update."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from billstream.functions.names import action_key
from billstream.operators.common import top_per_key
from billstream.session import saved

ACTION_KEY = ["bill_id", "description", "date"]


def _filled(actions: DataFrame) -> DataFrame:
    """Missing key parts count as empty, as in the action key."""
    return actions.withColumns(
        {c: F.coalesce(F.col(c), F.lit("")) for c in ("description", "date")}
    )


def changed_bills(previous: DataFrame, incoming: DataFrame, compare: str = "count") -> DataFrame:
    """Bills that are new or whose actions changed.

    ``count`` compares the number of actions only, so an edit that keeps the
    number goes unseen; ``hash`` compares an order-free sum of action hashes.
    """

    def digest(actions: DataFrame, name: str) -> DataFrame:
        key = F.xxhash64(action_key(F.col("description"), F.col("date"))).cast("decimal(38,0)")
        return actions.groupBy("bill_id").agg(
            F.count("*").alias(f"n_{name}"), F.sum(key).alias(f"h_{name}")
        )

    joined = digest(incoming, "incoming").join(digest(previous, "previous"), "bill_id", "left")
    differs = F.col("n_previous") != F.col("n_incoming")
    if compare == "hash":
        differs = differs | (F.col("h_previous") != F.col("h_incoming"))
    return joined.filter(F.col("n_previous").isNull() | differs).select(
        "bill_id", "n_previous", "n_incoming", F.col("n_previous").isNull().alias("is_new")
    )


def new_actions(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming actions whose description and date are not stored yet."""
    known = _filled(stored).select(*ACTION_KEY).distinct()
    return _filled(incoming).join(known, ACTION_KEY, "left_anti")


def merge_actions(stored: DataFrame, incoming: DataFrame, carried: Sequence[str]) -> DataFrame:
    """Incoming order; known actions keep the stored ``carried`` columns.

    Among stored duplicates the last one counts. Stored actions that are gone
    from the incoming list vanish.
    """
    last = top_per_key(_filled(stored), ACTION_KEY, [F.desc("ord")], 1)
    kept = last.select(*ACTION_KEY, *[F.col(c).alias(f"_{c}") for c in carried], F.lit(True).alias("_known"))
    merged = _filled(incoming).join(kept, ACTION_KEY, "left")
    for c in carried:
        own = F.col(c) if c in incoming.columns else F.lit(None)
        merged = merged.withColumn(c, F.when(F.col("_known"), F.col(f"_{c}")).otherwise(own))
    return merged.withColumn("is_new", F.col("_known").isNull()).drop(
        "_known", *[f"_{c}" for c in carried]
    )


STORED_COLUMNS = ["bill_id", "ord", "description", "date", "created"]


def merged_bills(stored: DataFrame, incoming: DataFrame, run: Column, changed: DataFrame | None = None) -> DataFrame:
    """Rows of the incoming bills that changed, merged; only new actions get ``run``.

    Both sides are cut to the changed bills first, so what is ranked and joined follows the run and
    not the stored table.
    """
    if changed is None:
        changed = changed_bills(stored, incoming).select("bill_id")
    before = stored.join(changed, "bill_id", "left_semi")
    merged = merge_actions(before, incoming.join(changed, "bill_id", "left_semi"), ["created"])
    created = F.when(F.col("is_new"), run).otherwise(F.col("created"))
    return merged.withColumn("created", created).select(STORED_COLUMNS)


def incremental_bills(stored: DataFrame, incoming: DataFrame, run: Column) -> DataFrame:
    """One run over whole bills; returns the stored table after the run.

    ``stored`` has ``bill_id, ord, description, date, created``. Bills that did
    not change, or are not part of the run, keep their rows.
    """
    # Decided once: the gate is needed three times.
    changed = saved(changed_bills(stored, incoming).select("bill_id"), "changed-bills")
    untouched = stored.join(changed, "bill_id", "left_anti")
    return untouched.select(STORED_COLUMNS).unionByName(merged_bills(stored, incoming, run, changed))


#: Kinds of rows that a run of ``BillTable`` deals out together.
HELD, ARRIVED, DUE = 0, 1, 2


class BillTable:
    """Stored bills in buckets of their id, next to the action count of every bill.

    The gate reads the counts alone. A run then reads, and replaces by dynamic partition overwrite,
    only the buckets that hold a changed bill. The count is written last: after a run that died half
    way the same bills are still due, and merging them again gives the same rows.
    """

    ROWS = "bill_id STRING, ord INT, description STRING, date STRING, created STRING, bucket INT"
    GATE = "bill_id STRING, actions BIGINT, bucket INT"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, files: int = 1):
        self.spark, self.path, self.buckets, self.files = spark, path, buckets, files
        for name, schema in (("rows", self.ROWS), ("gate", self.GATE)):
            # Empty folders for a first run; nothing that is there is touched.
            self._replace(name, spark.createDataFrame([], schema))

    def rows(self) -> DataFrame:
        return self._read("rows").select(STORED_COLUMNS)

    def update(self, incoming: DataFrame, run: Column) -> list[int]:
        """Merge whole bills; returns the buckets that were replaced (at most their number)."""
        counts = incoming.groupBy("bill_id").agg(F.count("*").alias("actions"))
        before = self._read("gate").select("bill_id", F.col("actions").alias("before"))
        due = counts.join(before, "bill_id", "left").filter("before IS NULL OR before <> actions")
        due = saved(due.select("bill_id", "actions", self._bucket().alias("bucket")), "due-bills")
        touched = sorted(r.bucket for r in due.select("bucket").distinct().collect())
        if not touched:
            return []
        held = {name: self._read(name).filter(F.col("bucket").isin(touched)) for name in ("rows", "gate")}
        arrived = incoming.filter("bill_id IS NOT NULL").select(*ACTION_KEY, "ord", self._bucket().alias("bucket"))
        arrived = arrived.filter(F.col("bucket").isin(touched))
        self._replace("rows", self._merged(held["rows"], arrived, due.filter("bill_id IS NOT NULL"), run))
        counts = self._dealt(held["gate"].withColumn("_side", F.lit(HELD)).unionByName(due.withColumn("_side", F.lit(DUE))))
        self._replace("gate", counts.groupBy("bucket", "_file", "bill_id").agg(F.max_by("actions", "_side").alias("actions")))
        return touched

    def _merged(self, held: DataFrame, arrived: DataFrame, due: DataFrame, run: Column) -> DataFrame:
        """Rows of the touched buckets after ``merge_actions`` of the due bills, in one shuffle.

        Held, arrived and due rows are dealt out together as they are written; what they have to know
        of each other lies in one task. Rows stay rows: a bill's are never gathered in a list.
        """
        sides = [held.withColumn("_side", F.lit(HELD)), arrived.withColumn("_side", F.lit(ARRIVED))]
        sides.append(due.select("bill_id", "bucket", F.lit(DUE).alias("_side")))
        rows = reduce(partial(DataFrame.unionByName, allowMissingColumns=True), sides)
        rows = self._dealt(rows.select(*STORED_COLUMNS, "bucket", "_side"))
        side = F.col("_side")
        filled = {c: F.coalesce(F.col(c), F.lit("")) for c in ("description", "date")}
        bill = Window.partitionBy("bucket", "_file", "bill_id")
        action = Window.partitionBy("bucket", "_file", "bill_id", *filled.values())
        # Among stored duplicates the last one counts.
        last = F.max(F.when(side == HELD, F.struct("ord", "created"))).over(action)
        rows = rows.withColumn("_last", last).withColumn("_due", F.max(side == DUE).over(bill))
        new = side == ARRIVED
        kept = rows.filter((side != DUE) & (new == F.col("_due")))
        created = F.when(new, F.when(F.col("_last").isNull(), run).otherwise(F.col("_last.created"))).otherwise(F.col("created"))
        texts = {c: F.when(new, value).otherwise(F.col(c)) for c, value in filled.items()}
        return kept.withColumns({"created": created, **texts}).select(*STORED_COLUMNS, "bucket", "_file")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64("bill_id"), F.lit(self.buckets)).cast("int")

    def _read(self, name: str) -> DataFrame:
        return self.spark.read.schema(getattr(self, name.upper())).parquet(f"{self.path}/{name}")

    def _dealt(self, rows: DataFrame) -> DataFrame:
        """Rows by the file of a bucket they go to.

        The number of partitions is stated, so that a share does not grow where a session has few, and is a
        multiple of the files, so that few of them meet in one task; partitions without a file end at once.
        """
        spread = F.pmod(F.xxhash64("bill_id", F.lit("file")), F.lit(self.files)).cast("int")
        return rows.withColumn("_file", spread).repartition(4 * self.buckets * self.files, "bucket", "_file")

    def _replace(self, name: str, rows: DataFrame) -> None:
        dealt = rows if "_file" in rows.columns else self._dealt(rows)
        (
            dealt.drop("_file").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(f"{self.path}/{name}")
        )


def action_order(bills: DataFrame, actions: str = "actions") -> DataFrame:
    """One row per action with its position in the list of its bill; no window needed."""
    return bills.select("*", F.posexplode(actions).alias("ordinal", "action")).drop(actions)


def last_write_wins(logs: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows with the same output name overwrite each other; the last in input order stays."""
    return top_per_key(logs, keys, [F.desc(c) for c in order], 1)


def ownership_merge(
    scraped: DataFrame, extracted: DataFrame, keys: Sequence[str], scraper_owns: Sequence[str], extractor_owns: Sequence[str]
) -> DataFrame:
    """Two versions of one table: each side wins in the columns it owns."""
    joined = scraped.alias("s").join(extracted.alias("x"), list(keys), "full_outer")
    return joined.select(
        *keys,
        *[F.coalesce(F.col(f"s.{c}"), F.col(f"x.{c}")).alias(c) for c in scraper_owns],
        *[F.coalesce(F.col(f"x.{c}"), F.col(f"s.{c}")).alias(c) for c in extractor_owns],
    )


def bills_summary(bills: DataFrame) -> DataFrame:
    """One row per loaded bill document with its counts."""
    return bills.select(
        "identifier",
        "title",
        F.col("legislative_session").alias("session"),
        F.col("jurisdiction.id").alias("jurisdiction_id"),
        F.col("jurisdiction.name").alias("jurisdiction_name"),
        F.coalesce(F.size("actions"), F.lit(0)).cast("bigint").alias("action_count"),
        F.coalesce(F.size("sponsorships"), F.lit(0)).cast("bigint").alias("sponsor_count"),
    )


def bills_summary_flat(bills: DataFrame, actions: DataFrame, sponsors: DataFrame) -> DataFrame:
    """The same over flat tables: only counts are joined, no list is ever built."""
    out = bills
    for rows, name in ((actions, "action_count"), (sponsors, "sponsor_count")):
        counts = rows.groupBy("bill_id").agg(F.count("*").alias(name))
        out = out.join(counts, "bill_id", "left").withColumn(name, F.coalesce(name, F.lit(0)))
    return out


def reconcile(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """What to create, update and delete to get from actual to expected."""
    e = expected.select(key).distinct().withColumn("_e", F.lit(True))
    a = actual.select(key).distinct().withColumn("_a", F.lit(True))
    verb = (
        F.when(F.col("_a").isNull(), "create").when(F.col("_e").isNull(), "delete").otherwise("update")
    )
    return e.join(a, key, "full_outer").select(key, verb.alias("verb"))
