"""Tag files as partitioned tables, and the job that keeps them.

What a tag file holds, the tag's configuration with its hash, the texts and the scored bills of one
session, are three tables partitioned by state, session and tag. A run reads and replaces only the
partitions it has new rows for; all others keep their files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from billstream.functions.text import entry_id, text_hash
from billstream.operators.common import top_per_key
from billstream.operators.tagging import PLACE, Tag, TagVectors, already_tagged, config_hash, keyword_tags, semantic_or_keyword_tags
from billstream.session import saved

FILE = ["state", "session_id", "tag"]
BILL = PLACE
PARTS = ["final_score", "base_embedding", "example_similarity", "keyword_match", "negative_penalty"]
CONFIG = ["name", "description", "examples", "include_keywords", "exclude_keywords", "negative_examples", "threshold"]
#: Fixed value: model name of runs without vectors.
KEYWORD_MODEL = "keyword-fallback"


class TagStore:
    """The tables ``bills``, ``texts`` and ``heads`` below one shared folder."""

    TABLES = {
        "bills": "bill_id STRING, text_hash STRING, final_score DOUBLE, base_embedding DOUBLE, example_similarity DOUBLE, "
        "keyword_match ARRAY<STRING>, negative_penalty DOUBLE",
        "texts": "text_hash STRING, text STRING",
        "heads": "last_run STRING, model STRING, tag_config STRING, tag_config_hash STRING",
    }

    UNIQUE = {"texts": ["text_hash"]}

    def __init__(self, spark: SparkSession, path: str, files: int = 1):
        #: ``files`` are the tasks that write one partition.
        self.spark, self.path, self.files = spark, path, files
        for name in self.TABLES:
            # Makes the folder of a new store; partitions that are there stay.
            self._replace(name, spark.createDataFrame([], self._schema(name)))

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._schema(name)).parquet(f"{self.path}/{name}")

    def merge(self, fresh: DataFrame, tags: Sequence[Tag], run: str, model: str) -> None:
        """Put rows ``FILE, bill_id, text_hash, text, PARTS`` on top of what is stored.

        Bills are written last: after a run that died half way they are still due, and merging them
        again gives the same tables. ``fresh`` is read twice, once for its texts alone, which go to
        their table without a copy in between.
        """
        texts, fresh = fresh.select(*FILE, "text_hash", "text"), saved(fresh.drop("text"), "tag-rows")
        touched = fresh.select(FILE).distinct()

        def kept(name: str) -> DataFrame:
            return self.read(name).join(touched, FILE, "left_semi")

        self._replace("texts", texts.unionByName(kept("texts")))
        self._replace("heads", self._heads(touched, kept("heads"), tags, run, model))
        key = [*FILE, "bill_id"]
        bills = kept("bills").join(fresh.select(key), key, "left_anti").unionByName(fresh.select(*key, "text_hash", *PARTS))
        self._replace("bills", bills)

    def _heads(self, touched: DataFrame, old: DataFrame, tags: Sequence[Tag], run: str, model: str) -> DataFrame:
        """A configuration is replaced where its hash differs, and stays as it was written elsewhere."""
        rows = [tuple(list(v) if isinstance(v, (list, tuple)) else v for v in (getattr(t, c) for c in CONFIG)) for t in tags]
        schema = "name STRING, description STRING, examples ARRAY<STRING>, include_keywords ARRAY<STRING>, exclude_keywords ARRAY<STRING>, negative_examples ARRAY<STRING>, threshold DOUBLE"
        current = self.spark.createDataFrame(rows, schema).select(
            F.col("name").alias("tag"), F.to_json(F.struct(*CONFIG)).alias("_config"), config_hash(*CONFIG).alias("_hash")
        )
        both = touched.join(current, "tag", "left").join(old.select(*FILE, "tag_config", "tag_config_hash"), FILE, "left")
        same = F.coalesce(F.col("_hash") == F.col("tag_config_hash"), F.col("_hash").isNull())
        return both.select(
            *FILE,
            F.lit(run).alias("last_run"),
            F.lit(model).alias("model"),
            F.when(same, F.col("tag_config")).otherwise(F.col("_config")).alias("tag_config"),
            F.when(same, F.col("tag_config_hash")).otherwise(F.col("_hash")).alias("tag_config_hash"),
        )

    def _schema(self, name: str) -> str:
        return ", ".join([self.TABLES[name], *(f"{c} STRING" for c in FILE)])

    def _replace(self, name: str, rows: DataFrame) -> None:
        """Rows move once, to the task that writes them; of equal ``UNIQUE`` columns in a file one stays."""
        key = next((c for c in ("bill_id", "text_hash") if c in rows.columns), "tag")
        spread = F.pmod(F.xxhash64(key), F.lit(self.files))
        dealt = rows.withColumn("_spread", spread).repartition(*FILE, "_spread")
        if name in self.UNIQUE:
            # The key holds what the rows are dealt by, so this needs no shuffle of its own.
            dealt = dealt.dropDuplicates([*FILE, "_spread", *self.UNIQUE[name]])
        (
            dealt.drop("_spread").write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic").partitionBy(*FILE).parquet(f"{self.path}/{name}")
        )


def tag_run(
    entries: DataFrame,
    store: TagStore,
    tags: Sequence[Tag],
    run: str,
    only: str | None = None,
    overwrite: bool = False,
    vectors: TagVectors | None = None,
    model: str = KEYWORD_MODEL,
) -> DataFrame:
    """One run over ``state, session_id, bill_id, text, line_no`` (and ``vector``); returns the matched lines.

    ``line_no`` is the order of the input. A bill that is stored is not scored again; its lines match.
    Of the other lines of a bill the first that gets a tag is stored, and it and the later ones match.
    With ``overwrite`` all lines are scored and the last one of each tag is stored. With ``vectors``,
    entries without a usable vector take keyword tags. Lines without a state or session are left out;
    a missing bill id is made from the text.
    """
    if only is not None and only not in {t.name for t in tags}:
        raise ValueError(f"tag {only!r} is not configured; there are {[t.name for t in tags]}")
    placed = entries.filter(F.col("state").isNotNull() & F.col("session_id").isNotNull())
    placed = placed.withColumn("bill_id", entry_id(F.col("bill_id"), F.col("text")))
    gated = saved(already_tagged(placed, store.read("bills"), only, overwrite), "tag-gate")
    todo = gated.filter("gate = 'todo'").select(*BILL, "line_no", "text", text_hash(F.col("text")).alias("text_hash"), *(["vector"] if vectors else []))
    if vectors:
        scored = semantic_or_keyword_tags(todo, "text", "vector", vectors, tags)
    else:
        scored = keyword_tags(todo, "text", tags).drop("text")
    missing = [F.lit(None).cast("double").alias(c) for c in PARTS if c not in scored.columns]
    scored = scored.select("*", *missing).select(*BILL, "line_no", "text_hash", "tag", *PARTS)
    scored = saved(scored.filter(F.col("tag") == only) if only else scored, "tag-scores")
    line = [*BILL, "line_no"]
    if overwrite:
        chosen = top_per_key(scored, [*FILE, "bill_id"], [F.desc("line_no")], 1)
        out = gated.join(scored.select(line).distinct(), line, "left_semi")
    else:
        first = scored.groupBy(BILL).agg(F.min("line_no").alias("_first"))
        chosen = scored.join(first, BILL).filter("line_no = _first").drop("_first")
        out = gated.join(first, BILL, "left").filter("gate = 'matched' OR line_no >= _first").drop("_first")
    store.merge(chosen.join(todo.select(*line, "text"), line), tags, run, model)
    return out.drop("gate")
