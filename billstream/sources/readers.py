"""Scraped JSON, JSON lines, log trees, session and tag sources as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from billstream import schemas
from billstream.operators.common import first_non_empty
from billstream.operators.tagging import TAG_SCHEMA, tag_rows, with_tag_defaults

CORRUPT = "_corrupt_record"


def scan_scraped_json(spark: SparkSession, folder: str, kind: str) -> DataFrame:
    """Records of one type, one per file; damaged files keep their text in ``_corrupt_record``."""
    return (
        spark.read.schema(f"{schemas.BY_KIND[kind]}, {CORRUPT} STRING")
        .option("multiLine", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("pathGlobFilter", f"{kind}_*.json")
        .json(folder)
        .withColumn("file_name", F.col("_metadata.file_name"))
    )


def split_corrupt(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good, quarantine) of a scan; the quarantine keeps the raw text."""
    bad = F.col(CORRUPT).isNotNull()
    return records.filter(~bad).drop(CORRUPT), records.filter(bad).select(
        F.lit("invalid_json").alias("category"), "file_name", F.col(CORRUPT).alias("raw")
    )


def is_damaged(body: Column) -> Column:
    return F.try_parse_json(body).isNull()


def parse_jsonl(lines: DataFrame, schema: str, line: str = "value") -> DataFrame:
    """Well-formed lines as a struct ``doc``; blank and malformed lines are skipped."""
    return lines.filter((F.trim(F.col(line)) != "") & ~is_damaged(F.col(line))).withColumn(
        "doc", F.from_json(F.col(line), schema)
    )


def jsonl_counts(lines: DataFrame, line: str = "value") -> DataFrame:
    blank = F.trim(F.col(line)) == ""
    return lines.agg(
        F.count("*").alias("lines"),
        F.count_if(blank).alias("blank"),
        F.count_if(~blank & is_damaged(F.col(line))).alias("malformed"),
    )


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return parse_jsonl(spark.read.text(path), schema)


def read_log_tree(spark: SparkSession, roots: list[str]) -> DataFrame:
    """Log files below the chosen roots with their path; only these roots are listed."""
    return (
        spark.read.schema(schemas.LOG)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.json")
        .json(roots)
        .withColumn("path", F.url_decode(F.col("_metadata.file_path")))
        .filter(F.col("path").contains("/logs/"))
    )


def load_bills(*shapes: DataFrame) -> DataFrame:
    """Bill documents of different shapes as one table, columns by name."""
    out = shapes[0]
    for df in shapes[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def read_bills(spark: SparkSession, folder: str) -> DataFrame:
    return (
        spark.read.schema(schemas.BILL)
        .option("multiLine", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "metadata.json")
        .json(folder)
        .withColumn("source_file", F.url_decode(F.col("_metadata.file_path")))
    )


def session_rows(jurisdictions: DataFrame) -> DataFrame:
    """Sessions with id, name, start and end; incomplete ones are left out."""
    s = jurisdictions.select(F.explode("legislative_sessions").alias("s")).select(
        F.col("s.identifier").alias("session_id"), "s.name", "s.start_date", "s.end_date"
    )
    return complete_sessions(s)


def complete_sessions(sessions: DataFrame) -> DataFrame:
    start, end = (F.substring(F.coalesce(F.col(c), F.lit("")), 1, 4) for c in ("start_date", "end_date"))
    filled = (F.coalesce("session_id", F.lit("")) != "") & (F.coalesce("name", F.lit("")) != "")
    return sessions.filter(filled & (start != "") & (end != "")).select(
        "session_id", "name", F.concat_ws("-", start, end).alias("date_folder")
    )


def sessions_dim(fresh: DataFrame, cached: DataFrame) -> DataFrame:
    """Sessions of the jurisdiction file, else the cached map, else nothing."""
    return first_non_empty(fresh, cached)


def read_tag_config(spark: SparkSession, path: str) -> DataFrame:
    """Tag definitions from a configuration file (JSON, or YAML where a parser is installed).

    Spark reads the file, so it may lie wherever tables do. JSON stays with it; a file that is none
    fails the read.
    """
    whole = spark.read.text(path, wholetext=True)
    if path.endswith((".yml", ".yaml")):
        import yaml

        return tag_rows(spark, yaml.safe_load(whole.first()["value"])["tags"])
    fields = TAG_SCHEMA.split(", ", 1)[1]
    config = F.from_json("value", f"tags map<string,struct<{fields}>>", {"mode": "FAILFAST"})
    tags = whole.select(F.explode(config["tags"]).alias("name", "tag"))
    return with_tag_defaults(tags.select("name", "tag.*"))


def feed_config(config: dict) -> dict:
    """The feed section: ``build`` wins over its older name ``publish``."""
    return config.get("build") or config.get("publish") or {}
