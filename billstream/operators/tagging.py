"""Keyword and embedding based tags."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstream.functions import arrow
from billstream.functions.text import text_hash
from billstream.functions.variants import bound
from billstream.operators.common import top_per_key
from billstream.operators.keywords import keyword_hits, matched_keywords  # noqa: F401
from billstream.session import state_dir

# Score of a keyword tag, threshold of a tag that names none.
KEYWORD_SCORE = 0.6
DEFAULT_THRESHOLD = 0.5


@dataclass(frozen=True)
class Tag:
    name: str
    description: str = ""
    examples: Sequence[str] = field(default_factory=tuple)
    include_keywords: Sequence[str] = field(default_factory=tuple)
    exclude_keywords: Sequence[str] = field(default_factory=tuple)
    negative_examples: Sequence[str] = field(default_factory=tuple)
    threshold: float = DEFAULT_THRESHOLD


TAG_SCHEMA = (
    "name STRING, description STRING, examples ARRAY<STRING>, include_keywords ARRAY<STRING>, "
    "exclude_keywords ARRAY<STRING>, negative_examples ARRAY<STRING>, threshold DOUBLE"
)


def tag_rows(spark: SparkSession, config: dict[str, dict]) -> DataFrame:
    """Tag definitions from a configuration map, defaults filled in."""
    return with_tag_defaults(
        spark.createDataFrame([{"name": n, **(d or {})} for n, d in config.items()], TAG_SCHEMA)
    )


def with_tag_defaults(tags: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return tags.withColumns(
        {
            "description": F.coalesce("description", F.lit("")),
            "threshold": F.coalesce("threshold", F.lit(DEFAULT_THRESHOLD)),
            **{
                c: F.coalesce(F.col(c), none)
                for c in ("examples", "include_keywords", "exclude_keywords", "negative_examples")
            },
        }
    )


def tag_vector_text(description: Column, examples: Column) -> Column:
    """Text whose vector stands for the tag."""
    joined = F.array_join(examples, " | ")
    return F.when(
        F.size(examples) > 0, F.concat(description, F.lit(" Examples: "), joined)
    ).otherwise(description)


def config_hash(*columns: str) -> Column:
    return F.sha2(F.to_json(F.struct(*columns)), 256)


# -- keywords ----------------------------------------------------------------------


TAG_HIT = "array<struct<owner:int,tag:string,final_score:double,keyword_match:array<string>>>"


def _hits_of(lowered: Column, tags: Sequence[Tag]) -> Column:
    return keyword_hits(lowered, [(t.include_keywords, t.exclude_keywords) for t in tags])


def _owners(hits: Column, excludes: bool) -> Column:
    return F.array_distinct(F.transform(F.filter(hits, lambda h: h["excludes"] == excludes), lambda h: h["owner"]))


def _keywords_of(hits: Column, owner: Column) -> Column:
    """Keywords of one tag in configuration order."""
    own = F.filter(hits, lambda h: (h["owner"] == owner) & ~h["excludes"])
    placed = F.array_sort(F.transform(own, lambda h: F.struct(h["place"].alias("place"), h["shown"].alias("shown"))))
    return F.transform(placed, lambda h: h["shown"])


def _constant(values: Sequence, kind: str) -> Column:
    """A constant array that is one node of the plan, however long it is."""
    return F.from_json(F.lit(json.dumps(list(values))), f"array<{kind}>")


def tag_hits(hits: Column, tags: Sequence[Tag]) -> Column:
    """``TAG_HIT`` rows of the tags that a text's keyword hits include and do not exclude."""
    names = _constant([t.name for t in tags], "string")
    scores = _constant([max(float(t.threshold), KEYWORD_SCORE) for t in tags], "double")
    kept = F.array_sort(F.array_except(_owners(hits, False), _owners(hits, True)))
    return F.transform(
        kept,
        lambda o: F.struct(
            o.alias("owner"), F.get(names, o).alias("tag"), F.get(scores, o).alias("final_score"), _keywords_of(hits, o).alias("keyword_match")
        ),
    )


def keyword_tags(entries: DataFrame, text: str, tags: Sequence[Tag]) -> DataFrame:
    """(entry columns, tag, final_score, keyword_match), one row per matching tag.

    One pass of the texts through the keyword index; no join, no shuffle, no plan per tag, and
    entries without a tag leave at the explode.
    """
    # The outer form keeps the optimizer from searching the texts once more in a filter ahead of the explode.
    return (
        entries.withColumn("_low", F.lower(text))
        .withColumn("_hits", _hits_of(F.col("_low"), tags))
        .withColumn("_hit", F.explode_outer(bound(F.col("_hits"), lambda hits: tag_hits(hits, tags))))
        .filter(F.col("_hit").isNotNull())
        .select(*entries.columns, "_hit.tag", "_hit.final_score", "_hit.keyword_match")
    )


def rank_tags(scored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rank of each tag inside its entry, best score first, then by name."""
    ordered = F.array_sort(F.collect_list(F.struct((-F.col("final_score")).alias("neg"), "tag")))
    return (
        scored.groupBy(*keys)
        .agg(ordered.alias("_all"))
        .select(*keys, F.posexplode("_all").alias("_pos", "_one"))
        .select(
            *keys,
            F.col("_one.tag").alias("tag"),
            (-F.col("_one.neg")).alias("final_score"),
            (F.col("_pos") + 1).cast("bigint").alias("tag_rank"),
        )
    )


# -- vectors -----------------------------------------------------------------------


class TagVectors(NamedTuple):
    """Where the vectors of the configured tags lie, and their length."""

    path: str
    size: int


def store_tag_vectors(table: DataFrame, tags: Sequence[Tag]) -> TagVectors:
    """Write ``(tag, vector, examples, negatives)`` rows where the tasks read them, one vector a row.

    Nothing of it passes through the driver. Vectors of tags that are not configured are left out.
    """
    spark = table.sparkSession
    owners = spark.createDataFrame([(i, t.name) for i, t in enumerate(tags)], "owner INT, tag STRING")
    known = table.join(owners, "tag")
    none = F.array().cast("array<array<double>>")
    kinds = ((arrow.TAG, F.array("vector")), (arrow.EXAMPLE, F.col("examples")), (arrow.NEGATIVE, F.col("negatives")))
    lists = F.array(*[F.struct(F.lit(k).alias("kind"), F.coalesce(v.cast("array<array<double>>"), none).alias("vectors")) for k, v in kinds])
    rows = (
        known.select("owner", F.explode(lists).alias("x"))
        .select("owner", "x.kind", F.explode("x.vectors").alias("vector"))
        .filter(F.col("vector").isNotNull())
    )
    path = state_dir(spark, f"tag-vectors-{uuid.uuid4().hex}")
    rows.write.parquet(path)
    return TagVectors(path, spark.read.schema(rows.schema).parquet(path).agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0])


def composite_score(base: Column, example: Column, negative: Column, hit: Column, threshold: Column) -> Column:
    """Weighted mean of the parts that exist, lifted by a keyword hit, lowered by a
    negative example, clamped to [0, 1]."""

    def pick(weights: tuple[float, float]) -> Column:
        return F.when(hit, F.lit(weights[1])).otherwise(F.lit(weights[0]))

    zero = F.lit(0.0)
    w_base = F.when(base.isNotNull(), pick(arrow.BASE_WEIGHT)).otherwise(zero)
    w_example = F.when(example.isNotNull(), pick(arrow.EXAMPLE_WEIGHT)).otherwise(zero)
    w_keyword = F.when(hit, F.lit(arrow.KEYWORD_WEIGHT)).otherwise(zero)
    weight = w_base + w_example + w_keyword
    total = F.coalesce(base, zero) * w_base + F.coalesce(example, zero) * w_example + w_keyword
    mean = F.when(weight > 0, total / weight).otherwise(zero)
    lifted = F.when(hit, F.greatest(mean, threshold)).otherwise(mean)
    lowered = F.when(
        negative.isNotNull(), F.greatest(lifted - negative * arrow.NEGATIVE_WEIGHT, zero)
    ).otherwise(lifted)
    return F.greatest(F.least(lowered, F.lit(1.0)), zero)


def score_entries(
    entries: DataFrame, text: str, vector: str, vectors: TagVectors, tags: Sequence[Tag], keep_all: bool = False
) -> DataFrame:
    """(entry columns, tag, parts, final_score) of tags at or above their threshold.

    Each Arrow batch is multiplied with the tag vectors and only what reaches a threshold comes out,
    so no row per entry and tag is ever made. ``keep_all`` keeps scores below the threshold too.
    """
    plain = [c for c in entries.columns if c not in (text, vector)]
    found = entries.withColumn("_hits", _hits_of(F.lower(text), tags)).select(*plain, vector, "_hits")
    marked = found.withColumns({"_include": _owners(F.col("_hits"), False), "_exclude": _owners(F.col("_hits"), True)})
    keep = [*plain, "_hits"]
    parts = "_owner INT, final_score DOUBLE, base_embedding DOUBLE, example_similarity DOUBLE, _negative DOUBLE"
    schema = T.StructType([*[marked.schema[c] for c in keep], *T.StructType.fromDDL(parts)])
    thresholds = np.array([float(t.threshold) for t in tags])
    file = arrow.TagVectorFile(*vectors)
    scored = marked.mapInArrow(arrow.sparse_scores(file, thresholds, vector, keep, keep_all), schema)
    owner = F.col("_owner")
    blocked = F.exists("_hits", lambda h: (h["owner"] == owner) & h["excludes"])
    return scored.select(
        *plain,
        F.get(_constant([t.name for t in tags], "string"), owner).alias("tag"),
        F.get(_constant(thresholds.tolist(), "double"), owner).alias("threshold"),
        "final_score",
        "base_embedding",
        "example_similarity",
        F.when(blocked, F.array().cast("array<string>")).otherwise(_keywords_of(F.col("_hits"), owner)).alias("keyword_match"),
        F.coalesce(F.col("_negative") * arrow.NEGATIVE_WEIGHT, F.lit(0.0)).alias("negative_penalty"),
    )


Embedder = Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]


def embed_texts(entries: DataFrame, embedder: Embedder, vector: str = "vector") -> DataFrame:
    """Attach vectors with a user-supplied batch embedder (``mapInPandas``)."""
    schema = entries.schema.simpleString()[len("struct<") : -1]
    return entries.mapInPandas(embedder, schema=f"{schema},{vector}:array<float>")


def semantic_or_keyword_tags(entries: DataFrame, text: str, vector: str, vectors: TagVectors, tags: Sequence[Tag]) -> DataFrame:
    """Semantic tags of entries with a vector, keyword tags of those without, in one plan.

    A vector is missing if it is null, has gaps or is not as long as the tags' vectors.
    """
    size = vectors.size
    gap = F.exists(vector, lambda x: x.isNull() | F.isnan(x))
    usable = F.coalesce((F.size(vector) == size) & ~gap, F.lit(False))
    semantic = score_entries(entries.filter(usable), text, vector, vectors, tags)
    keyword = keyword_tags(entries.filter(~usable), text, tags).drop(text, vector)
    return semantic.unionByName(keyword, allowMissingColumns=True)


def with_keyword_fallback(semantic: DataFrame, keyword: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Keyword tags for entries whose embedding failed, semantic tags for the rest."""
    bad = failed.select(key).distinct()
    return semantic.join(bad, key, "left_anti").unionByName(
        keyword.join(bad, key, "left_semi"), allowMissingColumns=True
    )


# -- job ---------------------------------------------------------------------------


#: What tells bills apart: one id may stand in several sessions and states.
PLACE = ["state", "session_id", "bill_id"]


def _shared(one: DataFrame, other: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c in one.columns and c in other.columns]


def already_tagged(entries: DataFrame, bill_tags: DataFrame, tag: str | None = None, overwrite: bool = False) -> DataFrame:
    """Entries with a ``gate``: ``matched`` bills are not scored again.

    A bill is known by its id and by those of state and session that both tables have.
    """
    if overwrite:
        return entries.withColumn("gate", F.lit("todo"))
    known = bill_tags.filter(F.col("tag") == tag) if tag else bill_tags
    keys = _shared(entries, bill_tags, PLACE)
    known = known.select(keys).distinct().withColumn("_known", F.lit(True))
    return (
        entries.join(known, keys, "left")
        .withColumn("gate", F.when(F.col("_known"), "matched").otherwise("todo"))
        .drop("_known")
    )


def text_cache(entries: DataFrame, text: str = "text") -> DataFrame:
    """Distinct texts by hash. Grouping by both columns keeps the hash aggregate."""
    return entries.select(text_hash(F.col(text)).alias("text_hash"), F.col(text).alias("text")).distinct()


def merge_bill_tags(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Stored rows with the rows of this run on top, one per place, tag and bill."""
    both = stored.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)))
    order = [F.desc("_new"), F.desc("final_score"), F.desc("text_hash")]
    return top_per_key(both, [*_shared(stored, fresh, PLACE), "tag"], order, 1).drop("_new")


def tag_job(entries: DataFrame, stored: DataFrame, tags: Sequence[Tag], only: str | None = None, overwrite: bool = False) -> DataFrame:
    """Stored tag table after one keyword run over ``entries(session_id, bill_id, text)``, by state if both
    tables have it. ``tag_store.tag_run`` is the run with vectors, lines out and tag files."""
    wanted = [t for t in tags if only is None or t.name == only]
    todo = already_tagged(entries, stored, only, overwrite).filter(F.col("gate") == "todo").drop("gate")
    fresh = keyword_tags(todo, "text", wanted).select(
        *_shared(entries, stored, PLACE), "tag", text_hash(F.col("text")).alias("text_hash"), "final_score"
    )
    return merge_bill_tags(stored, fresh)
