"""Tagging by keywords and by vectors."""

import uuid

from pyspark.sql import functions as F

from billstream.functions.vectors import mean_pool
from billstream.operators import tagging as G
from billstream.operators.common import top_per_key
from billstream.operators.tag_store import FILE, TagStore, tag_run
from billstream.operators.tagging import Tag
from billstream.plans.registry import query
from billstream.session import saved, state_dir

KEYWORDS = ["then", "the", "que de", "der"]
EDGE = "(^|[^\\p{L}\\p{N}_])"
TAIL = "($|[^\\p{L}\\p{N}_])"


def has_sql(word: str, text: str = "text") -> str:
    if " " in word:
        return f"contains(lower({text}), '{word}')"
    return f"regexp_matches(lower({text}), '{EDGE}{word}{TAIL}')"


@query(
    "keyword_match",
    "SELECT doc_id, concat_ws(',', " + ", ".join(f"CASE WHEN {has_sql(k)} THEN '{k}' END" for k in KEYWORDS) + ") AS found FROM documents",
)
def keyword_match(t):
    lowered = t("documents").select("doc_id", F.lower("text").alias("low"))
    return lowered.select("doc_id", F.array_join(G.matched_keywords(F.col("low"), KEYWORDS), ",").alias("found"))


TAGS = [
    Tag("health", include_keywords=["then", "que de"], exclude_keywords=["der"]),
    Tag("water", include_keywords=["the"], threshold=0.8),
    Tag("road", include_keywords=["der", "que"], exclude_keywords=["thon"], threshold=0.55),
]
KEYWORD_TAGS_SQL = f"""SELECT doc_id, 'health' AS tag, 0.6 AS final_score, concat_ws(',', CASE WHEN {has_sql('then')} THEN 'then' END, CASE WHEN {has_sql('que de')} THEN 'que de' END) AS found
  FROM documents WHERE ({has_sql('then')} OR {has_sql('que de')}) AND NOT {has_sql('der')}
  UNION ALL SELECT doc_id, 'water', 0.8, 'the' FROM documents WHERE {has_sql('the')}
  UNION ALL SELECT doc_id, 'road', 0.6, concat_ws(',', CASE WHEN {has_sql('der')} THEN 'der' END, CASE WHEN {has_sql('que')} THEN 'que' END)
  FROM documents WHERE ({has_sql('der')} OR {has_sql('que')}) AND NOT {has_sql('thon')}"""


@query("keyword_tags", KEYWORD_TAGS_SQL)
def keyword_tags(t):
    return G.keyword_tags(t("documents"), "text", TAGS).select(
        "doc_id", "tag", "final_score", F.array_join("keyword_match", ",").alias("found")
    )


MANY = [a + b for a in ("th", "an", "er", "re", "en", "in") for b in ("e", "en", "er", "on", "es")]
MANY_SQL = " UNION ALL ".join(f"SELECT '{w}' AS word" for w in MANY)


@query(
    "keyword_tags_many",
    f"""WITH w AS ({MANY_SQL}), d AS (SELECT doc_id, list_distinct(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+')) AS words FROM documents)
  SELECT doc_id, word AS tag FROM d JOIN w ON list_contains(d.words, w.word)""",
)
def keyword_tags_many(t):
    tags = [Tag(w, include_keywords=[w]) for w in MANY]
    return G.keyword_tags(t("documents"), "text", tags).select("doc_id", "tag")


@query(
    "rank_tags",
    f"""SELECT doc_id, tag, final_score, row_number() OVER (PARTITION BY doc_id ORDER BY final_score DESC, tag) AS tag_rank FROM ({KEYWORD_TAGS_SQL}) x""",
)
def rank_tags(t):
    return G.rank_tags(G.keyword_tags(t("documents"), "text", TAGS), ["doc_id"])


@query(
    "sink_tagfile",
    f"""SELECT b.session_id, x.tag, 'HB' || x.doc_id AS bill_id, sha256(d.text) AS text_hash, x.final_score FROM ({KEYWORD_TAGS_SQL}) x
  JOIN documents d USING (doc_id) JOIN b_bill b ON b.bill_id = 'HB' || x.doc_id""",
)
def sink_tagfile(t):
    return G.tag_job(tag_entries(t), empty_tags(t), TAGS)


def tag_entries(t):
    bills = t("b_bill").select("bill_id", "session_id")
    return t("b_text").select("bill_id", "text", "doc_id").join(bills, "bill_id")


def empty_tags(t):
    return t.spark.createDataFrame(
        [], "session_id STRING, tag STRING, bill_id STRING, text_hash STRING, final_score DOUBLE"
    )


@query(
    "tag_job",
    f"""WITH k AS ({KEYWORD_TAGS_SQL}), one AS (SELECT doc_id, tag, final_score FROM k WHERE tag = 'water' AND doc_id % 3 <> 0),
  two AS (SELECT doc_id, tag, final_score FROM k WHERE doc_id NOT IN (SELECT doc_id FROM one)), u AS (SELECT * FROM one UNION ALL SELECT * FROM two)
  SELECT b.session_id, u.tag, 'HB' || u.doc_id AS bill_id, sha256(d.text) AS text_hash, u.final_score FROM u JOIN documents d USING (doc_id) JOIN b_bill b ON b.bill_id = 'HB' || u.doc_id""",
)
def tag_job(t):
    entries = tag_entries(t)
    # First run: one tag over two thirds of the bills. Second run: all tags over all bills.
    after_one = saved(G.tag_job(entries.filter("doc_id % 3 <> 0"), empty_tags(t), TAGS, only="water"))
    return G.tag_job(entries, after_one, TAGS)


# Two runs over entries of which every tenth bill id also stands in a second session, and some lines twice.
STORE_SQL = f"""WITH k AS ({KEYWORD_TAGS_SQL}), n AS (SELECT doc_id, substring(state, 1, 2) AS state, session_id FROM documents JOIN b_bill ON bill_id = 'HB' || doc_id),
  x AS (SELECT doc_id, state, session_id, FALSE AS extra FROM n UNION ALL SELECT doc_id, state, 'extra', TRUE FROM n WHERE doc_id % 10 = 0),
  one AS (SELECT doc_id FROM k WHERE tag = 'water' AND doc_id % 3 <> 0),
  s AS (SELECT x.*, tag, final_score, found, CASE WHEN NOT extra AND doc_id IN (SELECT doc_id FROM one) THEN 'run1' ELSE 'run2' END AS run FROM x JOIN k USING (doc_id)),
  b AS (SELECT * FROM s WHERE run = 'run2' OR tag = 'water')"""


def stored_runs(t):
    """The store after two runs, and the lines that each run gave out."""
    bills = t("b_bill").select("bill_id", F.substring("state", 1, 2).alias("state"), "session_id")
    rows = t("b_text").select("bill_id", "text", "doc_id").join(bills, "bill_id").withColumn("line_no", F.col("doc_id"))
    extra = rows.filter("doc_id % 10 = 0").withColumn("session_id", F.lit("extra"))
    again = rows.filter("doc_id % 4 = 0").withColumns({"line_no": F.col("doc_id") + 1_000_000_000, "text": F.lit("nothing")})
    store = TagStore(t.spark, state_dir(t.spark, f"tags-{uuid.uuid4().hex}"))
    lines = [
        tag_run(rows.filter("doc_id % 3 <> 0"), store, TAGS, "run1", only="water"),
        tag_run(rows.unionByName(extra).unionByName(again), store, TAGS, "run2"),
    ]
    return store, lines


@query("tag_store_bills", STORE_SQL + " SELECT state, session_id, tag, 'HB' || doc_id AS bill_id, sha256(text) AS text_hash, final_score, found FROM b JOIN documents USING (doc_id)")
def tag_store_bills(t):
    store, _ = stored_runs(t)
    found = F.array_join("keyword_match", ",").alias("found")
    return store.read("bills").select("state", "session_id", "tag", "bill_id", "text_hash", "final_score", found)


@query(
    "tag_store_files",
    STORE_SQL
    + """ SELECT state, session_id, tag, CASE WHEN bool_or(run = 'run2') THEN 'run2' ELSE 'run1' END AS last_run, 'keyword-fallback' AS model, count(DISTINCT sha256(text)) AS texts,
  CASE tag WHEN 'water' THEN 0.8 WHEN 'road' THEN 0.55 ELSE 0.5 END AS threshold, TRUE AS hashed FROM b JOIN documents USING (doc_id) GROUP BY state, session_id, tag""",
)
def tag_store_files(t):
    store, _ = stored_runs(t)
    texts = store.read("texts").groupBy(*FILE).agg(F.count("*").alias("texts"))
    threshold = F.get_json_object("tag_config", "$.threshold").cast("double").alias("threshold")
    hashed = (F.sha2("tag_config", 256) == F.col("tag_config_hash")).alias("hashed")
    return store.read("heads").join(texts, FILE).select(*FILE, "last_run", "model", "texts", threshold, hashed)


@query(
    "tag_store_lines",
    STORE_SQL
    + """, y AS (SELECT DISTINCT doc_id, session_id FROM s)
  SELECT 1 AS run, doc_id AS line_no, session_id FROM n WHERE doc_id IN (SELECT doc_id FROM one)
  UNION ALL SELECT 2, doc_id, session_id FROM y UNION ALL SELECT 2, doc_id + 1000000000, session_id FROM y WHERE doc_id % 4 = 0 AND session_id <> 'extra'""",
)
def tag_store_lines(t):
    _, lines = stored_runs(t)
    one, two = (df.select(F.lit(run).cast("bigint").alias("run"), "line_no", "session_id") for run, df in enumerate(lines, 1))
    return one.unionByName(two)


@query(
    "tag_vector_text",
    "SELECT item_id, CASE WHEN item_id % 3 = 0 THEN text ELSE text || ' Examples: ' || substring(text, 1, 10) || ' | ' || substring(text, 11, 10) END AS vector_text FROM benchmark",
)
def tag_vector_text(t):
    examples = F.when(F.col("item_id") % 3 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.substring("text", 1, 10), F.substring("text", 11, 10))
    )
    return t("benchmark").select("item_id", G.tag_vector_text(F.col("text"), examples).alias("vector_text"))


@query(
    "config_hash",
    """SELECT item_id, sha256('{"name":"tag_' || item_id || '","description":' || CAST(to_json(text) AS VARCHAR) || ',"threshold":0.5}') AS config_hash, item_id % 2 = 1 AS replaced FROM benchmark""",
)
def config_hash(t):
    tags = t("benchmark").select(
        "item_id",
        F.concat(F.lit("tag_"), F.col("item_id").cast("string")).alias("name"),
        F.col("text").alias("description"),
        F.lit(0.5).alias("threshold"),
    )
    new = tags.withColumn("config_hash", G.config_hash("name", "description", "threshold"))
    # Half of the stored configurations are older.
    stored = tags.withColumn("threshold", F.when(F.col("item_id") % 2 == 1, F.lit(0.4)).otherwise(F.lit(0.5))).select(
        "item_id", G.config_hash("name", "description", "threshold").alias("stored_hash")
    )
    return new.join(stored, "item_id").select("item_id", "config_hash", (F.col("config_hash") != F.col("stored_hash")).alias("replaced"))


# -- vectors: labels stand for tags -----------------------------------------------------

VECTOR_CTE = """e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
  x AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e), c AS (SELECT label, i, avg(x) AS m FROM x GROUP BY 1, 2),
  ctr AS (SELECT label, list(m ORDER BY i) AS m FROM c GROUP BY 1),
  two AS (SELECT label, v FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS rn FROM e) r WHERE rn <= 2),
  neg AS (SELECT (label + 9) % 10 AS label, v FROM two WHERE label % 2 = 1),
  sim AS (SELECT e.vec_id, ctr.label, list_dot_product(e.v, ctr.m) / greatest(sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(ctr.m, ctr.m)), 1e-9) AS base FROM e, ctr),
  ex AS (SELECT e.vec_id, t.label, greatest(max(list_dot_product(e.v, t.v) / greatest(sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(t.v, t.v)), 1e-9)), 0) AS best FROM e, two t GROUP BY 1, 2),
  ng AS (SELECT e.vec_id, t.label, greatest(max(list_dot_product(e.v, t.v) / greatest(sqrt(list_dot_product(e.v, e.v)) * sqrt(list_dot_product(t.v, t.v)), 1e-9)), 0) AS best FROM e, neg t GROUP BY 1, 2)"""

VECTOR_TAGS = [
    Tag("0", include_keywords=["then"], threshold=0.45),
    Tag("1", include_keywords=["the"], exclude_keywords=["thon"], threshold=0.5),
    Tag("2", include_keywords=["que"], exclude_keywords=["der"], threshold=0.4),
    *[Tag(str(i), threshold=0.4) for i in range(3, 10)],
]
SCORE_CTE = f"""{VECTOR_CTE}, txt AS (SELECT doc_id AS vec_id, {has_sql('then')} AS k0, {has_sql('the')} AS k1, {has_sql('thon')} AS x1, {has_sql('que')} AS k2, {has_sql('der')} AS x2 FROM documents),
  p AS (SELECT vec_id, label, base, ex.best AS example, ng.best AS negative, CASE label WHEN 0 THEN k0 WHEN 1 THEN k1 WHEN 2 THEN k2 ELSE FALSE END AS hit,
    CASE label WHEN 1 THEN x1 WHEN 2 THEN x2 ELSE FALSE END AS blocked, CASE label WHEN 0 THEN 0.45 WHEN 1 THEN 0.5 ELSE 0.4 END AS threshold
    FROM sim JOIN ex USING (vec_id, label) LEFT JOIN ng USING (vec_id, label) JOIN txt USING (vec_id)),
  w AS (SELECT *, CASE WHEN hit THEN greatest(base * 0.35 + example * 0.25 + 0.4, threshold) ELSE (base * 0.5 + example * 0.35) / 0.85 END AS lifted FROM p),
  s AS (SELECT vec_id, CAST(label AS VARCHAR) AS tag, threshold, CASE WHEN blocked THEN 0 ELSE greatest(0, least(1, CASE WHEN negative IS NULL THEN lifted ELSE greatest(lifted - negative * 0.25, 0) END)) END AS final_score,
    CASE WHEN NOT blocked THEN base END AS base, CASE WHEN NOT blocked THEN example END AS example, CASE WHEN blocked THEN 0 ELSE coalesce(negative * 0.25, 0) END AS penalty FROM w)"""


def tag_vector_table(t):
    """Tag vector, examples and negatives per label; bounded lists of two."""
    e = t("embeddings").select("label", "embedding", "vec_id")
    center = mean_pool(e, "label", "embedding").withColumnRenamed("embedding", "vector")
    two = top_per_key(e, ["label"], [F.asc("vec_id")], 2)
    lists = two.groupBy("label").agg(F.collect_list("embedding").alias("examples"))
    negatives = lists.filter("label % 2 = 1").select(
        ((F.col("label") + 9) % 10).alias("label"), F.col("examples").alias("negatives")
    )
    joined = center.join(lists, "label").join(negatives, "label", "left")
    return joined.select(F.col("label").cast("string").alias("tag"), "vector", "examples", "negatives")


def scored(t, keep_all):
    texts = t("documents").select(F.col("doc_id").alias("vec_id"), "text")
    entries = t("embeddings").select("vec_id", F.col("embedding").alias("vector")).join(texts, "vec_id")
    vectors = G.store_tag_vectors(tag_vector_table(t), VECTOR_TAGS)
    return G.score_entries(entries, "text", "vector", vectors, VECTOR_TAGS, keep_all)


@query(
    "composite_score",
    f"""WITH {SCORE_CTE} SELECT vec_id, tag, round(final_score, 5) AS final_score, round(base, 5) AS base_embedding, round(example, 5) AS example_similarity, round(penalty, 5) AS negative_penalty FROM s""",
)
def composite_score(t):
    return scored(t, True).select(
        "vec_id",
        "tag",
        *[F.round(c, 5).alias(c) for c in ("final_score", "base_embedding", "example_similarity", "negative_penalty")],
    )


@query("semantic_tags", f"WITH {SCORE_CTE} SELECT vec_id, tag, round(final_score, 5) AS final_score FROM s WHERE final_score >= threshold")
def semantic_tags(t):
    return scored(t, False).select("vec_id", "tag", F.round("final_score", 5).alias("final_score"))


@query(
    "semantic_tags_fallback",
    f"""WITH {SCORE_CTE} SELECT vec_id, tag, round(final_score, 5) AS final_score FROM s WHERE final_score >= threshold AND vec_id % 5 <> 0
  UNION ALL SELECT vec_id, '0', 0.6 FROM txt WHERE k0 AND vec_id % 5 = 0 AND vec_id IN (SELECT vec_id FROM e)
  UNION ALL SELECT vec_id, '1', 0.6 FROM txt WHERE k1 AND NOT x1 AND vec_id % 5 = 0 AND vec_id IN (SELECT vec_id FROM e)
  UNION ALL SELECT vec_id, '2', 0.6 FROM txt WHERE k2 AND NOT x2 AND vec_id % 5 = 0 AND vec_id IN (SELECT vec_id FROM e)""",
)
def semantic_tags_fallback(t):
    # The embedder failed on every fifth entry.
    texts = t("documents").select(F.col("doc_id").alias("vec_id"), "text")
    failed = t("embeddings").select("vec_id").filter("vec_id % 5 = 0")
    keyword = G.keyword_tags(texts.join(t("embeddings").select("vec_id"), "vec_id"), "text", VECTOR_TAGS).select("vec_id", "tag", "final_score")
    semantic = scored(t, False).select("vec_id", "tag", F.round("final_score", 5).alias("final_score"))
    return G.with_keyword_fallback(semantic, keyword, failed, "vec_id")


@query(
    "tag_job_semantic",
    f"""WITH {SCORE_CTE}, f AS (SELECT vec_id, tag, final_score FROM s WHERE final_score >= threshold AND vec_id % 5 <> 0
  UNION ALL SELECT vec_id, '0', 0.6 FROM txt WHERE k0 AND vec_id % 5 = 0 AND vec_id IN (SELECT vec_id FROM e)
  UNION ALL SELECT vec_id, '1', 0.6 FROM txt WHERE k1 AND NOT x1 AND vec_id % 5 = 0 AND vec_id IN (SELECT vec_id FROM e)
  UNION ALL SELECT vec_id, '2', 0.6 FROM txt WHERE k2 AND NOT x2 AND vec_id % 5 = 0 AND vec_id IN (SELECT vec_id FROM e))
  SELECT tag, 'HB' || vec_id AS bill_id, round(final_score, 5) AS final_score, vec_id % 5 <> 0 AS by_vector FROM f""",
)
def tag_job_semantic(t):
    # Every fifth entry has no vector; all of them go through one run with one plan.
    vector = F.when(F.col("vec_id") % 5 != 0, F.col("embedding").cast("array<double>")).alias("vector")
    texts = t("documents").select(F.col("doc_id").alias("vec_id"), "text")
    entries = t("embeddings").select("vec_id", vector).join(texts, "vec_id").select(
        F.lit("n00").alias("state"), F.lit("2024").alias("session_id"), F.concat(F.lit("HB"), F.col("vec_id").cast("string")).alias("bill_id"),
        "text", "vector", F.col("vec_id").alias("line_no"),
    )
    store = TagStore(t.spark, state_dir(t.spark, f"tags-{uuid.uuid4().hex}"))
    tag_run(entries, store, VECTOR_TAGS, "run1", vectors=G.store_tag_vectors(tag_vector_table(t), VECTOR_TAGS), model="given")
    by_vector = F.col("base_embedding").isNotNull().alias("by_vector")
    return store.read("bills").select("tag", "bill_id", F.round("final_score", 5).alias("final_score"), by_vector)


@query(
    "example_max_similarity",
    f"WITH {VECTOR_CTE} SELECT vec_id, CAST(label AS VARCHAR) AS tag, round(best, 5) AS similarity FROM ex",
)
def example_max_similarity(t):
    plain = [Tag(tag.name) for tag in VECTOR_TAGS]
    entries = t("embeddings").select("vec_id", F.lit("").alias("text"), F.col("embedding").alias("vector"))
    scores = G.score_entries(entries, "text", "vector", G.store_tag_vectors(tag_vector_table(t), plain), plain, True)
    return scores.select("vec_id", "tag", F.round("example_similarity", 5).alias("similarity"))
