"""Chat formatting with DataFrame expressions only.

A message is ``### role: `` followed by the texts of its turns, each ended by ``</turn>``; adjacent
turns of one role share a message, and messages are joined by a line feed. Texts and roles are
escaped with a backslash so that no control string can stand inside them, and come back unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HEAD, SEP, END = "### ", ": ", "</turn>"
SPANS = "array<struct<start:int,end:int>>"


def escaped(text: Column) -> Column:
    """No ``#`` without a backslash and no ``</`` is left."""
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(text, F.lit("#"), F.lit("\\#")), F.lit("</"), F.lit("<\\/"))


def escaped_role(role: Column) -> Column:
    return F.replace(escaped(role), F.lit(":"), F.lit("\\:"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_conversations(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """One row per conversation: ``formatted`` and ``loss_spans`` (code points, end exclusive).

    Input: ``conv_id``, ``turn``, ``role``, ``text``; other columns are ignored. Rows go by turn
    (null first); equal turns go by role, then text, and repeated rows stay. Null role or text is
    empty. Rows with a null ``conv_id`` form one conversation. An empty table gives no row.
    ``loss_spans`` covers the escaped text of each turn of a loss role, nothing between.
    """
    text, role = F.coalesce("text", F.lit("")).alias("text"), F.coalesce("role", F.lit("")).alias("role")
    collected = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", role, text))).alias("turns"))
    first = F.struct(
        F.lit(0).alias("at"), F.lit(None).cast("string").alias("role"), F.array().cast("array<string>").alias("pieces"), F.array().cast(SPANS).alias("spans")
    )

    def add(seen: Column, turn: Column) -> Column:
        joins = F.coalesce(seen["role"] == turn["role"], F.lit(False))
        head = F.concat(F.when(seen["role"].isNull(), "").otherwise("\n"), F.lit(HEAD), escaped_role(turn["role"]), F.lit(SEP))

        def put(piece: Column) -> Column:
            start = seen["at"] + F.length(piece["head"])
            end = start + F.length(piece["body"])
            span = F.when(turn["role"].isin(*loss_roles), F.array(F.struct(start.alias("start"), end.alias("end")))).otherwise(F.array().cast(SPANS))
            return F.struct(
                (end + len(END)).alias("at"),
                turn["role"].alias("role"),
                F.concat(seen["pieces"], F.array(F.concat(piece["head"], piece["body"], F.lit(END)))).alias("pieces"),
                F.concat(seen["spans"], span).alias("spans"),
            )

        piece = F.struct(F.when(joins, "").otherwise(head).alias("head"), escaped(turn["text"]).alias("body"))
        return F.element_at(F.transform(F.array(piece), put), 1)

    merged = collected.select("conv_id", F.aggregate("turns", first, add).alias("all"))
    return merged.select("conv_id", F.array_join("all.pieces", "").alias("formatted"), F.col("all.spans").alias("loss_spans"))


def parsed_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of ``role``, ``text``."""

    def turns_of(message: Column) -> Column:
        role = F.regexp_extract(message, r"(?s)^((?:[^\\:]|\\.)*): ", 1)
        # The last piece stands after the last end mark.
        bodies = F.split(F.substr(message, F.length(role) + 1 + len(SEP)), END, -1)
        kept = F.slice(bodies, F.lit(1), F.size(bodies) - 1)
        return F.transform(kept, lambda b: F.struct(unescaped(role).alias("role"), unescaped(b).alias("text")))

    messages = F.split(F.substr(formatted, F.lit(1 + len(HEAD))), "\n" + HEAD, -1)
    return F.flatten(F.transform(messages, turns_of))


def loss_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(spans, lambda s: unescaped(F.substr(formatted, s["start"] + 1, s["end"] - s["start"]))), "")


def formatted_digests(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: counts and digests of turns, and of the text under the loss mask."""
    turns = formatted.withColumn("turns", parsed_turns(F.col("formatted")))
    loss = loss_text(F.col("formatted"), F.col("loss_spans"))
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return turns.withColumn("loss", loss).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op4_chat_formatting(spark, sf_dir: str) -> DataFrame:
    """All conversations and one whose texts hold control strings, read back from the output."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hard).alias("text"),
    )
    return formatted_digests(format_conversations(given.unionByName(added)))


OP4_SQL = r"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), r AS (
  SELECT *, row_number() OVER w AS rn, lag(role) OVER w AS before,
    length(replace(replace(replace(text, '\', '\\'), '#', '\#'), '</', '<\/')) AS body,
    length(replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</', '<\/'), ':', '\:')) AS name
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY rn)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY rn) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(body + 7 + CASE WHEN before IS NULL OR before <> role THEN name + 6 + (rn > 1)::INT ELSE 0 END)::BIGINT
    AS formatted_chars
FROM r GROUP BY conv_id
"""
