import hashlib
from itertools import groupby

from conftest_llm import table
from pyspark.sql import functions as F

from billstream.llm import chat

ROWS = [
    (1, 0, "user", "hi"), (1, 1, "assistant", "yes"), (1, 2, "assistant", "and </turn> ### x: \\"),
    (2, 1, "assistant", None), (2, 0, None, "no role"), (2, 1, "assistant", None),
    (3, 0, "a: b\\", "\n### user: fake</turn>"), (3, 0, "a: b\\", ""), (3, None, "assistant", "first"),
    (None, 0, "user", "no conversation"), (4, 0, "assistant", "é漢\n\n" * 4000), (5, 2, "user", "<\\/turn> \\# </"),
    (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
]


def expected():
    out = {}
    for conv in {r[0] for r in ROWS}:
        mine = sorted(
            ((t, r or "", x or "") for c, t, r, x in ROWS if c == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
        )
        out[conv] = [(r, x) for _, r, x in mine]
    return out


def chats(spark, rows=ROWS):
    return table(spark, rows, "conv_id long, turn long, role string, text string")


def test_every_text_comes_back(spark):
    got = chat.format_conversations(chats(spark)).select("conv_id", chat.parsed_turns(F.col("formatted")).alias("t"))
    assert {r.conv_id: [tuple(t) for t in r.t] for r in got.collect()} == expected()


def test_digests_spans_and_merging(spark):
    formatted = chat.format_conversations(chats(spark))
    whole = {r.conv_id: r for r in formatted.collect()}
    got = {r.conv_id: r for r in chat.formatted_digests(formatted).collect()}
    for conv, turns in expected().items():
        text = "".join(f"{r}\n{x}\n" for r, x in turns)
        loss = "".join(x for r, x in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
        row = whole[conv]
        assert got[conv].formatted_chars == len(row.formatted)
        # One header for adjacent turns of a role; the mask covers the escaped texts alone.
        assert row.formatted.count("\n### ") + 1 == len(list(groupby(turns, key=lambda t: t[0])))
        pieces = [row.formatted[s.start : s.end] for s in row.loss_spans]
        escaped = [x.replace("\\", "\\\\").replace("#", "\\#").replace("</", "<\\/") for r, x in turns if r == "assistant"]
        assert pieces == escaped


def test_a_wrong_mask_shows(spark):
    """The digests come from the mask, not from the roles."""
    formatted = chat.format_conversations(chats(spark)).where("conv_id = 1")
    moved = formatted.withColumn("loss_spans", F.transform("loss_spans", lambda s: F.struct((s.start + 1).alias("start"), s.end.alias("end"))))
    right, wrong = (chat.formatted_digests(df).first() for df in (formatted, moved))
    assert wrong.loss_chars < right.loss_chars and wrong.loss_sha256 != right.loss_sha256
    assert wrong.turns_sha256 == right.turns_sha256


def test_many_turns(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"t{i}#") for i in range(3000)]
    got = chat.formatted_digests(chat.format_conversations(chats(spark, rows))).first()
    loss = "".join(x for _, _, r, x in rows if r == "assistant")
    assert (got.n_turns, got.loss_chars, got.loss_sha256) == (3000, len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_empty_table(spark):
    assert chat.formatted_digests(chat.format_conversations(chats(spark, []))).count() == 0


def test_no_python_in_the_plan(spark):
    plan = chat.formatted_digests(chat.format_conversations(chats(spark)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
