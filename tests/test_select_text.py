"""The open text selector against a plain walk over Python objects."""

import json
import random

from pyspark.sql import functions as F

from billstream.functions.entries import BILL_TEXTS, DENIED_KEYS, select_text


def walk(value):
    if isinstance(value, str):
        return value
    if isinstance(value, list):
        return " ".join(map(walk, value))
    if not isinstance(value, dict):
        return ""

    def at(x, key):
        return x.get(key) if isinstance(x, dict) else None

    def strings(*values):
        return [v for v in values if isinstance(v, str)]

    texts, bill, log = [], at(value, "bill"), at(value, "log")
    for key, whole in BILL_TEXTS:
        if whole and isinstance(bill, dict) and key in bill:
            texts.append(walk(bill[key]))
        elif not whole:
            texts += strings(at(bill, key))
    texts += strings(at(at(log, "action"), "description"), at(log, "action"))
    held = isinstance(log, dict) and "bill_id" in log
    texts += strings(at(log, "bill_id" if held else "bill_identifier"))
    texts += strings(at(at(value, "action"), "description"), at(value, "action"))
    for key in sorted(value):
        if not key.startswith("_") and key not in DENIED_KEYS:
            if isinstance(value[key], (dict, list)):
                texts.append(walk(value[key]))
            texts += strings(value[key])
    return " ".join(texts)


KEYS = [
    "bill", "log", "action", "title", "subject", "abstracts", "legislative_session", "from_organization", "description",
    "bill_id", "bill_identifier", "_x", "id", "notes", "zeta", "é",
]


def some_json(rng, depth):
    if depth <= 0 or rng.random() < 0.3:
        return rng.choice(["text", "a b", "", "[{", None, 3, 1.5, True, "é"])
    if rng.random() < 0.35:
        return [some_json(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(KEYS): some_json(rng, depth - 1) for _ in range(rng.randint(0, 6))}


def texts(spark, bodies):
    rows = spark.createDataFrame(list(enumerate(bodies)), "i long, body string")
    got = rows.select("i", select_text(F.try_parse_json("body")).alias("text"))
    return got, [r.text for r in got.orderBy("i").collect()]


def test_any_json(spark):
    rng = random.Random(4)
    values = [some_json(rng, rng.randint(0, 6)) for _ in range(600)]
    _, got = texts(spark, [json.dumps(v) for v in values])
    assert got == [walk(v) for v in values]


def test_depth_needs_no_longer_plan(spark):
    deep, shallow = "end", {"a": "end"}
    for i in range(400):
        deep = {"n": deep} if i % 2 else [deep]
    frames = [texts(spark, [json.dumps(v)]) for v in (deep, shallow)]
    assert [got for _, got in frames] == [["end"], ["end"]]
    plans = [df._jdf.queryExecution().executedPlan().toString() for df, _ in frames]
    assert plans[0].count("lambda") == plans[1].count("lambda")
    assert all("Exchange" not in p and "Generate" not in p and "Python" not in p for p in plans)


def test_missing_and_damaged(spark):
    assert texts(spark, [None, "{", "null", "{}", "[]", "7"])[1] == [None, None, "", "", "", ""]
