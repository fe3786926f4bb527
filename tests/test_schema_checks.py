"""Schema violations against a plain check of Python objects."""

import json
import random

import pytest
from pyspark.sql import functions as F

from billstream.operators.schema_checks import SchemaCompiler, schema_violations
from billstream.rules.record_schemas import SCHEMAS

SCHEMA = {
    "type": "object",
    "required": ["a", "n"],
    "additionalProperties": False,
    "properties": {
        "a": {"type": "string", "enum": ["x", "y"]},
        "n": {"type": ["number", "null"], "minimum": 2},
        "d": {"type": "string", "format": "date"},
        "t": {"format": "date-time"},
        "tags": {"type": "array", "items": {"type": "string", "format": "uri"}},
        "kids": {"type": "array", "items": {"$ref": "#/definitions/Kid"}},
        "sub": {"$ref": "#/definitions/Kid"},
        "any": {"$ref": "#/definitions/Missing"},
    },
    "definitions": {"Kid": {"type": "object", "required": ["k"], "properties": {"k": {"type": "integer"}, "deep": {"type": "array", "items": {"type": "array", "items": {"type": "boolean"}}}}}},
}


def kind(v):
    names = {type(None): "null", bool: "boolean", int: "integer", float: "number", str: "string", list: "array", dict: "object"}
    return names[type(v)]


def check(v, schema, path=""):
    schema = SCHEMA["definitions"].get(schema["$ref"].split("/")[-1], {}) if "$ref" in schema else schema
    types = [schema["type"]] if isinstance(schema.get("type"), str) else schema.get("type", [])
    if types and kind(v) not in types and not (kind(v) == "integer" and "number" in types):
        return [(path, "type")]
    out = []
    if "enum" in schema and v not in schema["enum"]:
        out.append((path, "enum"))
    if "format" in schema and isinstance(v, str) and v not in GOOD[schema["format"]]:
        out.append((path, "format"))
    if "minimum" in schema and kind(v) in ("integer", "number") and v < schema["minimum"]:
        out.append((path, "minimum"))
    if isinstance(v, dict):
        at = lambda n: f"{path}.{n}" if path else n
        out += [(at(n), "required") for n in schema.get("required", []) if n not in v]
        if schema.get("additionalProperties") is False:
            out += [(at(n), "additional") for n in v if n not in schema["properties"]]
        for n, s in schema.get("properties", {}).items():
            if n in v:
                out += check(v[n], s, at(n))
    if isinstance(v, list) and "items" in schema:
        for i, x in enumerate(v):
            out += check(x, schema["items"], f"{path}[{i}]")
    return out


GOOD = {
    "date": ["2024-02-29"],
    "date-time": ["2024-02-29T23:59:60Z", "2024-01-01t00:00:00.5+05:30"],
    "uri": ["https://x.y/z?q", "urn:a"],
}
TEXTS = ["x", "z", "", "2023-02-29", "2023-02-29T00:00:00Z", "2024-01-01 00:00:00Z", "2024-01-01T24:00:00Z", "no uri", *sum(GOOD.values(), [])]


def some(rng, depth=3):
    r = rng.random()
    if depth == 0 or r < 0.45:
        return rng.choice([*TEXTS, *TEXTS, None, True, 1, 2, 3.5, 1.5, -7])
    if r < 0.65:
        return [some(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice([*SCHEMA["properties"], "k", "deep", "more"]): some(rng, depth - 1) for _ in range(rng.randint(0, 8))}


def test_any_value(spark):
    rng = random.Random(3)
    values = [{**v, **{n: some(rng, 3) for n in rng.sample(["a", "n", "d", "t", "tags", "kids", "sub"], 4)}} if isinstance(v := some(rng), dict) else v for _ in range(500)]
    df = spark.createDataFrame([(i, json.dumps(v)) for i, v in enumerate(values)], "i INT, body STRING")
    rows = df.select("i", SchemaCompiler(SCHEMA).violations("try_parse_json(body)").alias("v")).orderBy("i").collect()
    got = [sorted(tuple(x) for x in r.v) for r in rows]
    want = [sorted(check(v, SCHEMA)) for v in values]
    assert got == want and {rule for w in want for _, rule in w} >= {"type", "enum", "format", "minimum", "required", "additional"}


def test_a_schema_that_contains_itself_is_refused():
    with pytest.raises(ValueError, match="contains itself"):
        SchemaCompiler({"$ref": "#/definitions/A", "definitions": {"A": {"properties": {"a": {"$ref": "#/definitions/A"}}}}})._resolved({"$ref": "#/definitions/A"}, ("A",))


def test_records(spark):
    good = {"_id": "o", "name": "n", "classification": "upper", "parent_id": None, "links": [], "sources": [{"a": 1}], "extras": {}}
    rows = [("organization", json.dumps(good)), ("organization", json.dumps({**good, "classification": None, "x": 1})), ("organization", "{"), ("organization", None), ("unknown", "{")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i INT, kind STRING, body STRING")
    got = sorted((r.i, r.path, r.rule) for r in schema_violations(df, SCHEMAS).collect())
    assert got == [(1, "classification", "type"), (1, "x", "additional"), (2, "", "json"), (3, "", "json")]
