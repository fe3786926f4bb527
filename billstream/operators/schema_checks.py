"""JSON Schema as SQL expressions: one row for everything a record violates."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A date that exists is tested apart from its shape.
FORMATS = {
    "date": r"^\d{4}-\d{2}-\d{2}$",
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt]([01]\d|2[0-3]):[0-5]\d:([0-5]\d|60)(\.\d+)?([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$",
    "uri": r"^[A-Za-z][A-Za-z0-9+.-]*:[^\s]+$",
}
VIOLATIONS = "array<struct<path:string,rule:string>>"
NONE = f"CAST(array() AS {VIOLATIONS})"
RULES = "types:array<string>,enum:array<string>,minimum:double,format:string,dated:boolean"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _constant(value, kind: str) -> str:
    """One node of the plan, whatever it holds."""
    return f"from_json({_text(json.dumps(value))}, '{kind}')"


def _members(value: str) -> str:
    return f"try_variant_get({value}, '$', 'map<string,variant>')"


def _items(value: str) -> str:
    return f"try_variant_get({value}, '$', 'array<variant>')"


def _kind(value: str) -> str:
    """The JSON Schema type of a ``VARIANT``; a null member is a JSON null."""
    scalar = f"schema_of_variant({value})"
    return (
        f"CASE WHEN {value} IS NULL OR {scalar} = 'VOID' THEN 'null' WHEN {_members(value)} IS NOT NULL THEN 'object' "
        f"WHEN {_items(value)} IS NOT NULL THEN 'array' WHEN {scalar} = 'STRING' THEN 'string' WHEN {scalar} = 'BOOLEAN' THEN 'boolean' "
        f"WHEN {scalar} = 'BIGINT' OR {scalar} LIKE '%,0)' THEN 'integer' ELSE 'number' END"
    )


def _found(path: str, rule: str) -> str:
    return f"named_struct('path', {path}, 'rule', '{rule}')"


def _if(broken: str, path: str, rule: str) -> str:
    return f"IF(coalesce({broken}, false), array({_found(path, rule)}), {NONE})"


def _joined(parts: list[str]) -> str:
    return f"concat({', '.join(parts)})" if parts else NONE


def _under(path: str, name: str) -> str:
    return f"concat({path}, IF({path} = '', '', '.'), {name})"


def _item(path: str, i: str) -> str:
    return f"concat({path}, '[', {i}, ']')"


def _scalar_rules(schema: Mapping) -> dict:
    """What a value itself has to be, as data."""
    wanted = schema.get("type", [])
    wanted = [wanted] if isinstance(wanted, str) else list(wanted)
    types = [*wanted, "integer"] if "number" in wanted else wanted
    out = {"types": types or None, "enum": schema.get("enum"), "minimum": schema.get("minimum")}
    if schema.get("format") in FORMATS:
        out |= {"format": FORMATS[schema["format"]], "dated": schema["format"] != "uri"}
    return {k: v for k, v in out.items() if v is not None}


def _holds_rules(schema: Mapping) -> bool:
    return bool({"properties", "required", "items"} & set(schema))


class SchemaCompiler:
    """Builds the expression of one schema; ``$ref`` takes a definition of the same schema.

    Known words: type, enum, format (date, date-time, uri), minimum, required, properties,
    additionalProperties false, items. A definition that is missing allows anything. A schema that
    contains itself cannot be written out and is refused. What values themselves have to be is a
    constant of the plan; only objects and arrays within others add expressions.
    """

    def __init__(self, schema: Mapping):
        self.schema, self.definitions, self._numbers = schema, schema.get("definitions", {}), count()

    def violations(self, value: str) -> Column:
        """An array of path and rule for a column of type ``VARIANT``."""
        rules = _constant(_scalar_rules(self.schema), f"struct<{RULES}>")
        whole = self._bound(value, lambda v: _joined([self._scalar(rules, v, "''"), self._inside(v, self.schema, "''", ())]))
        return F.expr(whole)

    def _name(self) -> str:
        return f"x{next(self._numbers)}"

    def _bound(self, value: str, use: Callable[[str], str]) -> str:
        """``use`` of a value that is evaluated once."""
        return f"element_at({self._each(f'array({value})', use)}, 1)"

    def _each(self, values: str, use: Callable[[str], str]) -> str:
        x = self._name()
        return f"transform({values}, {x} -> {use(x)})"

    def _each_placed(self, values: str, use: Callable[[str, str], str]) -> str:
        x, i = self._name(), self._name()
        return f"transform({values}, ({x}, {i}) -> {use(x, i)})"

    def _resolved(self, schema: Mapping, seen: tuple) -> tuple[Mapping, tuple]:
        name = schema.get("$ref", "").rpartition("/")[2]
        if not name:
            return schema, seen
        if name in seen:
            raise ValueError(f"the definition {name} contains itself")
        return self._resolved(self.definitions.get(name, {}), (*seen, name))

    def _scalar(self, rules: str, value: str, path: str) -> str:
        """Violations of ``RULES`` by a value; a wrong type is the only one it has."""
        text, number = f"try_variant_get({value}, '$', 'string')", f"try_variant_get({value}, '$', 'double')"

        def broken(k: str) -> str:
            dated = f"({rules}.dated AND try_to_timestamp(substring({text}, 1, 10), 'yyyy-MM-dd') IS NULL)"
            rest = _joined(
                [
                    _if(f"{rules}.enum IS NOT NULL AND ({k} <> 'string' OR NOT array_contains({rules}.enum, {text}))", path, "enum"),
                    _if(f"{k} = 'string' AND (NOT regexp_like({text}, {rules}.format) OR {dated})", path, "format"),
                    _if(f"{k} IN ('integer', 'number') AND {number} < {rules}.minimum", path, "minimum"),
                ]
            )
            return f"IF(coalesce(NOT array_contains({rules}.types, {k}), false), array({_found(path, 'type')}), {rest})"

        return f"IF({rules} IS NULL, {NONE}, {self._bound(_kind(value), broken)})"

    def _inside(self, value: str, schema: Mapping, path: str, seen: tuple) -> str:
        """Violations of what an object or an array holds; other values hold nothing."""
        out = []
        if {"properties", "required"} & set(schema):
            out.append(self._bound(_members(value), lambda m: f"IF({m} IS NULL, {NONE}, {self._object(m, schema, path, seen)})"))
        if schema.get("items"):
            out.append(self._bound(_items(value), lambda xs: f"IF({xs} IS NULL, {NONE}, {self._array(xs, schema['items'], path, seen)})"))
        return _joined(out)

    def _object(self, own: str, schema: Mapping, path: str, seen: tuple) -> str:
        properties = {name: self._resolved(s, seen) for name, s in schema.get("properties", {}).items()}
        under = lambda names, rule: self._each(names, lambda n: _found(_under(path, n), rule))
        keys, out = f"map_keys({own})", []
        if schema.get("required"):
            out.append(under(f"array_except({_constant(schema['required'], 'array<string>')}, {keys})", "required"))
        if schema.get("additionalProperties") is False:
            out.append(under(f"array_sort(array_except({keys}, {_constant(list(properties), 'array<string>')}))", "additional"))
        rules, nested = {}, {}
        for name, (inner, known) in properties.items():
            rules[name] = _scalar_rules(inner)
            item = self._resolved(inner.get("items", {}), known)[0]
            if inner.get("items") and not _holds_rules(item):
                rules[name]["item"] = _scalar_rules(item)
            elif _holds_rules(inner):
                nested[name] = (inner, known)
        if any(rules.values()):
            table = _constant({n: r for n, r in rules.items() if r}, f"map<string,struct<{RULES},item:struct<{RULES}>>>")
            member = lambda k: self._bound(f"try_element_at({table}, {k})", lambda r: self._member(r, f"try_element_at({own}, {k})", _under(path, k)))
            out.append(f"flatten({self._each(keys, member)})")
        for name, (inner, known) in nested.items():
            out.append(self._inside(f"try_element_at({own}, {_text(name)})", inner, _under(path, _text(name)), known))
        return _joined(out)

    def _member(self, rules: str, value: str, path: str) -> str:
        """A member by its own rules and, if it is an array, its items by theirs."""
        each = self._each_placed(_items(value), lambda x, i: self._scalar(f"{rules}.item", x, _item(path, i)))
        return _joined([self._scalar(rules, value, path), f"IF({rules}.item IS NULL, {NONE}, coalesce(flatten({each}), {NONE}))"])

    def _array(self, values: str, schema: Mapping, path: str, seen: tuple) -> str:
        schema, seen = self._resolved(schema, seen)
        rules = _constant(_scalar_rules(schema), f"struct<{RULES}>")

        def one(x: str, i: str) -> str:
            return _joined([self._scalar(rules, x, _item(path, i)), self._inside(x, schema, _item(path, i), seen)])

        return f"flatten({self._each_placed(values, one)})"


def schema_violations(records: DataFrame, schemas: Mapping[str, Mapping], by: str = "kind", body: str = "body") -> DataFrame:
    """(record columns but the body, path, rule): one row per violation of the schema of the record's kind.

    A body that is no JSON breaks the rule ``json``; kinds without a schema are passed over.
    """
    plain = [c for c in records.columns if c != body]
    parsed = records.withColumn("_value", F.try_parse_json(body))
    found = F.expr(NONE)
    for name, schema in schemas.items():
        found = F.when(F.col(by) == name, SchemaCompiler(schema).violations("_value")).otherwise(found)
    no_json = F.col(by).isin(*schemas) & F.col("_value").isNull()
    found = F.when(no_json, F.expr(f"array({_found(_text(''), 'json')})")).otherwise(found)
    # The outer form spares a second check in a filter ahead of the explode.
    rows = parsed.select(*plain, F.explode_outer(found).alias("_v")).filter(F.col("_v").isNotNull())
    return rows.select(*plain, "_v.path", "_v.rule")
