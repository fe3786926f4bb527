"""Column builders driven by a schema: pruning, key removal, dotted paths."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billstream.functions.variants import bound


def deep_prune(value: Column, dtype: T.DataType) -> Column:
    """Null, empty string, empty list and empty object go, at any depth."""
    if isinstance(dtype, T.StringType):
        return F.nullif(value, F.lit(""))
    if isinstance(dtype, T.ArrayType):
        kept = F.filter(
            F.transform(value, lambda x: deep_prune(x, dtype.elementType)), lambda x: x.isNotNull()
        )
        return bound(kept, lambda k: F.when(F.size(k) > 0, k))
    if isinstance(dtype, T.MapType):
        kept = F.map_filter(
            F.transform_values(value, lambda _, v: deep_prune(v, dtype.valueType)),
            lambda _, v: v.isNotNull(),
        )
        return bound(kept, lambda k: F.when(F.size(k) > 0, k))
    if isinstance(dtype, T.StructType):
        fields = [deep_prune(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        filled = lambda s: reduce(lambda a, b: a | b, [s[f.name].isNotNull() for f in dtype.fields])
        # Named once: a test of the fields themselves would double the plan at every level.
        return bound(F.struct(*fields), lambda s: F.when(filled(s), s))
    return value


def drop_keys(value: Column, dtype: T.DataType, keys: Iterable[str]) -> Column:
    """Remove the named fields from every struct inside ``value``."""
    keys = set(keys)
    if isinstance(dtype, T.ArrayType):
        return F.transform(value, lambda x: drop_keys(x, dtype.elementType, keys))
    if isinstance(dtype, T.MapType):
        return F.transform_values(
            F.map_filter(value, lambda k, _: ~k.isin(*keys)),
            lambda _, v: drop_keys(v, dtype.valueType, keys),
        )
    if isinstance(dtype, T.StructType):
        kept = [
            drop_keys(value[f.name], f.dataType, keys).alias(f.name)
            for f in dtype.fields
            if f.name not in keys
        ]
        return F.when(value.isNotNull(), F.struct(*kept))
    return value


def sanitize_keys(df: DataFrame, keys: Iterable[str] = ("_id", "scraped_at")) -> DataFrame:
    keys = set(keys)
    return df.select(
        *[
            drop_keys(F.col(f"`{f.name}`"), f.dataType, keys).alias(f.name)
            for f in df.schema.fields
            if f.name not in keys
        ]
    )


def json_path(dotted: str) -> str:
    """``a.b.0.c`` to the variant path ``$.a.b[0].c``."""
    return "$" + "".join(f"[{s}]" if s.isdigit() else f".{s}" for s in dotted.split("."))


def json_field(doc: Column, dotted: str, dtype: str = "string") -> Column:
    """One field of open JSON text by dotted path; null for absent or damaged input."""
    return F.try_variant_get(F.try_parse_json(doc), json_path(dotted), dtype)


def readable(doc: Column) -> Column:
    """JSON value as text: strings bare, arrays joined by comma, objects ``[object]``."""
    variant = F.try_parse_json(doc)
    kind = F.schema_of_variant(variant)
    items = F.try_variant_get(variant, "$", "array<variant>")
    joined = F.array_join(
        F.transform(
            items,
            lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), F.lit("[object]")).otherwise(
                F.coalesce(v.try_cast("string"), F.lit("null"))
            ),
        ),
        ", ",
    )
    return (
        F.when(kind.startswith("OBJECT"), F.lit("[object]"))
        .when(kind.startswith("ARRAY"), joined)
        .otherwise(F.coalesce(variant.try_cast("string"), F.lit("null")))
    )
