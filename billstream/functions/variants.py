"""Reading open JSON (``VARIANT``) inside expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(value: Column, use) -> Column:
    """``use`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def members(value: Column) -> Column:
    """Members of an object, null for anything else; a JSON null is a null member."""
    return F.try_variant_get(value, "$", "map<string,variant>")


def items(value: Column) -> Column:
    """Items of an array, null for anything else."""
    return F.try_variant_get(value, "$", "array<variant>")
