"""Vector expressions on arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return dot(a, b) / F.greatest(norms, F.lit(1e-9))


def mean_pool(df: DataFrame, key: str, vector: str, size: int | None = None) -> DataFrame:
    """Mean vector per key.

    A key has one accumulator, a sum and a count for each dimension, combined in every task before
    the shuffle, so one row per task and key moves however many vectors there are. ``size`` is the
    longest length; without it one pass over the lengths finds it. Shorter vectors count in the
    dimensions that they have.
    """
    if size is None:
        size = df.agg(F.coalesce(F.max(F.size(vector)), F.lit(0))).first()[0]
    means = [F.avg(F.get(F.col(vector), F.lit(i)).cast("double")).alias(f"_{i}") for i in range(size)]
    pooled = df.filter(F.size(vector) > 0).groupBy(key).agg(F.max(F.size(vector)).alias("_size"), *means)
    return pooled.select(key, F.slice(F.array(*[f"_{i}" for i in range(size)]), F.lit(1), F.col("_size")).alias(vector) if size else F.array().alias(vector))
