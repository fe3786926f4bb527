"""Ranking helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key in ``order``, which must be a total order.

    For the usual small ``n`` Spark keeps only ``n`` rows per key and task ahead of
    the shuffle, so a hot key stays small.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter(F.col("_rn") <= n).drop("_rn")


def first_non_empty(*sources: DataFrame) -> DataFrame:
    """Rows of the first source that has any; later sources are fallbacks."""
    ranked = [df.withColumn("_rank", F.lit(i)) for i, df in enumerate(sources)]
    united = ranked[0]
    for df in ranked[1:]:
        united = united.unionByName(df, allowMissingColumns=True)
    best = united.agg(F.min("_rank")).scalar()
    return united.filter(F.col("_rank") == best).drop("_rank")
