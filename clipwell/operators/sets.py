"""Set operations on id tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.operators.picking import one_per_key


def union_ids(tables: Sequence[DataFrame], key: str) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [t.select(key) for t in tables]).distinct()


def shared_count(left: DataFrame, right: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Number of distinct ids present on both sides."""
    return left.select(key).intersect(right.select(key)).agg(F.count(F.lit(1)).alias(name))


def differences(left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str) -> DataFrame:
    """Ids on one side only, tagged with the side they miss on."""
    a, b = left.select(key).distinct(), right.select(key).distinct()
    return (
        a.join(b, key, "left_anti").withColumn("side", F.lit(left_name))
        .unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit(right_name)))
    )


def filtered_ids(invalid: DataFrame, uncovered: DataFrame, anomalous: DataFrame | None, key: str) -> DataFrame:
    """Ids to leave out: invalid and uncovered ones, and anomalous ones unless kept."""
    return union_ids([invalid, uncovered] if anomalous is None else [invalid, uncovered, anomalous], key)


def concat_first(tables: Sequence[DataFrame], key: str, order: Sequence[Column] = ()) -> DataFrame:
    """Concatenation in table order, the first row per id kept."""
    tagged = [t.withColumn("__src", F.lit(i)) for i, t in enumerate(tables)]
    both = reduce(lambda a, b: a.unionByName(b), tagged)
    return one_per_key(both, [key], [F.col("__src"), *order]).drop("__src")
