"""Array columns to rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, keys: Sequence[str | Column], array: str | Column, name: str, position: str | None = None) -> DataFrame:
    """One row per non-null element.

    A plain ``explode`` makes the optimizer infer ``size(array) > 0`` and push
    that filter below the projections, which computes a derived array twice and
    can blow up the plan. The outer form has no such filter; the null row of an
    empty array is dropped after it.
    """
    if position is None:
        out = df.select(*keys, F.explode_outer(array).alias(name))
    else:
        out = df.select(*keys, F.posexplode_outer(array).alias(position, name))
    return out.where(F.col(name).isNotNull())
