"""Exact global order at cluster scale.

A window without PARTITION BY pulls every row into one task, and an exact
percentile aggregate holds every distinct value of a group in one buffer. The
helpers here use a range-partitioned sort instead: rows are sorted globally,
their slot is written down together with the rows (a reliable checkpoint, so a
lost executor cannot re-draw the ranges), and only one row count per sort
partition is accumulated in a single task. A hot key only fills more ranges.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SLOT_BITS = 33
_BLOCK, _SLOT, _BASE, _N = "__block", "__slot", "__base", "__n"


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder the session names; a temporary one only for local runs without it."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        shared = tempfile.mkdtemp(prefix="clipwell-ckpt-")
    return shared


def durable(df: DataFrame) -> DataFrame:
    """Write the rows to the session's checkpoint folder and read them back."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(checkpoint_folder(spark))
    return df.checkpoint(eager=True)


def _placed(df: DataFrame, order: Sequence[str | Column], keep: Sequence[str] | None = None) -> DataFrame:
    slotted = df.orderBy(*order).withColumn(_SLOT, F.monotonically_increasing_id())
    if keep is not None:
        slotted = slotted.select(*keep, _SLOT)  # the sort carries the order's columns besides these, the checkpoint does not
    return durable(slotted.withColumn(_BLOCK, F.shiftright(_SLOT, SLOT_BITS)))


def _offsets(placed: DataFrame, weight: Column) -> DataFrame:
    """Start value of every sort partition: one row per partition."""
    sizes = placed.groupBy(_BLOCK).agg(F.sum(weight).alias(_N))
    before = Window.orderBy(_BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(F.col(_BLOCK), F.coalesce(F.sum(_N).over(before), F.lit(0)).alias(_BASE))


def with_row_number(df: DataFrame, order: Sequence[str | Column], name: str = "row_no") -> DataFrame:
    """1-based global row number under a total order (give a unique last key)."""
    return _numbered(_placed(df, order), name)


def row_numbers(df: DataFrame, order: Sequence[str | Column], keep: Sequence[str], name: str = "row_no") -> DataFrame:
    """The columns ``keep`` with their global row number: only these are sorted and stored, wide rows can meet them later."""
    return _numbered(_placed(df, order, keep), name)


def _numbered(placed: DataFrame, name: str) -> DataFrame:
    offsets = _offsets(placed, F.lit(1).cast("bigint"))
    within = F.col(_SLOT).bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), _BLOCK)
        .withColumn(name, (F.col(_BASE) + within + 1).cast("bigint"))
        .drop(_BLOCK, _SLOT, _BASE)
    )


def with_running_total(df: DataFrame, order: Sequence[str | Column], weight: str, name: str) -> DataFrame:
    """Inclusive global running sum of ``weight`` under a total order."""
    placed = _placed(df, order)
    offsets = _offsets(placed, F.col(weight))
    upto = Window.partitionBy(_BLOCK).orderBy(_SLOT).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = placed.withColumn(name, F.sum(weight).over(upto))
    return (
        inner.join(F.broadcast(offsets), _BLOCK)
        .withColumn(name, (F.col(name) + F.col(_BASE)).cast("bigint"))
        .drop(_BLOCK, _SLOT, _BASE)
    )


def with_previous(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], cols: Sequence[str], prefix: str = "prev_"
) -> DataFrame:
    """Previous row's values within the key, null on a key's first row.

    Works like ``lag`` but a key may span many tasks: rows are ranged by
    (key, order), and the last row of each range is handed to the next one.
    """
    placed = _placed(df, [*keys, *order])
    local = Window.partitionBy(_BLOCK).orderBy(_SLOT)
    carried = [*keys, *cols]
    packed = F.struct(*carried)
    last = placed.groupBy(_BLOCK).agg(F.max_by(packed, F.col(_SLOT)).alias("__last"))
    across = last.select(
        F.lead(_BLOCK).over(Window.orderBy(_BLOCK)).alias(_BLOCK), F.col("__last").alias("__carry")
    ).where(F.col(_BLOCK).isNotNull())
    seen = placed.withColumn("__prev", F.lag(packed).over(local)).join(F.broadcast(across), _BLOCK, "left")
    prev = F.coalesce(F.col("__prev"), F.col("__carry"))
    same = F.lit(True)
    for k in keys:
        same = same & prev[k].eqNullSafe(F.col(k))
    out = seen
    for c in cols:
        out = out.withColumn(prefix + c, F.when(same, prev[c]))
    return out.drop(_BLOCK, _SLOT, "__prev", "__carry")


def histogram(
    df: DataFrame, value: str | Column, keys: Sequence[str], name: str, count: str, weight: str | None = None
) -> DataFrame:
    """Rows per (key, value), counted map-side; nulls skipped."""
    val = F.col(value) if isinstance(value, str) else value
    n = F.count(F.lit(1)) if weight is None else F.sum("__w")
    extra = [] if weight is None else [F.col(weight).alias("__w")]
    kept = df.select(*keys, val.alias(name), *extra).where(F.col(name).isNotNull())
    return kept.groupBy(*keys, name).agg(n.alias(count))


def order_statistics(
    df: DataFrame,
    value: str | Column,
    picks: Mapping[str, Callable[[Column], Column]],
    keys: Sequence[str] = (),
    weight: str | None = None,
) -> DataFrame:
    """Exact values at chosen 0-based ranks per key, plus ``n``.

    ``picks`` maps an output name to a function of the group's row count that
    gives the rank. Equal values are counted before they are sorted, so a value
    repeated in a third of all rows is one row, and the ranks come from one
    global running count instead of one buffer per group. Nulls are skipped.
    ``weight`` names a count column when the input is already a histogram.
    """
    counted = histogram(df, value, keys, "__v", "__c", weight)
    run = with_running_total(counted, [*keys, "__v"], "__c", "__run")
    sizes = run.groupBy(*keys).agg(F.max("__run").alias("__end"), F.sum("__c").alias("n"))
    if keys:
        joined = run.join(sizes, list(keys))
    else:
        whole = sizes.select(F.struct("__end", "n").alias("__s")).scalar()
        joined = run.withColumn("__s", whole).withColumns({"__end": F.col("__s.__end"), "n": F.col("__s.n")})
    upto = F.col("__run") - (F.col("__end") - F.col("n"))
    found = []
    for name, rank in picks.items():
        at = rank(F.col("n"))
        hit = (at < upto) & (at >= upto - F.col("__c"))
        found.append(F.max(F.when(hit, F.col("__v"))).alias(name))
    return joined.groupBy(*keys).agg(*found, F.max("n").alias("n"))


def medians(
    df: DataFrame, value: str | Column, keys: Sequence[str] = (), name: str = "median", weight: str | None = None
) -> DataFrame:
    """Exact interpolated median per key."""
    low_high = {
        "__lo": lambda n: F.floor((n - 1) / 2),
        "__hi": lambda n: F.floor(n / 2),
    }
    found = order_statistics(df, value, low_high, keys, weight)
    mid = (F.col("__lo").cast("double") + F.col("__hi").cast("double")) / 2.0
    return found.withColumn(name, mid).drop("__lo", "__hi")


def long_form(df: DataFrame, ids: Sequence[str], features: Sequence[str], name: str, value: str) -> DataFrame:
    """One row per (row, feature) with a double value."""
    typed = df.select(*ids, *[F.col(f).cast("double").alias(f) for f in features])
    return typed.unpivot(list(ids), list(features), name, value)
