"""Top-k, latest-per-key and sampling operators.

``row_number() <= k`` lets Spark cut every map task's groups to k rows before
the shuffle, so a hot key ships at most k rows per task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwell.operators.ordering import durable, order_statistics, row_numbers, with_row_number


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, name: str = "pos") -> DataFrame:
    ranked = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(ranked)).where(F.col(name) <= k).withColumn(name, F.col(name).cast("bigint"))


def one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order``."""
    return top_per_key(df, keys, order, 1, "__first").drop("__first")


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's values, the same in every run: the last word among equal rows of an order."""
    return F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in kind or "variant" in kind else F.col(c) for c, kind in df.dtypes])


def unique(df: DataFrame, keys: Sequence[str], order: Sequence[Column] = ()) -> DataFrame:
    """One row per key: the first under ``order``, equal ones by their hash. Makes a join's side unique."""
    return one_per_key(df, keys, [*order, row_hash(df)])


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return one_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def first_matching_per_key(df: DataFrame, keys: Sequence[str], wanted: Column, order: Sequence[Column]) -> DataFrame:
    """Latest row that satisfies a predicate, per key."""
    return one_per_key(df.where(wanted), keys, order)


def head_and_tail(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], reverse: Sequence[Column], n: int
) -> DataFrame:
    """First n rows and last n rows (from the end) per key, tagged top / bottom."""
    top = top_per_key(df, keys, order, n).withColumn("side", F.lit("top"))
    bottom = top_per_key(df, keys, reverse, n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom)


@dataclass(frozen=True)
class Top:
    """A flag ``name`` for the first max(1, floor(n * fraction)) rows by (metric, key)."""

    name: str
    metric: str
    fraction: float
    descending: bool = True


def top_fractions(df: DataFrame, key: str, picks: Sequence[Top]) -> DataFrame:
    """Several flags over the whole table at once; missing values count as 0.

    Rows are not sorted: the values of all metrics are stored once in long form,
    the exact boundary values come from one keyed order statistic over their
    counts, and the boundary keys among the rows that tie from a second one. A
    few numbers for each pick reach the driver; the flags are filter expressions.
    """
    value = lambda p: F.coalesce(F.col(p.metric).cast("double"), F.lit(0.0)) * (-1 if p.descending else 1)
    rows = F.explode(F.array(*[F.struct(F.lit(i).alias("pick"), value(p).alias("v")) for i, p in enumerate(picks)]))
    long = durable(df.select(F.col(key).alias("k"), rows.alias("r")).select("k", "r.pick", "r.v"))
    of_pick = lambda values: F.element_at(F.array(*[F.lit(v) for v in values]), F.col("pick") + 1)
    size = lambda n: F.greatest(F.lit(1), F.floor(n * of_pick([p.fraction for p in picks])))
    edges = order_statistics(long, "v", {"edge": lambda n: size(n) - 1}, ["pick"])
    found = {r.pick: r for r in edges.select("pick", "edge", size(F.col("n")).alias("size")).collect()}
    if not found:
        return df.withColumns({p.name: F.lit(False) for p in picks})
    edge = of_pick([found[i].edge for i in range(len(picks))])
    taken = {r.pick: r.n for r in long.where(F.col("v") < edge).groupBy("pick").agg(F.count(F.lit(1)).alias("n")).collect()}
    left = of_pick([found[i].size - taken.get(i, 0) - 1 for i in range(len(picks))])
    last = {r.pick: r.last for r in order_statistics(long.where(F.col("v") == edge), "k", {"last": lambda n: left}, ["pick"]).collect()}
    flags = {
        p.name: (value(p) < found[i].edge) | ((value(p) == found[i].edge) & (F.col(key) <= F.lit(last[i]))) for i, p in enumerate(picks)
    }
    return df.withColumns(flags)


def top_fraction(
    df: DataFrame, metric: str, key: str, fraction: float, descending: bool = True, name: str = "in_top"
) -> DataFrame:
    """Flag the first max(1, floor(n * fraction)) rows by (metric, key) of the whole table."""
    return top_fractions(df, key, [Top(name, metric, fraction, descending)])


def numbered_per_key(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], name: str, total: str, row: Sequence[str] | None = None
) -> DataFrame:
    """Position and size per key without a per-key task: global numbers minus the key's first number.

    With ``row``, columns that name a row and are not null, only these and the keys are sorted and stored;
    the wide rows meet their positions once.
    """
    order = [*[F.col(k).asc() for k in keys], *order]
    ranked = with_row_number(df, order, "__g") if row is None else row_numbers(df, order, list(dict.fromkeys([*keys, *row])), "__g")
    spans = ranked.groupBy(*keys).agg(F.min("__g").alias("__from"), F.count(F.lit(1)).cast("bigint").alias(total))
    ranked = ranked.join(spans, list(keys)).withColumn(name, F.col("__g") - F.col("__from") + 1).drop("__g", "__from")
    return ranked if row is None else df.join(ranked.select(*row, name, total), list(row))


def spread_sample(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, row: Sequence[str] | None = None) -> DataFrame:
    """Rows at evenly spread positions of each key's order (0-based round(i*(n-1)/(k-1)))."""
    ranked = numbered_per_key(df, keys, order, "__pos", "__size", row)
    at = F.col("__pos") - 1
    if k <= 1:
        return ranked.where(at < k).withColumn("sample_index", at).drop("__pos", "__size")
    wanted = F.transform(
        F.sequence(F.lit(0), F.lit(k - 1)),
        lambda i: F.bround(i * (F.col("__size") - 1) / F.lit(k - 1), 0).cast("bigint"),
    )
    keep = (F.col("__size") <= k) | F.array_contains(wanted, at)
    return ranked.where(keep).withColumn("sample_index", at).drop("__pos", "__size")


def chunked(df: DataFrame, order: Sequence[Column], size: int, name: str = "chunk_no", row: Sequence[str] | None = None) -> DataFrame:
    """Fixed-size chunk numbers (1-based) over the whole table's order."""
    ranked = with_row_number(df, order, "__rank") if row is None else df.join(row_numbers(df, order, row, "__rank"), list(row))
    return ranked.withColumn(name, (F.floor((F.col("__rank") - 1) / F.lit(size)) + 1).cast("bigint")).drop("__rank")


def first_k_per_key_limited(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, limit: int | None
) -> DataFrame:
    """First k rows per key, then the first ``limit`` rows overall (top-k report)."""
    kept = top_per_key(df, keys, order, k)
    return kept if limit is None else kept.orderBy(*order).limit(limit)
