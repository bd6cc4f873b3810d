"""Joins of the content model.

Right sides are made unique (pre-aggregated or one row per key) before they are
joined, so no join can fan out; of repeated ids the row with the smallest hash
counts, unless the caller has picked one before; Spark picks broadcast or shuffle from sizes and
splits skewed partitions at run time. Nothing is broadcast by hint unless it is
one row.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions.coerce import filled, text
from clipwell.functions.text import bare_name
from clipwell.operators.picking import one_per_key, unique


def assemble(sources: Sequence[DataFrame], key: str, defaults: Mapping[str, object], limit: int | None = None) -> DataFrame:
    """Full outer join of sources on one id; missing values get their default; optional first n ids."""
    joined = reduce(lambda a, b: a.join(b, key, "full"), [unique(s, [key]) for s in sources])
    out = joined.select(key, *[F.coalesce(F.col(c), F.lit(v)).alias(c) for c, v in defaults.items()])
    return out if limit is None else out.orderBy(key).limit(limit)


def with_metrics(videos: DataFrame, metrics: DataFrame, comments: DataFrame, key: str = "video_id") -> DataFrame:
    """Videos with counters and the number of collected comments, 0 where missing."""
    per_video = comments.groupBy(key).agg(F.count(F.lit(1)).alias("collected_comment_count"))
    counters = [c for c in metrics.columns if c != key]
    return (
        videos.join(unique(metrics, [key]), key, "left")
        .join(per_video, key, "left")
        .fillna(0, subset=[*counters, "collected_comment_count"])
    )


def merge_keeping(
    current: DataFrame, incoming: DataFrame, key: str, texts: Sequence[str], counters: Sequence[str],
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """Full outer merge: filled texts of the current side stay, non-zero incoming counters win."""
    names = [*texts, *counters]
    a = unique(current, [key]).select(key, *[F.col(c).alias(f"a_{c}") for c in names if c in current.columns])
    b = unique(incoming, [key]).select(key, *[F.col(c).alias(f"b_{c}") for c in names if c in incoming.columns])
    j = a.join(b, key, "full")
    none = F.lit(None)

    def side(p: str, c: str) -> Column:
        return F.col(f"{p}_{c}") if f"{p}_{c}" in j.columns else none

    cols = [F.coalesce(filled(side("a", c)), filled(side("b", c)), F.lit((defaults or {}).get(c, ""))).alias(c) for c in texts]
    zero = F.lit(0).cast("bigint")
    for c in counters:
        new, old = F.coalesce(side("b", c), zero), F.coalesce(side("a", c), zero)
        cols.append(F.when(new != 0, F.greatest(new, zero)).otherwise(F.greatest(old, zero)).cast("bigint").alias(c))
    return j.select(key, *cols)


def star(facts: DataFrame, dims: Sequence[DataFrame], key: str = "video_id") -> DataFrame:
    """Left joins of per-id feature tables onto the fact table."""
    return reduce(lambda f, d: f.join(unique(d, [key]), key, "left"), dims, facts)


def only_ids(rows: DataFrame, ids: DataFrame, key: str = "video_id") -> DataFrame:
    return rows.join(ids.select(key), key, "left_semi")


def missing_ids(have: DataFrame, known: DataFrame, key: str = "video_id") -> DataFrame:
    return have.join(known.select(key), key, "left_anti")


def observed(rows: DataFrame, index: DataFrame, keys: Sequence[str], name: str = "observed") -> DataFrame:
    """Flag rows found in the index; an empty index keeps every row."""
    marks = index.select(*keys).distinct().withColumn("__hit", F.lit(True))
    empty = index.select(F.lit(1).alias("x")).limit(1).agg((F.count(F.lit(1)) == 0).alias("empty")).scalar()
    return (
        rows.join(marks, list(keys), "left")
        .withColumn(name, F.coalesce(F.col("__hit"), F.lit(False)) | empty)
        .drop("__hit")
    )


def mentioned(rows: DataFrame, texts: DataFrame, key: str, account: str, body: str, name: str = "mentioned") -> DataFrame:
    """Equi-join on the artifact key, then: does the bare account name occur in the bare text?"""
    who = bare_name(account)
    joined = rows.join(unique(texts.select(key, body), [key]), key, "left")
    hit = (who != "") & F.coalesce(F.translate(F.col(body), "?？", "").contains(who), F.lit(False))
    return joined.withColumn(name, hit).drop(body)


def fallback_lookup(rows: DataFrame, counts: DataFrame, name: str, value: str) -> DataFrame:
    """Value by exact name, else the highest value among names that are equal without question marks."""
    exact = counts.groupBy(F.col(name).alias("__exact")).agg(F.max(value).alias("__by_exact"))
    norm = counts.groupBy(bare_name(name).alias("__norm")).agg(F.max(value).alias("__by_norm"))
    return (
        rows.join(exact, F.col(name) == F.col("__exact"), "left")
        .join(norm, bare_name(name) == F.col("__norm"), "left")
        .withColumn(
            value, F.coalesce(F.nullif(F.col("__by_exact"), F.lit(0)), F.col("__by_norm"), F.lit(0)).cast("bigint")
        )
        .drop("__exact", "__norm", "__by_exact", "__by_norm")
    )


def reverse_lookup(rows: DataFrame, mapping: DataFrame, key: str, value: str, order: Sequence[Column]) -> DataFrame:
    """Left join where the last mapping entry per key wins."""
    return rows.join(one_per_key(mapping, [key], order).select(key, value), key, "left")


def resolve_parents(
    replies: DataFrame, comments: DataFrame, reply_id: str, scope: str,
    candidates: Sequence[str], comment_keys: Sequence[str], parent: str,
) -> DataFrame:
    """Parent comment of each reply through candidate keys in priority order; null when unresolved.

    Keys are exploded on both sides and met by an equi-join, then each reply
    keeps its best match. A comment with very many replies only makes one join
    partition large, which the engine splits at run time.
    """
    known = comments.select(scope, F.col(parent).alias("__parent"), F.explode(F.array(*[text(k) for k in comment_keys])).alias("__key"))
    known = known.where(F.col("__key") != "").groupBy(scope, "__key").agg(F.max("__parent").alias("__parent"))
    asked = replies.select(reply_id, scope, F.posexplode(F.array(*[text(k) for k in candidates])).alias("__prio", "__key"))
    met = asked.where(F.col("__key") != "").join(known, [scope, "__key"])
    best = met.groupBy(reply_id).agg(F.min_by("__parent", "__prio").alias(parent))
    return replies.join(best, reply_id, "left")


def latest_unique(rows: DataFrame, allowed: DataFrame, source: str, key: str, order: Sequence[Column]) -> DataFrame:
    """Rows of allowed sources (an empty allow-list keeps all), first row per key."""
    kept = observed(rows, allowed.select(F.col(allowed.columns[0]).alias(source)), [source], "__ok")
    return one_per_key(kept.where("__ok").drop("__ok").where(text(key) != ""), [key], order)


def driven_by(targets: DataFrame, artifacts: DataFrame, key: str) -> DataFrame:
    """Target ids lead; when there are no targets, the artifact ids do."""
    leading = artifacts.select(key).distinct() if targets.isEmpty() else targets.select(key).distinct()
    return leading


def count_by_account(rows: DataFrame, account: str, name: str) -> DataFrame:
    who = F.coalesce(filled(account), F.lit("unknown"))
    return rows.groupBy(who.alias(account)).agg(F.count(F.lit(1)).alias(name))


def two_counts(left: DataFrame, right: DataFrame, key: str, left_n: str, right_n: str) -> DataFrame:
    """Full outer join of two grouped counts, 0 where a side has no rows."""
    return left.join(right, key, "full").fillna(0, subset=[left_n, right_n])
