"""Mixing sources to target weights by Pareto order sampling. DataFrame functions only.

A source's target is its share of all words by weight, stopped at ``most``
times its size; the excess goes to the other sources by weight. With
target / size = whole + f, every document of the source gets ``whole`` certain
copies, and the remaining f * size words are a Pareto sample of fixed size in
words: documents are ranked by the odds of their random number over their
inclusion odds, (u / (1 - u)) / (f / (1 - f) * words ** power), and taken in
this order until the words are there. The factor f / (1 - f) is the same for a
whole source and drops out of the ranks; ``power`` prefers long documents, which
also leaves short ones at the cut, so that the words come close to the target.

u comes from the MD5 of seed and id, so reruns agree. Documents without words
take none. A null source is a source of its own, the last one; null ids draw one
common number. Rows that agree in id, source and number of words share one
fate. An empty table gives no rows. Only the named columns are read; in the
texts form a column ``copies`` of the input would be replaced.

Ranks and running sums are global over (source, rank): a range-partitioned sort
with per-partition totals, so a source that holds a third of all rows spreads
over many tasks. What comes back is one cut per source; documents are compared
to it where they are, without moving texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwell.llm.common import WORD, durable, small, text_of
from clipwell.operators.ordering import with_running_total

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
MAX_SOURCES = 10_000


def rank_of(key: Column, words: Column, seed: int, power: float) -> Column:
    """Random odds over inclusion odds; null without words."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return F.when(words > 0, u / (1.0 - u) / F.pow(words.cast("double"), F.lit(power)))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size) to the same with ``target``, ``whole`` and ``rest``: one row per source.

    Stopped sources are those with the least size per weight; the sum over the
    stopped ones gives the words per weight that are left for the others.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), ((F.col("place") - 1) % len(weights) + 1).cast("int"))
    df = sizes.withColumn("place", F.row_number().over(order)).withColumn("weight", weight.cast("long"))
    df = df.withColumn("cap", F.lit(most).cast("long") * F.col("source_size"))
    up = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before = up.rowsBetween(Window.unboundedPreceding, -1)
    rest = up.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(everything)
    level = (total - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(rest)
    df = df.withColumn("level", level)
    # the first source that is not stopped gives the level of all that follow
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct(F.col("cap") / F.col("weight"), "place", "level"))
    df = df.withColumn("found", F.min(fits).over(everything)["level"])
    df = df.withColumn("target", F.least(F.col("found") * F.col("weight"), F.col("cap").cast("double")))
    times = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    df = df.withColumn("whole", F.floor(times).cast("long"))
    return df.withColumn("left", F.col("target") - F.col("whole") * F.col("source_size")).select(
        "source", "source_size", "target", "whole", "left"
    )


def _measured(docs: DataFrame, key: str, source: str, text: str, seed: int, power: float) -> DataFrame:
    words = F.regexp_count(text_of(f"`{text}`"), F.lit(WORD)).cast("long")
    df = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), words.alias("size"))
    return df.withColumn("rank", rank_of(F.col("doc_id"), F.col("size"), seed, power))


def _null_safe(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on equal keys, null equal to null."""
    other = right.withColumnRenamed(key, "__key")
    return left.join(other, F.col(key).eqNullSafe(F.col("__key")), "left").drop("__key")


def source_cuts(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = 3) -> DataFrame:
    """One row per source: size, target, whole copies and the last (rank, id) that gets one copy more."""
    targets = source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, most)
    run = with_running_total(rows.where("size > 0"), ["source", "rank", "doc_id"], "size", "run")
    starts = run.groupBy("source").agg(F.min(F.col("run") - F.col("size")).alias("start"))
    sources = durable(_null_safe(targets, starts, "source"))
    ranked = run.alias("a").join(small(sources, MAX_SOURCES).alias("b"), F.expr("a.source <=> b.source"))
    middle = F.col("run") - F.col("start") - F.col("size") / 2
    last = ranked.where(middle <= F.col("left")).groupBy(F.col("a.source").alias("source"))
    cut = last.agg(F.max(F.struct("rank", "doc_id")).alias("cut"))
    return durable(_null_safe(sources.drop("start", "left"), cut, "source"))


def _decided(df: DataFrame, rows: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``df`` (with struct ``__m`` of doc_id, source, size, rank) plus its source's ``__c`` and ``__copies``."""
    cuts = source_cuts(rows, weights, most)
    cuts = small(cuts.select(F.struct(*cuts.columns).alias("__c")), MAX_SOURCES)
    out = df.join(cuts, F.expr("__m.source <=> __c.source"))
    more = F.expr("__m.rank < __c.cut.rank or __m.rank = __c.cut.rank and (__m.doc_id is null or __m.doc_id <= __c.cut.doc_id)")
    copies = F.col("__c.whole") + F.coalesce(more, F.lit(False)).cast("long")
    return out.withColumn("__copies", F.when(F.col("__m.size") > 0, copies).otherwise(F.lit(0)).cast("long"))


def mixed(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = 3,
    power: float = 0.5,
    seed: int = 7,
) -> DataFrame:
    """One row per document: size, source_size, target of its source, copies and taken words."""
    rows = durable(_measured(docs, key, source, text, seed, power))
    out = _decided(rows.select(F.struct(*rows.columns).alias("__m")), rows, weights, most)
    return out.select(
        "__m.doc_id", "__m.source", "__m.size", "__c.source_size", "__c.target", F.col("__copies").alias("copies"),
        (F.col("__copies") * F.col("__m.size")).alias("taken"),
    )


def mixed_rows(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    weights: tuple[int, ...] = WEIGHTS,
    most: int = 3,
    power: float = 0.5,
    seed: int = 7,
) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as it is copied, columns as they are."""
    rows = durable(_measured(docs, key, source, text, seed, power))
    size = F.regexp_count(text_of(f"`{text}`"), F.lit(WORD)).cast("long")
    one = F.struct(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{source}`").alias("source"), size.alias("size"))
    wide = docs.withColumn("__one", one)
    rank = rank_of(F.col("__one.doc_id"), F.col("__one.size"), seed, power)
    wide = wide.withColumn("__m", F.col("__one").withField("rank", rank))
    out = _decided(wide, rows, weights, most).where("__copies > 0")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies")))).select(
        *[F.col(f"`{c}`") for c in docs.columns]
    )
