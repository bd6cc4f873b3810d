"""Contiguous balanced shards from global prefix sums of bytes.

Documents are put in one global order, by the MD5 of their text and then by id,
so that equal texts are neighbours. A range-partitioned sort stores the narrow
rows; the byte totals of its partitions give every partition its base, and so
every document its place on the byte axis. The axis is cut at equal targets. A
cut that falls into a group of equal texts moves to the group's nearer end if
the group is at most ``whole_group`` of a shard, so small groups share a shard;
larger groups are cut at the nearer end of the document under the target, so no
group can unbalance the shards.

Size: UTF-8 bytes of the text plus ``overhead``. Null texts count as empty ones.
Null ids come first among equal texts; rows that agree in id and text are
interchangeable. A document larger than a shard leaves shards empty. An empty
table gives no rows. Other columns play no part; in the wide form, input columns
named like the new ones are replaced.

Only cut positions (one number per shard) and one row per sort partition pass
through a single task or the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwell.llm.common import digest, durable, row_key, text_of, utf8_crc32

SLOT_BITS = 33
MAX_SHARDS = 100_000
ADDED = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


def _placed(docs: DataFrame, key: str, text: str, overhead: int) -> DataFrame:
    """Narrow rows with their row number ``n`` and the bytes before them ``at``, in global order."""
    t = text_of(f"`{text}`")
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"), digest(F.col(f"`{text}`")).alias("digest"), row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_key"),
        (F.octet_length(t) + overhead).cast("long").alias("size"), utf8_crc32(t).alias("text_crc32"),
    )
    sort = durable(rows.orderBy("digest", "doc_id").withColumn("place", F.monotonically_increasing_id()))
    sort = sort.withColumn("block", F.shiftright("place", SLOT_BITS))
    totals = sort.groupBy("block").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    base = totals.select(
        F.col("block").alias("b"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("base"),
        F.coalesce(F.sum("rows").over(earlier), F.lit(0)).alias("first"),
    )
    inside = Window.partitionBy("block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    within = F.col("place").bitwiseAND(F.lit((1 << SLOT_BITS) - 1))
    at = sort.withColumn("at", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    # one row per sort partition
    return at.join(F.broadcast(base), F.col("block") == F.col("b")).select(
        "doc_id", "digest", "row_key", "size", "text_crc32", (F.col("at") + F.col("base")).alias("at"), (F.col("first") + within).alias("n")
    )


def _cuts(placed: DataFrame, shards: int, whole_group: float) -> list[int]:
    """Byte positions where the shards 1, 2, ... begin."""
    total = placed.agg(F.sum("size")).first()[0] or 0
    if not total:
        return []
    share = total / shards
    number = lambda p: F.floor(p * float(shards) / float(total))
    under = placed.where(number(F.col("at")) < number(F.col("at") + F.col("size")))
    under = durable(under.select("digest", "at", (F.col("at") + F.col("size")).alias("end")))  # at most one row per cut
    group = (
        placed.join(F.broadcast(under.select("digest").distinct()), "digest")
        .groupBy("digest")
        .agg(F.min("at").alias("low"), F.max(F.col("at") + F.col("size")).alias("high"))
    )
    found = sorted(tuple(r) for r in under.join(group, "digest").select("at", "end", "low", "high").collect())
    cuts, i = [], 0
    for k in range(1, shards):
        target = k * share
        while i < len(found) - 1 and found[i][1] < target:
            i += 1
        at, end, low, high = found[i]
        low, high = (low, high) if high - low <= whole_group * share else (at, end)
        cuts.append(low if target - low <= high - target else high)
    return cuts


def _address(placed: DataFrame, shards: int, whole_group: float):
    """Functions of the byte position and of position and row number: shard, and slot in it."""
    if not 0 < shards <= MAX_SHARDS:
        raise ValueError(f"shards must be between 1 and {MAX_SHARDS}")
    cuts = F.array(*[F.lit(c).cast("long") for c in _cuts(placed, shards, whole_group)]).cast("array<bigint>")
    shard = lambda at: F.size(F.filter(cuts, lambda c: c <= at)).cast("int")
    first = dict(map(tuple, placed.groupBy(shard(F.col("at"))).agg(F.min("n")).collect()))  # one row per shard
    starts = F.array(*[F.lit(first.get(k, 0)).cast("long") for k in range(shards)])
    return shard, lambda at, n: (n - F.get(starts, shard(at))).cast("long")


def shard_places(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 8, whole_group: float = 0.05
) -> DataFrame:
    """One narrow row per document: size, text_crc32, law, shard, slot in the shard, grown_shard (null)."""
    placed = _placed(docs, key, text, overhead)
    shard, slot = _address(placed, shards, whole_group)
    return placed.select("doc_id", "size", "text_crc32", *_added(shard, slot, F.col("at"), F.col("n")))


def _added(shard, slot, at: Column, n: Column) -> list[Column]:
    return [F.lit("bytes").alias("law"), shard(at).alias("shard"), slot(at, n).alias("slot"), F.lit(None).cast("int").alias("grown_shard")]


def sharded(
    docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text", overhead: int = 8, whole_group: float = 0.05
) -> DataFrame:
    """The documents themselves with their place.

    Rows of equal id and text lie one after the other; the k-th of them, in any
    order, takes the k-th of their places. One shuffle of the texts.
    """
    placed = _placed(docs, key, text, overhead)
    shard, slot = _address(placed, shards, whole_group)
    runs = placed.groupBy(F.col("row_key").alias("__same")).agg(
        F.struct(F.min("at").alias("at"), F.min("n").alias("n"), F.max("size").alias("size"), F.max("text_crc32").alias("crc")).alias("__run")
    )
    wide = docs.withColumn("__key", row_key(F.col(f"`{key}`"), F.col(f"`{text}`")))
    out = wide.join(runs, F.col("__key") == F.col("__same"))
    out = out.withColumn("__k", F.row_number().over(Window.partitionBy("__key").orderBy("__key")) - 1)
    at, n = F.col("__run.at") + F.col("__k") * F.col("__run.size"), F.col("__run.n") + F.col("__k")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in ADDED]
    return out.select(*kept, F.col("__run.size").alias("size"), F.col("__run.crc").alias("text_crc32"), *_added(shard, slot, at, n))
