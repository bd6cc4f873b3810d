"""Structured Streaming runs over the same transforms.

Each micro-batch writes the rows it changed as one epoch folder, overwritten
when the batch is replayed; the latest image per key is the table. A batch
reads only earlier epochs, so replays after a failure give the same result. It
takes on only those rows whose keys it shares; no row is dropped for being late.

``compact`` folds old epochs into a base: the latest image of every row in buckets
of the row key, and for every key that batches look up a narrow index of rows in
buckets of that key. A batch then reads the index buckets of its keys, the row
buckets of the rows found there, and the few epochs after the base.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.util import inheritable_thread_target

from clipwell.operators.joins import resolve_parents
from clipwell.operators.ordering import checkpoint_folder
from clipwell.operators.picking import one_per_key
from clipwell.sources.sinks import current_version, switch_version
from clipwell.streaming import upserts as up


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the session's shared checkpoint folder."""
    return f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def write_epoch(images: DataFrame, path: str, epoch: int) -> None:
    images.write.mode("overwrite").parquet(f"{path}/epoch={epoch}")


def read_images(spark: SparkSession, path: str, schema: StructType, before: int | None = None) -> DataFrame:
    """The base's and all later row images, or those of earlier epochs; an empty frame when there are none."""
    recent, base = _recent(spark, path, schema, before), base_of(spark, path)
    return recent if base is None else recent.unionByName(_base_part(spark, base, "rows", _full(schema)))


def _full(schema: StructType) -> StructType:
    return StructType([*schema.fields]).add("epoch", "long")


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def _recent(spark: SparkSession, path: str, schema: StructType, before: int | None) -> DataFrame:
    """Images of the epochs that the base does not hold."""
    if not _exists(spark, path):
        return spark.createDataFrame([], _full(schema))
    upto = folded_upto(spark, path)
    if before is not None and upto >= before:
        raise ValueError(f"the base of {path} holds epoch {upto}, so epoch {before} cannot be run again")
    found = spark.read.schema(_full(schema)).parquet(path).where(F.col("epoch") > upto)
    return found if before is None else found.where(F.col("epoch") < before)


def latest(images: DataFrame, keys: Sequence[str]) -> DataFrame:
    return one_per_key(images, keys, [F.col("epoch").desc()]).drop("epoch")


def touched(images: DataFrame, row_key: str, *matches: tuple[DataFrame, str]) -> DataFrame:
    """Latest image of every stored row that ever shared a key with a batch, given as (batch, key) pairs.

    The keys select row ids first and the ids select images, so that only these
    rows meet in the window that finds the latest one.
    """
    return latest(images.join(_ids(images, row_key, *matches).distinct(), row_key, "left_semi"), [row_key])


def _ids(images: DataFrame, row_key: str, *matches: tuple[DataFrame, str]) -> DataFrame:
    found = [images.join(b.select(k).distinct(), k, "left_semi").select(row_key) for b, k in matches]
    ids = found[0]
    for more in found[1:]:
        ids = ids.unionByName(more)
    return ids


# -- compaction -----------------------------------------------------------------------

ROWS_PER_BUCKET = 1_000_000


def base_of(spark: SparkSession, path: str) -> str | None:
    """Folder of the current base of a table; None before the first ``compact``."""
    return current_version(spark, f"{path}/_base")


def folded_upto(spark: SparkSession, path: str) -> int:
    """The last epoch that the base holds; -1 without a base."""
    base = base_of(spark, path)
    return -1 if base is None else int(base.rsplit("/", 1)[1].split("-")[1])


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _base_part(spark: SparkSession, base: str, part: str, schema: StructType, needed: tuple[DataFrame, str] | None = None) -> DataFrame:
    """A part of the base; with ``needed`` = (rows, key) only the buckets that hold these keys are read."""
    found = spark.read.schema(StructType([*schema.fields]).add("bucket", "integer")).parquet(f"{base}/{part}")
    if needed is not None:
        rows, key = needed
        buckets = int(base.rsplit("-", 1)[1])
        numbers = [r.b for r in rows.select(_bucket(F.col(key).cast(schema[key].dataType), buckets).alias("b")).distinct().collect()]  # at most ``buckets`` numbers
        found = found.where(F.col("bucket").isin(numbers) if numbers else F.lit(False))
    return found.drop("bucket")


def compact(spark: SparkSession, path: str, schema: StructType, row_key: str, keys: Sequence[str], before: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> None:
    """Fold the epochs before ``before`` and the last base into a new base; readers see it when its pointer is switched.

    ``before`` is the first epoch that may still be run, so that a replay reads what its first run read. A failure
    leaves the old base. The number of buckets follows the rows, so a bucket does not grow with the table; files are
    sorted ranges of (bucket, key). Folded epochs are no longer read; ``remove_folded`` deletes them and older bases. ``keys`` are those that batches look rows up by.
    """
    images = read_images(spark, path, schema, before)
    rows = one_per_key(images, [row_key], [F.col("epoch").desc()])
    buckets = -(-max(1, images.count()) // rows_per_bucket)
    version = f"v-{before - 1}-{uuid.uuid4().hex}-{buckets}"
    into = f"{path}/_base/{version}"

    def save(df: DataFrame, key: str, part: str) -> None:
        placed = df.withColumn("bucket", _bucket(F.col(key), buckets))
        placed.repartitionByRange("bucket", key, row_key).sortWithinPartitions("bucket", key, row_key).write.partitionBy("bucket").parquet(f"{into}/{part}")

    save(rows, row_key, "rows")
    stored = spark.read.schema(_full(schema)).parquet(f"{into}/rows")
    for key in keys:
        save(stored.select(*dict.fromkeys((key, row_key))), key, f"by_{key}")
    switch_version(spark, f"{path}/_base", version)


def remove_folded(spark: SparkSession, path: str) -> None:
    """Delete the epochs that the base holds and the bases before it. No job may still read them."""
    base, upto = base_of(spark, path), folded_upto(spark, path)
    if base is None:
        return
    hadoop = spark._jvm.org.apache.hadoop.fs
    fs = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    names = lambda folder: [x.getPath().getName() for x in fs.listStatus(hadoop.Path(folder)) if x.isDirectory()]
    for name in names(path):
        if name.startswith("epoch=") and int(name.removeprefix("epoch=")) <= upto:
            fs.delete(hadoop.Path(f"{path}/{name}"), True)
    for name in names(f"{path}/_base"):
        if name.startswith("v-") and name != base.rsplit("/", 1)[1]:
            fs.delete(hadoop.Path(f"{path}/_base/{name}"), True)


def stored_rows(spark: SparkSession, path: str, schema: StructType, row_key: str, before: int, *matches: tuple[DataFrame, str]) -> DataFrame:
    """``touched`` over base and later epochs; of the base only the buckets of the batch's keys and of the rows they name are read."""
    recent, base = _recent(spark, path, schema, before), base_of(spark, path)
    if base is None:
        return touched(recent, row_key, *matches)
    ids = _ids(recent, row_key, *matches)
    for b, key in matches:
        index = StructType([schema[key]] if key == row_key else [schema[key], schema[row_key]])
        ids = ids.unionByName(_ids(_base_part(spark, base, f"by_{key}", index, (b, key)), row_key, (b, key)))
    ids = ids.distinct()
    old = _base_part(spark, base, "rows", _full(schema), (ids, row_key))
    return latest(recent.unionByName(old).join(ids, row_key, "left_semi"), [row_key])


@contextmanager
def held(rows: DataFrame) -> Iterator[DataFrame]:
    """Rows that one batch uses several times, computed once; what does not fit in memory goes to disk."""
    rows.persist()
    try:
        yield rows
    finally:
        rows.unpersist()


def at_once(session: SparkSession, writes: Mapping[str, Callable[[], dict[str, int]]]) -> dict[str, dict[str, int]]:
    """Writes of one batch that do not need each other, submitted together: one fills the cores that another leaves."""
    with ThreadPoolExecutor(len(writes)) as pool:
        running = {name: pool.submit(inheritable_thread_target(session)(write)) for name, write in writes.items()}
        return {name: r.result() for name, r in running.items()}


def _compact_due(spark: SparkSession, path: str, schema: StructType, row_key: str, keys: Sequence[str], epoch: int, every: int | None) -> None:
    """Fold when ``every`` epochs have come since the last base. Earlier epochs are committed, only ``epoch`` may be run again."""
    if every and epoch - 1 - folded_upto(spark, path) >= every:
        compact(spark, path, schema, row_key, keys, epoch)


def run_available(stream: DataFrame, step: Callable[[DataFrame, int], None], work: str, mode: str = "append") -> None:
    """Process everything that has arrived, then stop.

    A stateful query keeps the number of shuffle partitions its session had when
    it first started; ``stateful_session`` gives one that follows the cores.
    """
    query = (
        stream.writeStream.outputMode(mode).foreachBatch(step)
        .option("checkpointLocation", f"{work}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def stateful_session(spark: SparkSession, partitions: int | None = None) -> SparkSession:
    """A session of its own for a stream, with as many state partitions as the cluster has cores unless given."""
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))
    own.conf.set("spark.sql.shuffle.partitions", str(partitions or spark.sparkContext.defaultParallelism))
    return own


# -- comments -------------------------------------------------------------------------

COMMENT_SCHEMA = (
    "row_id string, video_key bigint, platform_id string, user_id string, nickname string, content string, "
    "like_count bigint, commented_at timestamp, unique_hash string"
)


def comment_stream(stream: DataFrame, work: str, compact_every: int | None = None) -> DataFrame:
    """Upsert per micro-batch by platform id, else by hash; returns the table.

    Old comments and comments without an id are kept: there is no watermark, a
    delivery that repeats an identity updates its row. ``compact_every`` folds
    the epochs whenever so many have come.
    """
    spark = stream.sparkSession
    schema = StructType.fromDDL(COMMENT_SCHEMA)
    path = f"{work}/comments"

    def step(batch: DataFrame, epoch: int) -> None:
        _compact_due(batch.sparkSession, path, schema, "row_id", ["video_key"], epoch, compact_every)
        with held(batch), held(stored_rows(batch.sparkSession, path, schema, "row_id", epoch, (batch, "video_key"))) as stored:
            new = up.upsert_comments(stored, batch, "commented_at").where(F.col(up.CHANGE) != "kept")
            write_epoch(new.drop(up.CHANGE), path, epoch)

    run_available(stream, step, work)
    return latest(read_images(spark, path, schema), ["row_id"])


# -- snapshots ------------------------------------------------------------------------

def snapshot_stream(stream: DataFrame, keep: Sequence[str], work: str) -> DataFrame:
    """Append one snapshot per observation through the file sink (exactly once)."""
    rows = up.snapshots(stream, keep)
    path = f"{work}/snapshots"
    query = (
        rows.writeStream.format("parquet").option("path", path)
        .option("checkpointLocation", f"{work}/progress").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(rows.schema).parquet(path)


# -- artifact arrivals ------------------------------------------------------------------

def arrival_stream(stream: DataFrame, key: str, status: str, at: Sequence[str], work: str) -> DataFrame:
    """Latest status and number of artifacts per key while files arrive (update mode)."""
    spark = stream.sparkSession
    state = stream.groupBy(key).agg(
        F.max_by(status, F.struct(*at)).alias("status"), F.count(F.lit(1)).alias("artifact_count")
    )
    path = f"{work}/status"
    run_available(state, lambda batch, epoch: write_epoch(batch, path, epoch), work, mode="update")
    return latest(read_images(spark, path, state.schema), [key])


# -- full crawl batches -------------------------------------------------------------------

TARGET_SCHEMA = (
    "homepage_url string, platform string, source_name string, category_lv1 string, category_lv2 string, "
    "tags array<string>, status string, notes string"
)
VIDEO_SCHEMA = (
    "row_id string, target_id string, video_id string, video_url string, title string, "
    "first_seen_at timestamp, last_seen_at timestamp"
)


REPLY_SCHEMA = (
    "video_key bigint, parents array<string>, platform_id string, user_id string, nickname string, content string, "
    "like_count bigint, commented_at timestamp, unique_hash string, seen_at timestamp"
)
#: Keys by which a reply names its parent, best first, and the columns of a comment that they may match.
PARENT_KEYS, COMMENT_KEYS = 6, ["platform_id", "unique_hash", "row_id"]

TABLES = {
    "targets": (TARGET_SCHEMA, ["homepage_url"]), "videos": (VIDEO_SCHEMA, ["row_id"]), "comments": (COMMENT_SCHEMA, ["row_id"]),
}


def persisted(spark: SparkSession, work: str, table: str) -> DataFrame:
    """Current rows of a table that ``persist_stream`` keeps; for ``replies`` what one batch of all resolved deliveries gives."""
    if table == "replies":
        return replies_table(read_images(spark, f"{work}/replies", StructType.fromDDL(REPLY_SCHEMA + ", comment_key string")))
    schema, keys = TABLES[table]
    return latest(read_images(spark, f"{work}/{table}", StructType.fromDDL(schema)), keys)


def replies_table(deliveries: DataFrame) -> DataFrame:
    """Replies by parent and identity; of repeated deliveries the one seen last counts, whichever epoch resolved it."""
    rows = deliveries.drop("epoch", "parents", "video_key")
    none = rows.where("false").drop("seen_at").withColumn("row_id", F.lit(""))
    return up.upsert_comments(none, rows, "seen_at", owner="comment_key", kind="reply", first_wins=False).drop(up.CHANGE)


def unresolved(spark: SparkSession, work: str, before: int | None = None) -> DataFrame:
    """Replies that wait for their parent: all that ever waited, without those that were settled since."""
    waiting = read_images(spark, f"{work}/waiting", StructType.fromDDL(REPLY_SCHEMA + ", reply_id string"), before)
    settled = read_images(spark, f"{work}/settled", StructType.fromDDL("reply_id string"), before)
    return waiting.join(settled.select("reply_id").distinct(), "reply_id", "left_anti").drop("epoch")


def _parented(replies: DataFrame, comments: DataFrame) -> DataFrame:
    keys = {f"__k{i}": F.get("parents", F.lit(i)) for i in range(PARENT_KEYS)}
    found = resolve_parents(replies.withColumns(keys), comments.withColumnRenamed("row_id", "comment_key").withColumn("row_id", F.col("comment_key")), "reply_id", "video_key", list(keys), COMMENT_KEYS, "comment_key")
    return found.drop(*keys)


def _write_counted(rows: DataFrame, path: str, epoch: int, **counts: Column) -> dict[str, int]:
    """Write an epoch; the counts come from the job that writes."""
    seen = Observation()
    write_epoch(rows.observe(seen, *[c.alias(n) for n, c in counts.items()]), path, epoch)
    return seen.get


def persist_stream(stream: DataFrame, work: str, compact_every: int | None = None) -> DataFrame:
    """Crawl items (one target, its video, comment and reply) into five tables and a quarantine.

    Items need homepage_url, source_name, ok, error, seen_at, video_id, title,
    metrics and comment columns; a reply column is optional. Failed items are set aside and counted; they
    never stop the batch. A reply that comes before its parent waits: each batch
    tries new replies with all comments of their videos, and waiting ones with the comments
    that the batch wrote. ``compact_every`` folds the epochs of targets, videos and comments
    whenever so many have come. Returns the counters of all epochs, taken by the jobs that wrote them; ``persisted`` reads the tables.
    """
    spark = stream.sparkSession
    schemas = {n: StructType.fromDDL(s) for n, (s, _) in TABLES.items()}
    changed = {c: F.count_if(F.col(up.CHANGE) == c) for c in ("created", "updated")}
    every = {"created": F.count(F.lit(1))}

    def step(batch: DataFrame, epoch: int) -> None:
        session = batch.sparkSession
        batch.persist()
        good = batch.where("ok")
        failed = batch.where("not ok").select("homepage_url", "error", "seen_at")
        counts = {"quarantine": _write_counted(failed, f"{work}/quarantine", epoch, **every)}
        videos = good.select(F.col("homepage_url").alias("target_id"), "video_id", "video_url", "title", "seen_at")
        comments = good.where(F.col("comment").isNotNull()).select("comment.*")
        parts = {
            "targets": lambda s: up.upsert_targets(s, good.select("homepage_url", "source_name", "seen_at"), "seen_at"),
            # A video may be met by its URL under another target, so both keys select the stored rows.
            "videos": lambda s: up.upsert_videos(s, videos, "seen_at"),
            "comments": lambda s: up.upsert_comments(s, comments, "commented_at"),
        }
        matches = {"targets": [(good, "homepage_url")], "videos": [(videos, "target_id"), (videos, "video_url")], "comments": [(comments, "video_key")]}

        def upserted(name: str) -> dict[str, int]:
            at = (session, f"{work}/{name}", schemas[name], TABLES[name][1][0])
            _compact_due(*at, [k for _, k in matches[name]], epoch, compact_every)
            with held(stored_rows(*at, epoch, *matches[name])) as stored:
                told = _write_counted(parts[name](stored).where(F.col(up.CHANGE) != "kept"), f"{work}/{name}", epoch, **changed)
            if name == "comments" and "reply" in batch.columns:
                _step_replies(session, good.where(F.col("reply").isNotNull()).select("reply.*", "seen_at"), epoch)
            return told

        rows = up.snapshots(good, ["homepage_url", "video_id", "seen_at"])
        counts |= at_once(session, {
            **{name: partial(upserted, name) for name in parts},
            "snapshots": lambda: _write_counted(rows, f"{work}/snapshots", epoch, **every),
        })
        told = [(n, c["created"], c.get("updated", 0)) for n, c in counts.items()]
        write_epoch(session.createDataFrame(told, "part string, created bigint, updated bigint"), f"{work}/counts", epoch)
        batch.unpersist()

    def _step_replies(session: SparkSession, rows: DataFrame, epoch: int) -> None:
        named = [c.split()[0] for c in REPLY_SCHEMA.split(", ")]
        new = rows.select(*named).withColumn("reply_id", F.sha2(F.to_json(F.struct(*named)), 256))
        written = _recent(session, f"{work}/comments", schemas["comments"], epoch + 1).where(F.col("epoch") == epoch).drop("epoch")
        tried = unresolved(session, work, epoch).join(written.select("video_key").distinct(), "video_key", "left_semi")
        with held(new), held(tried) as waiting:
            parts = [_parented(waiting, written).where(F.col("comment_key").isNotNull()).withColumn("__new", F.lit(False))]
            if not new.isEmpty():  # a batch without replies does not read the stored comments for them
                stored = stored_rows(session, f"{work}/comments", schemas["comments"], "row_id", epoch + 1, (new, "video_key"))
                parts.append(_parented(new, stored).withColumn("__new", F.lit(True)))
            known = F.col("comment_key").isNotNull()
            with held(reduce(DataFrame.unionByName, parts)) as found:
                write_epoch(found.where(known).select(*named, "comment_key"), f"{work}/replies", epoch)
                write_epoch(found.where(~known & F.col("__new")).select(*named, "reply_id"), f"{work}/waiting", epoch)
                write_epoch(found.where(known & ~F.col("__new")).select("reply_id"), f"{work}/settled", epoch)

    run_available(stream, step, work)
    sums = spark.read.parquet(f"{work}/counts").groupBy("part").agg(F.sum("created").alias("created"), F.sum("updated").alias("updated"))
    if "reply" not in stream.columns:
        return sums
    replies = persisted(spark, work, "replies").agg(F.lit("replies").alias("part"), F.count(F.lit(1)).alias("created"), F.lit(0).cast("bigint").alias("updated"))
    left = unresolved(spark, work).agg(F.lit("unresolved").alias("part"), F.count(F.lit(1)).alias("created"), F.lit(0).cast("bigint").alias("updated"))
    return sums.unionByName(replies).unionByName(left)
