"""Upserts as joins: the new state of a table from its current state and a batch.

Every function is a pure DataFrame transform, used the same way by batch jobs
and inside ``foreachBatch``. Repeated rows of one key inside a batch are
collapsed by partial aggregates (``max_by``), so a key that fills a third of a
batch costs one buffer row per task. Equal order values are decided by the hash
of the row, so a replay gives the same rows.

A null in a batch means that the record does not carry the field: the stored
value stays. An explicit blank text replaces it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions.coerce import filled, iso_text, number_from_float_text, text
from clipwell.functions.numbers import count_where
from clipwell.functions.text import identity_hash, path_segment_id
from clipwell.operators.picking import row_hash, unique

# How a batch value changes a stored one.
FILL = "fill"  # a filled value replaces, a blank one never does
TAKE = "take"  # any value replaces, also a blank one; null means absent
OVERWRITE = "overwrite"  # whatever the batch says, null included

CHANGE = "change"


def _rule(mode, new: Column, old: Column) -> Column:
    if mode == FILL:
        return F.coalesce(F.when(text(new) != "", new), old)
    if mode == TAKE:
        return F.coalesce(new, old)
    if mode == OVERWRITE:
        return new
    return F.coalesce(F.when(text(new) != "", new), F.lit(mode[1]))  # ("default", value)


def collapsed(batch: DataFrame, keys: Sequence[str], rules: Mapping[str, object], order: str | Column) -> DataFrame:
    """One row per key: last filled value for FILL columns, last present one for TAKE, last one for the others."""
    at = F.col(order) if isinstance(order, str) else order
    rows = batch.withColumns({"__at": at, "__tie": row_hash(batch)})
    place = F.struct("__at", "__tie")
    aggs = []
    for c, mode in rules.items():
        when = F.when(text(c) != "", place) if mode == FILL else F.when(F.col(c).isNotNull(), place) if mode == TAKE else place
        aggs.append(F.max_by(F.struct(c), when).getField(c).alias(c))
    return rows.groupBy(*keys).agg(*aggs, F.min("__at").alias("__first"), F.max("__at").alias("__last"))


def upsert(
    current: DataFrame, batch: DataFrame, keys: Sequence[str], rules: Mapping[str, object], order: str | Column,
    created: Mapping[str, object] | None = None, seen: tuple[str, str] | None = None,
) -> DataFrame:
    """Full outer join of state and batch; ``change`` says created, updated or kept.

    ``created`` holds defaults of new rows; ``seen`` names first/last columns
    kept as least and greatest of the order values.
    """
    present = {c: m for c, m in rules.items() if c in batch.columns}
    new = collapsed(batch, keys, present, order)
    state = [c for c in current.columns if c not in keys]
    a = current.select(*keys, *[F.col(c).alias(f"a_{c}") for c in state], F.lit(True).alias("__a"))
    b = new.select(*keys, *[F.col(c).alias(f"b_{c}") for c in present], "__first", "__last", F.lit(True).alias("__b"))
    j = a.join(b, list(keys), "full")
    old, fresh = F.col("__a").isNotNull(), F.col("__b").isNotNull()
    cols = []
    for c in state:
        if seen and c in seen:
            pick, edge = (F.least, "__first") if c == seen[0] else (F.greatest, "__last")
            cols.append(pick(F.col(f"a_{c}"), F.col(edge)).alias(c))
            continue
        kept = F.col(f"a_{c}")
        start = F.lit((created or {}).get(c)).cast(current.schema[c].dataType)
        if c in present:
            v = F.col(f"b_{c}").cast(current.schema[c].dataType)
            first = F.coalesce(F.when(text(v) != "", v), start) if isinstance(present[c], tuple) or c in (created or {}) else v
            changed = F.when(old, _rule(present[c], v, kept)).otherwise(first)
            cols.append(F.when(fresh, changed).otherwise(kept).alias(c))
        else:
            cols.append(F.when(old, kept).otherwise(start).alias(c))
    change = F.when(old & fresh, "updated").when(fresh, "created").otherwise("kept")
    return j.select(*keys, *cols, change.alias(CHANGE))


def change_counts(images: DataFrame) -> DataFrame:
    """Seen, created and updated rows of one upsert."""
    n = lambda v: count_where(F.col(CHANGE) == v)
    return images.agg(
        (n("created") + n("updated")).alias("seen"), n("created").alias("created"), n("updated").alias("updated")
    )


def batch_counts(parts: Mapping[str, DataFrame], snapshot_rows: DataFrame | None = None, unresolved: DataFrame | None = None) -> DataFrame:
    """Counters of one batch, a row per part: those of each upsert, snapshots as created, rows without a parent as unresolved."""
    none = F.lit(0).cast("bigint")
    rows = [change_counts(p).select(F.lit(name).alias("part"), "seen", "created", "updated", none.alias("unresolved")) for name, p in parts.items()]
    if snapshot_rows is not None:
        n = snapshot_rows.agg(F.count(F.lit(1)).alias("n"))
        rows.append(n.select(F.lit("snapshots").alias("part"), F.col("n").alias("seen"), F.col("n").alias("created"), none.alias("updated"), none.alias("unresolved")))
    if unresolved is not None:
        n = unresolved.agg(F.count(F.lit(1)).alias("n"))
        rows.append(n.select(F.lit("unresolved").alias("part"), F.col("n").alias("seen"), none.alias("created"), none.alias("updated"), F.col("n").alias("unresolved")))
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


# -- targets ----------------------------------------------------------------------

def target_rules(blank_overwrites: bool = False, platform: str = "douyin") -> dict[str, object]:
    """Crawl results never blank a name or category; an explicit import does."""
    named = OVERWRITE if blank_overwrites else FILL
    other = OVERWRITE if blank_overwrites else TAKE
    return {
        "platform": ("default", platform), "source_name": named, "category_lv1": named, "category_lv2": named,
        "tags": other, "status": FILL if blank_overwrites else ("default", "active"), "notes": other,
    }


def upsert_targets(current: DataFrame, batch: DataFrame, order: str, blank_overwrites: bool = False, platform: str = "douyin") -> DataFrame:
    """Targets by homepage URL."""
    b = batch
    for c in ("source_name", "category_lv1", "category_lv2", *(["notes"] if blank_overwrites else [])):
        if c in b.columns:
            b = b.withColumn(c, filled(c))
    rules = target_rules(blank_overwrites, platform)
    if blank_overwrites:
        rules.pop("platform")
    return upsert(
        current, b.where(text("homepage_url") != ""), ["homepage_url"], rules, order,
        created={"platform": platform, "status": "active"},
    )


# -- rows with a preferred and a second identity ------------------------------------

def matched(
    current: DataFrame, batch: DataFrame, row_id: str, first: Sequence[str], second: Sequence[str], new_id: Column,
) -> DataFrame:
    """Batch rows with the id of the stored row they belong to: by ``first``, else by ``second``, else new."""
    def known(cols: Sequence[str], name: str) -> DataFrame:
        return current.where(F.col(cols[-1]).isNotNull()).groupBy(*cols).agg(F.max(row_id).alias(name))

    one = batch.join(known(first, "__r1"), list(first), "left")
    two = one.join(known(second, "__r2"), list(second), "left")
    return two.withColumn(row_id, F.coalesce("__r1", "__r2", new_id)).drop("__r1", "__r2")


def upsert_videos(current: DataFrame, batch: DataFrame, order: str, url_prefix: str = "https://www.douyin.com/video/") -> DataFrame:
    """Videos by URL, else by (target, id); first and last seen from the order values."""
    vid = F.coalesce(filled("video_id"), filled(path_segment_id("video_url")))
    url = F.coalesce(filled("video_url"), F.concat(F.lit(url_prefix), filled("video_id")))
    b = batch.withColumns({"video_id": vid, "video_url": url}).where(F.col("video_id").isNotNull() & F.col("video_url").isNotNull())
    new_id = identity_hash("video", F.col("target_id"), F.col("video_id"))
    b = matched(current, b, "row_id", ["video_url"], ["target_id", "video_id"], new_id)
    take = {c: TAKE for c in ("target_id", "video_id", "video_url", "title", "description", "publish_at", "author_name", "cover_url")}
    return upsert(current, b, ["row_id"], take, order, seen=("first_seen_at", "last_seen_at"))


def comment_identity(kind: str, owner: str) -> Column:
    """Stored hash, else SHA-256 of owner, platform id, content, user, nickname and UTC ISO time."""
    when = iso_text(F.col("commented_at"))
    hashed = identity_hash(kind, F.col(owner), text("platform_id"), text("content"), text("user_id"), text("nickname"), when)
    return F.coalesce(filled("unique_hash"), hashed)


def upsert_comments(current: DataFrame, batch: DataFrame, order: str, owner: str = "video_key", kind: str = "comment", first_wins: bool = True) -> DataFrame:
    """Comments (or replies) by platform id, else by content hash.

    Inside a batch the first delivery of an identity wins for comments and the
    last one for replies.
    """
    b = batch.withColumns({"platform_id": filled("platform_id"), "unique_hash": comment_identity(kind, owner)})
    identity = F.coalesce(F.concat(F.lit("platform:"), F.col("platform_id")), F.concat(F.lit("hash:"), F.col("unique_hash")))
    if first_wins:
        cols = [c for c in b.columns if c != owner]
        place = F.struct(F.col(order).alias("at"), row_hash(b).alias("tie"))
        first = F.min_by(F.struct(*cols), F.col("__place")).alias("r")
        b = b.withColumns({"__id": identity, "__place": place}).groupBy(owner, "__id").agg(first).select(owner, "r.*")
    b = matched(current, b, "row_id", [owner, "platform_id"], [owner, "unique_hash"], identity_hash(kind, F.col(owner), identity))
    take = {c: TAKE for c in (owner, "platform_id", "user_id", "nickname", "content", "like_count", "reply_count", "commented_at", "unique_hash")
            if c in current.columns}
    return upsert(current, b, ["row_id"], take, order)


# -- snapshots, modalities, work lists ------------------------------------------------

SNAPSHOT_COUNTERS = ("view_count", "like_count", "comment_count", "share_count")


def snapshots(batch: DataFrame, keep: Sequence[str], counters: Sequence[str] = SNAPSHOT_COUNTERS) -> DataFrame:
    """One append-only row per observation: metrics struct, else snapshot struct, else flat columns."""
    def value(c: str) -> Column:
        boxes = [b for b in ("metrics", "snapshot") if b in batch.columns]
        expr = F.col(c) if c in batch.columns else F.lit(None).cast("string")
        for box in reversed(boxes):
            inner = F.col(f"{box}.{c}") if c in batch.schema[box].dataType.fieldNames() else F.lit(None).cast("string")
            expr = F.when(F.col(box).isNotNull(), inner.cast("string")).otherwise(expr.cast("string"))
        return number_from_float_text(expr).alias(c)

    return batch.select(*keep, *[value(c) for c in counters])


def merge_modality(table: DataFrame, results: DataFrame, modality: str, key: str = "video_id", ok: str = "ok") -> DataFrame:
    """Replace one modality column where the result is ok; everything else stays. Of repeated results of an id one counts."""
    good = unique(results.where(F.col(ok) & (text(key) != "")).select(key, modality), [key])
    fresh = good.select(key, F.col(modality).alias("__new"), F.lit(True).alias("__hit"))
    j = table.join(fresh, key, "full")
    kept = F.col(modality) if modality in table.columns else F.lit(None)
    value = F.when(F.col("__hit"), F.col("__new")).otherwise(kept)
    return j.withColumn(modality, value).drop("__new", "__hit")


def remaining(work: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return work.join(done.select(key), key, "left_anti")
