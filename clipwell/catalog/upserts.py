"""Bound upserts and streaming runs."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.filters import modalities
from clipwell.catalog.registry import query
from clipwell.operators import picking as pk
from clipwell.operators.joins import resolve_parents
from clipwell.streaming import runs
from clipwell.streaming import upserts as up

# Stored targets come from suppliers, arriving ones from customers: they share the names 'n0'..'n24'.
_CUR = """cur AS (SELECT 'https://h.example/' || s_suppkey AS url, s_name AS name, CASE WHEN s_nationkey % 2 = 0 THEN 'lv' || s_nationkey END AS cat,
  'paused' AS status FROM supplier)"""
_BAT = """bat AS (SELECT 'https://h.example/' || (c_custkey // 10) AS url, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE c_name END AS name,
  CASE WHEN c_custkey % 4 = 0 THEN c_mktsegment ELSE '' END AS cat, c_custkey AS seq FROM customer)"""
_COLLAPSED = f"""{_CUR}, {_BAT}, col AS (SELECT url, arg_max(trim(name), seq) FILTER (trim(name) <> '') AS fname, arg_max(cat, seq) FILTER (cat <> '') AS fcat,
  nullif(arg_max(trim(name), seq), '') AS lname, nullif(arg_max(cat, seq), '') AS lcat FROM bat GROUP BY url)"""


def _targets(t):
    url = F.lit("https://h.example/")
    none = F.lit(None).cast("string")
    cur = t.raw("supplier").select(
        F.concat(url, F.col("s_suppkey").cast("string")).alias("homepage_url"), F.lit("p").alias("platform"), F.col("s_name").alias("source_name"),
        F.when(F.col("s_nationkey") % 2 == 0, F.concat(F.lit("lv"), F.col("s_nationkey").cast("string"))).alias("category_lv1"),
        none.alias("category_lv2"), F.lit(None).cast("array<string>").alias("tags"), F.lit("paused").alias("status"), none.alias("notes"),
    )
    k = F.col("c_custkey")
    bat = t.raw("customer").select(
        F.concat(url, F.expr("c_custkey div 10").cast("string")).alias("homepage_url"),
        F.when(k % 3 == 0, " ").otherwise(F.col("c_name")).alias("source_name"),
        F.when(k % 4 == 0, F.col("c_mktsegment")).otherwise("").alias("category_lv1"), k.alias("seq"),
    )
    return cur, bat


_CHG = "CASE WHEN c.url IS NULL THEN 'created' WHEN l.url IS NULL THEN 'kept' ELSE 'updated' END AS change"


@query("inc1_upsert_targets", f"""WITH {_COLLAPSED} SELECT coalesce(c.url, l.url) AS homepage_url, coalesce(l.fname, c.name) AS source_name,
  coalesce(l.fcat, c.cat) AS category_lv1, coalesce(c.status, 'active') AS status, {_CHG} FROM cur c FULL JOIN col l ON l.url = c.url""")
def _(t):
    cur, bat = _targets(t)
    return up.upsert_targets(cur, bat, "seq").select("homepage_url", "source_name", "category_lv1", "status", "change")


@query("inc11_import_targets", f"""WITH {_COLLAPSED} SELECT coalesce(c.url, l.url) AS homepage_url, CASE WHEN l.url IS NULL THEN c.name ELSE l.lname END
  AS source_name, CASE WHEN l.url IS NULL THEN c.cat ELSE l.lcat END AS category_lv1, coalesce(c.status, 'active') AS status, {_CHG}
  FROM cur c FULL JOIN col l ON l.url = c.url""")
def _(t):
    cur, bat = _targets(t)
    out = up.upsert_targets(cur, bat, "seq", blank_overwrites=True)
    return out.select("homepage_url", "source_name", "category_lv1", "status", "change")


@query("inc6_change_counts", f"""WITH {_COLLAPSED}, x AS (SELECT {_CHG} FROM cur c FULL JOIN col l ON l.url = c.url)
  SELECT count(*) FILTER (change <> 'kept') AS seen, count(*) FILTER (change = 'created') AS created, count(*) FILTER (change = 'updated') AS updated FROM x""")
def _(t):
    cur, bat = _targets(t)
    return up.change_counts(up.upsert_targets(cur, bat, "seq"))


# Stored videos: orders of status F. Arriving: events, by URL for views and by (target, id) otherwise.
_VCUR = """vcur AS (SELECT 'r' || o_orderkey AS row_id, CAST(o_orderkey % 150 AS VARCHAR) AS target_id, CAST(o_orderkey AS VARCHAR) AS video_id,
  'u/' || o_orderkey AS url, o_orderpriority AS title, o_orderkey AS first_seen, o_orderkey AS last_seen FROM orders WHERE o_orderstatus = 'F')"""
_VBAT = """vbat AS (SELECT CAST(user_id AS VARCHAR) AS target_id, CAST(user_id + 150 * (event_id % 60) AS VARCHAR) AS video_id,
  CASE WHEN event_type = 'view' THEN 'u/' || event_id ELSE 'w/' || user_id || '-' || (event_id % 60) END AS url, event_type AS title, event_id AS seq FROM events)"""


@query("inc2_upsert_videos", f"""WITH {_VCUR}, {_VBAT}, m AS (SELECT v.*, coalesce(a.row_id, z.row_id, sha256('video|' || v.target_id || '|' || v.video_id)) AS rid
  FROM vbat v LEFT JOIN vcur a ON a.url = v.url LEFT JOIN vcur z ON z.target_id = v.target_id AND z.video_id = v.video_id), c AS (SELECT rid,
  arg_max(url, seq) AS url, arg_max(title, seq) AS title, min(seq) AS f, max(seq) AS l FROM m GROUP BY rid) SELECT coalesce(v.row_id, c.rid) AS row_id,
  coalesce(c.url, v.url) AS video_url, coalesce(c.title, v.title) AS title, least(v.first_seen, c.f) AS first_seen_at, greatest(v.last_seen, c.l) AS last_seen_at,
  CASE WHEN v.row_id IS NULL THEN 'created' WHEN c.rid IS NULL THEN 'kept' ELSE 'updated' END AS change FROM vcur v FULL JOIN c ON c.rid = v.row_id""")
def _(t):
    k = F.col("o_orderkey")
    cur = t.raw("orders").where("o_orderstatus = 'F'").select(
        F.concat(F.lit("r"), k.cast("string")).alias("row_id"), (k % 150).cast("string").alias("target_id"), k.cast("string").alias("video_id"),
        F.concat(F.lit("u/"), k.cast("string")).alias("video_url"), F.col("o_orderpriority").alias("title"),
        k.alias("first_seen_at"), k.alias("last_seen_at"),
    )
    e, u = F.col("event_id"), F.col("user_id")
    bat = t.raw("events").select(
        u.cast("string").alias("target_id"), (u + 150 * (e % 60)).cast("string").alias("video_id"),
        F.when(F.col("event_type") == "view", F.concat(F.lit("u/"), e.cast("string")))
        .otherwise(F.concat(F.lit("w/"), u.cast("string"), F.lit("-"), (e % 60).cast("string"))).alias("video_url"),
        F.col("event_type").alias("title"), e.alias("seq"),
    )
    return up.upsert_videos(cur, bat, "seq").select("row_id", "video_url", "title", "first_seen_at", "last_seen_at", "change")


@query("inc3_snapshots", """SELECT event_id, CASE WHEN event_type = 'view' THEN CAST(floor(value) AS BIGINT) WHEN event_type = 'click' THEN user_id
  ELSE event_id END AS view_count, CASE WHEN event_type IN ('view', 'click') THEN NULL ELSE 7 END AS like_count FROM events""")
def _(t):
    kind = F.col("event_type")
    obs = t.raw("events").select(
        "event_id", F.when(kind == "view", F.struct(F.col("value").cast("string").alias("view_count"))).alias("metrics"),
        F.when(kind == "click", F.struct(F.col("user_id").alias("view_count"))).alias("snapshot"),
        F.col("event_id").alias("view_count"), F.lit("7").alias("like_count"),
    )
    return up.snapshots(obs, ["event_id"]).select("event_id", "view_count", "like_count")


_CCUR = """ccur AS (SELECT 's' || o_orderkey AS row_id, o_orderkey % 150 AS video_key, CASE WHEN o_orderkey % 2 = 0 THEN 'p' || o_orderkey END AS platform_id,
  'old' AS content, 'h' || o_orderkey AS unique_hash FROM orders)"""
_CBAT = """cbat AS (SELECT user_id AS video_key, CASE WHEN event_type = 'view' THEN 'p' || (event_id % 4000) END AS platform_id, event_type || event_id AS content,
  CASE WHEN event_type <> 'signup' THEN 'h' || (event_id % 3000) END AS uh, user_id AS nick, event_id AS seq FROM events), chashed AS (SELECT *,
  coalesce(uh, sha256('comment|' || video_key || '|' || coalesce(platform_id, '') || '|' || content || '||' || nick || '|')) AS unique_hash,
  FROM cbat), cfirst AS (SELECT * FROM chashed QUALIFY row_number() OVER (PARTITION BY video_key, coalesce('platform:' || platform_id, 'hash:' || unique_hash)
  ORDER BY seq) = 1)"""


@query("inc4_upsert_comments", f"""WITH {_CCUR}, {_CBAT}, m AS (SELECT v.*, coalesce(a.row_id, z.row_id, sha256('comment|' || v.video_key || '|' ||
  coalesce('platform:' || v.platform_id, 'hash:' || v.unique_hash))) AS rid FROM cfirst v LEFT JOIN ccur a ON a.video_key = v.video_key AND
  a.platform_id = v.platform_id LEFT JOIN ccur z ON z.video_key = v.video_key AND z.unique_hash = v.unique_hash), c AS (SELECT rid, arg_max(content, seq)
  AS content FROM m GROUP BY rid) SELECT coalesce(v.row_id, c.rid) AS row_id, coalesce(c.content, v.content) AS content,
  CASE WHEN v.row_id IS NULL THEN 'created' WHEN c.rid IS NULL THEN 'kept' ELSE 'updated' END AS change FROM ccur v FULL JOIN c ON c.rid = v.row_id""")
def _(t):
    cur, bat = _comments(t)
    return up.upsert_comments(cur, bat, "seq").select("row_id", "content", "change")


def _comments(t):
    k = F.col("o_orderkey")
    s = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    none = F.lit(None)
    cur = t.raw("orders").select(
        s("s", k).alias("row_id"), (k % 150).alias("video_key"), F.when(k % 2 == 0, s("p", k)).alias("platform_id"),
        none.cast("string").alias("user_id"), none.cast("string").alias("nickname"), F.lit("old").alias("content"),
        none.cast("timestamp").alias("commented_at"), s("h", k).alias("unique_hash"),
    )
    e, kind = F.col("event_id"), F.col("event_type")
    bat = t.raw("events").select(
        F.col("user_id").alias("video_key"), F.when(kind == "view", s("p", e % 4000)).alias("platform_id"),
        F.concat(kind, e.cast("string")).alias("content"), F.when(kind != "signup", s("h", e % 3000)).alias("unique_hash"),
        none.cast("string").alias("user_id"), F.col("user_id").cast("string").alias("nickname"), none.cast("timestamp").alias("commented_at"), e.alias("seq"),
    )
    return cur, bat


@query("inc5_upsert_replies", f"""WITH {_CCUR}, rep AS (SELECT event_id AS seq, user_id AS video_key, 'p' || (event_id // 2) AS k1, 'h' || (event_id % 900) AS k2,
  event_type AS content, 'q' || (event_id % 700) AS platform_id FROM events), par AS (SELECT r.*, coalesce(a.row_id, z.row_id) AS comment_key FROM rep r
  LEFT JOIN ccur a ON a.video_key = r.video_key AND a.platform_id = r.k1 LEFT JOIN ccur z ON z.video_key = r.video_key AND z.unique_hash = r.k2)
  SELECT sha256('reply|' || comment_key || '|platform:' || platform_id) AS row_id, comment_key, arg_max(content, seq) AS content, 'created' AS change
  FROM par WHERE comment_key IS NOT NULL GROUP BY comment_key, platform_id UNION ALL SELECT 'unresolved', NULL, CAST(count(*) AS VARCHAR), 'skipped' FROM par
  WHERE comment_key IS NULL""")
def _(t):
    found = _replies(t)
    stored = found.where("false").select(
        F.lit("").alias("row_id"), "comment_key", "platform_id", "user_id", "nickname", "content", "commented_at", "unique_hash"
    )
    good = found.where(F.col("comment_key").isNotNull())
    out = up.upsert_comments(stored, good, "seq", owner="comment_key", kind="reply", first_wins=False)
    lost = found.where(F.col("comment_key").isNull()).agg(F.count(F.lit(1)).cast("string").alias("content"))
    return out.select("row_id", "comment_key", "content", "change").unionByName(
        lost.select(F.lit("unresolved").alias("row_id"), F.lit(None).cast("string").alias("comment_key"), "content", F.lit("skipped").alias("change"))
    )


def _replies(t):
    """Arriving replies with the key of their parent, null where there is none."""
    cur, _bat = _comments(t)
    e = F.col("event_id")
    s = lambda p, c: F.concat(F.lit(p), c.cast("string"))
    none = F.lit(None)
    rep = t.raw("events").select(
        e.alias("seq"), F.col("user_id").alias("video_key"), s("p", F.expr("event_id div 2")).alias("k1"), s("h", e % 900).alias("k2"),
        F.col("event_type").alias("content"), s("q", e % 700).alias("platform_id"), none.cast("string").alias("user_id"),
        none.cast("string").alias("nickname"), none.cast("timestamp").alias("commented_at"), none.cast("string").alias("unique_hash"),
    )
    parents = cur.withColumnRenamed("row_id", "comment_key")
    return resolve_parents(rep, parents, "seq", "video_key", ["k1", "k2"], ["platform_id", "unique_hash"], "comment_key")


@query("inc6_batch_counts", f"""WITH {_COLLAPSED}, x AS (SELECT {_CHG} FROM cur c FULL JOIN col l ON l.url = c.url), {_CCUR}, rep AS (SELECT event_id AS seq, user_id AS video_key,
  'p' || (event_id // 2) AS k1, 'h' || (event_id % 900) AS k2 FROM events) SELECT 'targets' AS part, count(*) FILTER (change <> 'kept') AS seen,
  count(*) FILTER (change = 'created') AS created, count(*) FILTER (change = 'updated') AS updated, 0 AS unresolved FROM x
  UNION ALL SELECT 'snapshots', count(*), count(*), 0, 0 FROM events UNION ALL SELECT 'unresolved', count(*), 0, 0, count(*) FROM rep r
  LEFT JOIN ccur a ON a.video_key = r.video_key AND a.platform_id = r.k1 LEFT JOIN ccur z ON z.video_key = r.video_key AND z.unique_hash = r.k2
  WHERE coalesce(a.row_id, z.row_id) IS NULL""")
def _(t):
    cur, bat = _targets(t)
    seen = up.snapshots(t.raw("events").select("event_id", F.col("value").cast("string").alias("view_count")), ["event_id"])
    return up.batch_counts({"targets": up.upsert_targets(cur, bat, "seq")}, seen, _replies(t).where(F.col("comment_key").isNull()))


@query("inc7_merge_modality", f"""WITH {b.FEATURES} SELECT coalesce(f.video_id, o.k) AS video_id, CASE WHEN o.k IS NOT NULL THEN o.v WHEN speech_rate_cpm < 300 THEN
  speech_rate_cpm END AS speech_rate, CASE WHEN person_count > 0 THEN face_center_score END AS face_center FROM features f FULL JOIN
  (SELECT o_custkey AS k, arg_max(o_totalprice, o_orderkey) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1) o ON o.k = f.video_id""")
def _(t):
    o = pk.latest_per_key(t.raw("orders").where("o_orderstatus = 'F'"), ["o_custkey"], "o_orderkey")
    res = o.select(F.col("o_custkey").alias("video_id"), F.lit(True).alias("ok"), F.struct(
        F.col("o_totalprice").alias("speech_rate_cpm"), F.lit(0.5).alias("opening_hook_score"), F.lit(0.125).alias("pause_ratio"), F.lit(30.0).alias("duration_sec"),
    ).alias("asr_speech"))
    m = up.merge_modality(modalities(t).drop("source_name"), res, "asr_speech")
    return m.select("video_id", F.col("asr_speech.speech_rate_cpm").alias("speech_rate"), F.col("face_quality.center_score").alias("face_center"))


@query("inc8_remaining_work", "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(t):
    return up.remaining(t.raw("orders").select("o_orderkey"), t.raw("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


def stream(t, table: str):
    """The table's parquet files as a stream."""
    spark = runs.stateful_session(t.spark)
    return spark.readStream.schema(t.raw(table).schema).option("pathGlobFilter", f"{table}.parquet").parquet(t.folder)


def delivered(t, rows, part, parts: int, run):
    """Rows written as deliveries that arrive one after the other, each followed by a run of the stream over all that has arrived."""
    folder = runs.work_folder(t.spark, "arriving")
    spark = runs.stateful_session(t.spark)
    for i in range(parts):
        rows.where(part == i).write.parquet(f"{folder}/{i}")
        out = run(spark.readStream.schema(rows.schema).parquet(f"{folder}/*"))
    return out


@query("inc3_snapshot_stream", "SELECT event_id, user_id AS view_count FROM events")
def _(t):
    obs = stream(t, "events").select("event_id", F.struct(F.col("user_id").cast("string").alias("view_count")).alias("metrics"))
    return runs.snapshot_stream(obs, ["event_id"], runs.work_folder(t.spark, "snapshots")).select("event_id", "view_count")


# Three deliveries; the later ones hold the older comments, and clicks have no platform id. Inside a delivery the first one wins, of deliveries the last.
@query("inc4_comment_stream", """WITH c AS (SELECT user_id AS video_key, CASE WHEN event_type <> 'click' THEN 'p' || (event_id % 5000) END AS platform_id, event_type AS content,
  CASE WHEN event_id % 2 = 0 THEN 'n' || event_id END AS nickname, ts, (SELECT max(event_id) + 1 FROM events) AS top, event_id FROM events), d AS (SELECT *, 2 - event_id * 3 // top AS part,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END || '+00:00' AS iso FROM c),
  i AS (SELECT *, coalesce(platform_id, sha256('comment|' || video_key || '||' || content || '||' || coalesce(nickname, '') || '|' || iso)) AS id FROM d),
  f AS (SELECT video_key, id, part, arg_min(platform_id, ts) AS platform_id, arg_min(content, ts) AS content, arg_min(struct_pack(n := nickname), ts).n AS nickname
  FROM i GROUP BY video_key, id, part) SELECT video_key, any_value(platform_id) AS platform_id, arg_max(content, part) AS content, arg_max(nickname, part) AS nickname FROM f GROUP BY video_key, id""")
def _(t):
    none, e = F.lit(None).cast("string"), t.raw("events")
    kind, at = F.col("event_type"), F.col("event_id")
    top = e.agg(F.max("event_id") + 1).scalar()
    rows = e.withColumn("part", 2 - F.floor(at * 3 / top)).select(
        F.col("user_id").alias("video_key"), F.when(kind != "click", F.concat(F.lit("p"), (at % 5000).cast("string"))).alias("platform_id"), none.alias("user_id"),
        F.when(at % 2 == 0, F.concat(F.lit("n"), at.cast("string"))).alias("nickname"), kind.alias("content"), F.lit(0).cast("bigint").alias("like_count"),
        F.col("ts").cast("timestamp").alias("commented_at"), none.alias("unique_hash"), "part",
    )
    work = runs.work_folder(t.spark, "comments")
    out = delivered(t, rows, F.col("part"), 3, lambda s: runs.comment_stream(s.drop("part"), work))
    return out.select("video_key", "platform_id", "content", "nickname")


@query("inc9_arrival_stream", """SELECT user_id AS video_id, arg_max(event_type, ts) AS status, count(*) AS artifact_count FROM events GROUP BY 1""")
def _(t):
    e = stream(t, "events").select(F.col("user_id").alias("video_id"), "event_type", "ts", "event_id")
    return runs.arrival_stream(e, "video_id", "event_type", ["ts", "event_id"], runs.work_folder(t.spark, "arrivals"))


@query("inc10_persist_stream", """SELECT 'targets' AS part, count(DISTINCT user_id) FILTER (event_type <> 'error') AS created, 0 AS updated FROM events UNION ALL
  SELECT 'videos', count(DISTINCT (user_id, event_id % 40)) FILTER (event_type <> 'error'), 0 FROM events UNION ALL
  SELECT 'comments', count(DISTINCT (user_id, event_id % 100)) FILTER (event_type = 'click'), 0 FROM events UNION ALL
  SELECT 'snapshots', count(*) FILTER (event_type <> 'error'), 0 FROM events UNION ALL SELECT 'quarantine', count(*) FILTER (event_type = 'error'), 0 FROM events""")
def _(t):
    return runs.persist_stream(crawled(t), runs.work_folder(t.spark, "persist"))


@query("inc10_persisted_videos", """SELECT 'u' || user_id AS target_id, CAST(event_id % 40 AS VARCHAR) AS video_id, 'u' || user_id || '/video/' || (event_id % 40) AS video_url,
  arg_max(event_type, ts) AS title, min(ts) AS first_seen_at, max(ts) AS last_seen_at FROM events WHERE event_type <> 'error' GROUP BY 1, 2, 3""")
def _(t):
    work = runs.work_folder(t.spark, "persist")
    runs.persist_stream(crawled(t), work)
    seen = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("first_seen_at", "last_seen_at")]
    return runs.persisted(t.spark, work, "videos").select("target_id", "video_id", "video_url", "title", *seen)


@query("inc10_persisted_comments", """SELECT user_id AS video_key, 'p' || (event_id % 100) AS platform_id, 'click' AS content, min(ts) AS commented_at FROM events
  WHERE event_type = 'click' GROUP BY 1, 2""")
def _(t):
    work = runs.work_folder(t.spark, "persist")
    runs.persist_stream(crawled(t), work)
    out = runs.persisted(t.spark, work, "comments")
    return out.select("video_key", "platform_id", "content", F.col("commented_at").cast("timestamp_ntz").alias("commented_at"))


# Views reply to clicks of the same user, some by a key that no click has. Views are delivered before most clicks, so their replies wait.
_REPLIES = """c AS (SELECT DISTINCT user_id AS video_key, 'p' || (event_id % 100) AS pid FROM events WHERE event_type = 'click'),
  v AS (SELECT user_id AS video_key, 'p' || (event_id % 130) AS k1, 'p' || (event_id % 110) AS k2, 'q' || (event_id % 9) AS platform_id, 'r' || event_id AS content, ts FROM events
  WHERE event_type = 'view'),
  r AS (SELECT v.*, coalesce(a.pid, b.pid) AS pid FROM v LEFT JOIN c a ON a.video_key = v.video_key AND a.pid = k1 LEFT JOIN c b ON b.video_key = v.video_key AND b.pid = k2)"""


@query("inc10_persisted_replies", f"""WITH {_REPLIES} SELECT sha256('reply|' || sha256('comment|' || video_key || '|platform:' || pid) || '|platform:' || platform_id) AS row_id,
  platform_id, arg_max(content, ts) AS content, max(ts) AS commented_at FROM r WHERE pid IS NOT NULL GROUP BY video_key, pid, platform_id""")
def _(t):
    work = runs.work_folder(t.spark, "persist")
    replied(t, work)
    at = F.col("commented_at").cast("timestamp_ntz").alias("commented_at")
    return runs.persisted(t.spark, work, "replies").select("row_id", "platform_id", "content", at)


@query("inc10_reply_counts", f"""WITH {_REPLIES} SELECT 'comments' AS part, count(*) AS created FROM c UNION ALL
  SELECT 'replies', count(DISTINCT (video_key, pid, platform_id)) FILTER (pid IS NOT NULL) FROM r UNION ALL SELECT 'unresolved', count(*) FILTER (pid IS NULL) FROM r""")
def _(t):
    counts = replied(t, runs.work_folder(t.spark, "persist"))
    return counts.where(F.col("part").isin("comments", "replies", "unresolved")).select("part", "created")


def replied(t, work: str):
    """Crawl items with replies in three deliveries: the views, then half of the clicks each."""
    kind, e, none = F.col("event_type"), F.col("event_id"), F.lit(None).cast("string")
    at = F.col("ts").cast("timestamp")
    key = lambda n: F.concat(F.lit("p"), (e % n).cast("string"))
    reply = F.struct(
        F.col("user_id").alias("video_key"), F.array(key(130), key(110)).alias("parents"), F.concat(F.lit("q"), (e % 9).cast("string")).alias("platform_id"),
        none.alias("user_id"), none.alias("nickname"), F.concat(F.lit("r"), e.cast("string")).alias("content"), F.lit(0).cast("bigint").alias("like_count"),
        at.alias("commented_at"), none.alias("unique_hash"),
    )
    comment = F.struct(
        F.col("user_id").alias("video_key"), key(100).alias("platform_id"), none.alias("user_id"), none.alias("nickname"), kind.alias("content"),
        F.lit(0).cast("bigint").alias("like_count"), at.alias("commented_at"), none.alias("unique_hash"),
    )
    rows = t.raw("events").where(kind.isin("view", "click")).select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("homepage_url"), none.alias("source_name"), F.lit(True).alias("ok"), none.alias("error"),
        at.alias("seen_at"), (e % 40).cast("string").alias("video_id"), F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/video/"), (e % 40).cast("string")).alias("video_url"),
        kind.alias("title"), F.struct(F.col("value").cast("string").alias("view_count")).alias("metrics"),
        F.when(kind == "click", comment).alias("comment"), F.when(kind == "view", reply).alias("reply"),
        F.when(kind == "view", 0).otherwise(1 + e % 2).alias("part"),
    )
    return delivered(t, rows, F.col("part"), 3, lambda s: runs.persist_stream(s.drop("part"), work))


def crawled(t):
    """Events as crawl items."""
    kind, at = F.col("event_type"), F.col("ts").cast("timestamp")
    none = F.lit(None).cast("string")
    vid = (F.col("event_id") % 40).cast("string")
    return stream(t, "events").select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("homepage_url"), none.alias("source_name"), (kind != "error").alias("ok"),
        F.when(kind == "error", "crawl failed").alias("error"), at.alias("seen_at"), vid.alias("video_id"),
        F.concat(F.lit("u"), F.col("user_id").cast("string"), F.lit("/video/"), vid).alias("video_url"), kind.alias("title"),
        F.struct(F.col("value").cast("string").alias("view_count")).alias("metrics"),
        F.when(kind == "click", F.struct(
            F.col("user_id").alias("video_key"), F.concat(F.lit("p"), (F.col("event_id") % 100).cast("string")).alias("platform_id"), none.alias("user_id"),
            none.alias("nickname"), kind.alias("content"), F.lit(0).cast("bigint").alias("like_count"), at.alias("commented_at"), none.alias("unique_hash"),
        )).alias("comment"),
    )
