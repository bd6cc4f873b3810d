"""Bound quality, pool, gap and diagnosis queries."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.aggregates import STATUS, artifacts
from clipwell.catalog.registry import query
from clipwell.operators import aggregates as ag
from clipwell.operators import joins as jn
from clipwell.plans import pool as po

_Q = """SELECT '{s}' AS section, '{m}' AS metric, CAST(({q}) AS BIGINT) AS value"""
_DETAILS = f"""{b.METRICS}, details AS (SELECT video_id + 5 AS video_id, CASE WHEN video_id % 7 = 0 THEN -view_count WHEN video_id % 5 = 0
  THEN 30 ELSE view_count END AS view_count, CASE WHEN video_id % 5 = 0 THEN 30 ELSE like_count END AS like_count,
  CASE WHEN video_id % 5 = 0 THEN 30 ELSE comment_count END AS comment_count, CASE WHEN video_id % 5 = 0 THEN 30 ELSE share_count END
  AS share_count FROM metrics), arts AS (SELECT o_custkey AS video_id, o_orderkey % 3 AS n_comments, o_orderpriority = '5-LOW' AS ph,
  o_orderstatus = 'P' AS es FROM orders), loads AS (SELECT p_partkey AS video_id FROM part), ok AS (SELECT DISTINCT video_id FROM details WHERE video_id > 9)"""
_parts = []
for _n, _src in (("detail", "details"), ("comment", "arts"), ("download", "loads")):
    _parts += [
        _Q.format(s="scanned", m=f"{_n}_file_count", q=f"SELECT count(*) FROM {_src}"),
        _Q.format(s="scanned", m=f"{_n}_video_count", q=f"SELECT count(DISTINCT video_id) FROM {_src} WHERE video_id > 9"),
        _Q.format(s="scanned", m=f"{_n}_invalid_count", q=f"SELECT count(*) FROM {_src} WHERE NOT video_id > 9"),
    ]
_odd = ("(view_count <> 0 AND view_count = like_count AND view_count = comment_count AND view_count = share_count) "
        "OR least(view_count, like_count, comment_count, share_count) < 0")
_parts += [
    _Q.format(s="coverage", m="download_without_detail_count", q="SELECT count(*) FROM (SELECT video_id FROM loads WHERE video_id > 9 EXCEPT FROM ok)"),
    _Q.format(s="coverage", m="detail_without_download_count", q="SELECT count(*) FROM (FROM ok EXCEPT SELECT video_id FROM loads)"),
    _Q.format(s="anomalies", m="metric_anomaly_count", q=f"SELECT count(*) FROM details WHERE video_id > 9 AND ({_odd})"),
    _Q.format(s="comment_quality", m="placeholder_count", q="SELECT count(*) FROM arts WHERE video_id > 9 AND ph"),
    _Q.format(s="comment_quality", m="empty_comment_state_count", q="SELECT count(*) FROM arts WHERE video_id > 9 AND es"),
    _Q.format(s="comment_quality", m="non_empty_artifact_count", q="SELECT count(*) FROM arts WHERE video_id > 9 AND n_comments > 0"),
    _Q.format(s="comment_quality", m="non_empty_video_count", q="SELECT count(DISTINCT video_id) FROM arts WHERE video_id > 9 AND n_comments > 0"),
]


@query("agg16_quality_report", f"WITH {_DETAILS} " + " UNION ALL ".join(_parts))
def _(t):
    k = F.col("video_id")
    flat = {c: F.when(k % 5 == 0, F.lit(30)).otherwise(F.col(c)) for c in ("like_count", "comment_count", "share_count")}
    d = t.metrics().withColumns({
        **flat, "view_count": F.when(k % 7 == 0, -F.col("view_count")).when(k % 5 == 0, F.lit(30)).otherwise(F.col("view_count")),
    }).withColumn("video_id", k + 5)
    arts = t.raw("orders").select(
        F.col("o_custkey").alias("video_id"), (F.col("o_orderkey") % 3).alias("n_comments"),
        (F.col("o_orderpriority") == "5-LOW").alias("has_placeholder"), (F.col("o_orderstatus") == "P").alias("has_empty_state"),
    )
    return po.quality_report(d, arts, t.videos().select("video_id"), id_size=2)


_VALID = f"""{b.POSTS}, pool AS (SELECT p.*, CASE WHEN p.video_id < 10 THEN 'invalid_video_id' WHEN l.toxic = 1 OR p.n_chars > 6000 THEN
  'quality_report_filtered' WHEN trim(p.lang) = '' OR p.n_chars < 100 THEN 'missing_required_assets' WHEN h.page_id IS NULL THEN 'not_homepage_observed'
  WHEN NOT contains(translate(c.html, '?？', ''), p.account_id) THEN 'detail_account_not_mentioned' ELSE '' END AS reason
  FROM (SELECT * REPLACE (left(account_id, 2) AS account_id) FROM posts) p LEFT JOIN labels l ON l.doc_id = p.video_id
  LEFT JOIN (SELECT DISTINCT o_custkey AS page_id FROM orders WHERE o_orderstatus = 'F') h ON h.page_id = p.video_id
  LEFT JOIN pages c ON c.page_id = p.video_id), pool2 AS (SELECT * REPLACE (CASE WHEN reason = '' AND video_id NOT IN (SELECT page_id FROM pages)
  THEN 'detail_account_not_mentioned' ELSE reason END AS reason) FROM pool)"""


def reasons(t):
    posts = t.posts().withColumn("account_id", F.left("account_id", F.lit(2))).withColumns({
        "mp4_path": F.when(F.col("n_chars") >= 100, F.lit("x")).otherwise(F.lit(" ")),
        "detail_artifact_path": F.col("video_id").cast("string"),
    })
    bad = t.raw("labels").where("toxic = 1").select(F.col("doc_id").alias("video_id"))
    big = t.raw("documents").where("n_chars > 6000").select(F.col("doc_id").alias("video_id"))
    home = t.raw("orders").where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("video_id"))
    index = posts.select("video_id", "account_id").join(home, "video_id", "left_semi")
    bodies = t.raw("pages").select(F.col("page_id").cast("string").alias("detail_artifact_path"), F.col("html").alias("body"))
    return po.pool_reasons(posts, bad.union(big), index, bodies, assets=("lang", "mp4_path"), id_size=2)


@query("sco16_pool_reasons", f"WITH {_VALID} SELECT video_id, reason FROM pool2")
def _(t):
    return reasons(t).select("video_id", "reason")


@query("sco16_valid_comments", f"""WITH {_VALID}, {b.COMMENTS} SELECT comment_id FROM comments WHERE video_id IN
  (SELECT video_id FROM pool2 WHERE reason = '') AND NOT ({" OR ".join(f"contains(text, '{w}')" for w in b.BOUND_NOISE)})""")
def _(t):
    _videos, _metrics, comments = po.valid_pool(reasons(t), t.metrics(), t.comments(), noise=b.BOUND_NOISE)
    return comments.select("comment_id")


@query("sco16_pool_summary", f"""WITH {_VALID}, {b.COMMENTS}, {b.METRICS}, v AS (SELECT video_id FROM pool2 WHERE reason = ''),
  known(reason) AS (VALUES ('invalid_video_id'), ('quality_report_filtered'), ('missing_required_assets'), ('not_homepage_observed'),
  ('detail_account_not_mentioned')) SELECT 'pool' AS section, 'valid_video_count' AS metric, (SELECT count(*) FROM v) AS value UNION ALL
  SELECT 'pool', 'valid_video_metric_count', (SELECT count(*) FROM metrics WHERE video_id IN (FROM v)) UNION ALL
  SELECT 'pool', 'valid_comment_count', (SELECT count(*) FROM comments WHERE video_id IN (FROM v) AND NOT ({" OR ".join(
    f"contains(text, '{w}')" for w in b.BOUND_NOISE)})) UNION ALL
  SELECT 'filtered', k.reason, count(p.video_id) FROM known k LEFT JOIN pool2 p ON p.reason = k.reason GROUP BY k.reason""")
def _(t):
    r = reasons(t)
    _videos, metrics, comments = po.valid_pool(r, t.metrics(), t.comments(), noise=b.BOUND_NOISE)
    return po.pool_summary(r, metrics, comments)


_GAPS = f"""{b.VIDEOS}, gi AS (SELECT account_id, count(*) AS input_video_count FROM videos GROUP BY 1), gv AS (SELECT account_id, count(*)
  AS n FROM videos WHERE video_id IN (SELECT doc_id FROM documents WHERE lang = 'en') GROUP BY 1), gaps AS (SELECT account_id, input_video_count,
  coalesce(n, 0) AS valid_video_count, greatest(0, input_video_count - coalesce(n, 0)) AS filtered_video_count,
  {b.mean("coalesce(n, 0) / input_video_count", 4)} AS retention_rate, CASE WHEN coalesce(n, 0) < 20 THEN '高' WHEN coalesce(n, 0) < 50 THEN '中'
  ELSE '低' END AS priority FROM gi LEFT JOIN gv USING (account_id))"""


def gaps(t):
    valid = jn.only_ids(t.videos(), t.posts().where("lang = 'en'"))
    return po.gap_report(t.videos(), valid)


@query("sco12_gap_report", f"WITH {_GAPS} SELECT * FROM gaps")
def _(t):
    return po.ordered_gaps(gaps(t))


@query("jon14_backfill_accounts", f"""WITH {_GAPS}, src AS (SELECT 'Brand#' || (s_nationkey + 1) AS name, arg_max(s_name, s_suppkey) AS url FROM supplier
  GROUP BY 1) SELECT 'Brand#' || substr(name, 7) || '?' AS source_name, url AS homepage_url, priority AS backfill_priority, valid_video_count
  FROM gaps JOIN src ON name = account_id WHERE priority IN ('高', '中') OR valid_video_count < 24""")
def _(t):
    src = t.raw("supplier").select(
        F.concat(F.lit("Brand#"), F.col("s_nationkey") + 1, F.lit("?")).alias("source_name"), F.col("s_name").alias("homepage_url"), "s_suppkey"
    )
    out = po.backfill_accounts(gaps(t), src, order=[F.col("s_suppkey").desc()], min_valid=24)
    return out.select("source_name", "homepage_url", "backfill_priority", "valid_video_count")


_TARGETS = f"""{STATUS}, {b.METRICS}, targets AS (SELECT m.video_id, m.comment_count, CASE WHEN comment_count > 0 AND NOT
  coalesce(has_observed_no_comment, FALSE) THEN 1 ELSE 0 END AS priority, CASE WHEN coalesce(has_observed_no_comment, FALSE) THEN 'no_comment_observed'
  WHEN comment_count > 0 THEN 'comment_expected' ELSE 'no_comment_expected' END AS comment_expected_status,
  coalesce(artifact_count, 0) > 0 AS has_comment_artifact FROM metrics m LEFT JOIN status s USING (video_id)
  WHERE NOT coalesce(has_non_empty_comments, FALSE))"""


def targets(t):
    return po.comment_targets(t.metrics().select("video_id", "comment_count"), ag.artifact_status(artifacts(t), "video_id"))


@query("sco13_comment_targets", f"WITH {_TARGETS} SELECT * FROM targets")
def _(t):
    return po.ordered_targets(targets(t)).drop("should_backfill_comment")


@query("win13_ranked_targets", f"WITH {_TARGETS} SELECT video_id, comment_count, priority FROM targets ORDER BY priority DESC, comment_count DESC, video_id LIMIT 40")
def _(t):
    return po.ordered_targets(targets(t), limit=40).select("video_id", "comment_count", "priority")


_DIAG = f"""{STATUS}, {b.METRICS}, diag AS (SELECT m.video_id, CASE WHEN artifact_count IS NULL THEN 'missing_artifact' WHEN real > 0 THEN
  'real_comment' WHEN comments = 0 THEN 'empty_response' ELSE 'noise_only' END AS status, comment_count AS expected_comment_count,
  coalesce(artifact_count, 0) AS artifact_count, coalesce(comments, 0) AS comment_count, coalesce(real, 0) AS real_comment_count,
  coalesce(has_observed_no_comment, FALSE) AS seen_empty FROM metrics m LEFT JOIN status USING (video_id)),
  diagnosed AS (SELECT * EXCLUDE (seen_empty), CASE WHEN status = 'real_comment' THEN status WHEN seen_empty THEN 'no_comment_observed'
  WHEN expected_comment_count <= 0 THEN 'no_comment_expected' ELSE 'comment_expected_' || status END AS expected_status FROM diag)"""


def diagnosed(t):
    m = t.metrics().select("video_id", "comment_count")
    arts = artifacts(t)
    return po.diagnose(jn.driven_by(m, arts, "video_id"), m, ag.artifact_status(arts, "video_id"))


@query("sco14_diagnosis", f"WITH {_DIAG} SELECT * FROM diagnosed")
def _(t):
    return diagnosed(t)


@query("sco14_diagnosis_summary", f"""WITH {_DIAG} SELECT count(*) AS video_count, count(*) FILTER (status = 'real_comment') AS real_comment_video_count,
  count(*) FILTER (status <> 'real_comment') AS failure_video_count, count(*) FILTER (expected_status = 'no_comment_observed') AS
  no_comment_observed_video_count, count(*) FILTER (expected_status = 'no_comment_expected') AS no_comment_expected_video_count,
  count(*) FILTER (starts_with(expected_status, 'comment_expected_')) AS comment_expected_but_uncollected_video_count,
  {b.mean("count(*) FILTER (status = 'real_comment') / count(*)", 6)} AS hit_rate FROM diagnosed""")
def _(t):
    return po.diagnosis_summary(diagnosed(t))


@query("agg15_reasons_per_status", f"""WITH {_DIAG} SELECT status, 'scan_meta.stop_reason:' || stop_reason AS reason, count(*) AS n FROM artifacts
  JOIN diagnosed USING (video_id) WHERE status <> 'real_comment' GROUP BY ALL""")
def _(t):
    r = ag.scan_reasons(artifacts(t), ["video_id"], ("stop_reason",), None)
    return po.failure_reasons(diagnosed(t), r)


