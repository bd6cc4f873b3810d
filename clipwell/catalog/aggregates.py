"""Bound aggregations."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.filters import TRUSTED, trusted
from clipwell.catalog.registry import query
from clipwell.catalog.texts import GRADE, SENTIMENT_SQL, TITLE_SQL, TITLE_WORDS, TOPICS_SQL
from clipwell.functions import text as tx
from clipwell.operators import aggregates as ag
from clipwell.operators import joins as jn
from clipwell.functions.numbers import level
from clipwell.operators import picking as pk
from clipwell.operators.sets import shared_count

# Posts with counters and title flags.
RATED = f"""{b.VIDEOS}, {b.METRICS}, rated AS (SELECT v.*, coalesce(view_count, 0) AS view_count,
  coalesce(like_count, 0) AS like_count, coalesce(comment_count, 0) AS comment_count, coalesce(share_count, 0) AS share_count,
  coalesce(like_count, 0) + 3 * coalesce(comment_count, 0) + 2 * coalesce(share_count, 0) AS engagement_score,
  {TITLE_SQL.format(t='title')} FROM videos v LEFT JOIN metrics USING (video_id))"""


def rated(t):
    v = t.videos().join(t.metrics(), "video_id", "left").fillna(0, subset=list(ag.METRICS))
    eng = F.col("like_count") + 3 * F.col("comment_count") + 2 * F.col("share_count")
    feats = tx.title_features("title", TITLE_WORDS, GRADE, " la ")
    return v.withColumns({"engagement_score": eng, **feats})


@query("agg1_rows_per_account", """SELECT coalesce(nullif(trim(s), ''), 'unknown') AS account_id, count(*) AS n FROM
  (SELECT CASE WHEN n_chars < 100 THEN ' ' ELSE source END AS s FROM documents) GROUP BY 1""")
def _(t):
    d = t.raw("documents").select(F.when(F.col("n_chars") < 100, " ").otherwise(F.col("source")).alias("account_id"))
    return jn.count_by_account(d, "account_id", "n").orderBy(F.col("n").desc(), "account_id")


SCALES = f"""{RATED}, tall AS (UNPIVOT (SELECT video_id, view_count, like_count, comment_count, share_count FROM rated)
  ON view_count, like_count, comment_count, share_count INTO NAME metric VALUE value),
  mids AS (SELECT metric, median(value) AS median FROM tall GROUP BY metric),
  scales AS (SELECT metric, m.median, greatest(mad * 1.4826::DOUBLE, 1) AS scale FROM mids m JOIN
  (SELECT metric, median(abs(value - median)) AS mad FROM tall JOIN mids USING (metric) GROUP BY metric) USING (metric))"""


@query("agg2_median_mad", f"WITH {SCALES} SELECT metric, median, round_even(scale, 6) AS scale FROM scales")
def _(t):
    return ag.robust_scales(rated(t), "video_id").withColumn("scale", F.bround("scale", 6))


@query("agg3_account_medians", f"""WITH {RATED} SELECT account_id, count(*) AS video_count,
  CAST(floor(median(engagement_score)) AS BIGINT) AS median_engagement_score, CAST(floor(median(comment_count)) AS BIGINT)
  AS median_comment_count, CAST(floor(median(like_count)) AS BIGINT) AS median_like_count,
  CAST(floor(median(share_count)) AS BIGINT) AS median_share_count FROM rated GROUP BY account_id""")
def _(t):
    return ag.account_medians(
        rated(t), "account_id", "video_id", ["engagement_score", "comment_count", "like_count", "share_count"]
    )


@query("agg4_index_percentile", """SELECT l_returnflag AS flag, list_sort(list(l_extendedprice))[1 + least(count(*) - 1,
  CAST(floor(count(*) * 0.75::DOUBLE) AS BIGINT))] AS threshold, count(*) AS n FROM lineitem GROUP BY 1""")
def _(t):
    li = t.raw("lineitem").select(F.col("l_returnflag").alias("flag"), "l_extendedprice")
    return ag.index_percentile(li, "l_extendedprice", 0.75, ["flag"])


IDEAL = ("fit_score", "ocr_readability", "subtitle_consistency", "structure_completeness", "face_center_score",
         "pose_facing_score", "speech_rate_cpm", "person_count", "opening_hook_score")


def ranges_sql(src: str) -> str:
    one = (
        "SELECT '{f}' AS feature, round_even(list_sort(list({f}))[1 + CAST(round_even((count(*) - 1) * 0.25::DOUBLE, 0) AS BIGINT)], 4) AS low, "
        "round_even(median({f}), 4) AS mid, round_even(list_sort(list({f}))[1 + CAST(round_even((count(*) - 1) * 0.75::DOUBLE, 0) AS BIGINT)], 4) AS high FROM "
    )
    return " UNION ALL ".join(one.format(f=f) + src for f in IDEAL)


@query("agg5_ideal_ranges", f"WITH {b.FEATURES} {ranges_sql('features')}")
def _(t):
    return ag.ideal_ranges(t.features(), "video_id", IDEAL)


@query("agg6_feature_lifts", f"""WITH {RATED}, cut AS (SELECT list_sort(list(engagement_score))[1 + least(count(*) - 1,
  CAST(floor(count(*) * 0.75::DOUBLE) AS BIGINT))] AS th FROM rated WHERE engagement_score > 0), tall AS (UNPIVOT
  (SELECT engagement_score >= th AS high, {", ".join(tx.TITLE_FLAGS)} FROM rated, cut WHERE engagement_score > 0)
  ON {", ".join(tx.TITLE_FLAGS)} INTO NAME feature VALUE v) SELECT feature,
  round_even(coalesce(avg(v) FILTER (high), 0), 4) AS high_rate, round_even(coalesce(avg(v) FILTER (NOT high), 0), 4) AS normal_rate,
  round_even(coalesce(avg(v) FILTER (high), 0) - coalesce(avg(v) FILTER (NOT high), 0), 4) AS lift FROM tall GROUP BY feature""")
def _(t):
    return ag.feature_lifts(rated(t), "engagement_score", tx.TITLE_FLAGS)


PROFILE = ("has_grade", "has_method", "has_material", "has_parent_child", "has_interaction", "has_subject", "has_persona")
_prof = ", ".join(
    f"round_even(avg({f}) FILTER (up <= 5), 3) AS top_{f}, round_even(avg({f}) FILTER (down <= 5), 3) AS weak_{f}" for f in PROFILE
)


@query("agg7_head_tail_profiles", f"""WITH {RATED} SELECT account_id, {_prof} FROM (SELECT *,
  row_number() OVER (PARTITION BY account_id ORDER BY engagement_score DESC, video_id) AS up,
  row_number() OVER (PARTITION BY account_id ORDER BY engagement_score, video_id) AS down FROM rated) GROUP BY account_id""")
def _(t):
    return ag.head_tail_profiles(rated(t), "account_id", "engagement_score", "video_id", PROFILE)


_corr = ("fit_score", "ocr_readability", "structure_completeness", "face_center_score", "subtitle_consistency")


@query("agg8_correlations", f"""WITH {b.FEATURES} SELECT {", ".join(
    f"round_even(corr({c}, engagement_score), 3) AS {c}" for c in _corr)}, 0 AS constant FROM features""")
def _(t):
    f = t.features().withColumn("one", F.lit(1.0))
    return f.agg(
        *[F.bround(ag.correlation(c, "engagement_score"), 3).alias(c) for c in _corr],
        ag.correlation("one", "engagement_score").alias("constant"),
    )


_gap = ("fit_score", "ocr_readability", "face_center_score", "structure_completeness", "speech_rate_cpm", "subtitle_consistency")


@query("agg9_half_gaps", f"""WITH {b.FEATURES}, r AS (SELECT *, row_number() OVER (ORDER BY engagement_score DESC, video_id)
  <= greatest(1, count(*) OVER () // 2) AS top FROM features) SELECT {", ".join(
    f"round_even(avg({c}) FILTER (top) - avg({c}) FILTER (NOT top), 3) AS {c}_gap" for c in _gap)} FROM r""")
def _(t):
    return ag.half_gaps(t.features(), "engagement_score", "video_id", _gap)


@query("agg9_quarter_gaps", f"""WITH {TRUSTED}, r AS (SELECT *, row_number() OVER (ORDER BY trusted_engagement_score DESC, video_id)
  <= greatest(1, count(*) OVER () // 4) AS hi, row_number() OVER (ORDER BY trusted_engagement_score, video_id)
  <= greatest(1, count(*) OVER () // 4) AS lo FROM trusted WHERE NOT metric_suspicious) SELECT
  round_even(avg(fit_score) FILTER (hi) - avg(fit_score) FILTER (lo), 2) AS fit_score_gap,
  round_even(avg(comment_count) FILTER (hi) - avg(comment_count) FILTER (lo), 2) AS comment_count_gap,
  round_even(avg(structure_completeness) FILTER (hi) - avg(structure_completeness) FILTER (lo), 3) AS structure_completeness_gap FROM r""")
def _(t):
    ok = trusted(t).where(~F.col("metric_suspicious"))
    digits = {"fit_score": 2, "comment_count": 2, "structure_completeness": 3}
    return ag.quarter_gaps(ok, "trusted_engagement_score", "video_id", digits)


@query("agg10_risk_counts", f"""WITH {b.FEATURES} SELECT source_name, count(*) FILTER (person_count > 1.5) AS
  multi_person_or_unstable_subject, count(*) FILTER (structure_completeness < 0.3) AS low_structure,
  count(*) FILTER (subtitle_consistency < 0.45) AS low_subtitle_consistency,
  count(*) FILTER (face_ratio < 0.02 OR face_center_score < 0.7) AS face_small_or_offcenter,
  count(*) FILTER (speech_rate_cpm > 360) AS speech_too_fast FROM features GROUP BY ROLLUP (source_name)""")
def _(t):
    return ag.risk_counts(t.features(), "source_name")


@query("agg11_level_distribution", f"""WITH {b.FEATURES}, l AS (SELECT fit_score, CASE WHEN fit_score >= 75 THEN 'high'
  WHEN fit_score >= 55 THEN 'medium' ELSE 'low' END AS level FROM features) SELECT count(*) AS total,
  round_even(avg(fit_score), 2) AS average_fit_score, {", ".join(
    f"count(*) FILTER (level = '{n}') AS n_{n}, round_even(count(*) FILTER (level = '{n}') / count(*), 4) AS {n}_ratio"
    for n in ("high", "medium", "low"))} FROM l""")
def _(t):
    f = t.features().select("fit_score", level(F.col("fit_score"), 75, 55).alias("level"))
    return f.agg(*ag.level_distribution("fit_score", "level"))


@query("agg12_sample_summary", f"""WITH {RATED}, c AS (SELECT conv_id AS video_id, count(*) AS n FROM conversations GROUP BY 1)
  SELECT count(*) AS video_count, count(*) FILTER (comment_count < 12) AS analysis_video_count,
  count(*) FILTER (comment_count >= 12) AS suspicious_metric_video_count, count(DISTINCT account_id) AS account_count,
  count(*) FILTER (view_count > 0) AS nonzero_view_count, count(*) FILTER (comment_count > 0) AS nonzero_comment_count,
  CAST(sum(coalesce(n, 0)) AS BIGINT) AS total_collected_comments FROM rated LEFT JOIN c USING (video_id)""")
def _(t):
    r = jn.with_metrics(t.videos(), t.metrics(), t.comments()).withColumn("metric_suspicious", F.col("comment_count") >= 12)
    return ag.sample_summary(r)


# Comment artifacts: one per order, belonging to post o_custkey.
ARTIFACTS = """artifacts AS (SELECT o_orderkey AS artifact, o_custkey AS video_id, CASE WHEN o_orderstatus = 'P' THEN 0
  ELSE o_orderkey % 5 END AS comment_count, CASE WHEN o_orderstatus = 'F' THEN o_orderkey % 3 % 5 ELSE 0 END AS real_comment_count,
  CASE WHEN o_orderpriority = '5-LOW' AND o_orderstatus = 'P' THEN 'empty_comment_state' ELSE lower(o_orderpriority) END AS stop_reason,
  o_orderdate AS seen_at FROM orders)"""


def artifacts(t):
    k, s = F.col("o_orderkey"), F.col("o_orderstatus")
    return t.raw("orders").select(
        k.alias("artifact"), F.col("o_custkey").alias("video_id"),
        F.when(s == "P", 0).otherwise(k % 5).alias("comment_count"),
        F.when(s == "F", k % 3 % 5).otherwise(0).alias("real_comment_count"),
        F.when((F.col("o_orderpriority") == "5-LOW") & (s == "P"), "empty_comment_state")
        .otherwise(F.lower("o_orderpriority")).alias("stop_reason"),
        F.col("o_orderdate").alias("seen_at"),
    )


STATUS = f"""{ARTIFACTS}, status AS (SELECT video_id, count(*) AS artifact_count, CAST(sum(comment_count) AS BIGINT) AS comments,
  CAST(sum(real_comment_count) AS BIGINT) AS real, bool_or(real_comment_count > 0) AS has_non_empty_comments,
  bool_or(stop_reason = 'empty_comment_state') AS has_observed_no_comment FROM artifacts GROUP BY video_id)"""


@query("agg14_artifact_status", f"WITH {STATUS} SELECT * FROM status")
def _(t):
    return ag.artifact_status(artifacts(t), "video_id")


@query("agg14_status_totals", f"""WITH {STATUS} SELECT CAST(sum(artifact_count) AS BIGINT) AS comment_artifact_count,
  count(*) AS comment_video_count, count(*) FILTER (real > 0) AS real_comment_video_count,
  count(*) FILTER (comments = 0) AS empty_comment_video_count, count(*) FILTER (comments > 0 AND real = 0) AS noise_only_video_count,
  CAST(sum(comments) AS BIGINT) AS total_comment_count, CAST(sum(real) AS BIGINT) AS total_real_comment_count FROM status""")
def _(t):
    return ag.status_totals(ag.artifact_status(artifacts(t), "video_id"))


@query("agg15_failure_reasons", """WITH r AS (SELECT event_type AS status, 'scan_meta.stop_reason:' || event_type AS reason FROM events
  UNION ALL SELECT event_type, 'scan_meta.backend:b ' || (user_id % 7) FROM events
  UNION ALL SELECT event_type, 'scan_meta.warning:' || unnest(['w' || (event_id % 3), 'slow net']) FROM events WHERE value > 100
  UNION ALL SELECT event_type, 'raw.stub:true' FROM events WHERE value < 10
  UNION ALL SELECT event_type, 'raw.error:e' || (user_id % 4) FROM events WHERE event_type = 'error'
  UNION ALL SELECT event_type, 'raw.response_url:h.example/a/' || (user_id % 3) FROM events WHERE event_type = 'view')
  SELECT status, reason, count(*) AS n FROM r GROUP BY ALL""")
def _(t):
    e, v = t.raw("events"), F.col("value")
    kind = F.col("event_type")
    arts = e.select(
        kind.alias("status"), kind.alias("stop_reason"), F.lit(None).cast("string").alias("stop_reason_detail"),
        F.concat(F.lit(" b \t"), F.col("user_id") % 7).alias("backend"),
        F.when(v > 100, F.array(F.concat(F.lit("w"), F.col("event_id") % 3), F.lit(" slow  net "), F.lit(" "))).alias("warnings"),
    )
    raw = e.select(
        kind.alias("status"), (v < 10).alias("stub"),
        F.when(kind == "error", F.concat(F.lit("e"), F.col("user_id") % 4)).alias("error"),
        F.when(kind == "view", F.concat(F.lit("https://h.example/a/"), F.col("user_id") % 3, F.lit("?x=1"))).alias("response_url"),
    )
    both = ag.scan_reasons(arts, ["status"]).unionByName(ag.item_reasons(raw, ["status"]))
    return ag.reason_totals(both, ["status"])


@query("agg17_batch_totals", f"""WITH {b.BATCH}, x AS (SELECT *, videos_seen AS detail_attempted, detail_success AS comments_attempted
  FROM batch) SELECT account_id, {", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in (
    "videos_seen", "detail_success", "comments_success", "warnings_count", "failed_count", "detail_attempted", "comments_attempted"))},
  round_even(coalesce(sum(detail_success) / nullif(sum(detail_attempted), 0), 0), 6) AS detail_success_rate,
  round_even(coalesce(sum(comments_success) / nullif(sum(comments_attempted), 0), 0), 6) AS comment_success_rate
  FROM x GROUP BY ROLLUP (account_id)""")
def _(t):
    a = t.batch_accounts().withColumns({
        "detail_attempted": F.col("videos_seen"), "comments_attempted": F.col("detail_success"),
    })
    return ag.batch_totals(a, "account_id", [c for c in a.columns if c != "account_id"])


# Crawl targets: one per order, chunked by order key.
CHUNKS = """chunks AS (SELECT (row_number() OVER (ORDER BY o_orderkey) - 1) // 16 + 1 AS chunk_no, count(*) OVER () AS total,
  o_custkey % 5 AS video_total, 3 AS detail_attempted, o_orderkey % 4 AS detail_success, 2 AS comment_attempted,
  o_orderkey % 3 AS comment_success, o_orderkey % 3 AS detail_meaningful, o_orderkey % 2 AS comment_meaningful,
  CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END AS failed_count,
  o_totalprice / 10000.0::DOUBLE AS duration_sec FROM orders), reports AS (SELECT chunk_no, count(*) AS chunk_size,
  CAST(sum(video_total) AS BIGINT) AS video_total, CAST(sum(detail_attempted) AS BIGINT) AS detail_attempted,
  CAST(sum(detail_success) AS BIGINT) AS detail_success, CAST(sum(comment_attempted) AS BIGINT) AS comment_attempted,
  CAST(sum(comment_success) AS BIGINT) AS comment_success, CAST(sum(detail_meaningful) AS BIGINT) AS detail_meaningful,
  CAST(sum(comment_meaningful) AS BIGINT) AS comment_meaningful, CAST(sum(failed_count) AS BIGINT) AS failed_count,
  round_even(sum(duration_sec), 6) AS duration_sec, round_even(sum(detail_success) / sum(detail_attempted), 6) AS detail_success_rate,
  round_even(sum(comment_success) / sum(comment_attempted), 6) AS comment_success_rate,
  round_even(sum(detail_meaningful) / sum(detail_attempted), 6) AS detail_meaningful_rate,
  round_even(sum(comment_meaningful) / sum(comment_attempted), 6) AS comment_meaningful_rate,
  CASE WHEN sum(failed_count) > 0 THEN 'failed' ELSE 'success' END AS status FROM chunks GROUP BY chunk_no)"""


def chunk_rows(t):
    k = F.col("o_orderkey")
    o = pk.chunked(t.raw("orders"), [k.asc()], 16, row=["o_orderkey"])
    return o.select(
        "chunk_no", (F.col("o_custkey") % 5).alias("video_total"), F.lit(3).alias("detail_attempted"),
        (k % 4).alias("detail_success"), F.lit(2).alias("comment_attempted"), (k % 3).alias("comment_success"),
        (k % 3).alias("detail_meaningful"), (k % 2).alias("comment_meaningful"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT"), 1).otherwise(0).alias("failed_count"),
        (F.col("o_totalprice") / 10000.0).alias("duration_sec"),
    )


@query("agg18_chunk_reports", f"WITH {CHUNKS} SELECT * FROM reports")
def _(t):
    return ag.chunk_reports(chunk_rows(t), "chunk_no")


@query("agg18_master_summary", f"""WITH {CHUNKS} SELECT CAST(sum(chunk_size) AS BIGINT) AS target_count, {", ".join(
    f"CAST(sum({c}) AS BIGINT) AS {c}" for c in ("video_total", "detail_attempted", "detail_success", "comment_attempted",
    "comment_success", "detail_meaningful", "comment_meaningful", "failed_count"))}, count(*) AS chunk_count,
  count(*) FILTER (status = 'success') AS chunk_success_count, count(*) FILTER (status = 'failed') AS chunk_failed_count,
  round_even(sum(duration_sec), 6) AS total_duration_sec, round_even(sum(detail_success) / sum(detail_attempted), 6) AS
  detail_success_rate, round_even(sum(comment_success) / sum(comment_attempted), 6) AS comment_success_rate FROM reports""")
def _(t):
    return ag.master_summary(ag.chunk_reports(chunk_rows(t), "chunk_no"))


@query("agg19_baselines", f"""WITH {b.BATCH} SELECT count(*) AS account_count, max(videos_seen) AS max_videos_seen,
  max(detail_success) AS max_detail_success, max(comments_success) AS max_comments_success,
  max(warnings_count) AS max_warnings_count, CAST(sum(failed_count) AS BIGINT) AS global_failed_count FROM batch""")
def _(t):
    return ag.baselines(t.batch_accounts())


def downloads(t):
    o = t.raw("orders")
    odd = F.col("o_orderkey") % 10 == 0
    return o.select(
        F.col("o_orderkey").alias("job_id"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed").alias("status"),
        (F.col("o_orderpriority") == "3-MEDIUM").alias("fallback_used"), F.col("o_custkey").alias("file_size"),
        F.when(odd, "Fresh Cookies needed").when(F.col("o_orderkey") % 7 == 0, "timeout").otherwise(" ").alias("ytdlp_error"),
        F.lit(None).cast("string").alias("error"), F.coalesce("o_orderpriority", F.lit("unknown")).alias("downloader"),
    )


@query("agg20_download_totals", """SELECT count(*) AS jobs_total, count(*) FILTER (o_orderstatus = 'F') AS success_count,
  count(*) FILTER (o_orderstatus <> 'F') AS failed_count, count(*) FILTER (o_orderpriority = '3-MEDIUM') AS fallback_count,
  CAST(sum(o_custkey) AS BIGINT) AS total_file_size, count(*) FILTER (o_orderkey % 10 = 0 OR o_orderkey % 7 = 0) AS
  ytdlp_error_count, count(*) FILTER (o_orderkey % 10 = 0) AS fresh_cookies_required_count FROM orders""")
def _(t):
    return ag.download_totals(downloads(t))


@query("agg20_downloader_breakdown", "SELECT o_orderpriority AS downloader, count(*) AS n FROM orders GROUP BY 1")
def _(t):
    return downloads(t).groupBy("downloader").agg(F.count(F.lit(1)).alias("n"))


@query("agg20_error_samples", """SELECT o_orderkey AS job_id, CASE WHEN o_orderkey % 10 = 0 THEN 'Fresh Cookies needed'
  ELSE 'timeout' END AS error_text FROM orders WHERE o_orderkey % 10 = 0 OR o_orderkey % 7 = 0 ORDER BY o_orderkey LIMIT 5""")
def _(t):
    return ag.error_samples(downloads(t), [F.col("job_id")]).select("job_id", "error_text")


@query("agg21_homepage_summary", """SELECT p_brand AS source_name, count(*) AS video_count,
  array_to_string((list(p_partkey ORDER BY p_partkey))[1:5], ',') AS sample_ids,
  array_to_string((list('/v/' || p_partkey ORDER BY p_partkey))[1:3], ',') AS sample_urls FROM part GROUP BY 1""")
def _(t):
    return ag.homepage_summary(homepages(t)).select(
        "source_name", "video_count", F.array_join("sample_video_ids", ",").alias("sample_ids"), F.array_join("sample_video_urls", ",").alias("sample_urls")
    )


@query("agg21_homepage_batch", """SELECT p_brand AS source_name, 'h/' || p_brand AS homepage_url, '' AS platform, count(*) AS video_count, 'html' AS backend,
  CAST(max(p_size) AS BIGINT) AS dom_href_count, CAST(0 AS BIGINT) AS merged_unique_video_ids, count(DISTINCT p_size) AS warnings_count,
  array_to_string((list(DISTINCT 'size ' || lpad(CAST(p_size AS VARCHAR), 2, '0') ORDER BY 'size ' || lpad(CAST(p_size AS VARCHAR), 2, '0')))[1:3], ',') AS warnings_preview
  FROM part GROUP BY p_brand""")
def _(t):
    out = ag.homepage_summary(homepages(t))
    return out.select(
        "source_name", "homepage_url", "platform", "video_count", "backend", "dom_href_count", "merged_unique_video_ids", "warnings_count",
        F.array_join("warnings_preview", ",").alias("warnings_preview"),
    )


@query("agg21_homepage_totals", "SELECT count(DISTINCT p_brand) AS target_count, count(*) AS video_total FROM part")
def _(t):
    return ag.homepage_totals(ag.homepage_summary(homepages(t)))


def homepages(t):
    """Parts as the videos of one crawled homepage per brand."""
    p, key = t.raw("part"), F.col("p_partkey").cast("string")
    video = F.struct("p_partkey", key.alias("video_id"), F.concat(F.lit("/v/"), key).alias("video_url"))
    size = F.concat(F.lit("size "), F.lpad(F.col("p_size").cast("string"), 2, "0"))
    g = p.groupBy("p_brand").agg(
        F.array_sort(F.collect_list(video)).alias("videos"), F.array_sort(F.collect_set(size)).alias("warnings"), F.max("p_size").alias("links")
    )
    return g.select(
        F.struct(F.col("p_brand").alias("source_name"), F.concat(F.lit("h/"), "p_brand").alias("homepage_url")).alias("target"),
        F.struct("videos", "warnings", F.lit("html").alias("backend"), F.struct(F.col("links").alias("dom_href_count")).alias("diagnostics")).alias("crawl_result"),
    )


@query("agg22_progress_rows", """SELECT p_brand AS source_name, count(*) FILTER (p_size > 20) AS downloaded, 50 AS target,
  greatest(0, 50 - count(*) FILTER (p_size > 20)) AS remaining, count(*) FILTER (p_size > 20) >= 50 AS completed,
  least(1.0::DOUBLE, count(*) FILTER (p_size > 20) / 50) AS progress FROM part GROUP BY 1""")
def _(t):
    p = t.raw("part").groupBy(F.col("p_brand").alias("source_name")).agg(F.count_if(F.col("p_size") > 20).alias("downloaded"))
    return ag.progress_rows(p, 50)


@query("agg22_progress_totals", """SELECT count(*) AS goal_accounts, count(*) FILTER (d >= 50) AS completed_accounts,
  count(*) FILTER (d < 50) AS remaining_accounts, count(*) * 50 AS target_videos, CAST(sum(d) AS BIGINT) AS downloaded_videos,
  round_even(least(1.0::DOUBLE, sum(d) / (count(*) * 50)), 6) AS download_progress FROM (SELECT p_brand,
  count(*) FILTER (p_size > 20) AS d FROM part GROUP BY 1)""")
def _(t):
    p = t.raw("part").groupBy(F.col("p_brand").alias("source_name")).agg(F.count_if(F.col("p_size") > 20).alias("downloaded"))
    return ag.progress_totals(ag.progress_rows(p, 50), 50)


@query("agg22_coverage", f"""WITH {ARTIFACTS}, latest AS (SELECT video_id, arg_max(comment_count, row(seen_at, artifact)) AS n FROM artifacts
  GROUP BY video_id) SELECT (SELECT count(*) FROM (SELECT p_partkey FROM part INTERSECT SELECT doc_id FROM documents)) AS
  detail_covered, (SELECT count(DISTINCT p_partkey) FROM part) AS downloaded, count(*) AS artifact_videos,
  count(*) FILTER (n > 0) AS nonempty_videos, CAST(sum(n) AS BIGINT) AS total_rows FROM latest""")
def _(t):
    have = t.raw("part").select(F.col("p_partkey").alias("video_id"))
    known = t.raw("documents").select(F.col("doc_id").alias("video_id"))
    return ag.coverage(have, known, artifacts(t), "video_id", "seen_at", "artifact")


JUDGED = f"""{b.COMMENTS}, judged AS (SELECT c.*, d.source AS account_id, {SENTIMENT_SQL.format(c='c.text')} AS sentiment,
  CASE WHEN len(ts) = 0 THEN ['other'] ELSE ts END AS topics FROM (SELECT *, {TOPICS_SQL.format(c='text')} AS ts FROM comments) c
  JOIN documents d ON d.doc_id = c.video_id)"""


def judged(t):
    c = t.comments().join(t.posts().select("video_id", "account_id"), "video_id")
    return c.withColumns({
        "sentiment": tx.sentiment(F.col("text"), b.BOUND_SENTIMENTS, "neutral"),
        "topics": tx.topics(F.col("text"), b.BOUND_TOPICS, "other"),
    })


_STATS = """count(*) AS collected, count(*) FILTER (is_author_reply) AS author_replies, count(*) FILTER (sentiment = 'asking')
  AS question_count, count(DISTINCT video_id) AS videos_with_comments,
  round_even(count(*) FILTER (sentiment = 'asking') / count(*), 4) AS question_rate"""


@query("agg23_video_comment_stats", f"WITH {JUDGED} SELECT account_id, video_id, {_STATS} FROM judged GROUP BY ALL")
def _(t):
    return ag.comment_stats(
        judged(t).withColumn("v", F.col("video_id")), ["account_id", "video_id"], "v", "asking"
    )


@query("agg23_account_comment_stats", f"WITH {JUDGED} SELECT account_id, {_STATS} FROM judged GROUP BY ALL")
def _(t):
    return ag.comment_stats(judged(t), ["account_id"], "video_id", "asking")


@query("agg23_account_top_topics", f"""WITH {JUDGED} SELECT account_id, topic, n, pos FROM (SELECT *, row_number() OVER
  (PARTITION BY account_id ORDER BY n DESC, topic) AS pos FROM (SELECT account_id, topic, count(*) AS n FROM
  (SELECT account_id, unnest(topics) AS topic FROM judged) GROUP BY ALL)) WHERE pos <= 3""")
def _(t):
    return ag.top_topics(judged(t), "topics", ["account_id"])


@query("agg24_topic_counts", f"""WITH {JUDGED} SELECT topic, count(*) AS n FROM (SELECT unnest(topics) AS topic FROM judged)
  GROUP BY topic""")
def _(t):
    return ag.topic_counts(judged(t), "topics")


@query("agg24_topic_examples", f"""WITH {JUDGED} SELECT topic, count(*) AS n, array_to_string((list(comment_id ORDER BY video_id, turn))[1:5],
  ' ') AS examples FROM (SELECT comment_id, video_id, turn, unnest(topics) AS topic FROM judged) GROUP BY topic""")
def _(t):
    out = ag.topic_examples(judged(t), "topics", "comment_id", [F.col("video_id"), F.col("turn")])
    return out.withColumn("examples", F.array_join("examples", " "))


# Names of targets, files and processed rows differ in case and blanks; one target has no file.
_STATUS26 = """s AS (SELECT p_brand AS source_name, count(*) AS local_count, count(d.doc_id) AS processed_count FROM part LEFT JOIN documents d
  ON d.doc_id = p_partkey AND d.lang = 'en' GROUP BY 1 UNION ALL SELECT 'none', 0, 0)"""


@query("agg26_download_status", f"WITH {_STATUS26} SELECT *, local_count > processed_count AS needs_refresh FROM s")
def _(t):
    return download_status(t)


@query("agg26_status_totals", f"WITH {_STATUS26} SELECT count(*) AS target_count, count(*) FILTER (local_count > processed_count) AS needs_refresh_count FROM s")
def _(t):
    return ag.download_status_totals(download_status(t))


def download_status(t):
    p = t.raw("part").select(F.col("p_brand").alias("source_name"), F.col("p_partkey").alias("doc_id"))
    done = p.join(t.raw("documents").where("lang = 'en'").select("doc_id"), "doc_id", "left_semi")
    targets = p.select("source_name").distinct().unionByName(t.spark.range(1).select(F.lit("none").alias("source_name")))
    spaced = p.withColumn("source_name", F.concat(F.lit(" "), F.col("source_name"), F.lit("  ")))
    return ag.download_status(targets, spaced, done)


@query("agg27_run_status", f"""WITH {CHUNKS} SELECT count(*) AS chunk_count, count(*) FILTER (status = 'success') AS
  completed_chunk_count, count(*) FILTER (status <> 'success') AS failed_count,
  CAST(sum(CASE WHEN status = 'success' THEN chunk_size ELSE 0 END) AS BIGINT) AS processed_video_count,
  CAST(sum(chunk_size) AS BIGINT) AS total_video_count, count(*) FILTER (status <> 'success') = 0 AS ok FROM reports""")
def _(t):
    return ag.run_status(ag.chunk_reports(chunk_rows(t), "chunk_no"), F.col("status") == "success", "chunk_size")


@query("agg29_trusted_summary", f"""WITH {TRUSTED} SELECT count(*) AS video_count, count(*) FILTER (NOT metric_suspicious) AS
  trusted_metric_count, count(*) FILTER (metric_suspicious) AS suspicious_metric_count, count(DISTINCT source_name) AS account_count,
  round_even(avg(fit_score), 2) AS average_fit_score, round_even(avg(trusted_engagement_score) FILTER (NOT metric_suspicious), 2)
  AS average_trusted_engagement FROM trusted""")
def _(t):
    r = trusted(t)
    return r.agg(*ag.trusted_summary(r))


@query("agg30_merged_counters", """SELECT counter, CAST(sum(v) AS BIGINT) AS n FROM (SELECT event_type AS counter, user_id AS v FROM events
  UNION ALL SELECT 'k', CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events UNION ALL SELECT role, turn FROM conversations) GROUP BY 1""")
def _(t):
    a = t.raw("events").select(F.create_map(
        "event_type", "user_id", F.lit("k"), F.get_json_object("props", "$.k").cast("bigint")
    ).alias("hits"))
    c = t.raw("conversations").select(F.create_map("role", "turn").alias("hits"))
    return ag.merge_counters([a, c], "hits")
