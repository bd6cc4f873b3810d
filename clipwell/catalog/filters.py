"""Bound predicates and projections."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.registry import query
from clipwell.functions import text as tx
from clipwell.operators import filters as fl
from clipwell.operators import projections as pr


@query("flt1_strict_id", "SELECT doc_id, regexp_full_match(CAST(doc_id AS VARCHAR), '[0-9]{2,}') AS ok FROM documents")
def _(t):
    return t.raw("documents").select("doc_id", tx.strict_id("doc_id", 2).alias("ok"))


@query("flt2_loose_id", """SELECT page_id, regexp_full_match(seg, '[A-Za-z0-9_-]{6,128}')
  AND lower(seg) NOT IN ('undefined','null','none','nan','false','true') AS ok FROM (
  SELECT page_id, regexp_extract(url, '://([^./]+)', 1) AS seg FROM pages)""")
def _(t):
    seg = F.regexp_extract("url", "://([^./]+)", 1)
    return t.raw("pages").select("page_id", tx.loose_id(seg).alias("ok"))


_REASONS = """reasons AS (SELECT d.doc_id, CASE WHEN length(CAST(d.doc_id AS VARCHAR)) < 2 THEN 'invalid_video_id'
  WHEN l.toxic = 1 THEN 'quality_report_filtered' WHEN trim(lang) = '' OR trim(source) = '' OR d.n_chars < 200
  THEN 'missing_required_assets' WHEN c.conv_id IS NULL AND d.lang <> 'en' THEN 'not_homepage_observed'
  WHEN NOT contains(d.text, 'the') AND d.lang = 'en' THEN 'detail_account_not_mentioned' ELSE '' END AS reason
  FROM documents d LEFT JOIN labels l USING (doc_id)
  LEFT JOIN (SELECT DISTINCT conv_id FROM conversations) c ON c.conv_id = d.doc_id)"""


def _reasons(t):
    d = t.raw("documents").join(t.raw("labels").select("doc_id", "toxic"), "doc_id", "left")
    seen = t.raw("conversations").select(F.col("conv_id").alias("doc_id")).distinct().withColumn("seen", F.lit(True))
    return d.join(seen, "doc_id", "left").select(
        "doc_id",
        fl.first_reason([
            ("invalid_video_id", ~tx.strict_id("doc_id", 2)),
            ("quality_report_filtered", F.coalesce(F.col("toxic") == 1, F.lit(False))),
            ("missing_required_assets", ~fl.has_assets("lang", "source") | (F.col("n_chars") < 200)),
            ("not_homepage_observed", F.col("seen").isNull() & (F.col("lang") != "en")),
            ("detail_account_not_mentioned", ~F.col("text").contains("the") & (F.col("lang") == "en")),
        ]).alias("reason"),
    )


@query("flt3_first_reason", f"WITH {_REASONS} SELECT * FROM reasons")
def _(t):
    return _reasons(t)


@query("flt3_reason_counts", f"""WITH {_REASONS}, known(reason) AS (VALUES ('invalid_video_id'),
  ('quality_report_filtered'), ('missing_required_assets'), ('not_homepage_observed'), ('detail_account_not_mentioned'))
  SELECT k.reason, count(r.doc_id) AS n FROM known k LEFT JOIN reasons r ON r.reason = k.reason GROUP BY k.reason""")
def _(t):
    return fl.reason_counts(_reasons(t), "reason")


@query("flt4_required_assets", """SELECT p_partkey AS video_id, trim(p_brand) <> '' AND
  trim(CASE WHEN p_size % 5 = 0 THEN ' ' ELSE p_type END) <> '' AS ok FROM part""")
def _(t):
    p = t.raw("part").withColumn("path", F.when(F.col("p_size") % 5 == 0, " ").otherwise(F.col("p_type")))
    return p.select(F.col("p_partkey").alias("video_id"), fl.has_assets("p_brand", "path").alias("ok"))


_noise = " OR ".join(f"contains(text, '{w}')" for w in b.BOUND_NOISE)


@query("flt5_noise_comments", f"WITH {b.COMMENTS} SELECT comment_id, ({_noise}) AS noise FROM comments")
def _(t):
    return t.comments().select("comment_id", tx.is_noise("text", b.BOUND_NOISE).alias("noise"))


@query("flt6_real_comments", """SELECT event_id, contains(lower('/aweme/v1/web/' || CASE WHEN event_type = 'view'
  THEN 'comment/list' ELSE event_type END), '/aweme/v1/web/comment/list') OR event_type = 'click' OR
  (event_type = 'purchase' AND NOT value > 100) AS real FROM events""")
def _(t):
    kind = F.col("event_type")
    url = F.concat(F.lit("/aweme/v1/web/"), F.when(kind == "view", "comment/list").otherwise(kind))
    author = F.when(kind == "click", F.col("user_id"))
    nick = F.when(kind == "purchase", F.col("user_id"))
    return t.raw("events").select("event_id", fl.real_comment(url, author, nick, F.col("value") > 100).alias("real"))


@query("flt7_plausible_text", r"""WITH lines AS (SELECT doc_id, trim(unnest(string_split(text, chr(10)))) AS line
  FROM documents) SELECT doc_id, count(*) FILTER (length(line) BETWEEN 2 AND 500
  AND lower(line) NOT IN ('comment','reply','content','text') AND NOT regexp_full_match(line, '[^\p{L}\p{N}]+')
  AND NOT regexp_full_match(line, '[0-9]+(\.[0-9]+)?')) AS plausible, count(*) AS lines FROM lines GROUP BY doc_id""")
def _(t):
    lines = t.raw("documents").select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    lines = lines.withColumn("line", F.btrim("line"))
    return lines.groupBy("doc_id").agg(
        F.count_if(tx.plausible_comment(F.col("line"))).alias("plausible"), F.count(F.lit(1)).alias("lines")
    )


@query("flt8_metric_anomalies", f"""WITH {b.METRICS}, odd AS (SELECT video_id, concat_ws(',',
  CASE WHEN v <> 0 AND v = like_count AND v = comment_count AND v = share_count THEN 'all_equal_non_zero' END,
  CASE WHEN least(v, like_count, comment_count, share_count) < 0 THEN 'negative_value' END,
  CASE WHEN greatest(v, like_count, comment_count, share_count) > 700 THEN 'huge_value' END) AS types
  FROM (SELECT *, CASE WHEN video_id % 7 = 0 THEN -view_count WHEN video_id % 5 = 0 THEN view_count % 10
  ELSE view_count END AS v FROM metrics)) SELECT * FROM odd WHERE types <> ''""")
def _(t):
    v = F.col("view_count")
    k = F.col("video_id")
    m = t.metrics().withColumn("view_count", F.when(k % 7 == 0, -v).when(k % 5 == 0, v % 10).otherwise(v))
    odd = m.select("video_id", fl.anomaly_types(huge=700).alias("types"))
    return odd.where(F.size("types") > 0).select("video_id", F.array_join("types", ",").alias("types"))


@query("flt9_suspicious_metrics", f"""WITH {b.FEATURES} SELECT video_id, comment_count >= 12 AS odd_scale,
  share_count > 16 AND like_count < 34 AND comment_count < 11 AS metric_suspicious,
  CASE WHEN share_count > 16 AND like_count < 34 AND comment_count < 11 THEN '低赞低评高转发' ELSE '' END
    AS suspicious_reason,
  CASE WHEN share_count > 16 AND like_count < 34 AND comment_count < 11 THEN 0 ELSE engagement_score END
    AS trusted_engagement_score FROM features""")
def _(t):
    f = trusted(t).withColumn("odd_scale", fl.comment_scale_suspicious(limit=12))
    return f.select("video_id", "odd_scale", "metric_suspicious", "suspicious_reason", "trusted_engagement_score")


def trusted(t):
    """Feature rows with the trust columns, limits fitted to the bound counters."""
    return fl.with_trust(t.features(), many_shares=16, few_likes=34, few_comments=11)


TRUSTED = f"""{b.FEATURES}, trusted AS (SELECT *, share_count > 16 AND like_count < 34 AND comment_count < 11
  AS metric_suspicious, CASE WHEN share_count > 16 AND like_count < 34 AND comment_count < 11 THEN 0
  ELSE engagement_score END AS trusted_engagement_score,
  CASE WHEN share_count > 16 AND like_count < 34 AND comment_count < 11 THEN '低赞低评高转发' ELSE '' END
  AS suspicious_reason FROM features)"""


@query("flt10_meaningful_results", """SELECT o_orderkey, o_totalprice > 200000 OR o_orderstatus = 'F' OR
  starts_with(o_orderpriority, '1-') AS detail_ok, o_custkey % 4 > 2 OR o_orderpriority = '5-LOW' AS comments_ok
  FROM orders""")
def _(t):
    pri = F.col("o_orderpriority")
    detail = fl.meaningful_detail(
        [F.when(F.col("o_totalprice") > 200000, F.lit(1)).otherwise(F.lit(0))], F.col("o_orderstatus") == "F", pri, live="1-"
    )
    stop = F.when(pri == "5-LOW", "body_text_comments_captured").otherwise(pri)
    n = F.greatest(F.lit(0), F.col("o_custkey") % 4 - 2)
    return t.raw("orders").select(
        "o_orderkey", detail.alias("detail_ok"), fl.meaningful_comments(n, pri, stop).alias("comments_ok")
    )


@query("flt11_backfill_selection", f"""WITH {b.VIDEOS}, {b.METRICS} SELECT video_id, comment_count FROM videos
  JOIN metrics USING (video_id) WHERE video_id % 3 <> 0 AND comment_count > 0 ORDER BY comment_count DESC, video_id
  LIMIT 50""")
def _(t):
    vm = t.videos().join(t.metrics(), "video_id").select("video_id", "comment_count")
    return fl.backfill_selection(
        vm, F.col("video_id") % 3 == 0, F.col("comment_count") > 0,
        [F.col("comment_count").desc(), F.col("video_id").asc()], limit=50,
    )


@query("flt12_video_downloads", """SELECT o_orderkey, o_orderstatus = 'F' AND (o_orderpriority = '1-URGENT' OR
  regexp_matches('x/' || o_custkey || CASE WHEN o_custkey % 2 = 0 THEN '.mp4' ELSE '.jpg' END, '\\.mp4$')) AS download_ok,
  o_orderstatus <> 'P' AND o_totalprice / 1000.0 >= 1.0 AND o_custkey % 10 > 0 AND o_orderpriority <> '2-HIGH' AS real_ok
  FROM orders""")
def _(t):
    status = F.when(F.col("o_orderstatus") == "F", "success").otherwise("failed")
    kind = F.when(F.col("o_orderpriority") == "1-URGENT", "video/mp4").otherwise("")
    ending = F.when(F.col("o_custkey") % 2 == 0, ".mp4").otherwise(".jpg")
    path = F.concat(F.lit("x/"), F.col("o_custkey").cast("string"), ending)
    codec = F.when(F.col("o_orderpriority") == "2-HIGH", "png").otherwise("h264")
    return t.raw("orders").select(
        "o_orderkey",
        fl.video_download(status, kind, path).alias("download_ok"),
        fl.real_video(
            F.col("o_orderstatus") != "P", F.col("o_totalprice") / 1000.0, F.col("o_custkey") % 10, F.lit(100),
            codec, F.lit("mov"),
        ).alias("real_ok"),
    )


@query("flt13_comment_backend", """SELECT conv_id AS video_id, CASE WHEN count(*) FILTER (role <> 'system') > 1 THEN
  CASE WHEN bool_or(role = 'assistant' AND length(text) > 1500) THEN 'playwright:network-response-v1'
  ELSE 'playwright:body_text-v2' END ELSE CASE WHEN min(turn) = max(turn) THEN 'playwright:empty-state'
  ELSE 'playwright:placeholder' END END AS backend FROM conversations GROUP BY conv_id""")
def _(t):
    c = t.raw("conversations").groupBy(F.col("conv_id").alias("video_id")).agg(
        F.count_if(F.col("role") != "system").alias("n"),
        F.bool_or((F.col("role") == "assistant") & (F.length("text") > 1500)).alias("net"),
        F.when(F.min("turn") == F.max("turn"), "empty_comment_state").otherwise("other").alias("stop"),
    )
    n = F.when(F.col("n") > 1, F.col("n")).otherwise(F.lit(0))
    return c.select("video_id", fl.comment_backend(n, F.col("net"), F.col("stop")).alias("backend"))


# -- projections ---------------------------------------------------------------

@query("prj1_pick_field", """SELECT doc_id, CASE WHEN trim(t1) <> '' THEN trim(t1) WHEN trim(source) <> '' THEN trim(source)
  ELSE '' END AS account FROM (SELECT doc_id, source, CASE WHEN doc_id % 3 = 0 THEN ' ' ELSE lang END AS t1 FROM documents)""")
def _(t):
    d = t.raw("documents").select(
        "doc_id", F.when(F.col("doc_id") % 3 == 0, " ").otherwise(F.col("lang")).alias("Account_ID"),
        F.col("source").alias("source_name"),
    )
    return d.select("doc_id", pr.pick_field(d, ("account_id", "source_name")).alias("account"))


@query("prj2_nested_metric", """SELECT event_id, CASE WHEN k % 3 = 0 THEN k WHEN k % 3 = 1 THEN k + 1
  ELSE coalesce(CASE WHEN k % 2 = 0 THEN k + 2 END, 0) END AS view_count FROM (
  SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)""")
def _(t):
    k = F.get_json_object("props", "$.k").cast("bigint")
    e = t.raw("events").select(
        "event_id",
        F.when(k % 3 == 0, k).alias("view_count"),
        F.when(k % 3 == 1, F.create_map(F.lit("play_count"), (k + 1).cast("string"))).alias("metrics"),
        F.struct(F.when((k % 3 == 2) & (k % 2 == 0), (k + 2).cast("string")).alias("viewCount")).alias("stats"),
    )
    return e.select("event_id", pr.nested_metric(e, ("view_count", "play_count", "viewCount", "playCount")).alias("view_count"))


@query("prj3_modality_whitelist", f"""WITH {b.FEATURES} SELECT video_id, CASE WHEN person_count > 0
  THEN face_center_score END AS face_center, CASE WHEN speech_rate_cpm < 300 THEN speech_rate_cpm END AS speech_rate
  FROM features""")
def _(t):
    f = modalities(t).withColumn("debug", F.lit("x"))
    j = pr.whitelist_modalities(t.videos().join(t.metrics().select("video_id"), "video_id").select("video_id"), f)
    assert "debug" not in j.columns
    return j.select(
        "video_id", F.col("face_quality.center_score").alias("face_center"),
        F.col("asr_speech.speech_rate_cpm").alias("speech_rate"),
    )


def modalities(t):
    """Feature document: one struct per modality, null where the modality is missing."""
    f = t.features()
    return f.select(
        "video_id", "source_name",
        F.when(F.col("person_count") > 0, F.struct(
            F.col("face_center_score").alias("center_score"),
            (F.col("face_ratio") > 0.02).alias("face_detected"),
            F.col("face_ratio"),
            F.col("structure_completeness").alias("sharpness_score"),
            F.col("knowledge_density").alias("expression_positive_score"),
            F.lit(0.1).alias("occlusion_risk"),
        )).alias("face_quality"),
        F.when(F.col("subtitle_consistency") > 0.2, F.struct(
            F.col("pose_facing_score").alias("facing_camera_score"),
            F.col("subtitle_consistency").alias("stability_score"),
            F.col("opening_hook_score").alias("gesture_activity_score"),
            (F.col("pose_facing_score") > 0.4).alias("upper_body_visible"),
        )).alias("pose_quality"),
        F.when(F.col("person_count") < 2, F.struct(
            F.col("person_count"), F.col("face_center_score").alias("center_score"),
            F.col("knowledge_density").alias("subject_ratio"),
            F.lit(0.25).alias("background_clutter_score"),
        )).alias("person_subject"),
        F.when(F.col("ocr_readability") > 0.1, F.struct(
            F.col("ocr_readability").alias("readability_score"), F.col("knowledge_density").alias("keyword_density"),
            F.col("subtitle_consistency").alias("subtitle_consistency_score"), F.lit(0.5).alias("coverage_ratio"),
        )).alias("ocr_subtitle"),
        F.when(F.col("speech_rate_cpm") < 300, F.struct(
            F.col("speech_rate_cpm"), F.col("opening_hook_score"), F.lit(0.125).alias("pause_ratio"),
            F.lit(30.0).alias("duration_sec"),
        )).alias("asr_speech"),
        F.when(F.col("structure_completeness") > 0.1, F.struct(
            (F.col("opening_hook_score") > 0).alias("has_hook"),
            (F.col("person_count") > 0.5).alias("has_pain_point"),
            (F.col("knowledge_density") > 0.3).alias("has_method"),
            (F.col("face_ratio") > 0.03).alias("has_example"),
            (F.col("subtitle_consistency") > 0.5).alias("has_cta"),
            F.col("knowledge_density").alias("knowledge_density_score"),
            F.col("structure_completeness").alias("structure_completeness_score"),
        )).alias("script_structure"),
    )


@query("agg13_modality_coverage", f"""WITH {b.FEATURES} SELECT count(*) FILTER (person_count > 0) AS face_quality,
  count(*) FILTER (subtitle_consistency > 0.2) AS pose_quality, count(*) FILTER (person_count < 2) AS person_subject,
  count(*) FILTER (ocr_readability > 0.1) AS ocr_subtitle, count(*) FILTER (speech_rate_cpm < 300) AS asr_speech,
  count(*) FILTER (structure_completeness > 0.1) AS script_structure FROM features""")
def _(t):
    return pr.modality_coverage(modalities(t))


@query("prj4_download_jobs", """SELECT 'dl_' || left(sha1(url || '|2026-01-01|' || page_id), 16) AS job_id, url AS video_url,
  left(sha1(url), 12) AS video_id, 'downloads/' || slug || '/' || slug || '_' || left(sha1(url), 12) || '.mp4'
  AS output_path, 'page ' || host AS source_name, 'homepage' AS kind FROM (SELECT page_id, trim(url) AS url, host,
  left(trim(regexp_replace('page ' || host, '[\\\\/:*?"<>|\\s_]+', '_', 'g'), '._ '), 80) AS slug FROM (SELECT *,
  regexp_extract(url, '://([^/]+)', 1) AS host FROM pages))""")
def _(t):
    p = t.raw("pages").select(
        F.col("url").alias("video_url"), F.lit(None).cast("string").alias("video_id"), "page_id",
        F.concat(F.lit("page "), F.regexp_extract("url", "://([^/]+)", 1)).alias("source_name"),
    )
    jobs = pr.download_jobs(p, "2026-01-01", "page_id")
    return jobs.select(
        "job_id", "video_url", "video_id", "output_path", "source_name",
        pr.artifact_kind(F.lit("C:\\x\\collector\\homepage\\a.json")).alias("kind"),
    )


@query("prj5_audit_extract", f"""WITH {TRUSTED} SELECT video_id, source_name, like_count, comment_count, share_count,
  view_count, engagement_score, suspicious_reason FROM trusted WHERE metric_suspicious""")
def _(t):
    return pr.audit_extract(trusted(t))


@query("prj5_risk_text", f"""WITH {TRUSTED} SELECT video_id, CASE WHEN r = '' THEN '-' ELSE r END AS risks FROM (
  SELECT video_id, concat_ws('、', CASE WHEN metric_suspicious THEN '指标可疑' END,
  CASE WHEN person_count > 1.5 THEN '主体不稳' END, CASE WHEN structure_completeness < 0.3 THEN '话术弱' END,
  CASE WHEN subtitle_consistency < 0.45 THEN '字幕弱' END, CASE WHEN speech_rate_cpm > 360 THEN '语速快' END) AS r FROM trusted)""")
def _(t):
    return trusted(t).select("video_id", pr.risk_text().alias("risks"))


