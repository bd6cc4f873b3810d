"""Small literal cases for the rules, and invariants of the distributed helpers."""

import datetime
import html
import json
import os
import random
import statistics
import subprocess
import sys

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipwell.catalog import load
from clipwell.functions import coerce as co
from clipwell.functions import lexicons as lx
from clipwell.functions import numbers as nm
from clipwell.functions import text as tx
from clipwell.operators import aggregates as ag
from clipwell.operators import filters as fl
from clipwell.operators import joins as jn
from clipwell.operators import ordering as od
from clipwell.operators import picking as pk
from clipwell.operators import projections as pr
from clipwell.plans import effect as ef
from clipwell.plans import engagement as en
from clipwell.plans import extraction as ex
from clipwell.plans import features as ft
from clipwell.plans import fusion as fu
from clipwell.plans import pool as po
from clipwell.plans import video_fit as vf
from clipwell.plans import visual_fit as vi
from clipwell.sources import files as fs
from clipwell.streaming import runs
from clipwell.streaming import upserts as up
from tests.oracle import compare

METRICS = "view_count bigint, like_count bigint, comment_count bigint, share_count bigint"


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


# -- F1 dataset ----------------------------------------------------------------

def test_dataset_assembly(spark, tmp_path):
    folder = tmp_path / "video"
    folder.mkdir()
    good = {"video_url": "https://x/video/1111111111", "metrics": {"view_count": "88"}, "title": "a"}
    (folder / "video_detail_a.json").write_text(json.dumps(good))
    (folder / "video_detail_b.json").write_text(json.dumps({**good, "title": "later"}))
    (folder / "video_detail_2222222222.json").write_text(json.dumps({"metrics": {"view_count": "99"}}))
    (folder / "video_detail_bad.json").write_text("{broken")
    schema = "video_id string, video_url string, title string, metrics struct<view_count: string>"
    ok, warnings = fs.split_corrupt(fs.read_artifacts(spark, str(folder), schema).cache())
    assert warnings.count() == 1
    found = fs.details(ok)
    got = {r.video_id: (r.title, r.v) for r in found.select("video_id", "title", pr.nested_metric(found, ("view_count",)).alias("v")).collect()}
    assert got == {"1111111111": ("later", 88), "2222222222": (None, 99)}


def test_media_index(spark):
    files = spark.createDataFrame([("file:/d/acc/acc_1111111111.mp4",), ("file:/d/acc/x.mp4",)], "path string")
    assert [(r.video_id, r.account_name) for r in fs.media_index(files).collect()] == [("1111111111", "acc")]


def test_read_targets_headers_and_blank_rows(spark, tmp_path):
    (tmp_path / "t.csv").write_text("﻿平台,分类,部门,账号名,主页链接\n p ,c1,c2,甲,https://h/1\n", encoding="utf-8")
    (row,) = rows(fs.read_targets(spark, str(tmp_path / "t.csv")))
    assert row["source_name"] == "甲" and row["tags"] == ["platform:p", "category_lv1:c1", "category_lv2:c2"]
    (tmp_path / "m.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        fs.read_targets(spark, str(tmp_path / "m.csv"))
    (tmp_path / "e.json").write_text(json.dumps({"items": [{"homepage_url": "", "source_name": "x", "category_lv1": "", "category_lv2": ""}]}))
    with pytest.raises(Exception, match="empty homepage_url"):
        fs.read_targets(spark, str(tmp_path / "e.json")).collect()


# -- F2 quality ------------------------------------------------------------------

def test_quality_report(spark):
    details = spark.createDataFrame(
        [("1111111111", 7, 7, 7, 7), ("3333333333", 100, -1, 0, 1), ("4444444444", 1000000001, 2, 3, 4), ("undefined", 1, 2, 3, 4)],
        f"video_id string, {METRICS}",
    )
    comments = spark.createDataFrame(
        [("1111111111", 0, True, False), ("2222222222", 1, False, False), ("3333333333", 0, False, True), ("bad", 0, False, False)],
        "video_id string, n_comments int, has_placeholder boolean, has_empty_state boolean",
    )
    loads = spark.createDataFrame([("1111111111",), ("2222222222",), ("x",)], "video_id string")
    got = {r.metric: r.value for r in po.quality_report(details, comments, loads).collect()}
    assert (got["detail_invalid_count"], got["comment_invalid_count"], got["download_invalid_count"]) == (1, 1, 1)
    assert (got["download_without_detail_count"], got["detail_without_download_count"]) == (1, 2)
    assert got["metric_anomaly_count"] == 3 and got["placeholder_count"] == 1
    assert got["empty_comment_state_count"] == 1 and got["non_empty_video_count"] == 1


# -- F3 pool ---------------------------------------------------------------------

def test_pool_reasons(spark):
    videos = spark.createDataFrame(
        [("1111111111", "甲?", "d1", "m1"), ("2222222222", "甲", "d2", "m2"), ("3333333333", "甲", "", "m3"), ("5", "甲", "d", "m"),
         ("4444444444", "乙", "d4", "m4"), ("6666666666", "甲", "d6", "m6")],
        "video_id string, account_id string, detail_artifact_path string, mp4_path string",
    )
    bad = spark.createDataFrame([("2222222222",)], "video_id string")
    home = spark.createDataFrame([("甲", "1111111111"), ("甲", "6666666666")], "account_id string, video_id string")
    bodies = spark.createDataFrame([("d1", "by 甲 ??"), ("d6", "nobody")], "detail_artifact_path string, body string")
    got = {r.video_id: r.reason for r in po.pool_reasons(videos, bad, home, bodies).collect()}
    assert got == {
        "1111111111": "", "2222222222": "quality_report_filtered", "3333333333": "missing_required_assets", "5": "invalid_video_id",
        "4444444444": "not_homepage_observed", "6666666666": "detail_account_not_mentioned",
    }
    counts = {r.reason: r.n for r in fl.reason_counts(po.pool_reasons(videos, bad, None, None), "reason").collect()}
    assert counts["not_homepage_observed"] == 0 and counts["quality_report_filtered"] == 1


# -- F4 engagement ------------------------------------------------------------------

def test_positive_factors(spark):
    posts = spark.createDataFrame(
        [("v1", "a1", "教程 爆款", 1000, 200, 80, 40), ("v2", "a1", "教程 进阶", 800, 120, 30, 10),
         ("v3", "a1", "日常 记录", 700, 20, 2, 1), ("v4", "a2", "舞蹈 挑战", 900, 150, 20, 5)],
        f"video_id string, account_id string, title string, {METRICS}",
    )
    scored = en.robust_engagement(posts, "video_id").cache()
    picks = {(r.account_id, r.side, r.pos): r.video_id for r in en.best_and_weakest(scored, "account_id", "engagement_score", 2).collect()}
    assert picks[("a1", "top", 1)] == "v1" and picks[("a1", "bottom", 1)] == "v3"
    top = en.best_and_weakest(scored, "account_id", "engagement_score", 2).where("side = 'top'")
    first = en.keywords(top, scored, ["account_id"], "title", 2).where("account_id = 'a1' and pos = 1").first()
    assert first.keyword == "教程"
    comments = spark.createDataFrame([("v1", "有用 有用 干货"), ("v2", "教程 清晰"), ("v4", "不错")], "video_id string, content string")
    own = en.account_comments(comments.withColumn("account_id", F.lit("")), posts)
    words = {r.keyword for r in en.keywords(own, None, ["account_id"], "content", 5).where("account_id = 'a1'").collect()}
    assert "有用" in words
    brute = statistics.median([1000, 800, 700, 900])
    assert {r.metric: r.median for r in ag.robust_scales(posts, "video_id").collect()}["view_count"] == brute


# -- F5 backfill ----------------------------------------------------------------------

def test_backfill_and_diagnosis(spark):
    details = spark.createDataFrame([("1", 10), ("2", 5), ("3", 4), ("4", 99), ("5", 0), ("6", 7)], "video_id string, comment_count bigint")
    arts = spark.createDataFrame(
        [("1", 2, 2, "ok"), ("2", 0, 0, "timeout"), ("4", 0, 0, "empty_comment_state"), ("6", 3, 0, "x")],
        "video_id string, comment_count int, real_comment_count int, stop_reason string",
    )
    status = ag.artifact_status(arts, "video_id")
    ordered = po.ordered_targets(po.comment_targets(details, status)).collect()
    assert [r.video_id for r in ordered] == ["6", "2", "3", "4", "5"] and ordered[-2].comment_expected_status == "no_comment_observed"
    videos = po.diagnose(details.select("video_id"), details, status).cache()
    got = {r.video_id: r.expected_status for r in videos.collect()}
    assert got == {
        "1": "real_comment", "2": "comment_expected_empty_response", "3": "comment_expected_missing_artifact",
        "4": "no_comment_observed", "5": "no_comment_expected", "6": "comment_expected_noise_only",
    }
    assert po.diagnosis_summary(videos).first().hit_rate == 0.166667
    assert ag.status_totals(status).first().noise_only_video_count == 1


# -- F6 fit and fusion -------------------------------------------------------------------

MODALITIES = (
    "local_video_fit struct<fit_score: double, strengths: array<string>>, face_quality struct<center_score: double, sharpness_score: double, "
    "expression_positive_score: double, face_detected: boolean, occlusion_risk: double>, pose_quality struct<facing_camera_score: double, "
    "stability_score: double, gesture_activity_score: double, upper_body_visible: boolean>, person_subject struct<person_count: double, subject_ratio: double, "
    "center_score: double, background_clutter_score: double>, ocr_subtitle struct<readability_score: double, keyword_density: double, "
    "subtitle_consistency_score: double, coverage_ratio: double>, asr_speech struct<speech_rate_cpm: double, opening_hook_score: double, pause_ratio: double>, "
    "script_structure struct<has_hook: boolean, has_pain_point: boolean, has_method: boolean, has_example: boolean, has_cta: boolean, knowledge_density_score: double>"
)


def test_fusion_full_and_empty(spark):
    full = ((90.0, ["好"]), (0.9, 0.9, 0.9, True, 0.0), (0.9, 0.9, 0.9, True), (1.0, 0.5, 0.9, 0.1), (0.9, 0.8, 0.9, 0.9), (260.0, 1.0, 0.05),
            (True, True, True, True, True, 0.8))
    df = spark.createDataFrame([("a", *full), ("b", *[None] * 7)], f"video_id string, {MODALITIES}")
    got = {r.video_id: r for r in fu.fuse(df).collect()}
    assert got["a"].fit_level == "high" and got["a"].fit_score >= 75 and got["a"].strengths[0] == "好"
    assert got["b"].fit_level == "low" and got["b"].fit_score < 55 and len(got["b"].risks) == 7


def test_visual_fit(spark):
    df = spark.createDataFrame(
        [("portrait", 28.0, "high", "high", "balanced", "high", "medium", "stable", "high", ["possible_talking_head"]),
         ("landscape", 6.0, "low", "low", "dark", "low", "low", "dynamic", "low", ["low_exposure_risk"])],
        "orientation string, duration_sec double, resolution_tier string, bitrate_tier string, brightness_level string, contrast_level string, "
        "saturation_level string, visual_rhythm_hint string, subtitle_readability string, visual_tags array<string>",
    )
    assert [r.fit_level for r in vi.visual_fit(df).collect()] == ["high", "low"]


def test_video_fit_prior_and_text(spark):
    df = spark.createDataFrame([(1000, 90, 13, 7), (0, 0, 0, 0)], METRICS)
    a, b = vf.video_fit(df, F.lit(None).cast("bigint")).collect()
    assert a.engagement_score == 100 and a.account_prior_score == 50 and a.volume_score == 65
    assert b.fit_level == "low" and b.consistency_score == 0


def test_script_structure_complete(spark):
    body = "你知道孩子为什么粗心吗。用这个方法，比如这道题，阅读和作文都能提升，记得收藏关注"
    r = ft.script_structure(spark.createDataFrame([(body,)], "t string"), "t").first()
    assert r.structure_completeness_score == 1.0 and r.missing_parts == []


def test_text_metrics(spark):
    body = "连播 1234 249 211 586 举报 发布时间：2026-01-01"
    r = ex.text_metrics(spark.createDataFrame([(body,)], "b string"), "b").first()
    assert (r.matched, r.like_count, r.comment_count, r.share_count) == (True, 1234, 249, 586)


# -- F7 effect model -----------------------------------------------------------------------

def test_effect_score_ignores_runtime(spark):
    cols = ("video_id string, source_name string, title string, view_count bigint, like_count bigint, comment_count bigint, share_count bigint, "
            "engagement_score bigint, trusted_engagement_score bigint, metric_suspicious boolean, "
            + ", ".join(f"{f} double" for f in ef.IDEAL_FEATURES) + ", knowledge_density double")
    a = ("a", "x", "怎么领取资料？", 1, 10, 5, 1, 100, 100, False, 75.0, 0.8, 0.7, 0.8, 0.9, 0.8, 260.0, 1.0, 0.5, 0.5)
    b = ("b", "x", "日常", 1, 1, 0, 0, 10, 10, False, 55.0, 0.4, 0.4, 0.2, 0.5, 0.4, 200.0, 2.0, 0.0, 0.1)
    data = spark.createDataFrame([a, b], cols)
    comments = spark.createDataFrame([("a", ["资料领取"])], "video_id string, topics array<string>")
    ideal = ef.ideal_sources(data)
    profile, weights = ef.train_profile(ideal), ef.train_topics(ideal, comments)
    assert {r.topic: r.weight for r in weights.collect()}["资料领取"] == 6
    seen = ef.effect_scores(data, profile, weights, commented=F.lit(True)).where("video_id = 'a'").first()
    loud = data.withColumns({c: F.lit(999999).cast("bigint") for c in ("like_count", "comment_count", "share_count")})
    again = ef.effect_scores(loud, profile, weights).where("video_id = 'a'").first()
    assert seen.effect_score > 60 and seen.effect_score == again.effect_score and "comments" in seen.ignored_runtime_fields


# -- F8 samples and correlations -----------------------------------------------------------

@pytest.mark.parametrize("n,k,want", [(10, 5, [0, 2, 4, 7, 9]), (3, 1, [0]), (3, 5, [0, 1, 2])])
def test_spread(spark, n, k, want):
    df = spark.range(n).select(F.lit("a").alias("acc"), F.col("id"))
    got = sorted(r.sample_index for r in pk.spread_sample(df, ["acc"], [F.col("id").asc()], k).collect())
    assert got == want


def test_correlation_edges(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.0, 5.0)], "x double, y double, c double")
    r = df.agg(ag.correlation("x", "y").alias("r"), ag.correlation("x", "c").alias("flat")).first()
    assert r.r == pytest.approx(1.0) and r.flat == 0.0
    assert df.limit(1).agg(ag.correlation("x", "y").alias("r")).first().r == 0.0


# -- F9 progress ---------------------------------------------------------------------------

def test_progress_and_name_fallback(spark):
    from clipwell.operators.joins import fallback_lookup

    seeds = spark.createDataFrame([("A",), ("B????",), ("C",)], "source_name string")
    counts = spark.createDataFrame([("A", 2), ("B", 1)], "source_name string, downloaded bigint")
    got = ag.progress_rows(fallback_lookup(seeds, counts, "source_name", "downloaded"), 2)
    total = ag.progress_totals(got, 2).first()
    assert (total.completed_accounts, total.downloaded_videos, total.target_videos) == (1, 3, 6)


# -- expressions ---------------------------------------------------------------------------

def test_expressions(spark):
    df = spark.createDataFrame([("　1,234万 ", "2.5w", "a_99/video/1234567890?x", "&lt;b&gt;​  &amp;lt;")], "a string, b string, c string, d string")
    r = df.select(
        nm.page_count("a").alias("a"), nm.comment_count_text("b").alias("b"), tx.path_digits_id("c").alias("c"), tx.longest_digit_run("c").alias("l"),
        tx.clean_comment("d").alias("d"), nm.score100(F.lit(None).cast("double")).alias("n"), tx.sentiment(F.lit("谢谢，太难")).alias("s"),
        tx.topics(F.lit("KET 资料")).alias("t"),
    ).first()
    assert (r.a, r.b, r.c, r.l, r.d, r.n) == (12340000, 25000, "1234567890", "1234567890", "<b> &lt;", None)
    assert r.s == "质疑/负向" and r.t == ["资料领取", "考试报考"]


def test_mojibake_repair(spark):
    broken = "知识".encode("gbk").decode("latin1")
    df = spark.createDataFrame([(broken,), ("café",), ("plain",), (None,)], "t string")
    assert [r.t for r in df.select(tx.repaired_text("t").alias("t")).collect()] == ["知识", "café", "plain", None]


def test_noise_and_real_comments(spark):
    df = spark.createDataFrame([(f"x{lx.COMMENT_NOISE[2]}", "", "", "n", True), ("ok", "https://h/AWEME/v1/web/comment/list/?a", "", "", True)],
                               "text string, url string, aid string, nick string, stub boolean")
    r = df.select(tx.is_noise("text").alias("noise"), fl.real_comment(F.col("url"), F.col("aid"), F.col("nick"), F.col("stub")).alias("real")).collect()
    assert [(x.noise, x.real) for x in r] == [(True, False), (False, True)]


def test_body_comment_patterns(spark):
    block = "首页 全部评论\n小明\n这个方法真好\n3天前·上海\n12\n分享\n回复\n展开2条回复\n推荐视频"
    lines = "全部评论\n小红\n作者\n真的有用吗\n置顶\n昨天 12:30·北京\n1.2万\n分享\n回复"
    got = {r.k: r for r in ex.body_comment_rows(
        spark.createDataFrame([("b", block), ("l", lines)], "k string, body string"), ["k"], "body").collect()}
    assert (got["b"].author_name, got["b"].like_count, got["b"].reply_count, got["b"].source) == ("小明", 12, 2, "body_text_block")
    assert (got["l"].author_name, got["l"].content, got["l"].like_count, got["l"].source) == ("小红", "真的有用吗", 12000, "body_text_lines")


# -- invariants ------------------------------------------------------------------------------

@pytest.mark.parametrize("parts", [1, 7])
def test_global_order_does_not_depend_on_partitions(spark, parts):
    df = spark.range(1000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") * 37 % 101).alias("v")).repartition(parts)
    pairs = [(i, 0 if i % 3 == 0 else i * 37 % 101) for i in range(1000)]
    ranked = {r.id: r.n for r in od.with_row_number(df, [F.col("v").desc(), F.col("id").asc()], "n").collect()}
    want = {i: n for n, (i, _v) in enumerate(sorted(pairs, key=lambda p: (-p[1], p[0])), 1)}
    assert ranked == want
    top = {r.id for r in pk.top_fraction(df, "v", "id", 0.8).where("in_top").collect()}
    assert top == {i for i, n in want.items() if n <= 800}
    low = {r.id for r in pk.top_fraction(df, "v", "id", 0.1, descending=False).where("in_top").collect()}
    assert low == {i for i, _v in sorted(pairs, key=lambda p: (p[1], p[0]))[:100]}
    assert od.medians(df, "v").first().median == statistics.median(v for _i, v in pairs)
    prev = {r.id: r.prev_id for r in od.with_previous(df, ["v"], ["id"], ["id"]).collect()}
    last, expect = {}, {}
    for i, v in sorted(pairs, key=lambda p: (p[1], p[0])):
        expect[i], last[v] = last.get(v), i
    assert prev == expect


def test_streamed_comments_equal_batch_and_survive_replays(spark, tmp_path):
    schema = (
        "video_key bigint, platform_id string, user_id string, nickname string, content string, like_count bigint, commented_at timestamp, unique_hash string"
    )
    day = "2026-01-01 00:0"
    first = [(1, "p1", "u", "n", "old", 1, f"{day}0:00", None), (1, None, "u", "n", "no id", 1, f"{day}0:01", None)]
    second = [(1, "p1", "u", "n", "old", 1, f"{day}0:00", None), (2, "p1", "u", "n", "other video", 3, f"{day}1:00", None)]
    for i, part in enumerate((first, second)):
        df = spark.createDataFrame([(*p[:6], None, p[7]) for p in part], schema)
        times = spark.createDataFrame([(p[4], p[6]) for p in part], "content string, at string")
        df.drop("commented_at").join(times, "content").withColumn("commented_at", F.col("at").cast("timestamp")).drop("at").coalesce(1).write.mode(
            "append").json(str(tmp_path / "in"))
        del i
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    work = str(tmp_path / "work")
    table = runs.comment_stream(stream, work)
    want = {(1, "p1", "old"), (1, None, "no id"), (2, "p1", "other video")}
    assert {(r.video_key, r.platform_id, r.content) for r in table.collect()} == want
    again = runs.comment_stream(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in")), work)
    assert {(r.video_key, r.platform_id, r.content) for r in again.collect()} == want


def test_upsert_is_idempotent(spark):
    cur = spark.createDataFrame([("u1", "p", "old", "c", None, None, "paused", None)], runs.TARGET_SCHEMA)
    bat = spark.createDataFrame([("u1", " ", 1), ("u1", "new", 2), ("u1", "", 3), ("u2", "x", 1)], "homepage_url string, source_name string, seq int")
    one = up.upsert_targets(cur, bat, "seq")
    assert {r.homepage_url: (r.source_name, r.category_lv1, r.status, r.change) for r in one.collect()} == {
        "u1": ("new", "c", "paused", "updated"), "u2": ("x", None, "active", "created")}
    two = up.upsert_targets(one.drop("change"), bat, "seq")
    assert two.drop("change").exceptAll(one.drop("change")).isEmpty()
    assert up.change_counts(two).first().created == 0
    blank = up.upsert_targets(cur, bat.where("seq = 3"), "seq", blank_overwrites=True).first()
    assert blank.source_name is None


def test_absent_fields_stay_and_blank_ones_erase(spark):
    schema = "row_id string, video_key long, platform_id string, user_id string, nickname string, content string, like_count long, commented_at timestamp, unique_hash string"
    stored = spark.createDataFrame([("r1", 1, "p1", "u", "nick", "old", 5, datetime.datetime(2026, 1, 1), "h")], schema)
    batch = spark.createDataFrame([(None, 1, "p1", None, "", None, None, None, None, 1)], schema + ", seq int").drop("row_id")
    got = up.upsert_comments(stored, batch, "seq").first()
    assert (got.user_id, got.nickname, got.content, got.like_count, got.commented_at) == ("u", "", "old", 5, datetime.datetime(2026, 1, 1))


def test_iso_text_is_utc_in_any_zone(spark):
    own = spark.newSession()
    own.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    df = own.sql("SELECT timestamp_micros(1767225600000000) AS a, timestamp_micros(1767225600000123) AS b, CAST(NULL AS timestamp) AS c")
    got = df.select(*[co.iso_text(F.col(c)).alias(c) for c in "abc"]).first()
    assert tuple(got) == ("2026-01-01T00:00:00+00:00", "2026-01-01T00:00:00.000123+00:00", "")


def test_repeated_ids_multiply_nothing(spark):
    left = spark.createDataFrame([(1,), (2,)], "video_id int")
    twice = spark.createDataFrame([(1, 5), (1, 7), (2, 3)], "video_id int, n int")
    once = lambda df: df.count() == 2
    assert once(jn.star(left, [twice])) and once(jn.assemble([left, twice], "video_id", {"n": 0}))
    assert once(jn.with_metrics(left, twice, twice.where("false"))) and once(jn.merge_keeping(left, twice, "video_id", [], ["n"]))
    results = spark.createDataFrame([(1, True, 5), (1, True, 6)], "video_id int, ok boolean, m int")
    assert once(up.merge_modality(left, results, "m"))


def test_configured_values_survive(tmp_path):
    """A submitted master, partition count and checkpoint folder are not replaced."""
    code = (
        "from clipwell.session import spark_session; s = spark_session(); "
        "print('GOT', s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'), s.conf.get('spark.checkpoint.dir'))"
    )
    args = f"--master local[2] --conf spark.sql.shuffle.partitions=77 --conf spark.checkpoint.dir={tmp_path} pyspark-shell"
    env = {**os.environ, "PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": os.getcwd()}
    env.pop("SPARK_CONF_DIR", None)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, env=env, timeout=120)
    assert f"GOT local[2] 77 {tmp_path}" in out.stdout, out.stdout + out.stderr


def test_entities_as_the_standard_decodes_them(spark):
    texts = ["&#20013;&#x4e2d;&eacute;&hellip;&#8230;", "a &amp;lt; b & c &unknown; d", "&lt;&gt;&quot;&#39;&apos;&nbsp;|", "&#150;&#x80;", "&#0;&#xD800;", "no", "&copy 1 &amp", ""]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = [r.u for r in df.select("i", tx.unescaped(F.col("t")).alias("u")).orderBy("i").collect()]
    assert got == [html.unescape(t) for t in texts]


def test_payload_comments_at_any_depth_and_number(spark):
    def nested(depth, text):
        node = {"content": text}
        for _ in range(depth):
            node = {"inner": [node]}
        return node

    body = json.dumps({"content": "top text", "many": [{"content": f"comment number {i}"} for i in range(30)], "deep": [nested(d, f"at depth {d}") for d in (3, 6, 12, 20)]})
    got = ex.payload_comments(spark.createDataFrame([(1, body), (2, "{}")], "k int, body string"), "k", "body").collect()
    assert {r.content for r in got} == {"top text", *[f"comment number {i}" for i in range(30)], *[f"at depth {d}" for d in (3, 6, 12, 20)]}
    few = ex.payload_comments(spark.createDataFrame([(1, body)], "k int, body string"), "k", "body", depth=3)
    assert "at depth 3" not in {r.content for r in few.collect()} and few.count() >= 31
    assert ex.payload_comments(spark.createDataFrame([(1, body)], "k int, body string"), "k", "body", cap=5).count() == 5


def test_open_comment_sections_are_read_whole(spark):
    m = ex.CommentMarkers()
    block = "\n".join(f"author{i}\nsome words number {i} here\n3天前·上海\n12\n{m.share}\n{m.reply}" for i in range(300))
    df = spark.createDataFrame([(1, f"x {m.start}\n{block}")], "k int, body string")
    assert ex.body_comment_rows(df, ["k"], "body").count() == 300
    assert ex.body_comment_rows(df, ["k"], "body", cap=20).count() == 20


def test_long_reasons_and_names_stay_apart(spark):
    long = "r" * 200
    df = spark.createDataFrame([(long + "a",), (long + "b",)], "t string")
    assert df.select(ag.clean_reason(F.col("t")).alias("x")).distinct().count() == 2
    slugs = [r.x for r in df.select(tx.slug("t").alias("x")).collect()]
    assert len(set(slugs)) == 2 and all(len(s) == 80 for s in slugs)


def test_comment_lines_of_long_pages(spark):
    """Line patterns with runs of controls of any length and repeated texts; texts too long for a block."""
    m = ex.CommentMarkers()
    tail = "\n".join([*[m.share, m.reply] * 20, "展开3条回复"])
    lines = "\n".join(f"author{i}\nwords of number {i % 500} {'x' * 230}\n3天前\n12\n{tail}" for i in range(2000))
    df = spark.createDataFrame([(1, f"x {m.start}\n{lines}")], "k int, body string")
    found = ex.body_comment_rows(df, ["k"], "body").groupBy("source").agg(F.count("*").alias("n"), F.min("reply_count").alias("r")).collect()
    assert [(r.source, r.n, r.r) for r in found] == [("body_text_lines", 500, 3)]


# -- artifacts that point to artifacts, authors at any depth -------------------------------

def test_linked_artifacts_end_cycles_and_skip_missing_files(spark, tmp_path):
    from clipwell.sources import files as fs

    video = lambda u: {"video_url": u, "video_id": u, "title": "t"}
    point = lambda *names: [{"artifact_path": f"{tmp_path}/{n}.json"} for n in names]
    files = {
        "a b+": {"source_name": "A", "videos": [video("1")], "chunks": [*point("gone", "two", "three"), {"artifact_path": " ", "results": []}]},
        "two": {"source_name": "B", "videos": [video("1"), video("2")], "chunks": point("four", "a b+")},
        "three": {"source_name": "C", "videos": [video("2"), video("3")], "chunks": point("four")},
        "four": {"source_name": "D", "videos": [video("3"), video("4")], "chunks": point("two")},
        "other": {"source_name": "E", "videos": [video("5")], "chunks": point("four")},
    }
    for name, body in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    d = fs.read_artifacts(spark, str(tmp_path), fs.ARTIFACT_SCHEMA)
    linked = fs.linked_artifacts(d, F.col("file_name").isin("a b+.json", "a%20b+.json"))
    trail = {r.source_name: r.trail for r in linked.collect()}
    assert trail == {"A": [], "B": [1], "C": [2], "D": [1, 0]}
    got = {r.video_url: r.source_name for r in fs.flatten_videos(linked, ("root_path", "trail")).collect()}
    assert got == {"1": "A", "2": "B", "3": "D", "4": "D"}
    both = fs.linked_artifacts(d, F.col("file_name") != "four.json")
    assert both.groupBy("source_name").count().where("source_name = 'D'").first()["count"] == 4
    assert fs.linked_artifacts(d, F.lit(False)).count() == 0


def test_author_name_equals_recursion(spark):
    from clipwell.functions import nodes

    def recursive(n):
        for k in (*nodes.AUTHOR_NAME_KEYS, "author"):
            if isinstance(n.get(k), str) and n[k].strip():
                return n[k].strip()
        return next((x for b in nodes.AUTHOR_NAME_BOXES if isinstance(n.get(b), dict) and (x := recursive(n[b]))), "")

    rng = random.Random(1)

    def node(depth):
        out = {}
        for k in rng.sample([*nodes.AUTHOR_NAME_KEYS, "author", "x"], rng.choice([0, 0, 0, 1, 2])):
            out[k] = rng.choice(["", " ", 5, True, None, ["q"], f"v{rng.randrange(99)}"])
        for b in rng.sample(nodes.AUTHOR_NAME_BOXES, rng.choice([0, 1, 2, 3]) if depth else 0):
            out[b] = node(depth - 1)
        return out

    trees = [node(rng.randint(0, 6)) for _ in range(400)] + [{}]
    deep = {"name": "bottom"}
    for _ in range(40):
        deep = {"owner": deep}
    trees.append(deep)
    df = spark.createDataFrame([(i, json.dumps(x)) for i, x in enumerate(trees)], "i int, j string")
    got = {r.i: r.a for r in df.select("i", nodes.author_name(F.try_parse_json("j")).alias("a")).collect()}
    assert got == {i: recursive(x) for i, x in enumerate(trees)} and len(set(got.values())) > 50


# -- summaries, versions, narrow ranks, waiting replies ------------------------------------

def test_homepage_summary_samples_and_blanks(spark):
    schema = (
        "target struct<source_name: string, platform: string>, crawl_result struct<videos: array<struct<video_id: string, video_url: string>>, "
        "warnings: array<string>, diagnostics: struct<dom_href_count: int>>"
    )
    videos = [{"video_id": None if i == 1 else str(i), "video_url": "" if i == 0 else f"u{i}"} for i in range(7)]
    rows = [({"source_name": " A ", "platform": None}, {"videos": videos, "warnings": ["a", "b", "c", "d"], "diagnostics": {"dom_href_count": 9}}), (None, None)]
    one, two = ag.homepage_summary(spark.createDataFrame(rows, schema)).collect()
    assert (one.source_name, one.video_count, one.sample_video_ids, one.sample_video_urls) == ("A", 7, ["0", "2", "3", "4"], ["u1", "u2"])
    assert (one.warnings_count, one.warnings_preview, one.dom_href_count, one.merged_unique_video_ids) == (4, ["a", "b", "c"], 9, 0)
    assert (two.source_name, two.video_count, two.sample_video_ids, two.warnings_preview) == ("", 0, [], [])


def test_download_and_run_status(spark):
    targets = spark.createDataFrame([("A", 1), ("B", 2), (None, 3)], "source_name string, backfill_priority int")
    names = lambda *x: spark.createDataFrame([(n,) for n in x], "source_name string")
    got = {r.backfill_priority: (r.local_count, r.processed_count, r.needs_refresh) for r in ag.download_status(targets, names(" A", "A ", "B"), names("A", "B")).collect()}
    assert got == {1: (2, 1, True), 2: (1, 1, False), 3: (0, 0, False)}
    chunks = spark.createDataFrame([(0, 5), (1, 4), (None, 3)], "code int, size int")
    row = ag.run_status(chunks, F.col("code") == 0, "size").first()
    assert tuple(row) == (3, 1, 1, 5, 12, False)
    assert tuple(ag.run_status(chunks.limit(0), F.col("code") == 0, "size").first()) == (0, 0, 0, 0, 0, True)


def test_a_failed_refresh_leaves_the_old_tables(spark, tmp_path):
    from clipwell.sources import sinks as sk

    folder = f"file://{tmp_path}/d"
    table = lambda *x: spark.createDataFrame([(v,) for v in x], "v int")
    with pytest.raises(FileNotFoundError):
        sk.read_dataset(spark, folder, "accounts")
    sk.write_dataset({n: table(1) for n in sk.DATASET}, folder)
    fails = table(7).select(F.raise_error(F.lit("lost")).cast("int").alias("v"))
    with pytest.raises(Exception, match="lost"):
        sk.write_dataset({"accounts": table(2), "videos": table(2), "video_metrics": fails, "comments": table(2)}, folder)
    assert [sk.read_dataset(spark, folder, n).first().v for n in sk.DATASET] == [1] * 4
    # a version is read while it is replaced, and made from itself
    sk.write_dataset({n: sk.read_dataset(spark, folder, n).select((F.col("v") + 2).alias("v")) for n in sk.DATASET}, folder)
    assert [sk.read_dataset(spark, folder, n).first().v for n in sk.DATASET] == [3] * 4


def test_ranks_store_keys_only(spark):
    df = spark.range(40).select("id", (F.col("id") % 3).alias("k"), F.repeat(F.lit("x"), 1000).alias("wide"))
    narrow = od.row_numbers(df, [F.desc("id")], ["id"], "n")
    assert narrow.columns == ["id", "n"] and {r.id: r.n for r in narrow.collect()} == {i: 40 - i for i in range(40)}
    one, two = (pk.numbered_per_key(df, ["k"], [F.asc("id")], "pos", "size", row=r).select("id", "pos", "size", "wide") for r in (None, ["id"]))
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, two.collect()))


def test_replies_wait_for_their_parents_in_any_order(spark, tmp_path):
    from clipwell.streaming import runs

    schema = (
        "homepage_url string, source_name string, ok boolean, error string, seen_at timestamp, video_id string, video_url string, title string, "
        f"metrics struct<view_count: string>, comment struct<{runs.COMMENT_SCHEMA.removeprefix('row_id string, ')}>, reply struct<{runs.REPLY_SCHEMA.removesuffix(', seen_at timestamp')}>"
    )
    at = lambda d: datetime.datetime(2024, 1, d)
    comment = lambda pid: (1, pid, None, None, "c" + pid, 0, at(1), None)
    reply = lambda pid, text, *keys: (1, list(keys), pid, None, None, text, None, at(2), None)
    item = lambda day, c, r: ("h", "n", True, None, at(day), "1", "u/1", "t", ("3",), c, r)
    items = [
        item(1, None, reply("q1", "first", "p1")), item(2, None, reply("q1", "second", "none", "p1")), item(3, None, reply("q2", "lost", "none")),
        item(4, comment("p1"), None), item(5, comment("p2"), reply("q3", "same", "p2")), item(6, None, reply("q1", None, "p1")), item(7, None, reply("q4", "late", "p3")),
    ]
    tables = []
    parts = [items[:3], items[3:5], items[5:]]
    for name, order in (("forth", parts), ("back", parts[::-1]), ("once", [items])):
        arriving, work = f"{tmp_path}/{name}/in", f"{tmp_path}/{name}/work"
        for i, x in enumerate(order):
            spark.createDataFrame(x, schema).write.parquet(f"{arriving}/{i}")
            counts = runs.persist_stream(runs.stateful_session(spark, 2).readStream.schema(schema).parquet(f"{arriving}/*"), work)
        told = {r.part: r.created for r in counts.collect()}
        assert (told["comments"], told["replies"], told["unresolved"], told["snapshots"]) == (2, 2, 2, 7)
        tables.append(sorted((r.platform_id, r.content) for r in runs.persisted(spark, work, "replies").collect()))
        assert sorted(r.platform_id for r in runs.unresolved(spark, work).collect()) == ["q2", "q4"]
    assert tables == [[("q1", "second"), ("q3", "same")]] * 3


def test_compacted_epochs_give_the_same_table_and_bounded_reads(spark, tmp_path):
    own = spark.newSession()
    own.conf.set("spark.sql.adaptive.enabled", "false")
    own.conf.set("spark.sql.shuffle.partitions", "2")
    schema, path = StructType.fromDDL("row_id string, video_key bigint, url string, content string"), str(tmp_path / "table")

    def read_bytes(df):
        leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
        sizes = [leaves.apply(i).metrics().get("filesSize") for i in range(leaves.size())]
        return sum(x.get().value() for x in sizes if x.isDefined())

    state, read = {}, []
    for epoch in range(50):
        if epoch % 5 == 0 and epoch:
            runs.compact(own, path, schema, "row_id", ["video_key", "url"], epoch, rows_per_bucket=4)
        rows = [(f"r{epoch}-{i}", epoch // 2, f"u{epoch}-{i}", f"c{epoch}" * 50) for i in range(4)]
        if epoch > 3:
            rows.append((f"r{epoch - 3}-1", (epoch - 3) // 2, f"moved{epoch}", "again"))
        runs.write_epoch(own.createDataFrame(rows, schema), path, epoch)
        state |= {r[0]: r for r in rows}
        if epoch % 5 == 2:
            # keys of another width than the table's
            by_key, by_url = own.createDataFrame([(epoch // 4,)], "video_key int"), own.createDataFrame([(f"u{epoch // 3}-2",)], "url string")
            got = runs.stored_rows(own, path, schema, "row_id", epoch + 1, (by_key, "video_key"), (by_url, "url"))
            want = {r for r in state.values() if r[1] == epoch // 4 or r[2] == f"u{epoch // 3}-2"}
            assert {tuple(r) for r in got.collect()} == want
            read.append(read_bytes(got))
    assert max(read[5:]) <= 2 * max(read[1:5])
    table = lambda: {tuple(r) for r in runs.latest(runs.read_images(own, path, schema), ["row_id"]).collect()}
    assert table() == set(state.values()) and runs.folded_upto(own, path) == 44
    runs.remove_folded(own, path)
    assert table() == set(state.values())
    left = sorted(x.name for x in (tmp_path / "table").iterdir() if x.name.startswith("epoch="))
    assert left == [f"epoch={n}" for n in range(45, 50)]
    with pytest.raises(ValueError):
        runs.read_images(own, path, schema, 44)


def test_a_failed_compaction_leaves_the_table(spark, tmp_path, monkeypatch):
    schema, path = StructType.fromDDL("row_id string, v bigint"), str(tmp_path / "table")
    for epoch in range(3):
        runs.write_epoch(spark.createDataFrame([("a", epoch), (f"b{epoch}", 0)], schema), path, epoch)
    seen = lambda: {tuple(r) for r in runs.latest(runs.read_images(spark, path, schema), ["row_id"]).collect()}
    before = seen()

    def broken(*_):
        raise OSError("no pointer")

    monkeypatch.setattr(runs, "switch_version", broken)
    with pytest.raises(OSError):
        runs.compact(spark, path, schema, "row_id", ["row_id"], 2)
    assert seen() == before == {("a", 2), ("b0", 0), ("b1", 0), ("b2", 0)} and runs.folded_upto(spark, path) == -1
    monkeypatch.undo()
    runs.compact(spark, path, schema, "row_id", ["row_id"], 2)
    assert seen() == before and runs.folded_upto(spark, path) == 1


def test_streams_that_compact_give_the_same_tables(spark, tmp_path):
    schema = StructType.fromDDL(runs.COMMENT_SCHEMA.removeprefix("row_id string, "))
    at = datetime.datetime(2026, 1, 1)
    for i in range(7):
        rows = [(v, f"p{v}-{i % 3}", "u", "n", f"text {i}", i, at + datetime.timedelta(minutes=i), None) for v in range(i, i + 3)]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
    tables = []
    for every in (None, 2):
        stream = runs.stateful_session(spark, 2).readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
        work = str(tmp_path / f"work{every}")
        table = runs.comment_stream(stream, work, compact_every=every)
        tables.append(sorted(map(tuple, table.drop("commented_at").collect()), key=repr))
        assert (runs.folded_upto(spark, f"{work}/comments") >= 3) == bool(every)
    assert tables[0] == tables[1] and len(tables[0]) > 10


#: A title cut inside an entity, as the crawl leaves it, and whole entities beside it.
CUT = '<html><title>a &amp;&copy; b&am</title><div class="ad">x &lt;y&gt; &amp</div><article><h1>cut &amp;&amp;&amp</h1> &quot &#39 z</article></html>'


def as_its_sql(spark, tmp_path, name):
    """A query over the cut page alone gives the rows of its SQL."""
    spark.createDataFrame([(1, "u", CUT), (2, "u", "<h1>no entity</h1>")], "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    ok, got, want, note = compare(spark, con, str(tmp_path), load().QUERIES[name], load().ORACLES[name])
    assert ok and got, f"{got} rows against {want}: {note}"


def test_cut_entities_in_html_comments(spark, tmp_path):
    as_its_sql(spark, tmp_path, "ext8_html_comments")


def test_cut_entities_in_clean_comment(spark, tmp_path):
    as_its_sql(spark, tmp_path, "str4_clean_comment")


def test_cut_entities_in_visible_text(spark, tmp_path):
    as_its_sql(spark, tmp_path, "str5_visible_text")


def test_a_batch_computes_its_stored_rows_once(spark, tmp_path, monkeypatch):
    row = ["'u' || (id % 3) as homepage_url", "cast(null as string) as source_name", "true as ok", "cast(null as string) as error", "timestamp'2024-01-01' as seen_at"]
    comment = "named_struct('video_key', id, 'platform_id', 'p' || id, 'user_id', cast(null as string), 'nickname', cast(null as string), 'content', 'c', 'like_count', 0L, 'commented_at', timestamp'2024-01-01', 'unique_hash', cast(null as string)) as comment"
    row += ["cast(id as string) as video_id", "'u' || (id % 3) || '/video/' || id as video_url", "'t' as title", "named_struct('view_count', '1') as metrics", comment]
    passed, found = spark.sparkContext.accumulator(0), []

    def counted(*a, stored_rows=runs.stored_rows):
        out = stored_rows(*a)
        found.append(out.count())

        def each(parts):
            for p in parts:
                passed.add(p.num_rows)
                yield p

        return out.mapInArrow(each, out.schema)

    monkeypatch.setattr(runs, "stored_rows", counted)
    work = str(tmp_path / "work")
    for i in range(2):
        spark.range(30).selectExpr(*row).write.parquet(f"{tmp_path}/in/{i}")
        stream = runs.stateful_session(spark, 2).readStream.schema(spark.range(0).selectExpr(*row).schema).parquet(f"{tmp_path}/in/*")
        told = {r.part: (r.created, r.updated) for r in runs.persist_stream(stream, work).collect()}
    assert told["videos"] == told["comments"] == (30, 30) and told["targets"] == (3, 3)
    assert sorted(found) == [0, 0, 0, 3, 30, 30] and passed.value == sum(found)
