"""Data quality, the trusted pool, coverage gaps and collection diagnosis."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions import lexicons as lx
from clipwell.functions.coerce import filled
from clipwell.functions.numbers import count_where, rate
from clipwell.functions.text import bare_name, is_noise, strict_id
from clipwell.operators import filters as fl
from clipwell.operators import joins as jn
from clipwell.operators.picking import one_per_key

# Gap priorities in order.
HIGH, MEDIUM, LOW = "高", "中", "低"
PRIORITIES = (HIGH, MEDIUM, LOW)


# -- quality report -------------------------------------------------------------

def _long(df: DataFrame, section: str) -> DataFrame:
    """One-row aggregate to (section, metric, value) rows."""
    typed = df.select([F.col(c).cast("bigint").alias(c) for c in df.columns])
    return typed.unpivot([], df.columns, "metric", "value").select(F.lit(section).alias("section"), "metric", "value")


def quality_report(details: DataFrame, comments: DataFrame, downloads: DataFrame, key: str = "video_id", id_size: int = 10) -> DataFrame:
    """Counts per source, invalid ids, coverage both ways, metric anomalies and comment states.

    ``details`` carries the four counters; ``comments`` has n_comments,
    has_placeholder and has_empty_state per artifact.
    """
    ok = strict_id(key, id_size)

    def scanned(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.count(F.lit(1)).alias(f"{name}_file_count"),
            F.count_distinct(F.when(ok, F.col(key))).alias(f"{name}_video_count"),
            count_where(~ok).alias(f"{name}_invalid_count"),
        )

    d, z = details.where(ok).select(key).distinct(), downloads.where(ok).select(key).distinct()
    gap = lambda a, b, n: a.join(b, key, "left_anti").agg(F.count(F.lit(1)).alias(n))
    odd = details.where(ok & (F.size(fl.anomaly_types()) > 0)).agg(F.count(F.lit(1)).alias("metric_anomaly_count"))
    states = comments.where(ok).agg(
        count_where(F.col("has_placeholder")).alias("placeholder_count"),
        count_where(F.col("has_empty_state")).alias("empty_comment_state_count"),
        count_where(F.col("n_comments") > 0).alias("non_empty_artifact_count"),
        F.count_distinct(F.when(F.col("n_comments") > 0, F.col(key))).alias("non_empty_video_count"),
    )
    parts = [
        *[_long(scanned(df, n), "scanned") for n, df in (("detail", details), ("comment", comments), ("download", downloads))],
        _long(gap(z, d, "download_without_detail_count"), "coverage"),
        _long(gap(d, z, "detail_without_download_count"), "coverage"),
        _long(odd, "anomalies"), _long(states, "comment_quality"),
    ]
    return reduce(lambda a, b: a.unionByName(b), parts)


# -- trusted pool ---------------------------------------------------------------

def pool_reasons(
    videos: DataFrame, filtered: DataFrame, homepage: DataFrame | None, bodies: DataFrame | None, *, key: str = "video_id",
    account: str = "account_id", assets: Sequence[str] = ("detail_artifact_path", "mp4_path"), id_size: int = 10,
    body_key: str = "detail_artifact_path", body: str = "body",
) -> DataFrame:
    """Each video with the first reason to leave it out, '' when it stays."""
    out = videos.join(filtered.select(key).distinct().withColumn("__bad", F.lit(True)), key, "left")
    out = out.withColumn("__name", bare_name(account))
    seen = told = F.lit(True)
    if homepage is not None:
        index = homepage.select(bare_name(account).alias("__name"), key)
        out, seen = jn.observed(out, index, ["__name", key], "__seen"), F.col("__seen")
    if bodies is not None:
        out, told = jn.mentioned(out, bodies, body_key, account, body, "__told"), F.col("__told")
    reason = fl.first_reason([
        ("invalid_video_id", ~strict_id(key, id_size)),
        ("quality_report_filtered", F.coalesce(F.col("__bad"), F.lit(False))),
        ("missing_required_assets", ~fl.has_assets(*assets)),
        ("not_homepage_observed", ~seen),
        ("detail_account_not_mentioned", ~told),
    ])
    return out.withColumn("reason", reason).drop("__bad", "__name", "__seen", "__told")


def valid_pool(reasons: DataFrame, metrics: DataFrame, comments: DataFrame, key: str = "video_id", body: str = "text",
               noise: Sequence[str] = lx.COMMENT_NOISE) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Kept videos, their metrics and their comments without noise texts."""
    keep = reasons.where(F.col("reason") == "").drop("reason")
    return keep, jn.only_ids(metrics, keep, key), jn.only_ids(comments, keep, key).where(~is_noise(body, noise))


def pool_summary(reasons: DataFrame, metrics: DataFrame, comments: DataFrame) -> DataFrame:
    """Sizes of the pool parts as (section, metric, value) rows, with the reason histogram."""
    size = lambda df, n: _long(df.agg(F.count(F.lit(1)).alias(n)), "pool")
    hist = fl.reason_counts(reasons, "reason").select(F.lit("filtered").alias("section"), F.col("reason").alias("metric"), F.col("n").alias("value"))
    return (
        size(reasons.where("reason = ''"), "valid_video_count")
        .unionByName(size(metrics, "valid_video_metric_count")).unionByName(size(comments, "valid_comment_count")).unionByName(hist)
    )


# -- coverage gaps ----------------------------------------------------------------

def gap_priority(valid: Column, given: Column) -> Column:
    return F.when(given <= 0, LOW).when(valid < 20, HIGH).when(valid < 50, MEDIUM).otherwise(LOW)


def gap_report(videos: DataFrame, valid: DataFrame, account: str = "account_id") -> DataFrame:
    """Input, valid and filtered counts, retention and priority per account."""
    both = jn.two_counts(
        jn.count_by_account(videos, account, "input_video_count"), jn.count_by_account(valid, account, "valid_video_count"),
        account, "input_video_count", "valid_video_count",
    )
    given, kept = F.col("input_video_count"), F.col("valid_video_count")
    return both.withColumns({
        "filtered_video_count": F.greatest(given - kept, F.lit(0)),
        "retention_rate": rate(kept, given, 4),
        "priority": gap_priority(kept, given),
    })


def ordered_gaps(report: DataFrame, account: str = "account_id") -> DataFrame:
    return report.orderBy("retention_rate", F.col("input_video_count").desc(), account)


def backfill_accounts(
    gaps: DataFrame, sources: DataFrame, *, account: str = "account_id", source: str = "source_name", order: Sequence[Column],
    min_priority: str = MEDIUM, min_valid: int = 50, platform: str = "抖音",
) -> DataFrame:
    """Gap accounts to collect again, matched to the target list by bare name (last target per name wins)."""
    rank = lambda c: F.coalesce(F.array_position(F.array(*[F.lit(p) for p in PRIORITIES]), c), F.lit(9))
    wanted = gaps.where((rank(F.col("priority")) <= PRIORITIES.index(min_priority) + 1) | (F.col("valid_video_count") < min_valid))
    named = sources.withColumn("__name", bare_name(source)).where(F.col("__name") != "")
    known = one_per_key(named, ["__name"], order)
    joined = wanted.withColumn("__name", bare_name(account)).join(known, "__name")
    pick = lambda c, d: (filled(c) if c in known.columns else F.lit(None), d)
    context = {c: F.coalesce(*pick(c, F.lit(d))) for c, d in
               (("homepage_url", ""), ("category_lv1", ""), ("category_lv2", ""), ("platform", platform), ("status", "active"))}
    return joined.select(
        F.coalesce(F.col(source), F.col(account)).alias("source_name"), *[v.alias(k) for k, v in context.items()],
        F.col("priority").alias("backfill_priority"), rank(F.col("priority")).cast("bigint").alias("priority_rank"),
        "input_video_count", "valid_video_count", "filtered_video_count", "retention_rate",
    )


# -- comment backfill ---------------------------------------------------------------

def comment_targets(details: DataFrame, status: DataFrame, key: str = "video_id") -> DataFrame:
    """Videos without real comments: expectation class, whether to collect again, priority."""
    j = details.join(status.select(key, "artifact_count", "has_non_empty_comments", "has_observed_no_comment"), key, "left")
    real = F.coalesce("has_non_empty_comments", F.lit(False))
    empty = F.coalesce("has_observed_no_comment", F.lit(False))
    expected = F.col("comment_count") > 0
    return j.where(~real).select(
        *details.columns,
        (expected & ~empty).cast("bigint").alias("priority"),
        F.when(empty, "no_comment_observed").when(expected, "comment_expected").otherwise("no_comment_expected").alias("comment_expected_status"),
        (expected & ~empty).alias("should_backfill_comment"),
        (F.coalesce("artifact_count", F.lit(0)) > 0).alias("has_comment_artifact"),
    )


def ordered_targets(targets: DataFrame, key: str = "video_id", limit: int | None = None) -> DataFrame:
    out = targets.orderBy(F.col("priority").desc(), F.col("comment_count").desc(), key)
    return out if limit is None else out.limit(limit)


# Status and expected status names.
STATUSES = ("real_comment", "empty_response", "noise_only", "missing_artifact")


def diagnose(ids: DataFrame, targets: DataFrame, status: DataFrame, key: str = "video_id") -> DataFrame:
    """Collection status and expected status per video."""
    j = ids.join(targets.select(key, F.col("comment_count").alias("expected_comment_count")), key, "left").join(status, key, "left")
    n = F.coalesce("artifact_count", F.lit(0))
    state = (
        F.when(n == 0, "missing_artifact").when(F.col("real") > 0, "real_comment")
        .when(F.col("comments") == 0, "empty_response").otherwise("noise_only")
    )
    want = F.greatest(F.coalesce("expected_comment_count", F.lit(0)), F.lit(0))
    expected = (
        F.when(state == "real_comment", state)
        .when(F.coalesce("has_observed_no_comment", F.lit(False)), "no_comment_observed")
        .when(want <= 0, "no_comment_expected").otherwise(F.concat(F.lit("comment_expected_"), state))
    )
    return j.select(
        key, state.alias("status"), expected.alias("expected_status"), want.cast("bigint").alias("expected_comment_count"),
        n.alias("artifact_count"), F.coalesce("comments", F.lit(0)).alias("comment_count"), F.coalesce("real", F.lit(0)).alias("real_comment_count"),
    )


def diagnosis_summary(videos: DataFrame) -> DataFrame:
    n, real = F.count(F.lit(1)), F.count_if(F.col("status") == "real_comment")
    exp = F.col("expected_status")
    return videos.agg(
        n.alias("video_count"), real.cast("bigint").alias("real_comment_video_count"), (n - real).alias("failure_video_count"),
        count_where(exp == "no_comment_observed").alias("no_comment_observed_video_count"),
        count_where(exp == "no_comment_expected").alias("no_comment_expected_video_count"),
        count_where(exp.startswith("comment_expected_")).alias("comment_expected_but_uncollected_video_count"),
        rate(real, n, 6).alias("hit_rate"),
    )


def failure_reasons(videos: DataFrame, reasons: DataFrame, key: str = "video_id") -> DataFrame:
    """Reason counts per failed status."""
    failed = videos.where(F.col("status") != "real_comment").select(key, "status")
    per_video = reasons.groupBy(key, "reason").agg(F.count(F.lit(1)).alias("n"))
    return per_video.join(failed, key).groupBy("status", "reason").agg(F.sum("n").cast("bigint").alias("n"))
