"""Row predicates and first-failing-reason classification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions import lexicons as lx
from clipwell.functions.coerce import col, text
from clipwell.functions.text import has_any

# Reasons in the order in which they are tested.
POOL_REASONS = (
    "invalid_video_id", "quality_report_filtered", "missing_required_assets",
    "not_homepage_observed", "detail_account_not_mentioned",
)
METRICS = ("view_count", "like_count", "comment_count", "share_count")


def first_reason(tests: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first failing test, '' when the row passes all of them."""
    expr = None
    for name, failed in tests:
        expr = F.when(failed, F.lit(name)) if expr is None else expr.when(failed, F.lit(name))
    return expr.otherwise(F.lit(""))


def reason_counts(df: DataFrame, reason: str, known: Sequence[str] = POOL_REASONS) -> DataFrame:
    """Histogram over the known reasons, zero where none occurred. One row per reason."""
    tally = df.agg(*[F.count_if(F.col(reason) == r).cast("bigint").alias(r) for r in known])
    pairs = F.explode(F.map_from_arrays(F.array(*[F.lit(r) for r in known]), F.array(*[F.col(f"`{r}`") for r in known])))
    return tally.select(pairs.alias(reason, "n"))


def has_assets(*paths: str) -> Column:
    out = F.lit(True)
    for p in paths:
        out = out & (text(p) != "")
    return out


def real_comment(response_url: Column, author_id: Column, author_name: Column, stub: Column) -> Column:
    """Served by the comment interface, or with a known author and no stub mark."""
    return (
        has_any(F.lower(text(response_url)), lx.COMMENT_RESPONSES)
        | (text(author_id) != "")
        | ((text(author_name) != "") & ~F.coalesce(stub, F.lit(False)))
    )


def anomaly_types(metrics: Sequence[str] = METRICS, huge: int = 1_000_000_000) -> Column:
    """Labels of implausible counters: all equal and not zero, negative, huge."""
    cols = [F.coalesce(col(m), F.lit(0)) for m in metrics]
    first = cols[0]
    equal = first != 0
    negative, large = F.lit(False), F.lit(False)
    for c in cols:
        equal, negative, large = equal & (c == first), negative | (c < 0), large | (c > huge)
    labels = [(equal, "all_equal_non_zero"), (negative, "negative_value"), (large, "huge_value")]
    return F.array_compact(F.array(*[F.when(cond, F.lit(label)) for cond, label in labels]))


def equal_counters(metrics: Sequence[str] = METRICS) -> Column:
    first = col(metrics[0])
    out = first > 0
    for m in metrics[1:]:
        out = out & (col(m) == first)
    return out


def comment_scale_suspicious(comment: str = "comment_count", limit: int = 100_000) -> Column:
    return col(comment) >= limit


# Fixed value: reason text of the share rule.
SHARE_REASON = "低赞低评高转发"


def with_trust(df: DataFrame, many_shares: int = 1000, few_likes: int = 1000, few_comments: int = 50) -> DataFrame:
    """Share rule: many shares with few likes and comments are not trusted."""
    odd = (F.col("share_count") > many_shares) & (F.col("like_count") < few_likes) & (F.col("comment_count") < few_comments)
    return (
        df.withColumn("metric_suspicious", F.coalesce(odd, F.lit(False)))
        .withColumn("suspicious_reason", F.when(F.col("metric_suspicious"), F.lit(SHARE_REASON)).otherwise(""))
        .withColumn(
            "trusted_engagement_score",
            F.when(F.col("metric_suspicious"), F.lit(0)).otherwise(F.coalesce(F.col("engagement_score"), F.lit(0))),
        )
    )


def meaningful_detail(metrics: Sequence[Column], text_matched: Column, backend: Column, live: str = "playwright:") -> Column:
    """A positive counter, a matched text block, or a live backend."""
    out = F.coalesce(text_matched, F.lit(False)) | text(backend).startswith(live)
    for m in metrics:
        out = out | F.coalesce(m > 0, F.lit(False))
    return out


# Backends and stop reasons that mean comments were really read.
TEXT_BACKENDS = ("playwright:body_text-v1", "playwright:body_text-v2")
TEXT_STOPS = ("body_text_comments_captured", "body_text_comment_stubs_captured")


def meaningful_comments(n_comments: Column, backend: Column, stop_reason: Column) -> Column:
    return (F.coalesce(n_comments, F.lit(0)) > 0) | text(backend).isin(*TEXT_BACKENDS) | text(stop_reason).isin(*TEXT_STOPS)


def backfill_selection(
    df: DataFrame, has_artifact: Column, expected: Column, order: Sequence[Column],
    only_missing: bool = True, only_expected: bool = True, limit: int | None = None,
) -> DataFrame:
    """Filters first, then the requested number of rows in order."""
    out = df
    if only_missing:
        out = out.where(~has_artifact)
    if only_expected:
        out = out.where(expected)
    return out if limit is None else out.orderBy(*order).limit(limit)


# Endings and codecs.
VIDEO_ENDINGS = (".mp4", ".mov", ".m4v", ".webm", ".mkv")
IMAGE_CODECS = ("png", "mjpeg", "jpg", "jpeg")
IMAGE_FORMATS = ("png_pipe", "image2")


def video_download(status: Column, content_type: Column, path: Column) -> Column:
    ending = F.lower(F.regexp_extract(text(path), r"(\.[^./]+)$", 1))
    return (F.lower(text(status)) == "success") & (
        F.lower(text(content_type)).startswith("video/") | ending.isin(*VIDEO_ENDINGS)
    )


def real_video(ok: Column, duration: Column, width: Column, height: Column, codec: Column, fmt: Column) -> Column:
    c = F.lower(text(codec))
    return (
        F.coalesce(ok, F.lit(False))
        & (F.coalesce(duration, F.lit(0.0)) >= 1.0)
        & (F.coalesce(width, F.lit(0)) > 0)
        & (F.coalesce(height, F.lit(0)) > 0)
        & (c != "")
        & ~c.isin(*IMAGE_CODECS)
        & ~F.lower(text(fmt)).isin(*IMAGE_FORMATS)
    )


def comment_backend(n_comments: Column, any_network: Column, stop_reason: Column) -> Column:
    """Label of the capture way from comment sources and the stop reason."""
    return (
        F.when((n_comments > 0) & any_network, "playwright:network-response-v1")
        .when(n_comments > 0, "playwright:body_text-v2")
        .when(stop_reason == "empty_comment_state", "playwright:empty-state")
        .otherwise("playwright:placeholder")
    )
