"""Whole report rounds: the tables of a report from the same few inputs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions import lexicons as lx
from clipwell.functions import messages as ms
from clipwell.functions.text import TITLE_FLAGS, topics
from clipwell.operators import aggregates as ag
from clipwell.plans import accounts as ac
from clipwell.plans import engagement as en
from clipwell.plans import reports as rp
from clipwell.plans import video_fit as vf

PROFILE = ("has_grade", "has_method", "has_material", "has_parent_child", "has_interaction", "has_subject", "has_persona")


def first_round(
    rows: DataFrame, comments: DataFrame, titles: Mapping[str, Column], *, account: str = "account_id", key: str = "video_id",
    suspicious: Column | None = None, buckets: Mapping[str, Sequence[str]] = lx.COMMENT_BUCKETS, body: str = "text",
) -> dict[str, DataFrame]:
    """Sample summary, factor lifts for two metrics, top lists, account medians with advice, comment buckets.

    ``rows`` are posts with counters and ``collected_comment_count``; ``titles``
    are the columns of ``text.title_features``.
    """
    odd = (F.col("comment_count") >= 100_000) if suspicious is None else suspicious
    full = rows.withColumns({**titles, "engagement_score": en.engagement_proxy(), "metric_suspicious": odd})
    kept = full.where(~F.col("metric_suspicious"))
    metrics = ("engagement_score", "comment_count", "like_count", "share_count")
    profiles = ag.head_tail_profiles(kept, account, "engagement_score", key, PROFILE)
    return {
        "summary": ag.sample_summary(full, account),
        "play_factors": ag.feature_lifts(kept, "engagement_score", TITLE_FLAGS),
        "comment_factors": ag.feature_lifts(kept, "comment_count", TITLE_FLAGS),
        "top_posts": rp.top_lists(kept, key, {"engagement_score": 12, "comment_count": 12, "share_count": 12}),
        "accounts": ag.account_medians(kept, account, key, metrics).join(
            rp.improvement_points(profiles, account, ms.TIPS_TITLES), account
        ),
        "comment_topics": ag.topic_counts(comments.withColumn("__b", topics(F.col(body), buckets, None)), "__b"),
    }


def weekly(accounts: DataFrame, posts: DataFrame, account: str = "account_id") -> dict[str, DataFrame]:
    """Overall row, ranked accounts, recommendations and the fit summary of a crawl batch."""
    scored = ac.account_scores(accounts, account)
    totals = accounts.agg(*[
        F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(n)
        for c, n in (("videos_seen", "video_total"), ("detail_success", "detail_success_count"),
                     ("comments_success", "comment_success_count"), ("failed_count", "failed_count"))
    ])
    fit = vf.with_account_prior(posts, scored, account)
    return {
        "global": rp.weekly_global(scored, totals),
        "accounts": ac.ranked_accounts(scored, account),
        "top_accounts": ac.top_accounts(scored, account),
        "recommendations": ac.ordered_recommendations(scored, account),
        "fit_summary": fit.agg(*ag.level_distribution("fit_score", "fit_level")),
    }
