"""Robust engagement scoring of posts and accounts, with keywords."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwell.functions.numbers import bounded, rounded
from clipwell.functions.text import token_rows
from clipwell.operators.aggregates import robust_scales
from clipwell.operators.picking import head_and_tail, top_per_key

# Weights of the robust z-scores.
WEIGHTS = {"view_count": 0.20, "like_count": 0.40, "comment_count": 0.25, "share_count": 0.15}


def engagement_proxy():
    return F.col("like_count") + 3 * F.col("comment_count") + 2 * F.col("share_count")


def robust_engagement(
    posts: DataFrame, key: str, weights: Mapping[str, float] = WEIGHTS, name: str = "engagement_score"
) -> DataFrame:
    """50 plus weighted z-scores clamped to +-4, times 8, clamped to 0-100 (2 digits).

    The four medians and scales form one map value that is read as a scalar.
    """
    scales = robust_scales(posts, key, list(weights))
    packed = F.map_from_entries(F.collect_list(F.struct("metric", F.struct("median", "scale"))))
    params = scales.agg(packed.alias("params")).scalar()
    out = posts.withColumn("__p", params)
    score = F.lit(50.0)
    for metric, weight in weights.items():
        p = F.col("__p")[metric]
        z = (F.coalesce(F.col(metric), F.lit(0)) - F.coalesce(p["median"], F.lit(0.0))) / F.coalesce(p["scale"], F.lit(1.0))
        score = score + bounded(z, -4.0, 4.0) * weight * 8.0
    return out.withColumn(name, F.bround(bounded(score, 0.0, 100.0), 2)).drop("__p")


def account_scores(posts: DataFrame, account: str, score: str) -> DataFrame:
    return posts.groupBy(account).agg(
        F.count(F.lit(1)).alias("video_count"), rounded(F.avg(score), 2).alias("engagement_score")
    )


def best_and_weakest(posts: DataFrame, account: str, score: str, n: int, views: str = "view_count", key: str = "video_id") -> DataFrame:
    order = [F.col(score).desc(), F.col(views).desc(), F.col(key).asc()]
    reverse = [F.col(score).asc(), F.col(views).asc(), F.col(key).desc()]
    return head_and_tail(posts, [account], order, reverse, n)


def keywords(focus: DataFrame, everything: DataFrame | None, keys: Sequence[str], body: str, k: int) -> DataFrame:
    """Top k keywords per key by (weight, count, keyword); weight = focus count / overall count (2 digits).

    Tokens are counted per task before the shuffle. ``everything=None`` means
    the focus rows are all rows, so every weight is 1.
    """
    def counted(df: DataFrame, name: str) -> DataFrame:
        return token_rows(df, keys, body, name="keyword").groupBy(*keys, "keyword").agg(F.count(F.lit(1)).alias(name))

    hits = counted(focus, "count")
    if everything is None:
        weighed = hits.withColumn("weight", F.lit(1.0))
    else:
        weighed = hits.join(counted(everything, "__all"), [*keys, "keyword"], "left").withColumn(
            "weight", F.bround(F.col("count") / F.greatest(F.lit(1), F.coalesce("__all", F.lit(0))), 2)
        ).drop("__all")
    order = [F.col("weight").desc(), F.col("count").desc(), F.col("keyword").asc()]
    return top_per_key(weighed, keys, order, k)


def account_comments(comments: DataFrame, videos: DataFrame, account: str = "account_id", video: str = "video_id") -> DataFrame:
    """Comments of an account: its own rows where it has any, else the comments of its posts."""
    direct = comments.where(F.coalesce(F.trim(account), F.lit("")) != "")
    owners = direct.select(account).distinct()
    through = comments.drop(account).join(videos.select(video, account), video).join(owners, account, "left_anti")
    return direct.unionByName(through, allowMissingColumns=True)
