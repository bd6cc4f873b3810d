"""Report tables: budgets, top lists, rerun priorities and hints."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions.notes import notes, notes_or
from clipwell.functions.numbers import rounded
from clipwell.operators.aggregates import mean_or_zero, trusted_summary
from clipwell.operators.picking import numbered_per_key
from clipwell.plans.accounts import overall_score

# Reasons of a chunk's rerun priority.
REASON_FAILED = "存在失败目标，建议优先补跑"
REASON_BOTH = "详情与评论都未形成有效样本"
REASON_COMMENT = "评论有效率偏低，建议先补评论链路"
REASON_DETAIL = "详情有效率偏低，建议复查详情页提取"
REASON_STABLE = "当前块较稳定，可低优先级补跑"


def budgets(
    rows: DataFrame, keys: Sequence[str], order: Sequence[Column], videos: int | None, comments: int | None, row: Sequence[str] | None = None
) -> DataFrame:
    """Action per candidate: collected within the target's budget, else the skip reason.

    Every row stays in the result, so positions come from one global sort and
    the target's first number, not from one task per target. With ``row``, columns that name a row, the sort
    and its checkpoint hold only these.
    """
    out = numbered_per_key(rows, keys, order, "__pos", "__n", row)
    pos = F.col("__pos")

    def act(limit: int | None, skipped: str) -> Column:
        return F.lit("collect") if not limit or limit <= 0 else F.when(pos <= limit, "collect").otherwise(skipped)

    return out.withColumns({
        "detail": act(videos, "video_limit_reached"), "comments": act(comments, "comment_video_limit_reached"),
    }).drop("__pos", "__n")


def top_lists(rows: DataFrame, key: str, sizes: Mapping[str, int]) -> DataFrame:
    """Top n rows per metric as one tall table (metric, key, value)."""
    lists = [
        rows.select(F.lit(m).alias("metric"), key, F.col(m).alias("value")).orderBy(F.col("value").desc(), F.col(key).asc()).limit(n)
        for m, n in sizes.items()
    ]
    return reduce(lambda a, b: a.unionByName(b), lists)


def rerun_priorities(chunks: DataFrame, chunk: str, k: int = 10) -> DataFrame:
    d, c, failed = F.col("detail_meaningful_rate"), F.col("comment_meaningful_rate"), F.col("failed_count")
    score = (
        failed * 100
        + F.greatest(F.lit(0.0), 1.0 - d) * 20.0
        + F.greatest(F.lit(0.0), 1.0 - c) * 25.0
        + F.least(F.col("duration_sec") / 60.0, F.lit(20.0))
    )
    reason = (
        F.when(failed > 0, REASON_FAILED)
        .when((d <= 0) & (c <= 0), REASON_BOTH)
        .when(c <= 0, REASON_COMMENT)
        .when(d < 0.5, REASON_DETAIL)
        .otherwise(REASON_STABLE)
    )
    ranked = chunks.withColumns({"priority_score": F.bround(score, 6), "reason": reason})
    return ranked.orderBy(F.col("priority_score").desc(), F.col(chunk).asc()).limit(k)


def rerun_hint(status: Column, videos_seen: Column, detail_meaningful: Column, comment_meaningful: Column) -> Column:
    return (
        F.when((status == "failed") | (videos_seen <= 0), "high")
        .when((detail_meaningful == 0) & (comment_meaningful == 0), "high")
        .when(comment_meaningful == 0, "medium")
        .otherwise("low")
    )




# -- account findings -------------------------------------------------------------

def mean_findings(rows: DataFrame, account: str, tips: Mapping[str, str], speed: bool) -> DataFrame:
    """Means per account and advice where a mean crosses its threshold."""
    fields = ("fit_score", "engagement_score", "ocr_readability", "structure_completeness", "person_count",
              "subtitle_consistency", "face_center_score", "speech_rate_cpm")
    means = rows.groupBy(account).agg(F.count(F.lit(1)).alias("video_count"), *[mean_or_zero(f).alias(f"m_{f}") for f in fields])
    rules = [
        (F.col("m_structure_completeness") < 0.3, tips["structure"]),
        (F.col("m_subtitle_consistency") < 0.5, tips["subtitle"]),
        (F.col("m_person_count") > 1.5, tips["subject"]),
        (F.col("m_face_center_score") < 0.75, tips["face"]),
    ]
    if speed:
        rules.append((F.col("m_speech_rate_cpm") > 340, tips["speed"]))
    digits = {"fit_score": 2, "engagement_score": 2, "ocr_readability": 3, "structure_completeness": 3, "person_count": 2}
    return means.select(
        account, "video_count", *[rounded(F.col(f"m_{f}"), d).alias(f"average_{f}") for f, d in digits.items()],
        notes_or(rules, tips["none"]).alias("recommendations"),
    )


def comment_advice(stats: DataFrame, top: DataFrame, structure: DataFrame, account: str, tips: Mapping[str, str], names: Mapping[str, str]) -> DataFrame:
    """Advice per account from its top topics, author replies and mean script structure."""
    topics = top.groupBy(account).agg(F.collect_set("topic").alias("__topics"))
    j = structure.join(stats, account, "left").join(topics, account, "left")
    has = lambda k: F.coalesce(F.array_contains("__topics", names[k]), F.lit(False))
    n, replies = F.coalesce("collected", F.lit(0)), F.coalesce("author_replies", F.lit(0))
    rules = [
        (has("material"), tips["material"]), (has("exam") | has("parent"), tips["exam"]), (has("doubt"), tips["doubt"]),
        ((replies == 0) & (n > 0), tips["reply"]), (F.col("mean_structure") < 0.3, tips["structure"]),
    ]
    return j.select(account, n.alias("comments"), notes_or(rules, tips["none"]).alias("advice"))


def trusted_accounts(rows: DataFrame, account: str, tips: Mapping[str, str]) -> DataFrame:
    """All posts against trusted posts per account."""
    counts = rows.groupBy(account).agg(*trusted_summary(rows, account)).drop("account_count")
    advice = mean_findings(rows, account, tips, speed=False).select(
        account, "average_structure_completeness", "average_person_count", "recommendations"
    )
    return counts.join(advice, account)


def improvement_points(profiles: DataFrame, account: str, tips: Mapping[str, str], gap: float = 0.2, most: int = 4) -> DataFrame:
    """Advice for features that the best posts show clearly more often than the weakest."""
    found = F.slice(notes([
        (F.col(f"top_{f}") - F.col(f"weak_{f}") >= gap, text) for f, text in tips.items() if f != "none"
    ]), 1, most)
    return profiles.select(account, F.when(F.size(found) > 0, found).otherwise(F.array(F.lit(tips["none"]))).alias("improvement_points"))


def weekly_global(scored: DataFrame, totals: DataFrame) -> DataFrame:
    """One row: overall score, account count and the batch totals."""
    return totals.withColumns({
        "overall_score": overall_score(scored).scalar(),
        "account_count": scored.agg(F.count(F.lit(1)).alias("n")).scalar(),
    })
