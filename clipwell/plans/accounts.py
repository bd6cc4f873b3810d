"""Account scores from batch summaries, and the advice derived from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions.messages import ACCOUNT as M
from clipwell.functions.notes import notes
from clipwell.functions.numbers import percentage, rate, score100, share_of
from clipwell.operators.aggregates import baselines
from clipwell.operators.ordering import with_row_number

# Weights of the activity parts and of the total.
ACTIVITY = {"videos_seen": 0.60, "detail_success": 0.25, "comments_success": 0.15}
TOTAL = {"activity_score": 0.30, "execution_score": 0.30, "interaction_score": 0.25, "stability_score": 0.15}
PENALTY_PER_WARNING, PENALTY_FAILED_BATCH = 12, 3


def prefer_meaningful(accounts: DataFrame) -> DataFrame:
    """Meaningful counts replace plain success counts where they exist."""
    out = accounts
    for plain, better in (("detail_success", "detail_meaningful"), ("comments_success", "comment_meaningful")):
        if better in accounts.columns:
            out = out.withColumn(plain, F.coalesce(better, plain))
    return out


def account_scores(accounts: DataFrame, account: str = "account_id", batch_failed: Column | None = None) -> DataFrame:
    """Four scores and the weighted total per account; maxima come as one scalar row."""
    rows = prefer_meaningful(accounts)
    if "failed_count" not in rows.columns:
        rows = rows.withColumn("failed_count", F.lit(0))
    top = baselines(rows).select(F.struct("*").alias("b")).scalar()
    r = rows.withColumn("__b", top)
    v, d, c, w = (F.col(x) for x in ("videos_seen", "detail_success", "comments_success", "warnings_count"))
    activity = F.lit(0.0)
    for name, weight in ACTIVITY.items():
        activity = activity + share_of(F.col(name), F.greatest(F.lit(1), F.col(f"__b.max_{name}"))) * weight
    failed = (F.col("__b.global_failed_count") > 0) if batch_failed is None else batch_failed
    stability = 100 - w * PENALTY_PER_WARNING - F.when(failed, PENALTY_FAILED_BATCH).otherwise(0)
    r = r.withColumns({
        "activity_score": score100(activity * 100.0),
        "execution_score": score100(rate(d * 100.0, v)),
        "interaction_score": score100(rate(c * 100.0, d)),
        "stability_score": score100(stability.cast("double")),
    })
    total = F.lit(0.0)
    for name, weight in TOTAL.items():
        total = total + F.col(name) * weight
    return r.withColumns({
        "total_score": score100(total),
        "detail_success_rate": percentage(d, v),
        "interaction_capture_rate": percentage(c, d),
        "warning_penalty": F.least(F.lit(100), w * PENALTY_PER_WARNING).cast("bigint"),
    }).drop("__b")


def ranked_accounts(scored: DataFrame, position: str) -> DataFrame:
    """Rank by (total, activity) descending, ties in input order."""
    return with_row_number(scored, [F.col("total_score").desc(), F.col("activity_score").desc(), F.col(position).asc()], "rank")


def recommendations(scored: DataFrame) -> DataFrame:
    """Focus areas, reasons, actions and priority per account."""
    low = {
        "activity": F.col("activity_score") < 60, "execution": F.col("execution_score") < 70,
        "interaction": F.col("interaction_score") < 60, "stability": F.col("stability_score") < 70,
    }
    none = ~(low["activity"] | low["execution"] | low["interaction"] | low["stability"])
    reasons = notes([*[(cond, M[f"{n}_reason"]) for n, cond in low.items()], (none, M["balanced_reason"])])
    actions = notes([
        (low["activity"], M["activity_action"]), (~low["activity"], M["activity_keep"]),
        *[(low[n], M[f"{n}_action"]) for n in ("execution", "interaction", "stability")],
        (none, M["balanced_action"]),
    ])
    total = F.col("total_score")
    priority = F.when(total >= 85, "low").when(total >= 70, "medium").otherwise("high")
    return scored.withColumns({
        "priority": priority,
        "priority_rank": F.when(priority == "high", 0).when(priority == "medium", 1).otherwise(2),
        "focus_areas": notes([(cond, n) for n, cond in low.items()]),
        "reason": F.array_join(reasons, M["separator"]),
        "actions": actions,
    })


def ordered_recommendations(scored: DataFrame, account: str) -> DataFrame:
    return recommendations(scored).orderBy("priority_rank", F.col("total_score").desc(), account)


def empty_recommendation(spark) -> DataFrame:
    """The single advice row for a batch without any account."""
    row = [("batch", "high", M["empty_title"], M["empty_reason"], [M["empty_action_1"], M["empty_action_2"]])]
    return spark.createDataFrame(row, "scope string, priority string, title string, reason string, actions array<string>")


def overall_score(scored: DataFrame) -> DataFrame:
    """Rounded mean of the account totals."""
    return scored.agg(F.coalesce(F.bround(F.avg("total_score"), 0), F.lit(0)).cast("bigint").alias("overall"))


def top_accounts(scored: DataFrame, account: str, k: int = 3) -> DataFrame:
    return scored.orderBy(F.col("total_score").desc(), F.col("activity_score").desc(), F.col(account).asc()).limit(k)
