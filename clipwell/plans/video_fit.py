"""Fit of a post from its counters and its account's score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions.messages import FIT_ACTIONS as A
from clipwell.functions.messages import FIT_RISKS as R
from clipwell.functions.messages import FIT_STRENGTHS as S
from clipwell.functions.notes import notes, notes_or
from clipwell.functions.numbers import level, rate, score100

# Rate goals with their weights, volume steps, component weights.
GOALS = {"like": (0.08, 0.55), "comment": (0.012, 0.30), "share": (0.006, 0.15)}
VOLUME = [(10000, 92.0), (2000, 82.0), (500, 65.0), (100, 40.0), (1, 18.0)]
WEIGHTS = {"engagement_score": 0.58, "volume_score": 0.18, "consistency_score": 0.10, "account_prior_score": 0.14}
NEUTRAL_PRIOR = 50


def account_prior(total: Column | None, parts: dict[str, Column] | None = None) -> Column:
    """Account total, else a weighted mean of its parts, else 50."""
    mix = None
    if parts:
        mix = parts["activity_score"] * 0.4 + parts["execution_score"] * 0.3 + parts["interaction_score"] * 0.2 + parts["stability_score"] * 0.1
    found = [c for c in (total, mix) if c is not None]
    return F.coalesce(*[score100(c.cast("double")) for c in found], F.lit(NEUTRAL_PRIOR).cast("bigint"))


def video_fit(rows: DataFrame, prior: Column | None = None) -> DataFrame:
    """Rates, component scores, fit score and level, and explanations per row."""
    v = F.coalesce("view_count", F.lit(0))
    counts = {k: F.coalesce(f"{k}_count", F.lit(0)) for k in GOALS}
    rates = {k: F.greatest(F.lit(0.0), rate(c, v)) for k, c in counts.items()}
    engagement = F.lit(0.0)
    for k, (goal, weight) in GOALS.items():
        engagement = engagement + F.least(rates[k] / goal, F.lit(1.0)) * weight
    observed = (v > 0).cast("int")
    for c in counts.values():
        observed = observed + (c > 0).cast("int")
    volume = F.when(v <= 0, F.lit(0.0))
    for cut, points in VOLUME:
        volume = volume.when(v >= cut, F.lit(points))
    base = rows.withColumns({
        **{f"{k}_rate": F.bround(r, 4) for k, r in rates.items()},
        "engagement_score": score100(engagement * 100.0),
        "volume_score": volume.otherwise(F.lit(18.0)).cast("bigint"),
        "consistency_score": F.element_at(F.array(*[F.lit(x) for x in (0, 45, 70, 85, 100)]), observed + 1).cast("bigint"),
        "account_prior_score": account_prior(prior),
    })
    raw = F.lit(0.0)
    for name, weight in WEIGHTS.items():
        raw = raw + F.col(name) * weight
    p = F.col("account_prior_score")
    like, comment, share = rates["like"], rates["comment"], rates["share"]
    scored = base.withColumn("fit_score", score100(raw)).withColumn("fit_level", level(F.col("fit_score"), 75, 45))
    few = {"comments": comment < 0.003, "shares": share < 0.001, "likes": like < 0.03}
    lev, fit = F.col("fit_level"), F.col("fit_score")
    main = notes([
        (lev == "high", A["high_1"]), (lev == "high", A["high_2"]),
        (lev == "medium", A["medium_1"]), (lev == "medium", A["medium_2"]),
        (lev == "low", A["low_1"]), (lev == "low", A["low_2"]),
        (few["comments"], A["comments"]), (few["shares"], A["shares"]), (few["likes"], A["likes"]),
        (fit >= 80, A["sample"]),
    ])
    return scored.withColumns({
        "strengths": notes([
            (v >= 1000, S["views_1000"]), ((v >= 100) & (v < 1000), S["views_100"]), (v < 100, S["views_few"]),
            (like >= 0.08, S["likes"]), (comment >= 0.012, S["comments"]), (share >= 0.006, S["shares"]), (p >= 75, S["account"]),
        ]),
        "risks": notes_or([
            (v < 50, R["views"]), (few["likes"], R["likes"]), (few["comments"], R["comments"]),
            (few["shares"], R["shares"]), (p < 40, R["account"]),
        ], R["none"]),
        "actions": F.when(F.size(main) < 3, F.concat(main, F.array(F.lit(A["keep"])))).otherwise(main),
    })


def with_account_prior(rows: DataFrame, accounts: DataFrame, account: str, total: str = "total_score") -> DataFrame:
    """Fit with the account's total score joined in; accounts without a score count as neutral."""
    prior = accounts.select(account, F.col(total).alias("__prior"))
    return video_fit(rows.join(prior, account, "left"), F.col("__prior")).drop("__prior")
