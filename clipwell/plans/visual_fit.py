"""Visual fit of a post from its content features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwell.functions.messages import VISUAL_ACTIONS as A
from clipwell.functions.messages import VISUAL_GOOD as G
from clipwell.functions.messages import VISUAL_RISKS as R
from clipwell.functions.notes import notes, notes_or
from clipwell.functions.numbers import level, score100

BASE = 50


def visual_fit(rows: DataFrame) -> DataFrame:
    """Base 50 plus points per rule; level at 75 and 50; explanations and actions."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    upright = text("orientation") == "portrait"
    res, bit, bright, con, sat, sub, rhythm = (
        text(c) for c in ("resolution_tier", "bitrate_tier", "brightness_level", "contrast_level", "saturation_level",
                          "subtitle_readability", "visual_rhythm_hint")
    )
    sec = F.coalesce("duration_sec", F.lit(0.0))
    tag = lambda name: F.coalesce(F.array_contains("visual_tags", name), F.lit(False))
    good = [
        (upright, 12, G["portrait"]), (sec.between(15, 50), 12, G["duration"]),
        (res.isin("high", "4k_like"), 8, G["resolution"]),
        (bright == "balanced", 8, G["balanced"]), (bright == "bright", 3, G["bright"]), (con == "high", 6, G["contrast"]),
        (sat == "medium", 5, G["saturation_medium"]), (sat == "high", 1, G["saturation_high"]), (bit == "high", 5, G["bitrate"]),
        (sub == "high", 5, G["subtitle"]), (tag("possible_talking_head"), 6, G["talking_head"]),
        (tag("clean_educational_style"), 5, G["clean"]), (tag("dynamic_visual_pacing"), 3, G["dynamic"]),
    ]
    bad = [
        (~upright, 10, R["not_portrait"]), (sec < 8, 12, R["too_short"]), (sec > 75, 8, R["too_long"]),
        (res == "low", 10, R["resolution"]), (bright == "dark", 6, R["dark"]), (con == "low", 5, R["contrast"]),
        (sat == "low", 3, R["saturation"]), (bit == "low", 4, R["bitrate"]), (sub == "low", 7, R["subtitle"]),
        (tag("low_exposure_risk"), 5, R["exposure"]),
    ]
    score = F.lit(BASE)
    for cond, points, _note in good:
        score = score + F.when(cond, points).otherwise(0)
    for cond, points, _note in bad:
        score = score - F.when(cond, points).otherwise(0)
    out = rows.withColumn("fit_score", score100(score.cast("double"))).withColumn("fit_level", level(F.col("fit_score"), 75, 50))
    lev = F.col("fit_level")
    return out.withColumns({
        "strengths": notes_or([(c, n) for c, _p, n in good], G["none"]),
        "risks": notes_or([(c, n) for c, _p, n in bad], R["none"]),
        "actions": notes([
            *[(lev == name, A[name]) for name in ("high", "medium", "low")],
            (~upright, A["not_portrait"]), (bright == "dark", A["dark"]), (con == "low", A["contrast"]),
            (sat == "low", A["saturation"]), (sec > 50, A["over_50"]), (sec < 12, A["under_12"]),
            (tag("possible_talking_head"), A["talking_head"]),
            (tag("dynamic_visual_pacing") & (rhythm == "dynamic"), A["dynamic"]),
            (sub == "low", A["subtitle_low"]), (sub == "high", A["subtitle_high"]),
        ]),
    })
