"""Fusion of seven modality scores into one fit score with explanations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions.coerce import real, truthy
from clipwell.functions.messages import FUSION as M
from clipwell.functions.messages import LIST_COMMA
from clipwell.functions.notes import merged, notes
from clipwell.functions.numbers import level, score100

# Component weights and scores of missing modalities.
WEIGHTS = {
    "local_visual": 0.16, "face_quality": 0.16, "pose_quality": 0.12, "person_subject": 0.12,
    "ocr_subtitle": 0.14, "asr_speech": 0.14, "script_structure": 0.16,
}
MISSING, MISSING_VISUAL = 35.0, 45.0
SCRIPT_FLAGS = ("has_hook", "has_pain_point", "has_method", "has_example", "has_cta")
NONE = "array<string>"


def _field(df: DataFrame, box: str, name: str, default: float) -> Column:
    kind = df.schema[box].dataType
    return real(F.col(f"{box}.{name}"), default) if name in kind.fieldNames() else F.lit(default)


def _flag(df: DataFrame, box: str, name: str) -> Column:
    kind = df.schema[box].dataType
    return truthy(F.col(f"{box}.{name}")) if name in kind.fieldNames() else F.lit(False)


def _raw_scores(df: DataFrame) -> dict[str, Column]:
    """Unrounded component scores of present modalities."""
    def f(box: str, name: str, default: float) -> Column:
        return _field(df, box, name, default)

    def yes(box: str, name: str, plus: float, minus: float) -> Column:
        return F.when(_flag(df, box, name), plus).otherwise(minus)

    face, pose, who, ocr, asr, scr = "face_quality", "pose_quality", "person_subject", "ocr_subtitle", "asr_speech", "script_structure"
    people = f(who, "person_count", 0.0).cast("int")
    pace = F.greatest(F.lit(0.0), 1.0 - F.abs(f(asr, "speech_rate_cpm", 260.0) - 260.0) / 220.0)
    parts = F.lit(0)
    for name in SCRIPT_FLAGS:
        parts = parts + _flag(df, scr, name).cast("int")
    return {
        face: 45.0 + f(face, "center_score", 0.5) * 18.0 + f(face, "sharpness_score", 0.5) * 17.0
        + f(face, "expression_positive_score", 0.5) * 12.0 + yes(face, "face_detected", 8.0, -18.0)
        - f(face, "occlusion_risk", 0.0) * 15.0,
        pose: 42.0 + f(pose, "facing_camera_score", 0.5) * 18.0 + f(pose, "stability_score", 0.5) * 16.0
        + f(pose, "gesture_activity_score", 0.5) * 12.0 + yes(pose, "upper_body_visible", 8.0, -8.0),
        who: 45.0 + f(who, "subject_ratio", 0.35) * 18.0 + f(who, "center_score", 0.5) * 18.0
        + F.when(people == 1, 10.0).when(people > 1, -10.0).otherwise(-16.0) - f(who, "background_clutter_score", 0.0) * 12.0,
        ocr: 40.0 + f(ocr, "readability_score", 0.5) * 22.0 + f(ocr, "keyword_density", 0.3) * 16.0
        + f(ocr, "subtitle_consistency_score", 0.5) * 12.0 + f(ocr, "coverage_ratio", 0.4) * 10.0,
        asr: 45.0 + pace * 22.0 + f(asr, "opening_hook_score", 0.5) * 20.0 - f(asr, "pause_ratio", 0.15) * 25.0,
        scr: 35.0 + parts / 5.0 * 45.0 + f(scr, "knowledge_density_score", 0.5) * 20.0,
    }


def fuse(items: DataFrame, local: str = "local_video_fit") -> DataFrame:
    """Component scores, weighted fit score, level, and capped explanation lists.

    Each modality is a struct column, null when it was not observed.
    """
    raws = _raw_scores(items)
    have = {name: F.col(name).isNotNull() for name in raws}
    seen = F.col(local).isNotNull()
    scores = {"local_visual": score100(F.when(seen, _field(items, local, "fit_score", 50.0)).otherwise(MISSING_VISUAL))}
    scores.update({n: score100(F.when(have[n], raw).otherwise(MISSING)) for n, raw in raws.items()})
    out = items.withColumns({f"{n}_score": c for n, c in scores.items()})
    total = F.lit(0.0)
    for name, weight in WEIGHTS.items():
        total = total + F.col(f"{name}_score") * weight
    out = out.withColumn("fit_score", score100(total)).withColumn("fit_level", level(F.col("fit_score"), 75, 55))

    kinds = items.schema[local].dataType.fieldNames()
    own = {k: F.coalesce(F.col(f"{local}.{k}"), F.array().cast(NONE)) if k in kinds else F.array().cast(NONE)
           for k in ("strengths", "risks", "actions")}
    lv = M["local_visual"]
    one = lambda t: F.array(F.lit(t))
    strengths = [F.when(seen, own["strengths"]).otherwise(F.array().cast(NONE))]
    risks = [F.when(seen, own["risks"]).otherwise(one(lv[3]))]
    actions = [F.when(seen, own["actions"]).otherwise(one(lv[4]))]
    flawed = {
        "face_quality": ~_flag(items, "face_quality", "face_detected"),
        "pose_quality": raws["pose_quality"] < 60, "ocr_subtitle": raws["ocr_subtitle"] < 60, "asr_speech": raws["asr_speech"] < 60,
        "person_subject": _field(items, "person_subject", "person_count", 0.0).cast("int") != 1,
    }
    for name, raw in raws.items():
        good, bad, act, gap, todo = M[name]
        strengths.append(notes([(have[name] & (raw >= (75 if name == "script_structure" else 70)), good)]))
        if name == "script_structure":
            lacking = F.array_compact(F.array(*[F.when(~_flag(items, name, p), F.lit(p)) for p in SCRIPT_FLAGS]))
            listed = F.concat(F.lit(bad), F.array_join(lacking, LIST_COMMA))
            seen_risk = F.when(F.size(lacking) > 0, F.array(listed)).otherwise(F.array().cast(NONE))
        else:
            seen_risk = notes([(flawed[name], bad)])
        risks.append(F.when(have[name], seen_risk).otherwise(one(gap)))
        actions.append(F.when(have[name], one(act)).otherwise(one(todo)))
    return out.withColumns({
        "strengths": merged(strengths, 8), "risks": merged(risks, 10), "actions": merged(actions, 10),
    })
