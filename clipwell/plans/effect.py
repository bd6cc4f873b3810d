"""Pre-publish effect model: an ideal profile learned from trusted posts, and scores against it.

Training may look at past performance; scoring never reads a post's own
counters or comments, it only reports which of them were present.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions import lexicons as lx
from clipwell.functions.coerce import real
from clipwell.functions.messages import EFFECT_ACTIONS as A
from clipwell.functions.messages import EFFECT_RISKS as R
from clipwell.functions.messages import EFFECT_TIP
from clipwell.functions.notes import notes
from clipwell.functions.numbers import person_score, range_score, rounded, speech_score
from clipwell.functions.text import has_any, topics
from clipwell.operators.aggregates import ideal_ranges, most_frequent, topic_counts
from clipwell.operators.joins import only_ids
from clipwell.operators.ordering import durable
from clipwell.operators.picking import Top, top_fractions

# Profile features, scales of the range parts, component weights, text fields.
IDEAL_FEATURES = (
    "fit_score", "ocr_readability", "subtitle_consistency", "structure_completeness", "face_center_score",
    "pose_facing_score", "speech_rate_cpm", "person_count", "opening_hook_score",
)
RANGE_PARTS = {
    "fit_score": 100.0, "ocr_readability": 1.0, "subtitle_consistency": 1.0, "face_center_score": 1.0, "pose_facing_score": 1.0,
}
WEIGHTS = {"production_quality_score": 0.55, "content_structure_score": 0.25, "comment_potential_score": 0.20}
TEXT_FIELDS = ("planned_title", "planned_caption", "title", "caption", "script_text", "asr_transcript", "ocr_text")
RUNTIME_FIELDS = ("view_count", "like_count", "comment_count", "share_count", "engagement_score")
TOP_SHARE = 0.25
DEMAND_WEIGHT, TOP_DEMAND_WEIGHT, TOP_OTHER_WEIGHT, TOP_TOPICS = 4, 6, 4, 5


def ideal_sources(
    rows: DataFrame, key: str = "video_id", share: float = TOP_SHARE, features: Sequence[str] = IDEAL_FEATURES
) -> DataFrame:
    """Trusted posts in the top share by engagement or by comments, each once.

    The few numeric columns are stored once, because both boundaries and the
    profile read them again.
    """
    narrow = rows.where(~F.col("metric_suspicious")).select(key, "trusted_engagement_score", "comment_count", *features)
    trusted = durable(narrow)
    picked = top_fractions(trusted, key, [Top("__eng", "trusted_engagement_score", share), Top("__com", "comment_count", share)])
    return picked.where(F.col("__eng") | F.col("__com")).drop("__eng", "__com")


def topic_weights(counts: DataFrame, demand: Sequence[str] = lx.DEMAND_TOPICS) -> DataFrame:
    """Demand topics weigh 4; the five most frequent topics rise to 6 (demand) or 4 (others)."""
    spark = counts.sparkSession
    base = spark.createDataFrame([(d, DEMAND_WEIGHT) for d in demand], "topic string, base int")
    top = counts.orderBy(F.col("n").desc(), F.col("topic").asc()).limit(TOP_TOPICS).withColumn("hot", F.lit(True))
    wanted = F.when(F.col("topic").isin(*demand), TOP_DEMAND_WEIGHT).otherwise(TOP_OTHER_WEIGHT)
    merged = base.join(top, "topic", "full")
    weight = F.when(F.col("hot"), F.greatest(F.coalesce("base", F.lit(3)), wanted)).otherwise(F.col("base"))
    return merged.select("topic", weight.cast("bigint").alias("weight"))


def train_profile(ideal: DataFrame, features: Sequence[str] = IDEAL_FEATURES, key: str = "video_id") -> DataFrame:
    """One row per feature: low, mid, high over the ideal posts."""
    return ideal_ranges(ideal, key, features)


def train_topics(
    ideal: DataFrame, comments: DataFrame, topic_col: str = "topics", key: str = "video_id",
    demand: Sequence[str] = lx.DEMAND_TOPICS,
) -> DataFrame:
    """Topic weights from the comments of the ideal posts."""
    return topic_weights(topic_counts(only_ids(comments, ideal, key), topic_col), demand)


def planned_text(df: DataFrame, fields: Sequence[str] = TEXT_FIELDS) -> Column:
    found = [F.coalesce(F.col(f), F.lit("")) if f in df.columns else F.lit("") for f in fields]
    return F.btrim(F.concat_ws(" ", *found))


def effect_scores(
    rows: DataFrame, profile: DataFrame, weights: DataFrame, *,
    planned: Mapping[str, Sequence[str]] = lx.PLANNED_TOPICS, no_topic: str = lx.NO_PLANNED_TOPIC,
    demand: Sequence[str] = lx.DEMAND_TOPICS, hooks: Sequence[str] = lx.HOOK_WORDS, cta: Sequence[str] = lx.CTA_WORDS,
    asking: Sequence[str] = ("?", "？", "吗"), lead_topics: Sequence[str] = ("资料领取", "考试报考", "家长咨询"),
    commented: Column | None = None,
) -> DataFrame:
    """Production, structure and comment potential, the weighted effect score, level, risks, actions.

    Profile and topic weights are a few rows each: they are folded into one map
    apiece and read as scalars.
    """
    ideal = profile.agg(
        F.map_from_entries(F.collect_list(F.struct("feature", F.struct("low", "mid", "high")))).alias("m")
    ).scalar()
    priced = weights.agg(F.map_from_entries(F.collect_list(F.struct("topic", "weight"))).alias("m")).scalar()
    num = lambda c: real(c, 0.0) if c in rows.columns else F.lit(0.0)
    df = rows.withColumns({"__ideal": ideal, "__priced": priced, "__text": planned_text(rows)})
    df = df.withColumn("planned_topics", topics(F.col("__text"), planned, no_topic))
    text, found = F.col("__text"), F.col("planned_topics")
    target = lambda f: F.try_element_at(F.col("__ideal"), F.lit(f))

    parts = [range_score(num(f), target(f), scale) for f, scale in RANGE_PARTS.items()]
    parts.append(speech_score(num("speech_rate_cpm"), target("speech_rate_cpm")["mid"]))
    parts.append(person_score(num("person_count")))
    production = sum(parts[1:], parts[0]) / float(len(parts))

    structure = F.least(
        F.lit(100.0),
        35.0 + num("structure_completeness") * 35.0 + num("knowledge_density") * 15.0 + num("opening_hook_score") * 15.0
        + F.when(has_any(text, hooks), 8.0).otherwise(0.0) + F.when(has_any(text, cta), 7.0).otherwise(0.0),
    )
    price = F.aggregate(
        found, F.lit(0).cast("bigint"),
        lambda acc, t: acc + F.coalesce(F.try_element_at(F.col("__priced"), t), F.lit(DEMAND_WEIGHT).cast("bigint")),
    )
    wanted = F.arrays_overlap(found, F.array(*[F.lit(d) for d in demand]))
    potential = F.least(
        F.lit(100.0),
        35.0 + F.least(F.lit(30.0), price.cast("double")) + F.when(has_any(text, asking), 12.0).otherwise(0.0)
        + F.when(has_any(text, cta), 15.0).otherwise(0.0) + F.when(wanted, 8.0).otherwise(0.0),
    )
    df = df.withColumns({
        "__production_quality_score": production, "__content_structure_score": structure, "__comment_potential_score": potential,
    })
    final = F.lit(0.0)
    for name, weight in WEIGHTS.items():
        final = final + F.col(f"__{name}") * weight
    weak = num("structure_completeness") < 0.3
    crowd = num("person_count") > 1.8
    untopical = F.array_contains(found, no_topic)
    leading = F.arrays_overlap(found, F.array(*[F.lit(t) for t in lead_topics]))
    risk_rules = [
        (weak, R["structure"]), (num("subtitle_consistency") < 0.45, R["subtitle"]), (crowd, R["subject"]),
        (text == "", R["no_text"]), (untopical, R["no_topic"]),
    ]
    action_rules = [(untopical, A["no_topic"]), (weak, A["structure"]), (crowd, A["subject"]), (leading, A["demand"])]
    present = [(F.coalesce(F.col(f).cast("string"), F.lit("")) != "", f) for f in RUNTIME_FIELDS if f in rows.columns]
    if commented is not None:
        present.append((commented, "comments"))
    out = df.withColumns({
        "effect_score": F.bround(final, 2),
        "effect_level": F.when(final >= 80, "excellent").when(final >= 65, "good").when(final >= 50, "medium").otherwise("weak"),
        **{name: F.bround(F.col(f"__{name}"), 2) for name in WEIGHTS},
        "ignored_runtime_fields": notes(present),
        "risks": notes(risk_rules),
        "actions": notes(action_rules),
    })
    idle = (F.size("actions") == 0) & (F.size("risks") == 0)
    out = out.withColumn("actions", F.when(idle, F.array(F.lit(A["steady"]))).otherwise(F.col("actions")))
    return out.drop("__ideal", "__priced", "__text", *[f"__{n}" for n in WEIGHTS])


def account_effects(scores: DataFrame, account: str = "source_name") -> DataFrame:
    """Mean scores per account and its most frequent risk (ties by text)."""
    means = scores.groupBy(account).agg(
        F.count(F.lit(1)).alias("video_count"),
        *[rounded(F.avg(c), 2).alias(f"avg_{c}") for c in ("effect_score", "production_quality_score", "comment_potential_score")],
    )
    tip = most_frequent(scores, [account], "risks", "tip").select(account, "tip")
    return means.join(tip, account, "left").withColumn("tip", F.coalesce("tip", F.lit(EFFECT_TIP)))
