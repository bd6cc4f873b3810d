"""Field picking, metric lookup, whitelists and derived job rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipwell.functions import lexicons as lx
from clipwell.functions.coerce import filled, text, whole_number
from clipwell.functions.text import short_hash, slug
from clipwell.operators.picking import unique


def pick_field(df: DataFrame, candidates: Sequence[str]) -> Column:
    """First non-blank among the candidate columns that exist (any letter case)."""
    by_name = {c.strip().lower(): c for c in df.columns}
    found = [filled(F.col(f"`{by_name[c.lower()]}`")) for c in candidates if c.lower() in by_name]
    return F.coalesce(*found, F.lit(""))


def nested_metric(
    df: DataFrame, keys: Sequence[str], containers: Sequence[str] = lx.DETAIL_CONTAINERS
) -> Column:
    """First integer among top-level keys, then the keys of each nested container; 0 when none."""
    found = []
    fields = {f.name: f.dataType for f in df.schema.fields}
    for key in keys:
        if key in fields and not isinstance(fields[key], (T.StructType, T.MapType)):
            found.append(whole_number(F.col(key)))
    for box in containers:
        kind = fields.get(box)
        for key in keys:
            if isinstance(kind, T.MapType):
                found.append(whole_number(F.try_element_at(F.col(box), F.lit(key))))
            elif isinstance(kind, T.StructType) and key in kind.fieldNames():
                found.append(whole_number(F.col(box)[key]))
    return F.coalesce(*found, F.lit(0).cast("bigint"))


# Modalities that may enter scoring.
MODALITIES = ("face_quality", "pose_quality", "person_subject", "ocr_subtitle", "asr_speech", "script_structure")


def whitelist_modalities(
    items: DataFrame, features: DataFrame, key: str = "video_id", modalities: Sequence[str] = MODALITIES
) -> DataFrame:
    """Attach only the known modality columns of the feature table."""
    known = [m for m in modalities if m in features.columns]
    return items.join(unique(features.select(key, *known), [key]), key, "left")


def modality_coverage(df: DataFrame, modalities: Sequence[str] = MODALITIES) -> DataFrame:
    """Non-null count per modality, one row."""
    return df.agg(*[F.count(m).alias(m) for m in sorted(modalities)])


def artifact_kind(path: Column) -> Column:
    """Kind of a crawl artifact from its path."""
    p = F.lower(F.translate(text(path), "\\", "/"))
    return (
        F.when(p.contains("/collector/homepage/"), "homepage")
        .when(p.contains("/collector/full-batch-chunks/"), "full-batch-chunk")
        .when(p.contains("/collector/full-batch/") & p.contains("phase1_chunked_master"), "phase1-chunked-master")
        .when(p.contains("/collector/full-batch/"), "full-batch")
        .when(p.contains("/collector/batch/"), "homepage-batch")
        .otherwise("artifact")
    )


def download_jobs(
    df: DataFrame, created_at: str, position: str | Column, root: str = "downloads", carry: Mapping[str, str] | None = None
) -> DataFrame:
    """One job per post URL: hashed id, slug path, carried context."""
    url = text("video_url")
    pos = F.col(position) if isinstance(position, str) else position
    source = F.coalesce(filled("source_name"), F.lit("unknown_source"))
    folder = slug(source)
    vid = F.coalesce(filled("video_id"), short_hash(url, 12))
    job = F.concat(F.lit("dl_"), short_hash(F.concat_ws("|", url, F.lit(created_at), pos.cast("string"))))
    extra = [text(src).alias(dst) for dst, src in (carry or {}).items()]
    return df.where(url != "").select(
        job.alias("job_id"),
        url.alias("video_url"),
        vid.alias("video_id"),
        F.lit("pending").alias("status"),
        F.lit("stub").alias("downloader"),
        F.concat(F.lit(root + "/"), folder, F.lit("/"), folder, F.lit("_"), vid, F.lit(".mp4")).alias("output_path"),
        F.concat(F.lit(root + "/"), folder, F.lit("/"), job, F.lit(".json")).alias("artifact_path"),
        source.alias("source_name"),
        F.lit(created_at).alias("created_at"),
        *extra,
    )


# Short risk labels.
RISK_SUSPICIOUS, RISK_SUBJECT, RISK_SCRIPT, RISK_SUBTITLE, RISK_SPEED = "指标可疑", "主体不稳", "话术弱", "字幕弱", "语速快"


def risk_rules() -> list[tuple[Column, str]]:
    return [
        (F.col("person_count") > 1.5, RISK_SUBJECT),
        (F.col("structure_completeness") < 0.3, RISK_SCRIPT),
        (F.col("subtitle_consistency") < 0.45, RISK_SUBTITLE),
        (F.col("speech_rate_cpm") > 360, RISK_SPEED),
    ]


def risk_text() -> Column:
    """Short risk labels joined by a comma, '-' when there are none."""
    rules = [(F.col("metric_suspicious"), RISK_SUSPICIOUS), *risk_rules()]
    joined = F.array_join(F.array_compact(F.array(*[F.when(c, F.lit(t)) for c, t in rules])), "、")
    return F.when(joined == "", F.lit("-")).otherwise(joined)


# Columns of the audit extract.
AUDIT_COLUMNS = (
    "video_id", "source_name", "video_url", "like_count", "comment_count", "share_count",
    "view_count", "engagement_score", "suspicious_reason",
)


def audit_extract(df: DataFrame, columns: Sequence[str] = AUDIT_COLUMNS) -> DataFrame:
    return df.where(F.col("metric_suspicious")).select(*[c for c in columns if c in df.columns])
