"""Speech, subtitle, person, frame and script features from observation rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions import lexicons as lx
from clipwell.functions import numbers as nm
from clipwell.functions.coerce import text
from clipwell.functions.notes import notes
from clipwell.functions.rows import exploded
from clipwell.functions.text import (
    char_overlap, contains_in, has_any, hits, occurrences, single_spaced,
)
from clipwell.operators.ordering import with_previous
from clipwell.operators.picking import top_per_key

HEAD = 80
TAIL = 120


# -- speech ---------------------------------------------------------------------

def speech_features(
    segments: DataFrame, key: str = "video_id", position: str = "segment_no",
    hooks: Sequence[str] = lx.SPEECH_HOOKS, durations: DataFrame | None = None,
) -> DataFrame:
    """Characters per minute, pause share, opening hooks and counts from (start, end, text) segments.

    Numbers are plain sums. The opening needs only the first 80 characters, so
    at most the first 80 filled segments per video are brought together; a
    video with very many segments is never gathered in one task.
    """
    said = text("text")
    spoken = segments.withColumns({"text": said})
    bare = F.regexp_replace("text", lx.SPEECH_PUNCTUATION, "")
    sums = spoken.groupBy(key).agg(
        F.count(F.lit(1)).alias("segments_count"),
        F.sum(F.length(bare)).alias("__chars"),
        F.sum(F.greatest(F.lit(0.0), F.col("end") - F.col("start"))).alias("__speech"),
        F.max("end").alias("__end"),
    )
    if durations is not None:
        sums = sums.join(durations.select(key, F.col("duration").alias("__given")), key, "left")
    else:
        sums = sums.withColumn("__given", F.lit(None).cast("double"))
    head = top_per_key(spoken.where(F.col("text") != ""), [key], [F.col(position).asc()], HEAD, "__pos")
    opening = head.groupBy(key).agg(
        F.left(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("__pos", "text"))), lambda x: x["text"]), ""), F.lit(HEAD)).alias("opening")
    )
    dur = F.when(F.col("__given") > 0, F.col("__given")).otherwise(F.coalesce("__end", F.lit(0.0)))
    cpm = F.when(dur > 0, F.bround(F.col("__chars") / dur * 60.0, 2)).otherwise(0.0)
    pause = F.when(dur > 0, F.bround(nm.bounded(1.0 - F.col("__speech") / dur), 3)).otherwise(0.0)
    return sums.join(opening, key, "left").select(
        key, "segments_count", cpm.alias("speech_rate_cpm"), pause.alias("pause_ratio"),
        F.bround(F.least(F.lit(1.0), hits(F.coalesce("opening", F.lit("")), hooks) / 2.0), 3).alias("opening_hook_score"),
        F.bround(dur, 3).alias("duration_sec"), F.coalesce("opening", F.lit("")).alias("opening"),
    )


def transcripts(segments: DataFrame, key: str = "video_id", position: str = "segment_no", size: int | None = None) -> DataFrame:
    """Whole transcript per video; with ``size``, in numbered parts of at most so many segment positions.

    A transcript is one text, as its readers need it whole; parts are for
    streams of segments that never end.
    """
    listed = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), text("text").alias("t"))))
    part = F.lit(0).cast("bigint") if size is None else F.floor(F.col(position) / F.lit(size)).cast("bigint")
    return segments.groupBy(key, part.alias("part_no")).agg(F.array_join(F.transform(listed, lambda x: x["t"]), "").alias("transcript"))


# -- subtitles --------------------------------------------------------------------

def consistency(frames: DataFrame, key: str, position: str, body: str, name: str = "consistency") -> DataFrame:
    """Mean character overlap of neighbouring non-empty frames; 1 for a single frame."""
    # the overlap compares sets of characters, so only these are sorted and handed on
    kinds = F.array_join(F.array_distinct(F.split(body, "")), "").alias(body)
    filled = frames.where(text(body) != "").select(key, position, kinds)
    pairs = with_previous(filled, [key], [position], [body])
    score = F.when(F.col(f"prev_{body}").isNotNull(), char_overlap(F.col(f"prev_{body}"), F.col(body)))
    return pairs.groupBy(key).agg(
        F.bround(F.when(F.count(F.lit(1)) == 1, 1.0).otherwise(F.avg(score)), 4).alias(name)
    )


def subtitle_features(
    frames: DataFrame, key: str = "video_id", position: str = "frame_no", lines: str = "lines",
    keywords: str = lx.SUBTITLE_KEYWORDS,
) -> DataFrame:
    """Coverage, readability, keyword density and consistency from OCR lines per frame.

    Distinct lines are counted before they are measured, so repeated subtitles
    are shuffled once. Readability and density are sums over distinct lines.
    """
    joined = frames.withColumn("__text", F.array_join(lines, ""))
    base = joined.groupBy(key).agg(
        F.count(F.lit(1)).alias("frames_count"), F.count_if(F.size(lines) > 0).alias("__filled")
    )
    tall = exploded(frames, [key], lines, "line").where(text("line") != "").distinct()
    t = F.regexp_replace("line", r"[\s\p{Z}]+", "")
    per_line = tall.select(
        key, F.length(t).alias("size"),
        F.length(F.regexp_replace(t, r"[^\x{4e00}-\x{9fff}\p{L}\p{N}]", "")).alias("readable"),
        F.regexp_count(t, F.lit(keywords)).alias("found"),
    ).groupBy(key).agg(F.sum("size").alias("size"), F.sum("readable").alias("readable"), F.sum("found").alias("found"))
    steady = consistency(joined, key, position, "__text", "subtitle_consistency_score")
    size = F.coalesce("size", F.lit(0))
    read = F.bround(F.col("readable") / size * 0.7 + F.least(F.lit(1.0), size / 80.0) * 0.3, 4)
    dense = F.bround(F.least(F.lit(1.0), F.col("found") * 6.0 / size), 4)
    return base.join(per_line, key, "left").join(steady, key, "left").select(
        key, "frames_count", nm.rate(F.col("__filled"), F.col("frames_count"), 4).alias("coverage_ratio"),
        F.when(size > 0, read).otherwise(0.0).alias("readability_score"),
        F.when(size > 0, dense).otherwise(0.0).alias("keyword_density"),
        F.coalesce("subtitle_consistency_score", F.lit(0.0)).alias("subtitle_consistency_score"),
    )


# -- people -----------------------------------------------------------------------

def best_box(boxes: DataFrame, keys: Sequence[str], packed: Column, area: Column, position: Column) -> DataFrame:
    """Largest box per key, the first one on ties."""
    return boxes.groupBy(*keys).agg(F.max_by(packed, F.struct(area, -position)).alias("box"))


def center_score(box: Column) -> Column:
    off = F.abs(box["x"] + box["w"] / 2 - 0.5) + F.abs(box["y"] + box["h"] / 2 - 0.5)
    return F.when(box.isNotNull(), F.bround(F.greatest(F.lit(0.0), 1.0 - off), 3)).otherwise(0.0)


def person_features(frames: DataFrame, key: str = "video_id") -> DataFrame:
    """Face, pose and subject features from per-frame box arrays.

    ``faces`` and ``people`` are arrays of struct(x, y, w, h, area), ``pose`` is
    struct(w, h, landmark_count) or null. Each frame is reduced to its own best
    box first, then the best of all frames wins; both are partial aggregates.
    """
    def largest(boxes: str) -> Column:
        ranked = F.transform(F.col(boxes), lambda b, i: F.struct(b["area"].alias("area"), (-i).alias("i"), b.alias("box")))
        return F.array_max(ranked)

    n = F.greatest(F.lit(1), F.count(F.lit(1)))
    pose_size = F.coalesce(F.col("pose.w") * F.col("pose.h"), F.lit(-1.0))
    g = frames.withColumns({"__f": largest("faces"), "__p": largest("people")}).groupBy(key).agg(
        F.count(F.lit(1)).alias("frames_count"),
        F.sum(F.size("faces")).alias("__nf"), F.count_if(F.size("faces") > 0).alias("__df"),
        F.sum(F.size("people")).alias("__np"),
        F.max(F.struct(F.col("__f.area").alias("area"), F.col("__f.box").alias("box"))).alias("__bf"),
        F.max(F.struct(F.col("__p.area").alias("area"), F.col("__p.box").alias("box"))).alias("__bp"),
        F.count("pose").alias("__npose"), F.max_by("pose", pose_size).alias("__pose"), n.alias("__n"),
    )
    face, who, pose = F.col("__bf.box"), F.col("__bp.box"), F.col("__pose")
    ratio = F.coalesce(who["w"] * who["h"], F.lit(0.0))
    marks = F.coalesce(pose["landmark_count"], F.lit(0))
    return g.select(
        key, "frames_count",
        (F.col("__nf") > 0).alias("face_detected"), F.bround(F.col("__nf") / F.col("__n"), 3).alias("face_count"),
        F.bround(F.coalesce(face["area"], F.lit(0.0)), 4).alias("face_ratio"), center_score(face).alias("face_center_score"),
        F.bround(1.0 - F.col("__df") / F.col("__n"), 3).alias("occlusion_risk"),
        (F.col("__npose") > 0).alias("pose_detected"),
        F.bround(F.least(F.lit(1.0), marks / 25.0), 3).alias("facing_camera_score"), (marks >= 10).alias("upper_body_visible"),
        F.bround(F.least(F.lit(1.0), (F.coalesce(pose["w"], F.lit(0.0)) + F.coalesce(pose["h"], F.lit(0.0))) / 1.2), 3).alias("gesture_activity_score"),
        F.bround(F.col("__npose") / F.col("__n"), 3).alias("stability_score"),
        F.bround(F.col("__np") / F.col("__n"), 3).alias("person_count"), F.bround(ratio, 4).alias("subject_ratio"),
        center_score(who).alias("subject_center_score"),
        F.when(F.col("__np") > 0, F.bround(F.greatest(F.lit(0.0), 1.0 - ratio * 3.0), 3)).otherwise(1.0).alias("background_clutter_score"),
    )


# -- frames -----------------------------------------------------------------------

def frame_summary(frames: DataFrame, key: str = "video_id") -> DataFrame:
    """Means, spreads and levels from per-frame brightness, saturation and contrast span."""
    def spread(c: str) -> Column:
        return F.max(c) - F.min(c)

    span = F.greatest(F.lit(0.0), F.col("yhigh") - F.col("ylow"))
    g = frames.withColumn("span", span).groupBy(key).agg(
        F.count(F.lit(1)).alias("sampled_frames"),
        F.avg("yavg").alias("b"), F.avg("satavg").alias("s"), F.avg("span").alias("c"),
        spread("yavg").alias("bs"), spread("satavg").alias("ss"), spread("span").alias("cs"),
    )
    three = lambda c, n: F.bround(F.col(c), 3).alias(n)
    return g.select(
        key, "sampled_frames", three("b", "avg_brightness"), three("s", "avg_saturation"), three("c", "avg_contrast_span"),
        three("bs", "brightness_spread"), three("ss", "saturation_spread"), three("cs", "contrast_spread"),
        nm.brightness(F.col("b")).alias("brightness_level"), nm.saturation(F.col("s")).alias("saturation_level"),
        nm.contrast(F.col("c")).alias("contrast_level"),
        nm.rhythm(F.col("bs"), F.col("ss"), F.col("cs")).alias("visual_rhythm_hint"),
    )


def content_features(rows: DataFrame) -> DataFrame:
    """Orientation, buckets and visual tags from probe columns and the frame summary."""
    w, h, d = F.col("width"), F.col("height"), F.col("duration_sec")
    bright, sat, con, rhy = (F.col(c) for c in ("brightness_level", "saturation_level", "contrast_level", "visual_rhythm_hint"))
    tags = notes([
        ((rhy == "stable") & (d >= 15), "possible_talking_head"),
        (rhy == "dynamic", "dynamic_visual_pacing"),
        (bright == "dark", "low_exposure_risk"),
        (con == "high", "subject_separation_good"),
        (sat == "low", "soft_color_style"),
        ((sat == "medium") & (bright == "balanced"), "clean_educational_style"),
    ])
    return rows.withColumns({
        "orientation": F.when(h > w, "portrait").when(w > h, "landscape").otherwise("square"),
        "duration_bucket": nm.duration_bucket(d), "resolution_tier": nm.resolution(w, h),
        "bitrate_tier": nm.bitrate(F.col("bit_rate")), "visual_tags": tags,
    })


# -- scripts ----------------------------------------------------------------------

def script_structure(
    rows: DataFrame, body: str, parts: Mapping[str, Sequence[str]] = lx.SCRIPT_PARTS,
    knowledge: Sequence[str] = lx.KNOWLEDGE_WORDS, head_part: str = "has_hook", tail_part: str = "has_cta",
) -> DataFrame:
    """Part flags (hook in the head, call to action in the tail), completeness, density, missing parts."""
    # A column of its own: used many times below, computed once.
    rows = rows.withColumn("__t", single_spaced(text(body)))
    t = F.col("__t")
    flags = {
        name: contains_in(t, words, head=HEAD if name == head_part else 0, tail=TAIL if name == tail_part else 0)
        for name, words in parts.items()
    }
    rows = rows.withColumns(flags)
    total = F.lit(0)
    for name in flags:
        total = total + F.col(name).cast("int")
    density = F.bround(nm.bounded(occurrences(t, knowledge) / F.greatest(F.lit(3.0), F.length(t) / 80.0)), 3)
    return rows.withColumns({
        "text_length": F.length(t).cast("bigint"),
        "structure_completeness_score": F.bround(total / float(len(parts)), 3),
        "knowledge_density_score": F.when(t == "", 0.0).otherwise(density),
        "missing_parts": F.array_compact(F.array(*[F.when(~F.col(n), F.lit(n)) for n in flags])),
    }).drop("__t")


def script_summary() -> list[Column]:
    avg = lambda c: F.bround(F.coalesce(F.avg(c), F.lit(0.0)), 3)
    return [
        avg("structure_completeness_score").alias("average_structure_completeness"),
        avg("knowledge_density_score").alias("average_knowledge_density"),
    ]


def prepublish_features(
    rows: DataFrame, title: str, caption: str, script: str, hooks: Sequence[str] = lx.HOOK_WORDS,
    cta: Sequence[str] = lx.CTA_WORDS, parts: Mapping[str, Sequence[str]] = lx.PREPUBLISH_PARTS,
    knowledge: Sequence[str] = lx.PREPUBLISH_KNOWLEDGE,
) -> DataFrame:
    """Structure, knowledge density and opening hook of texts planned for a post."""
    joined = F.array_join(F.filter(F.array(*[F.coalesce(c, F.lit("")) for c in (title, caption, script)]), lambda x: x != ""), " ")
    start = F.btrim(F.concat(F.coalesce(title, F.lit("")), F.lit(" "), F.left(F.coalesce(script, F.lit("")), F.lit(HEAD))))
    rows = rows.withColumns({"__full": joined, "__opening": start})
    full, opening = F.col("__full"), F.col("__opening")
    marks = lx.QUESTION_MARKS
    hook = lambda c: has_any(c, hooks) | has_any(c, marks)
    found = [hook(full), *[has_any(full, w) for w in parts.values()], has_any(full, cta)]
    total = F.lit(0)
    for c in found:
        total = total + c.cast("int")
    opened = (
        F.lit(0.35) + F.when(hook(opening), 0.35).otherwise(0.0) + F.when(has_any(opening, marks), 0.15).otherwise(0.0)
        + F.when(F.length(opening) <= 70, 0.15).otherwise(0.0)
    )
    dense = (hits(full, knowledge) + (F.length(full) >= HEAD).cast("int")) / 7.0
    return rows.withColumns({
        "structure_completeness": total / float(len(found)),
        "knowledge_density": F.when(full == "", 0.0).otherwise(F.least(F.lit(1.0), dense)),
        "opening_hook_score": F.when(opening == "", 0.0).otherwise(F.least(F.lit(1.0), opened)),
    }).drop("__full", "__opening")


# Neutral features of a post whose media could not be read.
MISSING_DEFAULTS = {
    "fit_score": 45.0, "ocr_readability": 0.5, "subtitle_consistency": 0.5, "face_center_score": 0.55,
    "pose_facing_score": 0.55,
}


def filled_features(rows: DataFrame, speech_rate: float = 260.0, person_count: float = 1.0) -> DataFrame:
    values = {**MISSING_DEFAULTS, "speech_rate_cpm": speech_rate, "person_count": person_count}
    return rows.fillna({k: v for k, v in values.items() if k in rows.columns})


# Page markers of a well loaded capture.
CAPTURE_MARKERS = {
    "comments": ("全部评论",), "published": ("发布时间：",), "report": ("举报",), "loading": ("视频数据加载中", "加载中"),
}


def capture_score(html: Column, body: Column, markers: Mapping[str, Sequence[str]] = CAPTURE_MARKERS) -> Column:
    """How complete a page capture looks."""
    def bonus(name: str, points: int) -> Column:
        return F.when(has_any(body, markers[name]), points).otherwise(0)

    return (
        F.length(body) + bonus("comments", 1200) + bonus("published", 900) + bonus("report", 400) + bonus("loading", -500)
        + F.least(F.lit(500), occurrences(F.lower(html), ("comment",)))
    )


