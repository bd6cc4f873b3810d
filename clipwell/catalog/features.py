"""Bound feature jobs over observation rows."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.registry import query
from clipwell.catalog.texts import OVERLAP_SQL, any_sql
from clipwell.functions import lexicons as lx
from clipwell.plans import features as ft

HOOKS = ("the", "les", "der", "que")
KEYWORDS = "the|eau|ung"
PARTS = {"has_hook": ("The", "Le"), "has_pain_point": ("und", "and"), "has_method": ("tion",), "has_example": ("que", "ing"), "has_cta": ("er.", "le.")}
KNOWLEDGE = ("the", "eau", "ung")


def segments(t):
    return t.raw("conversations").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("segment_no"), (F.col("turn") * 10.0).alias("start"),
        (F.col("turn") * 10.0 + F.length("text") / 64.0).alias("end"), "text",
    )


_PUNCT = lx.SPEECH_PUNCTUATION.replace("'", "''")
_CPM = "CASE WHEN dur > 0 THEN chars / dur * 60.0::DOUBLE ELSE 0 END"
_PAUSE = "CASE WHEN dur > 0 THEN greatest(0, least(1, 1.0::DOUBLE - speech / dur)) ELSE 0 END"


@query("fea1_speech_features", f"""WITH s AS (SELECT conv_id AS video_id, trim(string_agg(trim(text), '' ORDER BY turn)) AS t, count(*) AS n,
  CAST(sum(length(regexp_replace(trim(text), '{_PUNCT}', '', 'g'))) AS BIGINT) AS chars, sum(length(text) / 64.0::DOUBLE) AS speech,
  max(turn * 10.0::DOUBLE + length(text) / 64.0::DOUBLE) AS dur FROM conversations GROUP BY 1) SELECT video_id, n AS segments_count,
  {b.even(_CPM, 2)} AS speech_rate_cpm, {b.even(_PAUSE, 3)} AS pause_ratio, least(1.0::DOUBLE, ({" + ".join(
    f"contains(left(t, 80), '{h}')::INT" for h in HOOKS)}) / 2.0::DOUBLE) AS opening_hook_score, {b.even('dur', 3)} AS duration_sec,
  left(t, 80) AS opening FROM s""")
def _(t):
    return ft.speech_features(segments(t), hooks=HOOKS)


@query("fea1_transcripts", """SELECT conv_id AS video_id, 0 AS part_no, string_agg(trim(text), '' ORDER BY turn) AS transcript
  FROM conversations GROUP BY ALL""")
def _(t):
    return ft.transcripts(segments(t))


_OV = OVERLAP_SQL.format(a="joined", b="prev")


@query("fea2_subtitle_features", f"""WITH f AS (SELECT conv_id AS video_id, turn, string_split(text, chr(10)) AS lines,
  array_to_string(string_split(text, chr(10)), '') AS joined FROM conversations), p AS (SELECT *, lag(joined) OVER (PARTITION BY video_id ORDER BY turn)
  AS prev FROM f WHERE trim(joined) <> ''), c AS (SELECT video_id, round_even(CASE WHEN count(*) = 1 THEN 1 ELSE avg(CASE WHEN prev IS NOT NULL
  THEN {_OV} END) END, 4) AS steady FROM p GROUP BY 1), l AS (SELECT DISTINCT video_id, unnest(lines) AS line FROM f), m AS (SELECT video_id,
  CAST(sum(length(ct)) AS BIGINT) AS size, sum(length(regexp_replace(ct, '[^\\p{{L}}\\p{{N}}]', '', 'g'))) AS readable,
  sum(len(regexp_extract_all(ct, '{KEYWORDS}'))) AS found FROM (SELECT video_id, regexp_replace(line, '[\\s\\p{{Z}}]+', '', 'g') AS ct FROM l
  WHERE trim(line) <> '') GROUP BY 1), n AS (SELECT video_id, count(*) AS frames_count, count(*) FILTER (len(lines) > 0) AS filled FROM f GROUP BY 1)
  SELECT video_id, frames_count, round_even(filled / frames_count, 4) AS coverage_ratio,
  {b.even("readable / size * 0.7::DOUBLE + least(1.0::DOUBLE, size / 80.0::DOUBLE) * 0.3::DOUBLE", 4)} AS readability_score,
  {b.even("least(1.0::DOUBLE, found * 6.0::DOUBLE / size)", 4)} AS keyword_density, coalesce(steady, 0) AS subtitle_consistency_score
  FROM n LEFT JOIN m USING (video_id) LEFT JOIN c USING (video_id)""")
def _(t):
    frames = t.raw("conversations").select(
        F.col("conv_id").alias("video_id"), F.col("turn").alias("frame_no"), F.split("text", "\n").alias("lines")
    )
    return ft.subtitle_features(frames, keywords=KEYWORDS)


def frames(t):
    """Embeddings as frames of post ``label``: the first values give the boxes."""
    v = lambda i: F.abs(F.element_at("embedding", i).cast("double"))
    box = lambda i: F.struct(
        v(i).alias("x"), v(i + 1).alias("y"), v(i + 2).alias("w"), v(i + 3).alias("h"), (v(i + 2) * v(i + 3)).alias("area")
    )
    none = F.slice(F.array(box(1)), 1, 0)
    return t.raw("embeddings").select(
        F.col("label").cast("bigint").alias("video_id"), F.col("vec_id").alias("frame_no"),
        F.when(v(9) > 0.1, F.array(box(1), box(2))).otherwise(none).alias("faces"),
        F.when(v(10) > 0.05, F.array(box(3))).otherwise(none).alias("people"),
        F.when(v(11) > 0.1, F.struct(v(4).alias("w"), v(5).alias("h"), F.floor(v(6) * 100).alias("landmark_count"))).alias("pose"),
    )


_E = "abs(CAST(embedding[{i}] AS DOUBLE))"
_e = lambda i: _E.format(i=i)
_boxsql = lambda i: f"{{'area': {_e(i + 2)} * {_e(i + 3)}, 'x': {_e(i)}, 'y': {_e(i + 1)}, 'w': {_e(i + 2)}, 'h': {_e(i + 3)}}}"
_center = lambda s: b.even(f"greatest(0, 1.0::DOUBLE - (abs({s}.x + {s}.w / 2 - 0.5::DOUBLE) + abs({s}.y + {s}.h / 2 - 0.5::DOUBLE)))", 3)


@query("fea3_person_features", f"""WITH f AS (SELECT label AS video_id, {_e(9)} > 0.1 AS hf, {_e(10)} > 0.05 AS hp, {_e(11)} > 0.1 AS ho,
  {_boxsql(1)} AS f1, {_boxsql(2)} AS f2, {_boxsql(3)} AS p1, {_e(4)} AS pw, {_e(5)} AS ph, CAST(floor({_e(6)} * 100) AS BIGINT) AS marks FROM embeddings),
  g AS (SELECT video_id, count(*) AS n, count(*) FILTER (hf) AS nf, count(*) FILTER (hp) AS np, count(*) FILTER (ho) AS npose,
  arg_max(CASE WHEN f1.area >= f2.area THEN f1 ELSE f2 END, greatest(f1.area, f2.area)) FILTER (hf) AS bf, arg_max(p1, p1.area) FILTER (hp) AS bp,
  arg_max({{'w': pw, 'h': ph, 'marks': marks}}, pw * ph) FILTER (ho) AS bo FROM f GROUP BY 1) SELECT CAST(video_id AS BIGINT) AS video_id, n AS frames_count,
  nf > 0 AS face_detected, {b.even("nf * 2 / n", 3)} AS face_count, {b.even("bf.area", 4)} AS face_ratio, {_center('bf')} AS face_center_score,
  {b.even("1.0::DOUBLE - nf / n", 3)} AS occlusion_risk, npose > 0 AS pose_detected, {b.even("least(1.0::DOUBLE, bo.marks / 25.0::DOUBLE)", 3)} AS
  facing_camera_score, bo.marks >= 10 AS upper_body_visible, {b.even("least(1.0::DOUBLE, (bo.w + bo.h) / 1.2::DOUBLE)", 3)} AS gesture_activity_score,
  {b.even("npose / n", 3)} AS stability_score, {b.even("np / n", 3)} AS person_count, {b.even("bp.w * bp.h", 4)} AS subject_ratio,
  {_center('bp')} AS subject_center_score, {b.even("greatest(0, 1.0::DOUBLE - bp.w * bp.h * 3.0::DOUBLE)", 3)} AS background_clutter_score FROM g""")
def _(t):
    return ft.person_features(frames(t))


_FRAMES = """fr AS (SELECT user_id AS video_id, value AS yavg, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS satavg,
  greatest(0, value * 2.0::DOUBLE - event_id % 50) AS span FROM events), fs AS (SELECT video_id, count(*) AS n, avg(yavg) AS b, avg(satavg) AS s, avg(span) AS c,
  max(yavg) - min(yavg) AS bs, max(satavg) - min(satavg) AS ss, max(span) - min(span) AS cs FROM fr GROUP BY 1)"""


def frame_rows(t):
    return t.raw("events").select(
        F.col("user_id").alias("video_id"), F.col("value").alias("yavg"), F.get_json_object("props", "$.k").cast("double").alias("satavg"),
        (F.col("value") * 2.0).alias("yhigh"), (F.col("event_id") % 50).alias("ylow"),
    )


@query("fea4_frame_summary", f"""WITH {_FRAMES} SELECT video_id, n AS sampled_frames, {b.even('b', 3)} AS avg_brightness, {b.even('s', 3)} AS avg_saturation,
  {b.even('c', 3)} AS avg_contrast_span, {b.even('bs', 3)} AS brightness_spread, {b.even('ss', 3)} AS saturation_spread, {b.even('cs', 3)} AS contrast_spread,
  CASE WHEN b >= 150 THEN 'bright' WHEN b >= 95 THEN 'balanced' ELSE 'dark' END AS brightness_level,
  CASE WHEN s >= 55 THEN 'high' WHEN s >= 20 THEN 'medium' ELSE 'low' END AS saturation_level,
  CASE WHEN c >= 140 THEN 'high' WHEN c >= 80 THEN 'medium' ELSE 'low' END AS contrast_level,
  CASE WHEN bs * 0.45::DOUBLE + ss * 0.25::DOUBLE + cs * 0.30::DOUBLE >= 45 THEN 'dynamic' WHEN bs * 0.45::DOUBLE + ss * 0.25::DOUBLE + cs * 0.30::DOUBLE >= 18
  THEN 'mixed' ELSE 'stable' END AS visual_rhythm_hint FROM fs""")
def _(t):
    return ft.frame_summary(frame_rows(t))


@query("fea4_content_features", f"""WITH {_FRAMES}, x AS (SELECT o_orderkey AS video_id, o_custkey * 3 AS width, o_orderkey % 4000 AS height, o_totalprice / 5000.0::DOUBLE
  AS d, o_custkey * 4000 AS br, CASE WHEN b >= 150 THEN 'bright' WHEN b >= 95 THEN 'balanced' ELSE 'dark' END AS bl, CASE WHEN s >= 55 THEN 'high' WHEN s >= 20
  THEN 'medium' ELSE 'low' END AS sl, CASE WHEN c >= 140 THEN 'high' WHEN c >= 80 THEN 'medium' ELSE 'low' END AS cl, CASE WHEN bs * 0.45::DOUBLE + ss * 0.25::DOUBLE
  + cs * 0.30::DOUBLE >= 45 THEN 'dynamic' ELSE 'other' END AS rh FROM orders JOIN fs ON fs.video_id = o_custkey % 150) SELECT video_id,
  CASE WHEN height > width THEN 'portrait' WHEN width > height THEN 'landscape' ELSE 'square' END AS orientation,
  CASE WHEN d >= 45 THEN 'long' WHEN d >= 15 THEN 'medium' ELSE 'short' END AS duration_bucket, CASE WHEN greatest(width, height) >= 3000 THEN '4k_like'
  WHEN greatest(width, height) >= 1800 THEN 'high' WHEN greatest(width, height) >= 1000 THEN 'standard' ELSE 'low' END AS resolution_tier,
  CASE WHEN br >= 4000000 THEN 'high' WHEN br >= 1500000 THEN 'medium' WHEN br > 0 THEN 'low' ELSE 'unknown' END AS bitrate_tier,
  concat_ws(',', CASE WHEN rh = 'dynamic' THEN 'dynamic_visual_pacing' END, CASE WHEN bl = 'dark' THEN 'low_exposure_risk' END, CASE WHEN cl = 'high' THEN
  'subject_separation_good' END, CASE WHEN sl = 'low' THEN 'soft_color_style' END, CASE WHEN sl = 'medium' AND bl = 'balanced' THEN 'clean_educational_style' END)
  AS visual_tags FROM x""")
def _(t):
    o = t.raw("orders").select(
        F.col("o_orderkey").alias("post"), (F.col("o_custkey") % 150).alias("video_id"), (F.col("o_custkey") * 3).alias("width"),
        (F.col("o_orderkey") % 4000).alias("height"), (F.col("o_totalprice") / 5000.0).alias("duration_sec"), (F.col("o_custkey") * 4000).alias("bit_rate"),
    )
    out = ft.content_features(o.join(ft.frame_summary(frame_rows(t)), "video_id"))
    return out.select(
        F.col("post").alias("video_id"), "orientation", "duration_bucket", "resolution_tier", "bitrate_tier",
        F.array_join("visual_tags", ",").alias("visual_tags"),
    )


_NT = r"trim(regexp_replace(text, '[\s 　]+', ' ', 'g'))"
_flag = {n: any_sql({"has_hook": "left(nt, 80)", "has_cta": "right(nt, 120)"}.get(n, "nt"), w) for n, w in PARTS.items()}
_occ = " + ".join(f"(length(nt) - length(replace(nt, '{w}', ''))) // {len(w)}" for w in KNOWLEDGE)
_SCRIPT = f"""s AS (SELECT doc_id AS video_id, {_NT} AS nt FROM documents), sc AS (SELECT video_id, length(nt) AS text_length, {", ".join(
    f"{c} AS {n}" for n, c in _flag.items())}, {b.even(f"greatest(0, least(1, ({_occ}) / greatest(3.0::DOUBLE, length(nt) / 80.0::DOUBLE)))", 3)}
    AS knowledge_density_score FROM s), structured AS (SELECT *, {b.even("(" + " + ".join(f"{n}::INT" for n in PARTS) + ") / 5.0::DOUBLE", 3)} AS
    structure_completeness_score, concat_ws(',', {", ".join(f"CASE WHEN NOT {n} THEN '{n}' END" for n in PARTS)}) AS missing_parts FROM sc)"""


def structured(t):
    d = t.raw("documents").select(F.col("doc_id").alias("video_id"), "text")
    return ft.script_structure(d, "text", PARTS, KNOWLEDGE).drop("text")


@query("fea5_script_structure", f"WITH {_SCRIPT} SELECT * FROM structured")
def _(t):
    return structured(t).withColumn("missing_parts", F.array_join("missing_parts", ","))


@query("fea5_script_summary", f"""WITH {_SCRIPT} SELECT {b.mean('avg(structure_completeness_score)', 3)} AS average_structure_completeness,
  {b.mean('avg(knowledge_density_score)', 3)} AS average_knowledge_density FROM structured""")
def _(t):
    return structured(t).agg(*ft.script_summary())


_FULL = "concat_ws(' ', nullif(title, ''), nullif(lang, ''), nullif(text, ''))"
_OPEN = "trim(title || ' ' || left(text, 80))"
_mark = lambda c: f"(contains({c}, '?') OR contains({c}, '？'))"
_hook = lambda c: f"({any_sql(c, HOOKS)} OR {_mark(c)})"
PRE = {"pain": ("und", "and"), "method": ("tion",), "example": ("que", "ing")}


@query("fea6_prepublish_features", f"""WITH {b.POSTS}, x AS (SELECT video_id, {_FULL} AS ft, {_OPEN} AS op FROM posts) SELECT video_id,
  ({_hook('ft')}::INT + {" + ".join(f"{any_sql('ft', w)}::INT" for w in PRE.values())} + {any_sql('ft', ("er.", "le."))}::INT) / 5.0::DOUBLE AS structure_completeness,
  round_even(least(1.0::DOUBLE, ({" + ".join(f"contains(ft, '{w}')::INT" for w in KNOWLEDGE)} + (length(ft) >= 80)::INT) / 7.0::DOUBLE), 6) AS knowledge_density,
  round_even(least(1.0::DOUBLE, 0.35::DOUBLE + CASE WHEN {_hook('op')} THEN 0.35::DOUBLE ELSE 0 END + CASE WHEN {_mark('op')} THEN 0.15::DOUBLE ELSE 0 END
  + CASE WHEN length(op) <= 70 THEN 0.15::DOUBLE ELSE 0 END), 6) AS opening_hook_score FROM x""")
def _(t):
    out = ft.prepublish_features(t.posts(), F.col("title"), F.col("lang"), F.col("text"), HOOKS, ("er.", "le."), PRE, KNOWLEDGE)
    return out.select(
        "video_id", "structure_completeness", F.bround("knowledge_density", 6).alias("knowledge_density"),
        F.bround("opening_hook_score", 6).alias("opening_hook_score"),
    )
