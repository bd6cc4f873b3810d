"""Bound rule models: accounts, fit, fusion, effect and the report tables on top."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.aggregates import IDEAL, JUDGED, PROFILE, RATED, judged, ranges_sql, rated
from clipwell.catalog.filters import TRUSTED, modalities, trusted
from clipwell.catalog.registry import query
from clipwell.catalog.texts import GRADE, TITLE_WORDS, any_sql
from clipwell.functions import messages as ms
from clipwell.functions.text import TITLE_FLAGS, title_features
from clipwell.operators import aggregates as ag
from clipwell.operators.joins import with_metrics
from clipwell.plans import accounts as ac
from clipwell.plans import effect as ef
from clipwell.plans import engagement as en
from clipwell.plans import fusion as fu
from clipwell.plans import reports as rp
from clipwell.plans import rounds as ro
from clipwell.plans import video_fit as vf
from clipwell.plans import visual_fit as vi

CLAMP = "CAST(greatest(0, least(100, round_even({x}, 0))) AS BIGINT)"


def clamp(x: str) -> str:
    return CLAMP.format(x=x)


def notes_sql(rules, sep: str = "|") -> str:
    """SQL twin of a note list: texts of the conditions that hold, joined."""
    return f"concat_ws('{sep}', " + ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in rules) + ")"


def listed(name: str, df, *cols):
    """Array columns as joined text, for comparison."""
    return df.withColumns({c: F.array_join(c, name) for c in cols})


_share = lambda c: f"greatest(0, least(1, coalesce({c} / nullif(greatest(1, (SELECT max({c}) FROM batch)), 0), 0)))"
ACCOUNTS = f"""{b.BATCH}, a1 AS (SELECT *,
  {clamp(f"100.0::DOUBLE * (0.60::DOUBLE * {_share('videos_seen')} + 0.25::DOUBLE * {_share('detail_success')} + 0.15::DOUBLE * {_share('comments_success')})")} AS activity_score,
  {clamp("coalesce(100.0::DOUBLE * detail_success / nullif(videos_seen, 0), 0)")} AS execution_score,
  {clamp("coalesce(100.0::DOUBLE * comments_success / nullif(detail_success, 0), 0)")} AS interaction_score,
  {clamp("100 - 12 * warnings_count - CASE WHEN (SELECT sum(failed_count) FROM batch) > 0 THEN 3 ELSE 0 END")} AS stability_score FROM batch),
  scored AS (SELECT *, {clamp("activity_score * 0.30::DOUBLE + execution_score * 0.30::DOUBLE + interaction_score * 0.25::DOUBLE + stability_score * 0.15::DOUBLE")} AS total_score FROM a1)"""


def accounts(t):
    return ac.account_scores(t.batch_accounts())


@query("sco1_account_scores", f"""WITH {ACCOUNTS} SELECT account_id, activity_score, execution_score, interaction_score, stability_score,
  total_score, least(100, warnings_count * 12) AS warning_penalty, {b.even("coalesce(detail_success / nullif(videos_seen, 0), 0) * 100", 2)}
  AS detail_success_rate, row_number() OVER (ORDER BY total_score DESC, activity_score DESC, account_id) AS rank FROM scored""")
def _(t):
    return ac.ranked_accounts(accounts(t), "account_id").select(
        "account_id", "activity_score", "execution_score", "interaction_score", "stability_score", "total_score",
        "warning_penalty", "detail_success_rate", "rank",
    )


_low = {"activity": "activity_score < 60", "execution": "execution_score < 70", "interaction": "interaction_score < 60",
        "stability": "stability_score < 70"}
_none = "NOT (" + " OR ".join(_low.values()) + ")"
_M = ms.ACCOUNT


@query("sco2_recommendations", f"""WITH {ACCOUNTS} SELECT account_id, CASE WHEN total_score >= 85 THEN 'low' WHEN total_score >= 70
  THEN 'medium' ELSE 'high' END AS priority, {notes_sql([(c, n) for n, c in _low.items()], ',')} AS focus_areas,
  {notes_sql([*[(c, _M[n + '_reason']) for n, c in _low.items()], (_none, _M['balanced_reason'])], _M['separator'])} AS reason,
  {notes_sql([(_low['activity'], _M['activity_action']), ('NOT ' + _low['activity'], _M['activity_keep']),
  *[(_low[n], _M[n + '_action']) for n in ('execution', 'interaction', 'stability')], (_none, _M['balanced_action'])])} AS actions FROM scored""")
def _(t):
    out = ac.ordered_recommendations(accounts(t), "account_id")
    out = listed(",", out, "focus_areas")
    return listed("|", out, "actions").select("account_id", "priority", "focus_areas", "reason", "actions")


@query("sco4_engagement_proxy", f"WITH {RATED} SELECT video_id, engagement_score FROM rated")
def _(t):
    m = t.videos().join(t.metrics(), "video_id", "left").fillna(0, subset=list(ag.METRICS))
    return m.select("video_id", en.engagement_proxy().alias("engagement_score"))


_points = notes_sql([(f"top_{f} - weak_{f} >= 0.2", ms.TIPS_TITLES[f]) for f in
                     ("has_grade", "has_method", "has_material", "has_parent_child", "has_interaction")])
_profs = ", ".join(
    f"round_even(avg({f}) FILTER (up <= 5), 3) AS top_{f}, round_even(avg({f}) FILTER (down <= 5), 3) AS weak_{f}" for f in PROFILE
)


@query("sco5_improvement_points", f"""WITH {RATED}, p AS (SELECT account_id, {_profs} FROM (SELECT *,
  row_number() OVER (PARTITION BY account_id ORDER BY engagement_score DESC, video_id) AS up,
  row_number() OVER (PARTITION BY account_id ORDER BY engagement_score, video_id) AS down FROM rated) GROUP BY account_id)
  SELECT account_id, coalesce(nullif(array_to_string(string_split({_points}, '|')[1:4], '|'), ''), '{ms.TIPS_TITLES["none"]}')
  AS improvement_points FROM p""")
def _(t):
    prof = ag.head_tail_profiles(rated(t), "account_id", "engagement_score", "video_id", PROFILE)
    return listed("|", rp.improvement_points(prof, "account_id", ms.TIPS_TITLES), "improvement_points")


_r = {k: f"coalesce({k}_count / nullif(view_count, 0), 0)" for k in ("like", "comment", "share")}
FITTED = f"""{ACCOUNTS}, {RATED}, f1 AS (SELECT r.*, {_r['like']} AS lr, {_r['comment']} AS cr, {_r['share']} AS sr,
  coalesce(s.total_score, 50) AS prior FROM rated r LEFT JOIN scored s ON s.account_id = r.video_id),
  f2 AS (SELECT *, {clamp("100.0::DOUBLE * (least(lr / 0.08::DOUBLE, 1) * 0.55::DOUBLE + least(cr / 0.012::DOUBLE, 1) * 0.30::DOUBLE + least(sr / 0.006::DOUBLE, 1) * 0.15::DOUBLE)")} AS es,
  CASE WHEN view_count <= 0 THEN 0 WHEN view_count < 100 THEN 18 WHEN view_count < 500 THEN 40 WHEN view_count < 2000 THEN 65
  WHEN view_count < 10000 THEN 82 ELSE 92 END AS vs, CASE (view_count > 0)::INT + (like_count > 0)::INT + (comment_count > 0)::INT
  + (share_count > 0)::INT WHEN 4 THEN 100 WHEN 3 THEN 85 WHEN 2 THEN 70 WHEN 1 THEN 45 ELSE 0 END AS ks FROM f1),
  f3 AS (SELECT *, {clamp("es * 0.58::DOUBLE + vs * 0.18::DOUBLE + ks * 0.10::DOUBLE + prior * 0.14::DOUBLE")} AS fit_score FROM f2),
  fitted AS (SELECT *, CASE WHEN fit_score >= 75 THEN 'high' WHEN fit_score >= 45 THEN 'medium' ELSE 'low' END AS fit_level FROM f3)"""
_S, _R, _A = ms.FIT_STRENGTHS, ms.FIT_RISKS, ms.FIT_ACTIONS
_acts = notes_sql([
    ("fit_level = 'high'", _A["high_1"]), ("fit_level = 'high'", _A["high_2"]), ("fit_level = 'medium'", _A["medium_1"]),
    ("fit_level = 'medium'", _A["medium_2"]), ("fit_level = 'low'", _A["low_1"]), ("fit_level = 'low'", _A["low_2"]),
    ("cr < 0.003", _A["comments"]), ("sr < 0.001", _A["shares"]), ("lr < 0.03", _A["likes"]), ("fit_score >= 80", _A["sample"]),
])
_risks = notes_sql([("view_count < 50", _R["views"]), ("lr < 0.03", _R["likes"]), ("cr < 0.003", _R["comments"]),
                    ("sr < 0.001", _R["shares"]), ("prior < 40", _R["account"])])


def fitted(t):
    return vf.with_account_prior(rated(t).withColumnRenamed("account_id", "brand").withColumn("account_id", F.col("video_id")),
                                 accounts(t), "account_id")


@query("sco6_video_fit", f"""WITH {FITTED} SELECT video_id, fit_score, fit_level, es AS engagement_score, vs AS volume_score,
  ks AS consistency_score, prior AS account_prior_score, round_even(lr, 4) AS like_rate, {notes_sql([
    ("view_count >= 1000", _S["views_1000"]), ("view_count >= 100 AND view_count < 1000", _S["views_100"]), ("view_count < 100", _S["views_few"]),
    ("lr >= 0.08", _S["likes"]), ("cr >= 0.012", _S["comments"]), ("sr >= 0.006", _S["shares"]), ("prior >= 75", _S["account"])])} AS strengths,
  coalesce(nullif({_risks}, ''), '{_R["none"]}') AS risks, CASE WHEN len(string_split({_acts}, '|')) < 3 THEN {_acts} || '|{_A["keep"]}'
  ELSE {_acts} END AS actions FROM fitted""")
def _(t):
    out = listed("|", fitted(t), "strengths", "risks", "actions")
    return out.select(
        "video_id", "fit_score", "fit_level", "engagement_score", "volume_score", "consistency_score",
        "account_prior_score", "like_rate", "strengths", "risks", "actions",
    )


@query("sco7_batch_fit", f"""WITH {FITTED} SELECT account_id, count(*) AS total, {b.mean('avg(fit_score)', 2)} AS average_fit_score,
  {", ".join(f"count(*) FILTER (fit_level = '{n}') AS n_{n}, round_even(count(*) FILTER (fit_level = '{n}') / count(*), 4) AS {n}_ratio"
  for n in ("high", "medium", "low"))} FROM fitted GROUP BY account_id""")
def _(t):
    # Posts arrive nested under their crawl target and are exploded first.
    r = fitted(t).drop("account_id").withColumnRenamed("brand", "account_id")
    return r.groupBy("account_id").agg(*ag.level_distribution("fit_score", "fit_level"))


_VISUAL = """visual AS (SELECT o_orderkey AS video_id, CASE WHEN o_custkey % 3 = 0 THEN 'landscape' ELSE 'portrait' END AS orientation,
  o_totalprice / 5000.0::DOUBLE AS duration_sec, ['low', 'standard', 'high', '4k_like'][1 + o_custkey % 4] AS resolution_tier,
  ['low', 'medium', 'high', 'unknown'][1 + o_orderkey % 4] AS bitrate_tier, ['dark', 'balanced', 'bright'][1 + o_orderkey % 3] AS brightness_level,
  ['low', 'medium', 'high'][1 + o_custkey % 3] AS saturation_level, ['low', 'medium', 'high'][1 + (o_orderkey + o_custkey) % 3] AS contrast_level,
  ['dynamic', 'stable'][1 + o_orderkey % 2] AS visual_rhythm_hint, ['low', 'medium', 'high'][1 + o_custkey % 3] AS subtitle_readability,
  o_orderkey % 2 = 1 AS head, o_orderkey % 2 = 0 AS dyn, o_orderkey % 3 = 0 AS expo, o_custkey % 3 = 1 AND o_orderkey % 3 = 1 AS clean FROM orders)"""


def visual(t):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pick = lambda names, i: F.element_at(F.array(*[F.lit(x) for x in names]), (i + 1).cast("int"))
    lmh = ("low", "medium", "high")
    o = t.raw("orders").select(
        k.alias("video_id"), F.when(c % 3 == 0, "landscape").otherwise("portrait").alias("orientation"),
        (F.col("o_totalprice") / 5000.0).alias("duration_sec"),
        pick(("low", "standard", "high", "4k_like"), c % 4).alias("resolution_tier"),
        pick((*lmh, "unknown"), k % 4).alias("bitrate_tier"), pick(("dark", "balanced", "bright"), k % 3).alias("brightness_level"),
        pick(lmh, c % 3).alias("saturation_level"), pick(lmh, (k + c) % 3).alias("contrast_level"),
        pick(("dynamic", "stable"), k % 2).alias("visual_rhythm_hint"), pick(lmh, c % 3).alias("subtitle_readability"),
        F.array_compact(F.array(
            F.when(k % 2 == 1, "possible_talking_head"), F.when(k % 2 == 0, "dynamic_visual_pacing"),
            F.when(k % 3 == 0, "low_exposure_risk"), F.when((c % 3 == 1) & (k % 3 == 1), "clean_educational_style"),
        )).alias("visual_tags"),
    )
    return vi.visual_fit(o)


_G, _V, _W = ms.VISUAL_GOOD, ms.VISUAL_RISKS, ms.VISUAL_ACTIONS
_good = [
    ("orientation = 'portrait'", 12, _G["portrait"]), ("duration_sec BETWEEN 15 AND 50", 12, _G["duration"]),
    ("resolution_tier IN ('high', '4k_like')", 8, _G["resolution"]), ("brightness_level = 'balanced'", 8, _G["balanced"]),
    ("brightness_level = 'bright'", 3, _G["bright"]), ("contrast_level = 'high'", 6, _G["contrast"]),
    ("saturation_level = 'medium'", 5, _G["saturation_medium"]), ("saturation_level = 'high'", 1, _G["saturation_high"]),
    ("bitrate_tier = 'high'", 5, _G["bitrate"]), ("subtitle_readability = 'high'", 5, _G["subtitle"]), ("head", 6, _G["talking_head"]),
    ("clean", 5, _G["clean"]), ("dyn", 3, _G["dynamic"]),
]
_bad = [
    ("orientation <> 'portrait'", 10, _V["not_portrait"]), ("duration_sec < 8", 12, _V["too_short"]), ("duration_sec > 75", 8, _V["too_long"]),
    ("resolution_tier = 'low'", 10, _V["resolution"]), ("brightness_level = 'dark'", 6, _V["dark"]), ("contrast_level = 'low'", 5, _V["contrast"]),
    ("saturation_level = 'low'", 3, _V["saturation"]), ("bitrate_tier = 'low'", 4, _V["bitrate"]), ("subtitle_readability = 'low'", 7, _V["subtitle"]),
    ("expo", 5, _V["exposure"]),
]
_vscore = "50" + "".join(f" + CASE WHEN {c} THEN {p} ELSE 0 END" for c, p, _n in _good) + "".join(
    f" - CASE WHEN {c} THEN {p} ELSE 0 END" for c, p, _n in _bad)


@query("sco8_visual_fit", f"""WITH {_VISUAL}, x AS (SELECT *, CAST(greatest(0, least(100, {_vscore})) AS BIGINT) AS fit_score FROM visual),
  y AS (SELECT *, CASE WHEN fit_score >= 75 THEN 'high' WHEN fit_score >= 50 THEN 'medium' ELSE 'low' END AS fit_level FROM x)
  SELECT video_id, fit_score, fit_level, coalesce(nullif({notes_sql([(c, n) for c, _p, n in _good])}, ''), '{_G["none"]}') AS strengths,
  coalesce(nullif({notes_sql([(c, n) for c, _p, n in _bad])}, ''), '{_V["none"]}') AS risks, {notes_sql([
    *[(f"fit_level = '{x}'", _W[x]) for x in ("high", "medium", "low")], ("orientation <> 'portrait'", _W["not_portrait"]),
    ("brightness_level = 'dark'", _W["dark"]), ("contrast_level = 'low'", _W["contrast"]), ("saturation_level = 'low'", _W["saturation"]),
    ("duration_sec > 50", _W["over_50"]), ("duration_sec < 12", _W["under_12"]), ("head", _W["talking_head"]),
    ("dyn AND visual_rhythm_hint = 'dynamic'", _W["dynamic"]), ("subtitle_readability = 'low'", _W["subtitle_low"]),
    ("subtitle_readability = 'high'", _W["subtitle_high"])])} AS actions FROM y""")
def _(t):
    return listed("|", visual(t), "strengths", "risks", "actions").select(
        "video_id", "fit_score", "fit_level", "strengths", "risks", "actions"
    )


_face = "45.0::DOUBLE + face_center_score * 18.0::DOUBLE + structure_completeness * 17.0::DOUBLE + knowledge_density * 12.0::DOUBLE + CASE WHEN face_ratio > 0.02 THEN 8.0::DOUBLE ELSE -18.0::DOUBLE END - 0.1::DOUBLE * 15.0::DOUBLE"
_pose = "42.0::DOUBLE + pose_facing_score * 18.0::DOUBLE + subtitle_consistency * 16.0::DOUBLE + opening_hook_score * 12.0::DOUBLE + CASE WHEN pose_facing_score > 0.4 THEN 8.0::DOUBLE ELSE -8.0::DOUBLE END"
_who = "45.0::DOUBLE + knowledge_density * 18.0::DOUBLE + face_center_score * 18.0::DOUBLE + CASE WHEN floor(person_count) = 1 THEN 10.0::DOUBLE WHEN floor(person_count) > 1 THEN -10.0::DOUBLE ELSE -16.0::DOUBLE END - 0.25::DOUBLE * 12.0::DOUBLE"
_ocr = "40.0::DOUBLE + ocr_readability * 22.0::DOUBLE + knowledge_density * 16.0::DOUBLE + subtitle_consistency * 12.0::DOUBLE + 0.5::DOUBLE * 10.0::DOUBLE"
_asr = "45.0::DOUBLE + greatest(0, 1.0::DOUBLE - abs(speech_rate_cpm - 260.0::DOUBLE) / 220.0::DOUBLE) * 22.0::DOUBLE + opening_hook_score * 20.0::DOUBLE - 0.125::DOUBLE * 25.0::DOUBLE"
_flags = {"has_hook": "opening_hook_score > 0", "has_pain_point": "person_count > 0.5", "has_method": "knowledge_density > 0.3",
          "has_example": "face_ratio > 0.03", "has_cta": "subtitle_consistency > 0.5"}
_scr = "35.0::DOUBLE + (" + " + ".join(f"({c})::INT" for c in _flags.values()) + ") / 5.0::DOUBLE * 45.0::DOUBLE + knowledge_density * 20.0::DOUBLE"
_have = {"face_quality": "person_count > 0", "pose_quality": "subtitle_consistency > 0.2", "person_subject": "person_count < 2",
         "ocr_subtitle": "ocr_readability > 0.1", "asr_speech": "speech_rate_cpm < 300", "script_structure": "structure_completeness > 0.1"}
_raw = dict(zip(_have, (_face, _pose, _who, _ocr, _asr, _scr)))
_lack = "concat_ws('、', " + ", ".join(f"CASE WHEN NOT ({c}) THEN '{n}' END" for n, c in _flags.items()) + ")"
_flaw = {"face_quality": "NOT face_ratio > 0.02", "pose_quality": "pose_quality_raw < 60", "person_subject": "floor(person_count) <> 1",
         "ocr_subtitle": "ocr_subtitle_raw < 60", "asr_speech": "asr_speech_raw < 60"}
_fs, _fr, _fa = [("local", "'ok'")], [("NOT local", f"'{ms.FUSION['local_visual'][3]}'")], [("NOT local", f"'{ms.FUSION['local_visual'][4]}'")]
for _n, _c in _have.items():
    _good_text, _bad_text, _act, _gap, _todo = ms.FUSION[_n]
    _fs.append((f"{_c} AND {_n}_raw >= {75 if _n == 'script_structure' else 70}", f"'{_good_text}'"))
    if _n == "script_structure":
        _fr.append((f"({_c}) AND {_lack} <> ''", f"'{_bad_text}' || {_lack}"))
    else:
        _fr.append((f"({_c}) AND ({_flaw[_n]})", f"'{_bad_text}'"))
    _fr.append((f"NOT ({_c})", f"'{_gap}'"))
    _fa += [(_c, f"'{_act}'"), (f"NOT ({_c})", f"'{_todo}'")]
_list = lambda rules, cap: (
    "array_to_string(list_filter([" + ", ".join(f"CASE WHEN {c} THEN {v} END" for c, v in rules) + f"], lambda x: x IS NOT NULL)[1:{cap}], '|')"
)
_w = fu.WEIGHTS


@query("sco9_fusion", f"""WITH {b.FEATURES}, f1 AS (SELECT *, video_id % 4 > 0 AS local, {", ".join(f"{r} AS {n}_raw" for n, r in _raw.items())}
  FROM features), f2 AS (SELECT *, {clamp("CASE WHEN local THEN fit_score ELSE 45 END")} AS local_visual_score, {", ".join(
    clamp(f"CASE WHEN {c} THEN {n}_raw ELSE 35 END") + f" AS {n}_score" for n, c in _have.items())} FROM f1),
  f3 AS (SELECT * EXCLUDE (fit_score), {clamp(" + ".join(f"{n}_score * {w}::DOUBLE" for n, w in _w.items()))} AS fit_score FROM f2)
  SELECT video_id, fit_score, CASE WHEN fit_score >= 75 THEN 'high' WHEN fit_score >= 55 THEN 'medium' ELSE 'low' END AS fit_level,
  {", ".join(f"{n}_score" for n in _w)}, {_list(_fs, 8)} AS strengths, {_list(_fr, 10)} AS risks, {_list(_fa, 10)} AS actions FROM f3""")
def _(t):
    return listed("|", fused(t), "strengths", "risks", "actions").select(
        "video_id", "fit_score", "fit_level", *[f"{n}_score" for n in fu.WEIGHTS], "strengths", "risks", "actions"
    )


def fused(t):
    local = t.features().select("video_id", F.when(F.col("video_id") % 4 > 0, F.struct(
        "fit_score", F.array(F.lit("ok")).alias("strengths"),
    )).alias("local_video_fit"))
    return fu.fuse(modalities(t).join(local, "video_id"))


PLANNED = {"english": ("red", "blue"), "french": ("widget",), "german": ("gear", "ring"), "spanish": ("large",)}
DEMAND = ("english", "german")
HOOKS, CTA, ASKING = ("small", "large"), ("gizmo", "green"), ("bolt", "plate")
SOURCES = f"""{TRUSTED}, ok AS (SELECT *, row_number() OVER (ORDER BY trusted_engagement_score DESC, video_id) AS re,
  row_number() OVER (ORDER BY comment_count DESC, video_id) AS rc, greatest(1, CAST(floor(count(*) OVER () * 0.25::DOUBLE) AS BIGINT)) AS k
  FROM trusted WHERE NOT metric_suspicious), ideal AS (SELECT * FROM ok WHERE re <= k OR rc <= k)"""


@query("sco10_ideal_profile", f"WITH {SOURCES}, r AS ({ranges_sql('ideal')}) SELECT * FROM r")
def _(t):
    return ef.train_profile(ef.ideal_sources(trusted(t)))


_WEIGHTS = f"""{JUDGED}, tc AS (SELECT topic, count(*) AS n FROM (SELECT video_id, unnest(topics) AS topic FROM judged)
  WHERE video_id IN (SELECT video_id FROM ideal) GROUP BY topic), hot AS (SELECT topic FROM tc ORDER BY n DESC, topic LIMIT 5),
  demand(topic) AS (VALUES ('english'), ('german')), priced AS (SELECT coalesce(d.topic, h.topic) AS topic, CASE WHEN h.topic IS NULL THEN 4
  WHEN d.topic IS NULL THEN 4 ELSE 6 END AS weight FROM demand d FULL JOIN hot h USING (topic))"""


@query("sco10_topic_weights", f"WITH {SOURCES}, {_WEIGHTS} SELECT topic, weight FROM priced")
def _(t):
    return ef.train_topics(ef.ideal_sources(trusted(t)), judged(t), demand=DEMAND)


_rs = lambda f, scale: (
    f"(SELECT CASE WHEN {f} BETWEEN low AND high THEN 100 ELSE greatest(0, 100.0::DOUBLE - least(abs({f} - low), abs({f} - high), "
    f"abs({f} - mid)) / {scale}::DOUBLE * 100.0::DOUBLE) END FROM prof WHERE feature = '{f}')"
)
_topics_found = "list_filter([" + ", ".join(f"CASE WHEN {any_sql('lower(title)', w)} THEN '{n}' END" for n, w in PLANNED.items()) + "], lambda x: x IS NOT NULL)"
_e = ms.EFFECT_RISKS
EFFECT = f"""{SOURCES}, {_WEIGHTS}, prof AS ({ranges_sql('ideal')}), e1 AS (SELECT *, {_topics_found} AS tf FROM trusted),
  e2 AS (SELECT *, CASE WHEN len(tf) = 0 THEN ['none'] ELSE tf END AS planned, (({_rs('fit_score', 100)} + {_rs('ocr_readability', 1)}
  + {_rs('subtitle_consistency', 1)} + {_rs('face_center_score', 1)} + {_rs('pose_facing_score', 1)}
  + greatest(0, 100.0::DOUBLE - abs(speech_rate_cpm - (SELECT mid FROM prof WHERE feature = 'speech_rate_cpm')) / 220.0::DOUBLE * 100.0::DOUBLE)
  + CASE WHEN person_count <= 1.2 THEN 100 WHEN person_count <= 1.8 THEN 80 ELSE greatest(20, 80.0::DOUBLE - (person_count - 1.8::DOUBLE) * 16.0::DOUBLE) END)
  / 7.0::DOUBLE) AS production, least(100, 35.0::DOUBLE + structure_completeness * 35.0::DOUBLE + knowledge_density * 15.0::DOUBLE
  + opening_hook_score * 15.0::DOUBLE + CASE WHEN {any_sql('title', HOOKS)} THEN 8 ELSE 0 END + CASE WHEN {any_sql('title', CTA)} THEN 7 ELSE 0 END) AS structure
  FROM e1), pay AS (SELECT video_id, sum(coalesce(weight, 4)) AS paid FROM (SELECT video_id, unnest(planned) AS topic FROM e2)
  LEFT JOIN priced USING (topic) GROUP BY 1), e3 AS (SELECT *, least(100, 35.0::DOUBLE + least(30, paid) + CASE WHEN {any_sql('title', ASKING)} THEN 12 ELSE 0 END
  + CASE WHEN {any_sql('title', CTA)} THEN 15 ELSE 0 END + CASE WHEN list_has_any(planned, ['english', 'german']) THEN 8 ELSE 0 END) AS potential FROM e2 JOIN pay USING (video_id)),
  effects AS (SELECT *, production * 0.55::DOUBLE + structure * 0.25::DOUBLE + potential * 0.20::DOUBLE AS final,
  {notes_sql([("structure_completeness < 0.3", _e["structure"]), ("subtitle_consistency < 0.45", _e["subtitle"]), ("person_count > 1.8", _e["subject"]),
    ("trim(title) = ''", _e["no_text"]), ("planned = ['none']", _e["no_topic"])])} AS risks FROM e3)"""


def effects(t):
    rows = trusted(t)
    ideal = ef.ideal_sources(rows)
    return ef.effect_scores(
        rows, ef.train_profile(ideal), ef.train_topics(ideal, judged(t), demand=DEMAND), planned=PLANNED, no_topic="none",
        demand=DEMAND, hooks=HOOKS, cta=CTA, asking=ASKING, lead_topics=("english", "french"),
    )


_ea = ms.EFFECT_ACTIONS


@query("sco11_effect_scores", f"""WITH {EFFECT} SELECT video_id, {b.even('final', 2)} AS effect_score, CASE WHEN final >= 80 THEN 'excellent'
  WHEN final >= 65 THEN 'good' WHEN final >= 50 THEN 'medium' ELSE 'weak' END AS effect_level, {b.even('production', 2)} AS
  production_quality_score, {b.even('structure', 2)} AS content_structure_score, {b.even('potential', 2)} AS comment_potential_score,
  array_to_string(planned, ',') AS planned_topics, risks, CASE WHEN acts = '' AND risks = '' THEN '{_ea["steady"]}' ELSE acts END AS actions,
  'view_count,like_count,comment_count,share_count,engagement_score' AS ignored FROM (SELECT *, {notes_sql([("planned = ['none']", _ea["no_topic"]),
  ("structure_completeness < 0.3", _ea["structure"]), ("person_count > 1.8", _ea["subject"]), ("list_has_any(planned, ['english', 'french'])", _ea["demand"])])}
  AS acts FROM effects)""")
def _(t):
    out = listed("|", effects(t), "risks", "actions")
    return listed(",", out, "planned_topics", "ignored_runtime_fields").select(
        "video_id", "effect_score", "effect_level", "production_quality_score", "content_structure_score",
        "comment_potential_score", "planned_topics", "risks", "actions", F.col("ignored_runtime_fields").alias("ignored"),
    )


@query("agg28_account_effects", f"""WITH {EFFECT}, r AS (SELECT source_name, risk, row_number() OVER (PARTITION BY source_name ORDER BY
  count(*) DESC, risk) AS i FROM (SELECT source_name, unnest(string_split(risks, '|')) AS risk FROM effects WHERE risks <> '') GROUP BY source_name, risk)
  SELECT source_name, count(*) AS video_count, {b.mean(f'avg({b.even("final", 2)})', 2)} AS avg_effect_score,
  {b.mean(f'avg({b.even("production", 2)})', 2)} AS avg_production_quality_score, {b.mean(f'avg({b.even("potential", 2)})', 2)}
  AS avg_comment_potential_score, coalesce(max(r.risk), '{ms.EFFECT_TIP}') AS tip FROM effects LEFT JOIN
  (FROM r WHERE i = 1) r USING (source_name) GROUP BY source_name""")
def _(t):
    return ef.account_effects(effects(t))


@query("sco15_rerun_hints", f"""WITH {b.BATCH} SELECT account_id, CASE WHEN failed_count > 5 OR videos_seen <= 0 THEN 'high'
  WHEN detail_success = 0 AND comments_success = 0 THEN 'high' WHEN comments_success < 12 THEN 'medium' ELSE 'low' END AS hint FROM batch""")
def _(t):
    status = F.when(F.col("failed_count") > 5, "failed").otherwise("success")
    meaningful = F.greatest(F.lit(0), F.col("comments_success") - 11)
    return t.batch_accounts().select(
        "account_id", rp.rerun_hint(status, F.col("videos_seen"), F.col("detail_success"), meaningful).alias("hint")
    )


_means = [("fit_score", 2), ("engagement_score", 2), ("ocr_readability", 3), ("structure_completeness", 3), ("person_count", 2)]
_T = ms.TIPS_MULTIMODAL


@query("sco17_account_findings", f"""WITH {b.FEATURES} SELECT source_name, count(*) AS video_count, {", ".join(
    f"{b.mean(f'avg({c})', d)} AS average_{c}" for c, d in _means)}, coalesce(nullif({notes_sql([
    ("avg(structure_completeness) < 0.3", _T["structure"]), ("avg(subtitle_consistency) < 0.5", _T["subtitle"]), ("avg(person_count) > 1.5", _T["subject"]),
    ("avg(face_center_score) < 0.75", _T["face"]), ("avg(speech_rate_cpm) > 340", _T["speed"])])}, ''), '{_T["none"]}') AS recommendations
  FROM features GROUP BY source_name""")
def _(t):
    return listed("|", rp.mean_findings(t.features(), "source_name", ms.TIPS_MULTIMODAL, speed=True), "recommendations")


_C = ms.TIPS_COMMENTS
_NAMES = {"material": "english", "exam": "french", "parent": "german", "doubt": "passive"}


@query("sco17_comment_advice", f"""WITH {JUDGED}, st AS (SELECT account_id, count(*) AS n, count(*) FILTER (is_author_reply) AS rep FROM judged
  GROUP BY 1), tp AS (SELECT account_id, list(topic) AS ts FROM (SELECT account_id, topic, row_number() OVER (PARTITION BY account_id
  ORDER BY count(*) DESC, topic) AS i FROM (SELECT account_id, unnest(topics) AS topic FROM judged) GROUP BY account_id, topic) WHERE i <= 3 GROUP BY 1),
  m AS (SELECT source AS account_id, avg(doc_id % 10) / 10.0::DOUBLE AS s FROM documents GROUP BY 1) SELECT account_id, coalesce(n, 0) AS comments,
  coalesce(nullif({notes_sql([("list_contains(ts, 'english')", _C["material"]), ("list_contains(ts, 'french') OR list_contains(ts, 'german')", _C["exam"]),
    ("list_contains(ts, 'passive')", _C["doubt"]), ("rep = 0 AND n > 0", _C["reply"]), ("s < 0.45", _C["structure"])])}, ''), '{_C["none"]}') AS advice
  FROM m LEFT JOIN st USING (account_id) LEFT JOIN tp USING (account_id)""")
def _(t):
    j = judged(t)
    stats = ag.comment_stats(j, ["account_id"], "video_id", "asking")
    mean = t.raw("documents").groupBy(F.col("source").alias("account_id")).agg(
        (F.avg(F.col("doc_id") % 10) / 10.0 - 0.15).alias("mean_structure")
    )
    out = rp.comment_advice(stats, ag.top_topics(j, "topics", ["account_id"]), mean, "account_id", _C, _NAMES)
    return listed("|", out, "advice")


_Q = ms.TIPS_SHORT


@query("sco18_trusted_accounts", f"""WITH {TRUSTED} SELECT source_name, count(*) AS video_count, count(*) FILTER (NOT metric_suspicious) AS
  trusted_metric_count, count(*) FILTER (metric_suspicious) AS suspicious_metric_count, {b.mean('avg(fit_score)', 2)} AS average_fit_score,
  {b.mean('coalesce(avg(trusted_engagement_score) FILTER (NOT metric_suspicious), 0)', 2)} AS average_trusted_engagement,
  {b.mean('avg(structure_completeness)', 3)} AS average_structure_completeness, {b.mean('avg(person_count)', 2)} AS average_person_count,
  coalesce(nullif({notes_sql([("avg(structure_completeness) < 0.3", _Q["structure"]), ("avg(subtitle_consistency) < 0.5", _Q["subtitle"]),
    ("avg(person_count) > 1.5", _Q["subject"]), ("avg(face_center_score) < 0.75", _Q["face"])])}, ''), '{_Q["none"]}') AS recommendations
  FROM trusted GROUP BY source_name""")
def _(t):
    return listed("|", rp.trusted_accounts(trusted(t), "source_name", ms.TIPS_SHORT), "recommendations")


@query("agg25_overall_score", f"WITH {ACCOUNTS} SELECT CAST(round_even(avg(total_score), 0) AS BIGINT) AS overall FROM scored")
def _(t):
    return ac.overall_score(accounts(t))


@query("agg25_top_accounts", f"""WITH {ACCOUNTS} SELECT account_id, total_score FROM scored ORDER BY total_score DESC, activity_score DESC,
  account_id LIMIT 3""")
def _(t):
    return ac.top_accounts(accounts(t), "account_id").select("account_id", "total_score")


@query("sco19_weekly_global", f"""WITH {ACCOUNTS} SELECT CAST(round_even(avg(total_score), 0) AS BIGINT) AS overall_score, count(*) AS account_count,
  CAST(sum(videos_seen) AS BIGINT) AS video_total, CAST(sum(detail_success) AS BIGINT) AS detail_success_count,
  CAST(sum(comments_success) AS BIGINT) AS comment_success_count, CAST(sum(failed_count) AS BIGINT) AS failed_count FROM scored""")
def _(t):
    a = t.batch_accounts()
    totals = a.agg(*[F.sum(c).cast("bigint").alias(n) for c, n in (
        ("videos_seen", "video_total"), ("detail_success", "detail_success_count"),
        ("comments_success", "comment_success_count"), ("failed_count", "failed_count"))])
    return rp.weekly_global(ac.account_scores(a), totals)


_FLAGS = ", ".join(TITLE_FLAGS)


@query("sco5_comment_factors", f"""WITH {RATED}, keep AS (SELECT * FROM rated WHERE comment_count < 18), cut AS (SELECT list_sort(list(comment_count))[1 +
  least(count(*) - 1, CAST(floor(count(*) * 0.75::DOUBLE) AS BIGINT))] AS th FROM keep WHERE comment_count > 0), tall AS (UNPIVOT
  (SELECT comment_count >= th AS high, {_FLAGS} FROM keep, cut WHERE comment_count > 0) ON {_FLAGS} INTO NAME feature VALUE v) SELECT feature,
  {b.mean("coalesce(avg(v) FILTER (high), 0)", 4)} AS high_rate, {b.mean("coalesce(avg(v) FILTER (NOT high), 0)", 4)} AS normal_rate,
  {b.mean("coalesce(avg(v) FILTER (high), 0) - coalesce(avg(v) FILTER (NOT high), 0)", 4)} AS lift FROM tall GROUP BY feature""")
def _(t):
    return first_round(t)["comment_factors"]


@query("sco5_account_table", f"""WITH {RATED}, keep AS (SELECT * FROM rated WHERE comment_count < 18) SELECT account_id, count(*) AS video_count,
  CAST(floor(median(engagement_score)) AS BIGINT) AS median_engagement_score FROM keep GROUP BY 1""")
def _(t):
    return first_round(t)["accounts"].select("account_id", "video_count", "median_engagement_score")


def first_round(t):
    posts = with_metrics(t.videos(), t.metrics(), t.comments())
    titles = title_features("title", TITLE_WORDS, GRADE, " la ")
    return ro.first_round(posts, t.comments(), titles, suspicious=F.col("comment_count") >= 18)


@query("sco19_weekly_fit", f"""WITH {FITTED} SELECT count(*) AS total, {b.mean('avg(fit_score)', 2)} AS average_fit_score, {", ".join(
    f"count(*) FILTER (fit_level = '{n}') AS n_{n}, " + b.mean(f"count(*) FILTER (fit_level = '{n}') / count(*)", 4) + f" AS {n}_ratio" for n in ("high", "medium", "low"))}
  FROM fitted""")
def _(t):
    posts = rated(t).drop("account_id").withColumn("account_id", F.col("video_id"))
    return ro.weekly(t.batch_accounts(), posts)["fit_summary"]


assert set(IDEAL) == set(ef.IDEAL_FEATURES)
