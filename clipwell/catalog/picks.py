"""Bound rankings, samples and per-key picks."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.aggregates import ARTIFACTS, CHUNKS, RATED, SCALES, artifacts, chunk_rows, rated
from clipwell.catalog.filters import TRUSTED, trusted
from clipwell.catalog.registry import query
from clipwell.catalog.texts import OVERLAP_SQL, TOKENS_SQL, _stop
from clipwell.operators import aggregates as ag
from clipwell.operators import picking as pk
from clipwell.operators.ordering import with_row_number
from clipwell.plans import engagement as en
from clipwell.plans import features as ft
from clipwell.plans import reports as rp


@query("win1_latest_artifact", f"""WITH {ARTIFACTS} SELECT video_id, artifact, stop_reason FROM artifacts
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY seen_at DESC, artifact DESC) = 1""")
def _(t):
    return pk.latest_per_key(artifacts(t), ["video_id"], "seen_at", "artifact").select("video_id", "artifact", "stop_reason")


@query("win1_first_artifact", f"""WITH {ARTIFACTS} SELECT video_id, min(artifact) AS artifact FROM artifacts GROUP BY 1""")
def _(t):
    return pk.one_per_key(artifacts(t), ["video_id"], [F.col("artifact").asc()]).select("video_id", "artifact")


@query("win1_latest_matching", f"""WITH {ARTIFACTS} SELECT video_id, artifact FROM artifacts WHERE real_comment_count > 0
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY seen_at DESC, artifact DESC) = 1""")
def _(t):
    order = [F.col("seen_at").desc(), F.col("artifact").desc()]
    a = pk.first_matching_per_key(artifacts(t), ["video_id"], F.col("real_comment_count") > 0, order)
    return a.select("video_id", "artifact")


SCORED = f"""{SCALES}, scored AS (SELECT r.*, round_even(greatest(0, least(100, 50.0::DOUBLE
  + greatest(-4, least(4, (view_count - v.median) / v.scale)) * 0.20::DOUBLE * 8.0::DOUBLE
  + greatest(-4, least(4, (like_count - l.median) / l.scale)) * 0.40::DOUBLE * 8.0::DOUBLE
  + greatest(-4, least(4, (comment_count - c.median) / c.scale)) * 0.25::DOUBLE * 8.0::DOUBLE
  + greatest(-4, least(4, (share_count - s.median) / s.scale)) * 0.15::DOUBLE * 8.0::DOUBLE)), 2) AS score
  FROM rated r, (FROM scales WHERE metric = 'view_count') v, (FROM scales WHERE metric = 'like_count') l,
  (FROM scales WHERE metric = 'comment_count') c, (FROM scales WHERE metric = 'share_count') s)"""


def scored(t):
    return en.robust_engagement(rated(t), "video_id", name="score")


@query("sco3_robust_engagement", f"WITH {SCORED} SELECT video_id, account_id, score FROM scored")
def _(t):
    return scored(t).select("video_id", "account_id", "score")


@query("sco3_account_scores", f"""WITH {SCORED} SELECT account_id, count(*) AS video_count, round_even(avg(score), 2) AS
  engagement_score FROM scored GROUP BY 1""")
def _(t):
    return en.account_scores(scored(t), "account_id", "score")


@query("win2_top_bottom_posts", f"""WITH {SCORED}, r AS (SELECT *, row_number() OVER (PARTITION BY account_id ORDER BY score DESC,
  view_count DESC, video_id) AS up, row_number() OVER (PARTITION BY account_id ORDER BY score, view_count, video_id DESC) AS down
  FROM scored) SELECT account_id, video_id, title, score, up AS pos, 'top' AS side FROM r WHERE up <= 3 UNION ALL
  SELECT account_id, video_id, title, score, down, 'bottom' FROM r WHERE down <= 3""")
def _(t):
    return en.best_and_weakest(scored(t), "account_id", "score", 3).select(
        "account_id", "video_id", "title", "score", "pos", "side"
    )


@query("win3_global_rank", f"""WITH {b.BATCH} SELECT account_id, row_number() OVER (ORDER BY videos_seen DESC, detail_success DESC,
  account_id) AS rank FROM batch""")
def _(t):
    order = [F.col("videos_seen").desc(), F.col("detail_success").desc(), F.col("account_id").asc()]
    return with_row_number(t.batch_accounts(), order, "rank").select("account_id", "rank")


_KW = """SELECT account_id, token AS keyword, n AS count, weight, pos FROM (SELECT *, row_number() OVER (PARTITION BY account_id
  ORDER BY weight DESC, n DESC, token) AS pos FROM (SELECT f.account_id, f.token, f.n, round_even(f.n / greatest(1, a.n), 2) AS weight
  FROM f JOIN a USING (account_id, token))) WHERE pos <= 5"""


@query("win4_title_keywords", f"""WITH {SCORED}, words AS (SELECT account_id, video_id, unnest({TOKENS_SQL.format(c='title', stop=_stop)})
  AS token FROM scored), top AS (SELECT video_id FROM scored QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY score DESC,
  view_count DESC, video_id) <= 5), f AS (SELECT account_id, token, count(*) AS n FROM words WHERE video_id IN (FROM top) GROUP BY ALL),
  a AS (SELECT account_id, token, count(*) AS n FROM words GROUP BY ALL) {_KW}""")
def _(t):
    s = scored(t)
    top = en.best_and_weakest(s, "account_id", "score", 5).where("side = 'top'")
    return en.keywords(top, s, ["account_id"], "title", 5)


@query("win4_comment_keywords", f"""WITH {b.COMMENTS}, f AS (SELECT account_id, token, count(*) AS n FROM (SELECT d.source AS account_id,
  unnest({TOKENS_SQL.format(c='c.text', stop=_stop)}) AS token FROM comments c JOIN documents d ON d.doc_id = c.video_id) GROUP BY ALL),
  a AS (FROM f) {_KW}""")
def _(t):
    c = t.comments().join(t.posts().select("video_id", "account_id"), "video_id")
    return en.keywords(c, None, ["account_id"], "text", 5)


@query("win5_top_half", f"""WITH {RATED} SELECT video_id, row_number() OVER (ORDER BY engagement_score DESC, video_id)
  <= greatest(1, count(*) OVER () // 2) AS in_top FROM rated""")
def _(t):
    return pk.top_fraction(rated(t), "engagement_score", "video_id", 0.5).select("video_id", "in_top")


@query("win6_spread_sample", f"""WITH {RATED}, r AS (SELECT account_id, video_id, row_number() OVER (PARTITION BY account_id ORDER BY
  engagement_score DESC, video_id) - 1 AS i, count(*) OVER (PARTITION BY account_id) AS n FROM rated) SELECT account_id, video_id,
  i AS sample_index FROM r WHERE n <= 7 OR i IN (SELECT CAST(round_even(k * (n - 1) / 6.0::DOUBLE, 0) AS BIGINT) FROM range(7) t(k))""")
def _(t):
    order = [F.col("engagement_score").desc(), F.col("video_id").asc()]
    return pk.spread_sample(rated(t), ["account_id"], order, 7, row=["video_id"]).select("account_id", "video_id", "sample_index")


@query("win7_first_k_limited", """SELECT account_id, video_id, pos FROM (SELECT p_brand AS account_id, p_partkey AS video_id,
  row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS pos FROM part) WHERE pos <= 3 ORDER BY video_id LIMIT 60""")
def _(t):
    return pk.first_k_per_key_limited(t.videos(), ["account_id"], [F.col("video_id")], 3, 60).select("account_id", "video_id", "pos")


@query("win8_budgets", """SELECT p_partkey AS video_id, CASE WHEN r <= 10 THEN 'collect' ELSE 'video_limit_reached' END AS detail,
  CASE WHEN r <= 4 THEN 'collect' ELSE 'comment_video_limit_reached' END AS comments FROM (SELECT *, row_number() OVER
  (PARTITION BY p_brand ORDER BY p_partkey) AS r FROM part)""")
def _(t):
    out = rp.budgets(t.videos(), ["account_id"], [F.col("video_id").asc()], 10, 4, row=["video_id"])
    return out.select("video_id", "detail", "comments")


_OV = OVERLAP_SQL.format(a="text", b="prev")


@query("win9_adjacent_overlap", f"""WITH f AS (SELECT conv_id AS video_id, turn, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn)
  AS prev FROM conversations WHERE trim(text) <> '') SELECT video_id, round_even(CASE WHEN count(*) = 1 THEN 1 ELSE
  avg(CASE WHEN prev IS NOT NULL THEN {_OV} END) END, 4) AS consistency FROM f GROUP BY 1""")
def _(t):
    frames = t.comments().select("video_id", F.col("turn").alias("frame_no"), "text")
    return ft.consistency(frames, "video_id", "frame_no", "text")


@query("win10_chunk_ids", """SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 16 + 1 AS chunk_no FROM orders""")
def _(t):
    return pk.chunked(t.raw("orders"), [F.col("o_orderkey").asc()], 16, row=["o_orderkey"]).select("o_orderkey", "chunk_no")


@query("win11_top_posts", f"""WITH {RATED} (SELECT 'engagement_score' AS metric, video_id, engagement_score AS value FROM rated ORDER BY
  engagement_score DESC, video_id LIMIT 12) UNION ALL (SELECT 'comment_count', video_id, comment_count FROM rated ORDER BY
  comment_count DESC, video_id LIMIT 12) UNION ALL (SELECT 'share_count', video_id, share_count FROM rated ORDER BY
  share_count DESC, video_id LIMIT 12)""")
def _(t):
    return rp.top_lists(rated(t), "video_id", {"engagement_score": 12, "comment_count": 12, "share_count": 12})


@query("win11_top_trusted", f"""WITH {TRUSTED} (SELECT 'trusted_engagement_score' AS metric, video_id,
  trusted_engagement_score AS value FROM trusted WHERE NOT metric_suspicious ORDER BY trusted_engagement_score DESC, video_id
  LIMIT 30) UNION ALL (SELECT 'fit_score', video_id, CAST(fit_score AS BIGINT) FROM trusted WHERE NOT metric_suspicious
  ORDER BY fit_score DESC, video_id LIMIT 20)""")
def _(t):
    ok = trusted(t).where(~F.col("metric_suspicious")).withColumn("fit_score", F.col("fit_score").cast("bigint"))
    return rp.top_lists(ok, "video_id", {"trusted_engagement_score": 30, "fit_score": 20})


_PRI = """round_even(failed_count * 100 + greatest(0, 1.0::DOUBLE - detail_meaningful_rate) * 20.0::DOUBLE + greatest(0, 1.0::DOUBLE -
  comment_meaningful_rate) * 25.0::DOUBLE + least(duration_sec / 60.0::DOUBLE, 20.0::DOUBLE), 6)"""


@query("win12_rerun_priority", f"""WITH {CHUNKS} SELECT chunk_no, status, {_PRI} AS priority_score, CASE WHEN failed_count > 0 THEN
  '{rp.REASON_FAILED}' WHEN detail_meaningful_rate <= 0 AND comment_meaningful_rate <= 0 THEN '{rp.REASON_BOTH}'
  WHEN comment_meaningful_rate <= 0 THEN '{rp.REASON_COMMENT}' WHEN detail_meaningful_rate < 0.5 THEN '{rp.REASON_DETAIL}'
  ELSE '{rp.REASON_STABLE}' END AS reason FROM reports ORDER BY priority_score DESC, chunk_no LIMIT 10""")
def _(t):
    out = rp.rerun_priorities(ag.chunk_reports(chunk_rows(t), "chunk_no"), "chunk_no")
    return out.select("chunk_no", "status", "priority_score", "reason")


@query("win12_slowest_chunks", f"""WITH {CHUNKS} SELECT chunk_no, duration_sec FROM reports ORDER BY duration_sec DESC, chunk_no LIMIT 5""")
def _(t):
    r = ag.chunk_reports(chunk_rows(t), "chunk_no")
    return r.orderBy(F.col("duration_sec").desc(), "chunk_no").limit(5).select("chunk_no", "duration_sec")


@query("win14_best_box", """SELECT vec_id, list_max(embedding) AS area, list_position(embedding, list_max(embedding)) - 1 AS frame_no
  FROM embeddings""")
def _(t):
    boxes = t.raw("embeddings").select("vec_id", F.posexplode("embedding").alias("frame_no", "area"))
    best = ft.best_box(boxes, ["vec_id"], F.struct("frame_no", "area"), F.col("area"), F.col("frame_no"))
    return best.select("vec_id", F.col("box.area").alias("area"), F.col("box.frame_no").cast("bigint").alias("frame_no"))


@query("win15_best_capture", """SELECT conv_id, arg_max(turn, row(score, turn)) AS round, max(score) AS score FROM (SELECT conv_id, turn,
  length(text) + CASE WHEN contains(text, 'the') THEN 1200 ELSE 0 END + CASE WHEN contains(text, ' and ') THEN 900 ELSE 0 END
  + CASE WHEN contains(text, ' la ') THEN 400 ELSE 0 END - CASE WHEN contains(text, ' der ') THEN 500 ELSE 0 END
  + least(500, (length(text) - length(replace(lower(text), 'comment', ''))) // 7) AS score FROM conversations) GROUP BY conv_id""")
def _(t):
    c = t.raw("conversations")
    markers = {"comments": ("the",), "published": (" and ",), "report": (" la ",), "loading": (" der ",)}
    score = ft.capture_score(F.col("text"), F.col("text"), markers)
    return (
        c.withColumn("score", score).groupBy("conv_id")
        .agg(F.max_by("turn", F.struct("score", "turn")).alias("round"), F.max("score").cast("bigint").alias("score"))
    )
