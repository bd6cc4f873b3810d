"""Bound joins and set operations."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.filters import modalities
from clipwell.catalog.registry import query
from clipwell.functions.notes import merged
from clipwell.functions.text import same_author
from clipwell.operators import joins as jn
from clipwell.operators import sets as st


@query("jon1_assemble_ids", """SELECT coalesce(p_partkey, conv_id, c_custkey) AS video_id, coalesce(p_name, '') AS title,
  coalesce(n, 0) AS n_comments, coalesce(c_mktsegment, 'unknown') AS account FROM part FULL JOIN
  (SELECT conv_id, count(*) AS n FROM conversations GROUP BY 1) ON conv_id = p_partkey FULL JOIN customer
  ON c_custkey = coalesce(p_partkey, conv_id)""")
def _(t):
    detail = t.videos().select("video_id", "title")
    comments = t.comments().groupBy("video_id").agg(F.count(F.lit(1)).alias("n_comments"))
    media = t.raw("customer").select(F.col("c_custkey").alias("video_id"), F.col("c_mktsegment").alias("account"))
    return jn.assemble([detail, comments, media], "video_id", {"title": "", "n_comments": 0, "account": "unknown"})


@query("jon2_videos_metrics_comments", f"""WITH {b.VIDEOS}, {b.METRICS} SELECT video_id, account_id, title,
  coalesce(view_count, 0) AS view_count, coalesce(like_count, 0) AS like_count, coalesce(comment_count, 0) AS comment_count,
  coalesce(share_count, 0) AS share_count, coalesce(n, 0) AS collected_comment_count FROM videos LEFT JOIN metrics
  USING (video_id) LEFT JOIN (SELECT conv_id AS video_id, count(*) AS n FROM conversations GROUP BY 1) USING (video_id)""")
def _(t):
    return jn.with_metrics(t.videos(), t.metrics(), t.comments())


@query("jon3_merge_keeping", f"""WITH {b.METRICS} SELECT coalesce(d.doc_id, m.video_id) AS video_id,
  CASE WHEN d.doc_id IS NOT NULL THEN d.source ELSE 'unknown-account' END AS account_id,
  CASE WHEN coalesce(m.view_count, 0) <> 0 THEN m.view_count ELSE coalesce(d.n_chars, 0) END AS view_count,
  coalesce(m.comment_count, 0) AS comment_count FROM documents d FULL JOIN metrics m ON m.video_id = d.doc_id""")
def _(t):
    cur = t.raw("documents").select(
        F.col("doc_id").alias("video_id"), F.col("source").alias("account_id"), F.col("n_chars").alias("view_count")
    )
    return jn.merge_keeping(
        cur, t.metrics(), "video_id", ["account_id"], ["view_count", "comment_count"], {"account_id": "unknown-account"}
    )


@query("jon4_feature_star", f"""WITH {b.FEATURES} SELECT video_id, source_name, engagement_score,
  CASE WHEN person_count > 0 THEN face_center_score ELSE 0 END AS face_center_score,
  CASE WHEN subtitle_consistency > 0.2 THEN pose_facing_score ELSE 0 END AS pose_facing_score,
  CASE WHEN person_count < 2 THEN person_count ELSE 0 END AS person_count,
  CASE WHEN ocr_readability > 0.1 THEN ocr_readability ELSE 0 END AS ocr_readability,
  CASE WHEN speech_rate_cpm < 300 THEN speech_rate_cpm ELSE 0 END AS speech_rate_cpm,
  CASE WHEN structure_completeness > 0.1 THEN structure_completeness ELSE 0 END AS structure_completeness FROM features""")
def _(t):
    m = modalities(t)
    fusion = t.features().select("video_id", "source_name", "engagement_score")
    dims = [m.select("video_id", c) for c in
            ("face_quality", "pose_quality", "person_subject", "ocr_subtitle", "asr_speech", "script_structure")]
    j = jn.star(fusion, dims)
    zero = F.lit(0.0)
    return j.select(
        "video_id", "source_name", "engagement_score",
        F.coalesce("face_quality.center_score", zero).alias("face_center_score"),
        F.coalesce("pose_quality.facing_camera_score", zero).alias("pose_facing_score"),
        F.coalesce("person_subject.person_count", zero).alias("person_count"),
        F.coalesce("ocr_subtitle.readability_score", zero).alias("ocr_readability"),
        F.coalesce("asr_speech.speech_rate_cpm", zero).alias("speech_rate_cpm"),
        F.coalesce("script_structure.structure_completeness_score", zero).alias("structure_completeness"),
    )


@query("jon5_only_valid_ids", f"""WITH {b.COMMENTS} SELECT comment_id, turn FROM comments WHERE video_id IN
  (SELECT doc_id FROM labels WHERE quality = 1)""")
def _(t):
    good = t.raw("labels").where("quality = 1").select(F.col("doc_id").alias("video_id"))
    return jn.only_ids(t.comments(), good).select("comment_id", "turn")


@query("jon6_missing_details", """SELECT p_partkey AS video_id, p_name FROM part WHERE NOT EXISTS
  (SELECT 1 FROM labels WHERE doc_id = p_partkey)""")
def _(t):
    known = t.raw("labels").select(F.col("doc_id").alias("video_id"))
    return jn.missing_ids(t.raw("part").select(F.col("p_partkey").alias("video_id"), "p_name"), known)


@query("jon7_homepage_observed", """SELECT event_id, EXISTS (SELECT 1 FROM orders WHERE o_custkey = user_id AND
  o_orderkey = event_id) AS observed, TRUE AS observed_empty FROM events""")
def _(t):
    e = t.raw("events").select("event_id", F.col("user_id").alias("account"), F.col("event_id").alias("video"))
    idx = t.raw("orders").select(F.col("o_custkey").alias("account"), F.col("o_orderkey").alias("video"))
    both = jn.observed(jn.observed(e, idx, ["account", "video"]), idx.where("video < 0"), ["account", "video"], "observed_empty")
    return both.select("event_id", "observed", "observed_empty")


@query("jon8_comments_of_videos", f"""WITH {b.COMMENTS} SELECT comment_id, d.source AS account_id, d.lang FROM comments c
  JOIN documents d ON d.doc_id = c.video_id""")
def _(t):
    return t.comments().join(t.posts().select("video_id", "account_id", "lang"), "video_id").select(
        "comment_id", "account_id", "lang"
    )


@query("jon9_account_mentioned", """SELECT p.page_id, coalesce(contains(translate(d.text, '?？', ''),
  nullif(trim(translate(left(p.host, 2), '?？', '')), '')), FALSE) AS mentioned
  FROM (SELECT page_id, regexp_extract(url, '://([^./]+)', 1) AS host FROM pages) p LEFT JOIN documents d ON d.doc_id = p.page_id""")
def _(t):
    rows = t.raw("pages").select("page_id", F.left(F.regexp_extract("url", "://([^./]+)", 1), F.lit(2)).alias("account"))
    texts = t.raw("documents").select(F.col("doc_id").alias("page_id"), "text")
    return jn.mentioned(rows, texts, "page_id", "account", "text").select("page_id", "mentioned")


@query("jon10_author_reply", """SELECT c.conv_id, c.turn, contains(d.source, c.role) OR contains(c.role, d.source) OR
  contains(d.source, left(c.role, 1)) AS is_author FROM conversations c JOIN documents d ON d.doc_id = c.conv_id""")
def _(t):
    j = t.raw("conversations").join(t.raw("documents").select(F.col("doc_id").alias("conv_id"), "source"), "conv_id")
    is_author = same_author("role", "source") | same_author(F.left("role", F.lit(1)), "source")
    return j.select("conv_id", "turn", is_author.alias("is_author"))


@query("jon11_fallback_lookup", """WITH c AS (SELECT p_brand || CASE WHEN p_size > 25 THEN '?' ELSE '' END AS name,
  count(*) AS n FROM part WHERE p_size > 1 GROUP BY 1), r AS (SELECT DISTINCT p_brand || CASE WHEN p_size % 3 = 0 THEN '??'
  WHEN p_size % 3 = 1 THEN '?' ELSE '' END AS name FROM part)
  SELECT r.name, coalesce(nullif((SELECT max(n) FROM c WHERE c.name = r.name), 0),
  (SELECT max(n) FROM c WHERE replace(c.name, '?', '') = replace(r.name, '?', '')), 0) AS n FROM r""")
def _(t):
    p, k = t.raw("part"), F.col("p_size")
    counts = p.where("p_size > 1").groupBy(F.concat("p_brand", F.when(k > 25, "?").otherwise("")).alias("name"))
    marks = F.when(k % 3 == 0, "??").when(k % 3 == 1, "?").otherwise("")
    rows = p.select(F.concat("p_brand", marks).alias("name")).distinct()
    return jn.fallback_lookup(rows, counts.agg(F.count(F.lit(1)).alias("n")), "name", "n")


@query("jon12_reverse_lookup", """SELECT p.page_id, o.pri FROM pages p LEFT JOIN (SELECT o_custkey AS page_id,
  arg_max(o_orderpriority, o_orderkey) AS pri FROM orders GROUP BY 1) o USING (page_id)""")
def _(t):
    mapping = t.raw("orders").select(F.col("o_custkey").alias("page_id"), F.col("o_orderpriority").alias("pri"), "o_orderkey")
    return jn.reverse_lookup(t.raw("pages").select("page_id"), mapping, "page_id", "pri", [F.col("o_orderkey").desc()])


_REPLIES = """replies AS (SELECT event_id AS reply_id, user_id AS video_id, CASE WHEN event_type = 'view'
  THEN 'c' || (event_id // 2) ELSE '' END AS k1, CASE WHEN event_type IN ('click', 'view') THEN 'h' || (event_id // 3) ELSE '' END AS k2
  FROM events), known AS (SELECT o_custkey % 150 AS video_id, o_orderkey AS comment_id, 'c' || o_orderkey AS a,
  'h' || o_orderkey AS b FROM orders)"""


@query("jon13_reply_parents", f"""WITH {_REPLIES} SELECT r.reply_id, coalesce(x.comment_id, y.comment_id) AS comment_id FROM replies r
  LEFT JOIN known x ON x.video_id = r.video_id AND x.a = r.k1 LEFT JOIN known y ON y.video_id = r.video_id AND y.b = r.k2""")
def _(t):
    kind, e = F.col("event_type"), F.col("event_id")
    replies = t.raw("events").select(
        e.alias("reply_id"), F.col("user_id").alias("video_id"),
        F.when(kind == "view", F.concat(F.lit("c"), F.expr("event_id div 2"))).alias("k1"),
        F.when(kind.isin("click", "view"), F.concat(F.lit("h"), F.expr("event_id div 3"))).alias("k2"),
    )
    known = t.raw("orders").select(
        (F.col("o_custkey") % 150).alias("video_id"), F.col("o_orderkey").alias("comment_id"),
        F.concat(F.lit("c"), "o_orderkey").alias("a"), F.concat(F.lit("h"), "o_orderkey").alias("b"),
    )
    out = jn.resolve_parents(replies, known, "reply_id", "video_id", ["k1", "k2"], ["a", "b"], "comment_id")
    return out.select("reply_id", "comment_id")


@query("jon15_two_counts", """SELECT coalesce(a.k, z.k) AS account_id, coalesce(a.n, 0) AS input_n, coalesce(z.n, 0) AS valid_n
  FROM (SELECT c_nationkey AS k, count(*) AS n FROM customer GROUP BY 1) a FULL JOIN
  (SELECT s_nationkey AS k, count(*) AS n FROM supplier GROUP BY 1) z ON a.k = z.k""")
def _(t):
    a = t.raw("customer").groupBy(F.col("c_nationkey").alias("account_id")).agg(F.count(F.lit(1)).alias("input_n"))
    z = t.raw("supplier").groupBy(F.col("s_nationkey").alias("account_id")).agg(F.count(F.lit(1)).alias("valid_n"))
    return jn.two_counts(a, z, "account_id", "input_n", "valid_n")


@query("jon16_driving_side", """SELECT DISTINCT conv_id AS video_id, 'targets' AS lead FROM conversations UNION ALL
  SELECT doc_id, 'artifacts' FROM labels""")
def _(t):
    targets = t.raw("conversations").select(F.col("conv_id").alias("video_id"))
    arts = t.raw("labels").select(F.col("doc_id").alias("video_id"))
    return (
        jn.driven_by(targets, arts, "video_id").withColumn("lead", F.lit("targets"))
        .unionByName(jn.driven_by(targets.where("video_id < 0"), arts, "video_id").withColumn("lead", F.lit("artifacts")))
    )


@query("jon17_allowed_first", """SELECT o_custkey AS url, min(o_orderkey) AS first_order FROM orders WHERE o_orderstatus = 'F' AND
  o_orderpriority IN (SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority <> '5-LOW') GROUP BY 1""")
def _(t):
    o = t.raw("orders")
    rows = o.where("o_orderstatus = 'F'").select(F.col("o_custkey").alias("url"), "o_orderkey", F.col("o_orderpriority").alias("src"))
    allowed = o.where("o_orderpriority <> '5-LOW'").select("o_orderpriority")
    out = jn.latest_unique(rows, allowed, "src", "url", [F.col("o_orderkey")])
    return out.select("url", F.col("o_orderkey").alias("first_order"))


# -- sets ----------------------------------------------------------------------

def _ids(t, table, col):
    return t.raw(table).select(F.col(col).alias("video_id"))


@query("set1_union_ids", """SELECT p_partkey AS video_id FROM part UNION SELECT conv_id FROM conversations
  UNION SELECT o_orderkey FROM orders""")
def _(t):
    return st.union_ids([_ids(t, "part", "p_partkey"), _ids(t, "conversations", "conv_id"), _ids(t, "orders", "o_orderkey")], "video_id")


@query("set2_shared_count", "SELECT count(*) AS n FROM (SELECT p_partkey FROM part INTERSECT SELECT l_partkey FROM lineitem)")
def _(t):
    return st.shared_count(_ids(t, "part", "p_partkey"), _ids(t, "lineitem", "l_partkey"), "video_id")


@query("set3_differences", """SELECT video_id, 'no_label' AS side FROM (SELECT p_partkey AS video_id FROM part EXCEPT
  SELECT doc_id FROM labels) UNION ALL SELECT video_id, 'no_part' FROM (SELECT doc_id AS video_id FROM labels EXCEPT
  SELECT p_partkey FROM part)""")
def _(t):
    return st.differences(_ids(t, "part", "p_partkey"), _ids(t, "labels", "doc_id"), "video_id", "no_label", "no_part")


@query("set4_filtered_ids", """SELECT doc_id AS video_id FROM labels WHERE toxic = 1 UNION SELECT conv_id FROM conversations
  WHERE role = 'system' UNION SELECT doc_id FROM documents WHERE n_chars > 5000""")
def _(t):
    return st.filtered_ids(
        _ids(t, "labels", "doc_id").join(t.raw("labels").where("toxic = 1").select(F.col("doc_id").alias("video_id")), "video_id", "left_semi"),
        t.raw("conversations").where("role = 'system'").select(F.col("conv_id").alias("video_id")),
        t.raw("documents").where("n_chars > 5000").select(F.col("doc_id").alias("video_id")),
        "video_id",
    )


@query("set5_concat_first", """SELECT video_id, arg_min(src, pri) AS src FROM (SELECT conv_id AS video_id, 'comments' AS src, 1 AS pri
  FROM conversations UNION ALL SELECT doc_id, 'labels', 2 FROM labels) GROUP BY video_id""")
def _(t):
    a = _ids(t, "conversations", "conv_id").withColumn("src", F.lit("comments"))
    z = _ids(t, "labels", "doc_id").withColumn("src", F.lit("labels"))
    return st.concat_first([a, z], "video_id")


@query("set6_capped_distinct", r"""SELECT doc_id, string_agg(w, ' ' ORDER BY i) AS words FROM (SELECT doc_id, w, min(i) AS i,
  row_number() OVER (PARTITION BY doc_id ORDER BY min(i)) AS rn FROM (SELECT doc_id, trim(unnest(ws)) AS w,
  generate_subscripts(ws, 1) AS i FROM (SELECT doc_id, string_split(text, ' ') AS ws FROM documents)) WHERE w <> ''
  GROUP BY doc_id, w) WHERE rn <= 5 GROUP BY doc_id""")
def _(t):
    return t.raw("documents").select("doc_id", F.array_join(merged([F.split("text", " ")], 5), " ").alias("words"))
