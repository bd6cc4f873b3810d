"""Bound sources and sinks: Spark writes the tables as crawl files, then the readers read them back."""

from pyspark.sql import functions as F

from clipwell.catalog import bindings as b
from clipwell.catalog.registry import query
from clipwell.operators import projections as pr
from clipwell.sources import files as fs
from clipwell.sources import sinks as sk
from clipwell.streaming.runs import work_folder

_TARGETS_SQL = """SELECT 'https://h.example/' || s_suppkey AS homepage_url, s_name AS source_name, 'n' || s_nationkey AS category_lv1, '' AS category_lv2,
  'platform:p|category_lv1:n' || s_nationkey AS tags FROM supplier"""


@query("src1_read_targets", f"{_TARGETS_SQL} UNION ALL {_TARGETS_SQL}")
def _(t):
    work = work_folder(t.spark, "targets")
    s = t.raw("supplier").select(
        F.lit(" p ").alias("平台"), F.concat(F.lit("n"), F.col("s_nationkey").cast("string")).alias("分类"), F.lit("").alias("部门"),
        F.col("s_name").alias("账号名"), F.concat(F.lit("https://h.example/"), F.col("s_suppkey").cast("string")).alias("主页链接"),
    )
    s.write.option("header", True).option("sep", "\t").csv(f"{work}/t.tsv")
    s.withColumnsRenamed(fs.HEADER_ALIASES).withColumn("tags_json", F.lit(None).cast("string")).write.json(f"{work}/t.jsonl")
    cols = ["homepage_url", "source_name", "category_lv1", "category_lv2", F.array_join("tags", "|").alias("tags")]
    return fs.read_targets(t.spark, f"{work}/t.tsv").select(*cols).unionAll(fs.read_targets(t.spark, f"{work}/t.jsonl").select(*cols))


_DETAIL = "video_id string, video_url string, title string, metrics struct<view_count: string>, collected_at string"


@query("src2_read_details", """SELECT CAST(1000000000 + o_custkey AS VARCHAR) AS video_id, arg_max(o_orderpriority, o_orderkey) AS title,
  CAST(arg_max(o_orderkey, o_orderkey) AS BIGINT) AS view_count FROM orders GROUP BY o_custkey""")
def _(t):
    work = work_folder(t.spark, "details")
    k, v = F.col("o_orderkey"), (F.col("o_custkey") + 1000000000).cast("string")
    t.raw("orders").orderBy("o_orderkey").select(
        F.when(k % 2 == 0, v).alias("video_id"), F.concat(F.lit("https://h.example/video/"), v).alias("video_url"), F.col("o_orderpriority").alias("title"),
        F.struct(k.cast("string").alias("view_count")).alias("metrics"), F.lpad(k.cast("string"), 12, "0").alias("collected_at"),
    ).write.json(work)
    d = fs.read_artifacts(t.spark, work, _DETAIL, "*.json", multi_line=False)
    # Many records share a file here, so the record's own time stands in for the file name.
    one = fs.details(d.withColumn("artifact_path", F.concat(F.lit("f"), "collected_at")))
    return one.select("video_id", "title", pr.nested_metric(one, ("view_count",)).alias("view_count"))


_COMMENT = "struct<cid: string, text: string, content: string, digg_count: string, user: struct<uid: string, nickname: string>, user_id: string>"


@query("src3_read_comments", """SELECT CASE WHEN turn % 2 = 0 THEN 'c' || turn ELSE conv_id || ':' || (row_number() OVER (PARTITION BY conv_id, turn // 64 ORDER BY turn) - 1) END
  AS comment_id, conv_id AS video_id, trim(regexp_replace(text, '[\\s]+$', '')) AS text, turn AS digg_count, CAST(turn AS VARCHAR) AS user_id, role AS user_name FROM conversations""")
def _(t):
    work = work_folder(t.spark, "comments")
    k = F.col("turn")
    item = F.struct(
        k.alias("n"), F.when(k % 2 == 0, F.concat(F.lit("c"), k.cast("string"))).alias("cid"), F.when(k % 3 == 0, F.col("text")).alias("text"),
        F.when(k % 3 != 0, F.col("text")).alias("content"), k.cast("string").alias("digg_count"),
        F.struct(F.when(k % 5 == 0, k.cast("string")).alias("uid"), F.col("role").alias("nickname")).alias("user"), k.cast("string").alias("user_id"),
    )
    # At most 64 turns per artifact; a long conversation becomes several.
    page = t.raw("conversations").groupBy(F.col("conv_id").alias("video_id"), F.expr("turn div 64").alias("part")).agg(
        F.array_sort(F.collect_list(item)).alias("all")
    )
    even = F.col("video_id") % 2 == 0
    page.select("video_id", F.when(even, F.col("all")).alias("comments"), F.struct(F.when(~even, F.col("all")).alias("comments")).alias("data")).write.json(work)
    d = fs.read_artifacts(t.spark, work, f"video_id bigint, comments array<{_COMMENT}>, data struct<comments: array<{_COMMENT}>>", multi_line=False)
    return fs.comment_rows(d).select("comment_id", "video_id", "text", "digg_count", "user_id", "user_name")


@query("src4_quarantine", """SELECT CASE WHEN event_id % 10 <> 0 THEN event_id END AS video_id, CASE WHEN event_id % 10 = 0 THEN left('{"video_id":"' || event_id || '","title":"' || event_type || '"}',
  length('{"video_id":"' || event_id || '","title":"' || event_type || '"}') - 3) END AS record FROM events""")
def _(t):
    work = work_folder(t.spark, "corrupt")
    line = F.to_json(F.struct(F.col("event_id").cast("string").alias("video_id"), F.col("event_type").alias("title")))
    t.raw("events").select(F.when(F.col("event_id") % 10 == 0, F.left(line, F.length(line) - 3)).otherwise(line).alias("value")).write.text(work)
    # Parsed once and stored, so both halves see the same reading.
    read = fs.read_artifacts(t.spark, work, "video_id string, title string", "*", multi_line=False).cache()
    good, bad = fs.split_corrupt(read)
    return good.select(F.col("video_id").cast("bigint"), F.lit(None).cast("string").alias("record")).unionByName(
        bad.select(F.lit(None).cast("bigint").alias("video_id"), "record")
    )


def paths(t):
    """Orders as a file listing."""
    k = F.col("o_orderkey")
    return t.raw("orders").select(
        F.concat(
            F.lit("file:/d/"), F.col("o_orderpriority"), F.lit("/acc_"), (F.col("o_custkey") + 10000000000).cast("string"),
            F.when(k % 9 == 0, ".err").otherwise(".mp4"),
        ).alias("path"),
        F.col("o_custkey").alias("length"), F.col("o_orderdate").alias("modificationTime"),
    )


@query("src5_media_index", """SELECT CAST(o_custkey + 10000000000 AS VARCHAR) AS video_id, regexp_extract(max('file:/d/' || o_orderpriority || '/acc_' || (o_custkey + 10000000000) ||
  CASE WHEN o_orderkey % 9 = 0 THEN '.err' ELSE '.mp4' END), '/d/([^/]+)/', 1) AS account_name FROM orders GROUP BY o_custkey""")
def _(t):
    return fs.media_index(paths(t)).select("video_id", "account_name")


@query("src5_media_listing", "SELECT count(DISTINCT p_brand) AS folders, true AS sized FROM part")
def _(t):
    work = work_folder(t.spark, "media")
    t.videos().repartition("account_id").write.partitionBy("account_id").parquet(work)
    files = fs.listing(t.spark, work, "*.parquet")
    folder = F.element_at(F.split("path", "/"), -2)
    return files.agg(F.count_distinct(folder).alias("folders"), F.bool_and(F.col("length") > 0).alias("sized"))


@query("src6_parts_union", f"WITH {b.VIDEOS} SELECT video_id, title FROM videos")
def _(t):
    work = work_folder(t.spark, "parts")
    part = F.expr("video_id div 64").alias("part")
    t.videos().groupBy("account_id", part).agg(F.struct(F.collect_list(F.struct("video_id", "title")).alias("results")).alias("result")).write.json(f"{work}/fusion")
    schema = "result struct<results: array<struct<video_id: bigint, title: string>>>"
    return fs.parts_union(t.spark, work, schema, "part-*.json", multi_line=False)


@query("src7_table_source", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 100")
def _(t):
    return fs.table_source(t.raw("orders"), "F", 100, "o_orderkey", "o_orderstatus").select("o_orderkey")


@query("src8_table_csv", "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name, '' AS blank FROM customer")
def _(t):
    work = work_folder(t.spark, "csv")
    t.raw("customer").select(
        F.col("c_custkey").alias(" id "), F.concat(F.lit("　 "), "c_name", F.lit(" ")).alias("name"), F.lit(None).cast("string").alias("blank")
    ).write.option("header", True).csv(work)
    return fs.read_table_csv(t.spark, work)


@query("src9_flatten_artifacts", """SELECT 'u/' || video_id AS video_url, CASE WHEN video_id % 4 = 0 THEN '' ELSE account_id END AS source_name FROM
  (SELECT p_partkey AS video_id, p_brand AS account_id FROM part)""")
def _(t):
    work = work_folder(t.spark, "crawl")
    v = t.videos().withColumns({"k": F.col("video_id") % 4, "url": F.concat(F.lit("u/"), F.col("video_id").cast("string"))})
    video = F.struct(F.col("url").alias("video_url"), F.col("video_id").cast("string").alias("video_id"), "title")
    g = v.groupBy("account_id", "k", F.expr("video_id div 64").alias("part")).agg(F.collect_list(video).alias("videos"))
    k = F.col("k")
    target = F.struct(F.col("account_id").alias("source_name"))
    item = F.struct(target.alias("target"), F.struct("videos").alias("crawl_result"))
    cand = F.struct(target.alias("target"), F.transform("videos", lambda x: F.struct(x.alias("candidate"))).alias("video_items"))
    g.select(
        F.when(k == 0, F.col("videos")).alias("videos"), F.when(k == 1, F.struct(F.array(item).alias("results"))).alias("batch"),
        F.when(k == 2, F.array(cand)).alias("results"), F.when(k == 3, F.array(F.struct(F.array(item).alias("results")))).alias("chunks"),
    ).write.json(work)
    d = fs.read_artifacts(t.spark, work, fs.ARTIFACT_SCHEMA, multi_line=False)
    return fs.flatten_videos(d).select("video_url", "source_name")


# Three files for each brand, the first one points to the second, this one to the third and a missing file, the third one back to the first.
@query("src9_linked_artifacts", """SELECT 'u/' || p_partkey AS video_url, 'b/' || p_brand || '/0' AS root, CAST(p_partkey % 3 AS INT) AS links, 'f' || (p_partkey % 3) AS source_name FROM part""")
def _(t):
    work = work_folder(t.spark, "chain")
    v = t.videos().withColumns({"step": F.col("video_id") % 3, "url": F.concat(F.lit("u/"), F.col("video_id").cast("string"))})
    video = F.struct(F.col("url").alias("video_url"), F.col("video_id").cast("string").alias("video_id"), "title")
    # each file again lists a video of the first file, which the nearer file keeps
    g = v.groupBy("account_id", "step").agg(F.collect_list(video).alias("videos"))
    first = v.where("step = 0").groupBy("account_id").agg(F.min(video).alias("again"))
    g = g.join(first, "account_id", "left").withColumn("videos", F.concat("videos", F.coalesce(F.array_compact(F.array("again")), F.array().cast("array<struct<video_url: string, video_id: string, title: string>>"))))
    to = lambda s: F.concat(F.lit("b/"), F.col("account_id"), F.lit("/"), s.cast("string"))
    paths = F.array(F.lit(" "), to((F.col("step") + 1) % 3), F.concat(to(F.col("step")), F.lit("/none")))
    g.select(
        "account_id", "step", "videos", F.concat(F.lit("f"), F.col("step").cast("string")).alias("source_name"),
        F.transform(paths, lambda p: F.struct(p.alias("artifact_path"))).alias("chunks"),
    ).repartition("account_id", "step").write.partitionBy("account_id", "step").json(work)
    # partition folders are escaped once more than paths
    part = lambda p, i: F.try_url_decode(F.element_at(F.split(F.element_at(F.split(fs.plain_path(p), "/"), i), "="), -1))
    name = F.concat(F.lit("b/"), part(F.col("artifact_path"), -3), F.lit("/"), part(F.col("artifact_path"), -2))
    d = fs.read_artifacts(t.spark, work, fs.ARTIFACT_SCHEMA, multi_line=False)
    linked = fs.linked_artifacts(d, name.endswith("/0"), name, F.trim("to"))
    found = fs.flatten_videos(linked.withColumn("root", F.concat(F.lit("b/"), part(F.col("root_path"), -3), F.lit("/0"))), ("root", "trail"))
    return found.select("video_url", "root", F.size("trail").alias("links"), "source_name")


_P = """p AS (SELECT o_orderpriority AS folder, 'file:/d/' || o_orderpriority || '/acc_' || (o_custkey + 10000000000) || CASE WHEN o_orderkey % 9 = 0 THEN '.err' ELSE '.mp4' END
  AS path, o_custkey AS length, o_orderdate AS ts FROM orders)"""


@query("src10_inventory", f"""WITH {_P} SELECT folder, count(*) AS files, CAST(sum(length) AS BIGINT) AS total_bytes, arg_max(path, row(ts, path)) AS latest_file,
  count(*) FILTER (length > 0 AND path LIKE '%.err') AS error_logs FROM p GROUP BY folder""")
def _(t):
    return fs.inventory(paths(t), F.element_at(F.split("path", "/"), -2))


@query("src10_listed_files", "SELECT DISTINCT p_brand AS folder, 1 AS files, true AS sized, 0 AS error_logs FROM part")
def _(t):
    work = work_folder(t.spark, "listed")
    t.videos().repartition("account_id").write.partitionBy("account_id").parquet(work)
    # the folder of a partition is escaped once more than its path
    folder = F.try_url_decode(F.element_at(F.split(F.element_at(F.split(fs.plain_path("path"), "/"), -2), "="), -1))
    found = fs.inventory(fs.listing(t.spark, work, "*.parquet"), folder)
    return found.select("folder", "files", (F.col("total_bytes") > 0).alias("sized"), "error_logs")


@query("src11_latest_of_kind", f"WITH {_P} SELECT folder AS kind, arg_max(path, row(ts, path)) AS path FROM p GROUP BY 1")
def _(t):
    p = paths(t).withColumn("kind", F.element_at(F.split("path", "/"), -2))
    return fs.latest_of_kind(p, "kind", "modificationTime", "path").select("kind", "path")


@query("src11_recent_runs", f"WITH {_P} SELECT path FROM (SELECT DISTINCT path, ts FROM p) ORDER BY ts DESC, path DESC LIMIT 20")
def _(t):
    return fs.recent(paths(t).select("path", "modificationTime").distinct(), 20).select("path")


@query("snk1_write_dataset", f"""WITH {b.VIDEOS}, {b.METRICS} SELECT 'videos' AS part, count(*) AS n FROM videos UNION ALL SELECT 'video_metrics', count(*) FROM metrics
  UNION ALL SELECT 'comments', count(*) FROM conversations UNION ALL SELECT 'accounts', count(DISTINCT account_id) FROM videos""")
def _(t):
    work = work_folder(t.spark, "dataset")
    tables = {"accounts": t.videos().select("account_id").distinct(), "videos": t.videos(), "video_metrics": t.metrics(), "comments": t.comments()}
    sk.write_dataset(tables, work)
    sizes = [sk.read_dataset(t.spark, work, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("part"), "n") for n in tables]
    return sizes[0].unionAll(sizes[1]).unionAll(sizes[2]).unionAll(sizes[3])


@query("snk2_write_pool", """SELECT 'valid_videos' AS part, count(*) AS n FROM documents WHERE n_chars >= 100 UNION ALL
  SELECT 'videos', count(*) FROM documents WHERE n_chars >= 100""")
def _(t):
    work = work_folder(t.spark, "pool")
    sk.write_pool({"videos": t.posts().where("n_chars >= 100").select("video_id", "account_id", "lang")}, work, "csv")
    read = lambda n: sk.read_dataset(t.spark, work, n, "csv").agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("part"), "n")
    return read("valid_videos").unionAll(read("videos"))


@query("snk3_write_report", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def _(t):
    work = work_folder(t.spark, "report")
    sk.write_report(t.raw("events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n")), work)
    return t.spark.read.schema("event_type string, n bigint").json(work)


