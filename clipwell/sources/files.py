"""Readers of crawl files: targets, JSON artifacts, listings, tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from clipwell.functions.coerce import default_tags, filled, tag_list, text, whole_number
from clipwell.functions.rows import exploded
from clipwell.functions.text import longest_digit_run
from clipwell.operators.ordering import durable
from clipwell.operators.picking import latest_per_key, one_per_key

# Header aliases of target files, required columns, envelopes.
HEADER_ALIASES = {
    "平台": "platform", "分类": "category_lv1", "部门": "category_lv2", "账号类型": "account_type", "账号名": "source_name",
    "账号uid": "account_uid", "直播间链接": "live_url", "主页链接": "homepage_url", "uid": "account_uid",
    "account_name": "source_name", "home_url": "homepage_url",
}
REQUIRED = ("homepage_url", "source_name", "category_lv1", "category_lv2")
ENVELOPES = ("targets", "items", "records", "data")
TAG_FIELDS = {"platform": "platform", "category_lv1": "category_lv1", "category_lv2": "category_lv2", "account_type": "account_type", "uid": "account_uid"}
CORRUPT = "_corrupt_record"


# -- targets --------------------------------------------------------------------------

def _raw_targets(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    kind = path.rstrip("/").rsplit(".", 1)[-1].lower() if fmt == "auto" else fmt
    if kind in ("csv", "tsv"):
        return spark.read.csv(path, sep="\t" if kind == "tsv" else ",", header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    if kind == "jsonl":
        return spark.read.json(path)
    if kind != "json":
        raise ValueError(f"unsupported target format: {kind}")
    df = spark.read.json(path, multiLine=True)
    for name in ENVELOPES:
        if name in df.columns and df.schema[name].dataType.typeName() == "array":
            return df.select(F.inline(name))
    return df


def read_targets(spark: SparkSession, path: str, fmt: str = "auto") -> DataFrame:
    """Targets with canonical columns, trimmed texts and tags.

    Missing required columns fail at once; a blank URL or name fails the job
    when the row is read, so no target is dropped silently.
    """
    df = _raw_targets(spark, path, fmt)
    df = df.withColumnsRenamed({c: HEADER_ALIASES.get(c.strip("﻿ \t"), c.strip("﻿ \t")) for c in df.columns})
    missing = [c for c in REQUIRED if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")

    def needed(c: str) -> Column:
        return F.when(text(c) == "", F.raise_error(F.lit(f"empty {c}")).cast("string")).otherwise(text(c))

    defaults = default_tags({k: v for k, v in TAG_FIELDS.items() if v in df.columns})
    tags = tag_list("tags_json", defaults) if "tags_json" in df.columns else defaults
    return df.withColumns({
        "homepage_url": needed("homepage_url"), "source_name": needed("source_name"),
        "category_lv1": text("category_lv1"), "category_lv2": text("category_lv2"), "tags": tags,
    })


def read_table_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """CSV with trimmed headers and values, byte-order mark dropped, blanks kept as ''."""
    df = spark.read.csv(path, sep=sep, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)
    return df.select([text(F.col(f"`{c}`")).alias(c.strip("﻿ \t")) for c in df.columns])


def table_source(df: DataFrame, status: str | None = None, limit: int | None = None, key: str = "id", column: str = "status") -> DataFrame:
    """Rows of one status in id order, optionally the first n."""
    kept = df if status is None else df.where(F.col(column) == status)
    ordered = kept.orderBy(key)
    return ordered if limit is None else ordered.limit(limit)


# -- JSON artifacts -------------------------------------------------------------------

def read_artifacts(spark: SparkSession, path: str, schema: str | StructType, glob: str = "*.json", multi_line: bool = True) -> DataFrame:
    """JSON objects with their path, name, time, and the raw text of corrupt ones."""
    full = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    full = StructType(full.fields).add(CORRUPT, "string")
    df = spark.read.schema(full).json(
        path, multiLine=multi_line, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, pathGlobFilter=glob, recursiveFileLookup=True
    )
    return df.select("*", F.col("_metadata.file_path").alias("artifact_path"), F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_modification_time").alias("modified_at"))


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows, and one warning row per corrupt record, with the whole record for a replay."""
    bad = F.col(CORRUPT).isNotNull()
    warnings = df.where(bad).select("artifact_path", F.concat(F.lit("corrupt record: "), F.left(CORRUPT, F.lit(80))).alias("warning"), F.col(CORRUPT).alias("record"))
    return df.where(~bad).drop(CORRUPT), warnings


def artifact_id(video_id: str, url: str, file_name: str, prefix: str) -> Column:
    """Id from the field, else from the URL, else from the file name."""
    stem = F.regexp_replace(F.regexp_replace(F.col(file_name), r"\.[^.]*$", ""), f"^{prefix}", "")
    return F.coalesce(filled(video_id), F.nullif(longest_digit_run(url), F.lit("")), F.nullif(longest_digit_run(stem), F.lit("")))


def details(df: DataFrame, prefix: str = "video_detail_") -> DataFrame:
    """One detail per video: the last file in name order wins."""
    named = df.withColumn("video_id", artifact_id("video_id", "video_url", "file_name", prefix)).where(F.col("video_id").isNotNull())
    return latest_per_key(named, ["video_id"], "artifact_path")


def comment_rows(df: DataFrame, video: str = "video_id") -> DataFrame:
    """Comments of an artifact (top level, else below data) with position, id fallback and user fields.

    Needs ``comments`` and optionally ``data.comments`` as arrays of structs
    with cid, comment_id, id, text, content, desc, create_time, digg_count,
    user and user_id / nickname fields; absent fields count as blank.
    """
    boxes = [F.col("comments")] + ([F.col("data.comments")] if "data" in df.columns else [])
    element = df.schema["comments"].dataType.elementType
    user = element["user"].dataType.fieldNames() if "user" in element.fieldNames() else []

    def pick(*names: str) -> Column:
        cols = []
        for n in names:
            box, _, leaf = n.partition(".")
            if (leaf and leaf in user) or (not leaf and box in element.fieldNames()):
                cols.append(filled(F.col(f"c.{n}")))
        return F.coalesce(*cols, F.lit(""))

    tall = exploded(df, [video, "artifact_path"], F.coalesce(*boxes), "c", "position")
    own = F.concat_ws(":", F.col(video).cast("string"), F.col("position").cast("string"))
    return tall.select(
        F.coalesce(F.nullif(pick("cid", "comment_id", "id"), F.lit("")), own).alias("comment_id"), video,
        pick("text", "content", "desc").alias("text"), pick("create_time").alias("create_time"),
        F.coalesce(whole_number(pick("digg_count")), F.lit(0).cast("bigint")).alias("digg_count"),
        pick("user.uid", "user.user_id", "user_id").alias("user_id"), pick("user.nickname", "nickname").alias("user_name"), "artifact_path",
    )


def parts_union(spark: SparkSession, path: str, schema: str, glob: str = "*_part*.json", multi_line: bool = True) -> DataFrame:
    """Results of all part files that match: ``result.results[]`` as rows."""
    df = spark.read.schema(schema).json(path, multiLine=multi_line, pathGlobFilter=glob, recursiveFileLookup=True)
    return df.select(F.inline("result.results"))


# -- listings -------------------------------------------------------------------------

def listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """Path, length and time of files; contents are never read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select(
        "path", "length", "modificationTime"
    )


def media_index(files: DataFrame, path: str = "path") -> DataFrame:
    """Video id from the file stem and account from the parent folder; the last path per video wins."""
    parts = F.split(path, "/")
    stem = F.regexp_replace(F.element_at(parts, -1), r"\.[^.]*$", "")
    rows = files.select(
        longest_digit_run(stem).alias("video_id"), F.coalesce(filled(F.element_at(parts, -2)), F.lit("unknown")).alias("account_name"), F.col(path).alias("mp4_path")
    )
    return latest_per_key(rows.where(F.col("video_id") != ""), ["video_id"], "mp4_path")


# Endings and name parts of error logs.
LOG_ENDINGS = (".err", ".log")
ERROR_PARTS = ("error", "err", "stderr", "failed", "failure")


def inventory(files: DataFrame, folder: Column, path: str = "path") -> DataFrame:
    """Per folder: files, bytes, latest file and error logs."""
    name = F.lower(F.element_at(F.split(path, "/"), -1))
    ending = F.regexp_extract(name, r"(\.[^.]*)$", 1)
    parts = F.lit(False)
    for p in ERROR_PARTS:
        parts = parts | name.contains(p)
    bad = (F.col("length") > 0) & ending.isin(*LOG_ENDINGS) & parts
    return files.withColumn("folder", folder).groupBy("folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").cast("bigint").alias("total_bytes"),
        F.max_by(path, F.struct("modificationTime", path)).alias("latest_file"), F.count_if(bad).alias("error_logs"),
    )


def recent(files: DataFrame, limit: int, at: str = "modificationTime", path: str = "path") -> DataFrame:
    return files.orderBy(F.col(at).desc(), F.col(path).desc()).limit(limit)


def latest_of_kind(files: DataFrame, kind: str, at: str, path: str) -> DataFrame:
    """Newest artifact per kind."""
    return files.groupBy(kind).agg(F.max_by(path, F.struct(at, path)).alias(path), F.max(at).alias(at))


# -- nested crawl artifacts --------------------------------------------------------------

_VIDEO = "struct<video_url: string, video_id: string, title: string, publish_at: string>"
_RESULT = f"struct<source_name: string, homepage_url: string, videos: array<{_VIDEO}>>"
_TARGET = "struct<source_name: string, homepage_url: string>"
_CANDIDATES = f"array<struct<candidate: {_VIDEO}>>"
_ITEM = f"struct<target: {_TARGET}, crawl_result: {_RESULT}, homepage_result: {_RESULT}, video_items: {_CANDIDATES}>"
_BATCH = f"struct<results: array<{_ITEM}>>"
ARTIFACT_SCHEMA = (
    f"source_name string, homepage_url string, videos array<{_VIDEO}>, target {_TARGET}, crawl_result {_RESULT}, homepage_result {_RESULT}, "
    f"video_items {_CANDIDATES}, results array<{_ITEM}>, batch {_BATCH}, chunks array<struct<artifact_path: string, batch: {_BATCH}, results: array<{_ITEM}>>>"
)


def plain_path(path: str | Column) -> Column:
    """A file's path without scheme, authority and percent signs, to compare pointers with listings."""
    p = F.regexp_replace(F.col(path) if isinstance(path, str) else path, "^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*", "/")
    return F.coalesce(F.try_url_decode(F.replace(p, F.lit("+"), F.lit("%2B"))), p)


def linked_artifacts(artifacts: DataFrame, roots: Column, name: Column | None = None, pointer: Column | None = None) -> DataFrame:
    """Artifacts that are reached from each root over ``chunks[].artifact_path``, any number of files on.

    ``artifacts`` are all artifacts of the store, read by ``read_artifacts``;
    ``roots`` is a condition on them. ``name`` is what pointers call an artifact,
    by default its path, and ``pointer`` rewrites a pointer (column ``to``). Each round follows
    only files that the root has not met, so cycles end and a file counts once per root; pointers to no file
    are skipped. Adds root_path and trail, the chunk positions on the shortest
    way: an artifact comes before those it points to, in the order of its chunks.
    """
    named = artifacts.withColumn("__name", plain_path("artifact_path") if name is None else name)
    chunks = named.select("__name", F.posexplode("chunks.artifact_path").alias("at", "to")).where(text("to") != "")
    goal = plain_path(text("to")) if pointer is None else pointer
    edges = chunks.select(F.col("__name").alias("from"), "at", goal.alias("__name")).join(named.select("__name").distinct(), "__name", "left_semi")
    edges = durable(edges.groupBy("from", F.col("__name").alias("to")).agg(F.min("at").alias("at")))
    reach = durable(named.where(roots).select(F.col("artifact_path").alias("root_path"), "__name", F.array().cast("array<int>").alias("trail")))
    edge = reach
    while True:
        steps = edge.join(edges, F.col("__name") == F.col("from")).select("root_path", F.col("to").alias("__name"), F.concat("trail", F.array("at")).alias("trail"))
        new = steps.groupBy("root_path", "__name").agg(F.min("trail").alias("trail"))
        edge = durable(new.join(reach, ["root_path", "__name"], "left_anti"))
        if edge.isEmpty():
            break
        reach = reach.unionByName(edge)
    return named.join(reach, "__name").drop("__name")


def flatten_videos(df: DataFrame, order: Sequence[str | Column] = ("artifact_path",)) -> DataFrame:
    """Videos of crawl artifacts at all known places, with the account they inherit; the first per URL wins.

    Shapes: videos, crawl_result, homepage_result, video_items[].candidate on
    the artifact itself and below results[], batch.results[] and
    chunks[](.batch).results[]. What chunks point to is in ``linked_artifacts``, whose
    order is ("root_path", "trail").
    """
    keep = [c for c in order if isinstance(c, str)]

    def places(item: Column) -> list[Column]:
        """Arrays of (source_name, homepage_url, video) inside one item."""
        src, home = item["target"]["source_name"], item["target"]["homepage_url"]
        out = []
        for box in ("crawl_result", "homepage_result"):
            r = item[box]
            out.append(_located(r, src, home))
        out.append(F.transform(item["video_items"], lambda v: _video(v["candidate"], src, home)))
        return out

    top = F.struct(*[F.col(c) for c in ("target", "crawl_result", "homepage_result", "video_items")])
    groups = [_located(F.struct("source_name", "homepage_url", "videos"), F.lit(None), F.lit(None)), *places(top)]
    nested = [F.col("results"), F.col("batch.results"), F.flatten(F.transform("chunks", lambda c: c["results"])), F.flatten(F.transform("chunks", lambda c: c["batch"]["results"]))]
    for items in nested:
        groups.append(F.flatten(F.transform(items, lambda i: F.concat(*[F.coalesce(p, _no_videos()) for p in places(i)]))))
    everything = F.concat(*[F.coalesce(g, _no_videos()) for g in groups])
    tall = exploded(df, keep, everything, "v", "__at").select(*keep, "__at", "v.*").where(text("video_url") != "")
    first = one_per_key(tall.withColumn("video_url", text("video_url")), ["video_url"], [*[F.col(c) for c in keep], F.col("__at")])
    return first.drop("__at")


def _video(v: Column, source: Column, home: Column) -> Column:
    return F.struct(
        v["video_url"].alias("video_url"), F.coalesce(filled(v["video_id"]), F.lit("")).alias("video_id"), v["title"].alias("title"),
        v["publish_at"].alias("publish_at"), F.coalesce(filled(source), F.lit("")).alias("source_name"), F.coalesce(filled(home), F.lit("")).alias("homepage_url"),
    )


def _no_videos() -> Column:
    none = F.lit(None).cast("string")
    blank = F.struct(*[none.alias(c) for c in ("video_url", "video_id", "title", "publish_at")])
    return F.slice(F.array(_video(blank, none, none)), 1, 0)


def _located(result: Column, source: Column, home: Column) -> Column:
    src = F.coalesce(filled(result["source_name"]), source.cast("string"))
    url = F.coalesce(filled(result["homepage_url"]), home.cast("string"))
    return F.transform(result["videos"], lambda v: _video(v, src, url))

