"""Aggregations: robust statistics, lifts, gaps, correlations, roll-ups and counters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipwell.functions.coerce import text
from clipwell.functions.rows import exploded
from clipwell.functions.numbers import bounded, count_where, rate, rounded
from clipwell.functions.text import account_key
from clipwell.operators.ordering import durable, histogram, long_form, medians, order_statistics
from clipwell.operators.picking import Top, latest_per_key, top_fraction, top_fractions, top_per_key
from clipwell.operators.sets import shared_count

METRICS = ("view_count", "like_count", "comment_count", "share_count")


def mean_or_zero(c: str | Column, digits: int | None = None) -> Column:
    """Average with missing values counted as 0, 0 for no rows."""
    col = F.col(c) if isinstance(c, str) else c
    value = F.coalesce(F.avg(F.coalesce(col.cast("double"), F.lit(0.0))), F.lit(0.0))
    return value if digits is None else rounded(value, digits)


# -- order statistics -----------------------------------------------------------

def robust_scales(videos: DataFrame, key: str, metrics: Sequence[str] = METRICS) -> DataFrame:
    """Median and MAD * 1.4826 (at least 1) per metric; one row per metric."""
    tall = long_form(videos.fillna(0, subset=list(metrics)), [key], metrics, "metric", "value")
    # One pass over the posts: both medians come from the stored value counts.
    counts = durable(histogram(tall, "value", ["metric"], "value", "c"))
    mids = medians(counts, "value", ["metric"], "median", "c").select("metric", "median")
    off = counts.join(F.broadcast(mids), "metric")  # one row per metric
    mads = medians(off.withColumn("dev", F.abs(F.col("value") - F.col("median"))), "dev", ["metric"], "mad", "c")
    scale = F.greatest(F.col("mad") * 1.4826, F.lit(1.0)).alias("scale")
    return mids.join(mads.select("metric", "mad"), "metric").select("metric", "median", scale)


def account_medians(rows: DataFrame, account: str, key: str, metrics: Sequence[str]) -> DataFrame:
    """Per account: video count and truncated medians of each metric."""
    tall = long_form(rows, [account, key], metrics, "metric", "value")
    mids = medians(tall, "value", [account, "metric"], "median")
    wide = [F.max(F.when(F.col("metric") == m, F.col("median").cast("bigint"))).alias(f"median_{m}") for m in metrics]
    return mids.groupBy(account).agg(F.max("n").alias("video_count"), *wide)


def index_percentile(rows: DataFrame, value: str, ratio: float, keys: Sequence[str] = (), name: str = "threshold") -> DataFrame:
    """``sorted[min(n - 1, floor(n * ratio))]``, exact."""
    pick = {name: lambda n: F.least(n - 1, F.floor(n * F.lit(ratio)))}
    return order_statistics(rows, value, pick, keys)


def ideal_ranges(rows: DataFrame, key: str, features: Sequence[str]) -> DataFrame:
    """Per feature the nearest-rank quartiles and the median: low, mid, high (4 digits)."""
    tall = long_form(rows, [key], features, "feature", "value")
    picks = {
        "low": lambda n: F.bround((n - 1) * F.lit(0.25), 0),
        "high": lambda n: F.bround((n - 1) * F.lit(0.75), 0),
        "m0": lambda n: F.floor((n - 1) / 2),
        "m1": lambda n: F.floor(n / 2),
    }
    found = order_statistics(tall, "value", picks, ["feature"])
    four = lambda c: F.bround(c.cast("double"), 4)
    return found.select(
        "feature", four(F.col("low")).alias("low"), four((F.col("m0") + F.col("m1")) / 2.0).alias("mid"),
        four(F.col("high")).alias("high"),
    )


def feature_lifts(rows: DataFrame, metric: str, features: Sequence[str], ratio: float = 0.75) -> DataFrame:
    """Share of each binary feature in the high group against the normal group."""
    scored = rows.where(F.col(metric) > 0)
    cut = index_percentile(scored, metric, ratio).select("threshold").scalar()
    flags = scored.select((F.col(metric) >= cut).alias("__high"), *features)
    sums = flags.groupBy("__high").agg(F.count(F.lit(1)).alias("__n"), *[F.sum(f).cast("double").alias(f) for f in features])
    tall = sums.unpivot(["__high", "__n"], list(features), "feature", "hits")

    def part(cond: Column) -> Column:
        return F.coalesce(F.max(F.when(cond, F.try_divide(F.col("hits"), F.col("__n")))), F.lit(0.0))

    return tall.groupBy("feature").agg(part(F.col("__high")).alias("h"), part(~F.col("__high")).alias("m")).select(
        "feature", rounded(F.col("h"), 4).alias("high_rate"), rounded(F.col("m"), 4).alias("normal_rate"),
        rounded(F.col("h") - F.col("m"), 4).alias("lift"),
    )


def head_tail_profiles(
    rows: DataFrame, account: str, metric: str, key: str, features: Sequence[str], size: int = 5
) -> DataFrame:
    """Feature means over the best and the weakest rows per account: top_<f>, weak_<f> (3 digits)."""
    best = top_per_key(rows, [account], [F.col(metric).desc(), F.col(key).asc()], size).withColumn("__top", F.lit(True))
    weak = top_per_key(rows, [account], [F.col(metric).asc(), F.col(key).asc()], size).withColumn("__top", F.lit(False))
    cols = []
    for f in features:
        for name, cond in (("top", F.col("__top")), ("weak", ~F.col("__top"))):
            cols.append(rounded(F.coalesce(F.avg(F.when(cond, F.col(f).cast("double"))), F.lit(0.0)), 3).alias(f"{name}_{f}"))
    return best.unionByName(weak).groupBy(account).agg(*cols)


def correlation(x: str, y: str) -> Column:
    """Pearson correlation; 0 for fewer than two rows or a constant side."""
    a, c = F.coalesce(F.col(x).cast("double"), F.lit(0.0)), F.coalesce(F.col(y).cast("double"), F.lit(0.0))
    r = F.try_divide(F.covar_pop(a, c), F.stddev_pop(a) * F.stddev_pop(c))
    return F.when(F.count(F.lit(1)) < 2, 0.0).otherwise(F.coalesce(r, F.lit(0.0)))


def half_gaps(rows: DataFrame, metric: str, key: str, features: Sequence[str], digits: int = 3) -> DataFrame:
    """Mean of the better half minus mean of the rest, one column per feature."""
    rows = durable(rows.select(key, metric, *[f for f in features if f not in (key, metric)]))
    flagged = top_fraction(rows, metric, key, 0.5)

    def mean(f: str, cond: Column) -> Column:
        return F.coalesce(F.avg(F.when(cond, F.coalesce(F.col(f).cast("double"), F.lit(0.0)))), F.lit(0.0))

    top = F.col("in_top")
    return flagged.agg(*[rounded(mean(f, top) - mean(f, ~top), digits).alias(f"{f}_gap") for f in features])


def quarter_gaps(rows: DataFrame, metric: str, key: str, features: Mapping[str, int]) -> DataFrame:
    """Top quarter mean minus bottom quarter mean; feature name to digits."""
    rows = durable(rows.select(key, metric, *[f for f in features if f not in (key, metric)]))
    j = top_fractions(rows, key, [Top("__high", metric, 0.25), Top("__low", metric, 0.25, descending=False)])
    high, low = F.col("__high"), F.col("__low")
    out = []
    for f, digits in features.items():
        v = F.coalesce(F.col(f).cast("double"), F.lit(0.0))
        gap = F.coalesce(F.avg(F.when(high, v)), F.lit(0.0)) - F.coalesce(F.avg(F.when(low, v)), F.lit(0.0))
        out.append(rounded(gap, digits).alias(f"{f}_gap"))
    return j.agg(*out)


# -- counters -------------------------------------------------------------------

def risk_conditions() -> dict[str, Column]:
    return {
        "multi_person_or_unstable_subject": F.col("person_count") > 1.5,
        "low_structure": F.col("structure_completeness") < 0.3,
        "low_subtitle_consistency": F.col("subtitle_consistency") < 0.45,
        "face_small_or_offcenter": (F.col("face_ratio") < 0.02) | (F.col("face_center_score") < 0.7),
        "speech_too_fast": F.col("speech_rate_cpm") > 360,
    }


def risk_counts(rows: DataFrame, account: str) -> DataFrame:
    """Risk counters per account and overall (account null) in one pass."""
    return rows.rollup(account).agg(*[count_where(c).alias(n) for n, c in risk_conditions().items()])


def level_distribution(score: str, level: str, levels: Sequence[str] = ("high", "medium", "low")) -> list[Column]:
    total = F.count(F.lit(1))
    out = [total.alias("total"), rounded(F.coalesce(F.avg(score), F.lit(0.0)), 2).alias("average_fit_score")]
    for name in levels:
        n = F.count_if(F.col(level) == name)
        out += [n.cast("bigint").alias(f"n_{name}"), rate(n, total, 4).alias(f"{name}_ratio")]
    return out


def sample_summary(rows: DataFrame, account: str = "account_id") -> DataFrame:
    n, odd = F.count(F.lit(1)), F.count_if(F.col("metric_suspicious"))
    return rows.agg(
        n.alias("video_count"),
        (n - odd).alias("analysis_video_count"),
        odd.cast("bigint").alias("suspicious_metric_video_count"),
        F.count_distinct(account).alias("account_count"),
        count_where(F.col("view_count") > 0).alias("nonzero_view_count"),
        count_where(F.col("comment_count") > 0).alias("nonzero_comment_count"),
        F.coalesce(F.sum("collected_comment_count"), F.lit(0)).cast("bigint").alias("total_collected_comments"),
    )


def artifact_status(artifacts: DataFrame, key: str) -> DataFrame:
    """Per video over its comment artifacts: artifact, comment and real counts, any real / empty state."""
    return artifacts.groupBy(key).agg(
        F.count(F.lit(1)).alias("artifact_count"),
        F.sum("comment_count").cast("bigint").alias("comments"),
        F.sum("real_comment_count").cast("bigint").alias("real"),
        F.bool_or(F.col("real_comment_count") > 0).alias("has_non_empty_comments"),
        F.bool_or(F.coalesce(F.col("stop_reason") == "empty_comment_state", F.lit(False))).alias("has_observed_no_comment"),
    )


def status_totals(per_video: DataFrame) -> DataFrame:
    return per_video.agg(
        F.coalesce(F.sum("artifact_count"), F.lit(0)).cast("bigint").alias("comment_artifact_count"),
        F.count(F.lit(1)).alias("comment_video_count"),
        count_where(F.col("real") > 0).alias("real_comment_video_count"),
        count_where(F.col("comments") == 0).alias("empty_comment_video_count"),
        count_where((F.col("comments") > 0) & (F.col("real") == 0)).alias("noise_only_video_count"),
        F.coalesce(F.sum("comments"), F.lit(0)).cast("bigint").alias("total_comment_count"),
        F.coalesce(F.sum("real"), F.lit(0)).cast("bigint").alias("total_real_comment_count"),
    )


# Scan fields that are counted as reasons, longest reason text that a report shows.
SCAN_FIELDS = ("stop_reason", "stop_reason_detail", "backend")
REASON_SIZE = 160


def clean_reason(c: Column) -> Column:
    """Whole reason with single blanks; reasons are counted as they are."""
    return F.regexp_replace(text(c), r"\s+", " ")


def shown_reason(c: Column, size: int = REASON_SIZE) -> Column:
    """A counted reason as a report shows it."""
    return F.left(c, F.lit(size))


def scan_reasons(artifacts: DataFrame, keep: Sequence[str], fields: Sequence[str] = SCAN_FIELDS, warnings: str | None = "warnings") -> DataFrame:
    """One row per reason of an artifact's scan record."""
    parts = [
        F.when(clean_reason(F.col(f)) != "", F.concat(F.lit(f"scan_meta.{f}:"), clean_reason(F.col(f)))) for f in fields
    ]
    found = F.array_compact(F.array(*parts))
    if warnings:
        warned = F.filter(F.transform(F.col(warnings), clean_reason), lambda w: w != "")
        named = F.transform(warned, lambda w: F.concat(F.lit("scan_meta.warning:"), w))
        found = F.concat(found, F.coalesce(named, F.array().cast("array<string>")))
    return exploded(artifacts, keep, found, "reason")


def item_reasons(comments: DataFrame, keep: Sequence[str]) -> DataFrame:
    """One row per reason of a raw comment record (stub, error, response_url)."""
    url = F.regexp_replace(F.regexp_replace(text("response_url"), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"[?].*$", "")
    err = clean_reason(F.col("error"))
    parts = [
        F.when(F.col("stub"), F.lit("raw.stub:true")),
        F.when(err != "", F.concat(F.lit("raw.error:"), err)),
        F.when(url != "", F.concat(F.lit("raw.response_url:"), url)),
    ]
    return exploded(comments, keep, F.array_compact(F.array(*parts)), "reason")


def reason_totals(reasons: DataFrame, keys: Sequence[str]) -> DataFrame:
    return reasons.groupBy(*keys, "reason").agg(F.count(F.lit(1)).alias("n"))


def batch_totals(rows: DataFrame, account: str, counters: Sequence[str]) -> DataFrame:
    """Counters per account and overall (account null), with success rates to 6 digits."""
    sums = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(c) for c in counters]
    out = rows.rollup(account).agg(*sums)
    return out.withColumn(
        "detail_success_rate", rate(F.col("detail_success"), F.col("detail_attempted"), 6)
    ).withColumn("comment_success_rate", rate(F.col("comments_success"), F.col("comments_attempted"), 6))


def chunk_reports(rows: DataFrame, chunk: str) -> DataFrame:
    """Counters, duration, status and rates per chunk of targets."""
    sums = ["video_total", "detail_attempted", "detail_success", "comment_attempted", "comment_success",
            "detail_meaningful", "comment_meaningful", "failed_count"]
    out = rows.groupBy(chunk).agg(
        F.count(F.lit(1)).alias("chunk_size"),
        *[F.sum(c).cast("bigint").alias(c) for c in sums],
        F.bround(F.sum("duration_sec"), 6).alias("duration_sec"),
    )
    pairs = {
        "detail_success_rate": ("detail_success", "detail_attempted"),
        "comment_success_rate": ("comment_success", "comment_attempted"),
        "detail_meaningful_rate": ("detail_meaningful", "detail_attempted"),
        "comment_meaningful_rate": ("comment_meaningful", "comment_attempted"),
    }
    for name, (a, z) in pairs.items():
        out = out.withColumn(name, rate(F.col(a), F.col(z), 6))
    return out.withColumn("status", F.when(F.col("failed_count") > 0, "failed").otherwise("success"))


def master_summary(chunks: DataFrame) -> DataFrame:
    """One row over all chunk reports."""
    sums = ["video_total", "detail_attempted", "detail_success", "comment_attempted", "comment_success",
            "detail_meaningful", "comment_meaningful", "failed_count"]
    out = chunks.agg(
        F.sum("chunk_size").cast("bigint").alias("target_count"),
        *[F.sum(c).cast("bigint").alias(c) for c in sums],
        F.count(F.lit(1)).alias("chunk_count"),
        count_where(F.col("status") == "success").alias("chunk_success_count"),
        count_where(F.col("status") == "failed").alias("chunk_failed_count"),
        F.bround(F.sum("duration_sec"), 6).alias("total_duration_sec"),
    )
    return out.withColumn("detail_success_rate", rate(F.col("detail_success"), F.col("detail_attempted"), 6)).withColumn(
        "comment_success_rate", rate(F.col("comment_success"), F.col("comment_attempted"), 6)
    )


def baselines(accounts: DataFrame) -> DataFrame:
    """Maxima of the per-account counters and global sums, one row."""
    return accounts.agg(
        F.count(F.lit(1)).alias("account_count"),
        *[F.coalesce(F.max(c), F.lit(0)).alias(f"max_{c}")
          for c in ("videos_seen", "detail_success", "comments_success", "warnings_count")],
        F.coalesce(F.sum("failed_count"), F.lit(0)).cast("bigint").alias("global_failed_count"),
    )


def download_totals(results: DataFrame) -> DataFrame:
    ok = F.col("status") == "success"
    err = F.lower(text("ytdlp_error"))
    return results.agg(
        F.count(F.lit(1)).alias("jobs_total"),
        count_where(ok).alias("success_count"),
        count_where(~F.coalesce(ok, F.lit(False))).alias("failed_count"),
        count_where(F.coalesce(F.col("fallback_used"), F.lit(False))).alias("fallback_count"),
        F.coalesce(F.sum("file_size"), F.lit(0)).cast("bigint").alias("total_file_size"),
        count_where(err != "").alias("ytdlp_error_count"),
        count_where(err.contains("fresh cookies")).alias("fresh_cookies_required_count"),
    )


def error_samples(results: DataFrame, order: Sequence[Column], k: int = 5) -> DataFrame:
    """First k error rows in order (a report sample)."""
    err = F.coalesce(F.nullif(text("error"), F.lit("")), text("ytdlp_error"))
    return results.withColumn("error_text", err).where(F.col("error_text") != "").orderBy(*order).limit(k)


def progress_rows(accounts: DataFrame, goal: int) -> DataFrame:
    """Remaining, completed and progress per account row with a ``downloaded`` count."""
    got = F.col("downloaded")
    ratio = bounded(F.col("downloaded") / F.lit(float(goal))) if goal > 0 else F.lit(0.0)
    return accounts.withColumns({
        "target": F.lit(goal).cast("bigint"),
        "remaining": F.greatest(F.lit(0), F.lit(goal) - got).cast("bigint"),
        "completed": got >= goal,
        "progress": ratio,
    })


def progress_totals(rows: DataFrame, goal: int) -> DataFrame:
    n = F.count(F.lit(1))
    done = F.count_if(F.col("completed"))
    got = F.coalesce(F.sum("downloaded"), F.lit(0))
    return rows.agg(
        n.alias("goal_accounts"), done.cast("bigint").alias("completed_accounts"),
        (n - done).alias("remaining_accounts"), (n * goal).alias("target_videos"),
        got.cast("bigint").alias("downloaded_videos"),
        F.bround(bounded(rate(got, n * goal)), 6).alias("download_progress"),
    )


def comment_stats(comments: DataFrame, keys: Sequence[str], video: str, question: str) -> DataFrame:
    """Collected comments, author replies, questions and commented videos per key."""
    n = F.count(F.lit(1))
    asked = F.count_if(F.col("sentiment") == question)
    return comments.groupBy(*keys).agg(
        n.alias("collected"),
        count_where(F.col("is_author_reply")).alias("author_replies"),
        asked.cast("bigint").alias("question_count"),
        F.count_distinct(video).alias("videos_with_comments"),
        rate(asked, n, 4).alias("question_rate"),
    )


def topic_counts(comments: DataFrame, topics: str, keys: Sequence[str] = ()) -> DataFrame:
    return exploded(comments, keys, topics, "topic").groupBy(*keys, "topic").agg(F.count(F.lit(1)).alias("n"))


def top_topics(comments: DataFrame, topics: str, keys: Sequence[str], k: int = 3) -> DataFrame:
    ranked = top_per_key(topic_counts(comments, topics, keys), keys, [F.col("n").desc(), F.col("topic").asc()], k)
    return ranked


def topic_examples(comments: DataFrame, topics: str, body: str, order: Sequence[Column], k: int = 5) -> DataFrame:
    """Per topic its count and the first k texts in order.

    The k rows are cut per task before any text is shipped, so a topic that
    holds most comments costs no more than a rare one.
    """
    tall = exploded(comments, comments.columns, topics, "topic")
    totals = tall.groupBy("topic").agg(F.count(F.lit(1)).alias("n"))
    few = top_per_key(tall, ["topic"], order, k)
    listed = few.groupBy("topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", body))), lambda x: x[body]).alias("examples"))
    return totals.join(listed, "topic")


def merge_counters(tables: Sequence[DataFrame], counters: str) -> DataFrame:
    """Sum of map counters by key over several diagnostics tables."""
    parts = [t.select(F.explode(counters).alias("counter", "v")) for t in tables]
    both = parts[0]
    for p in parts[1:]:
        both = both.unionByName(p)
    return both.groupBy("counter").agg(F.sum("v").cast("bigint").alias("n"))


def most_frequent(rows: DataFrame, keys: Sequence[str], values: str, name: str) -> DataFrame:
    """Most frequent element of an array column per key; ties by text."""
    counted = exploded(rows, keys, values, name).groupBy(*keys, name).agg(F.count(F.lit(1)).alias("n"))
    return top_per_key(counted, keys, [F.col("n").desc(), F.col(name).asc()], 1).select(*keys, name, "n")


def trusted_summary(rows: DataFrame, account: str = "source_name") -> list[Column]:
    n, odd = F.count(F.lit(1)), F.count_if(F.col("metric_suspicious"))
    trusted = F.when(~F.col("metric_suspicious"), F.col("trusted_engagement_score").cast("double"))
    return [
        n.alias("video_count"), (n - odd).alias("trusted_metric_count"), odd.cast("bigint").alias("suspicious_metric_count"),
        F.count_distinct(account).alias("account_count"),
        rounded(mean_or_zero("fit_score"), 2).alias("average_fit_score"),
        rounded(F.coalesce(F.avg(trusted), F.lit(0.0)), 2).alias("average_trusted_engagement"),
    ]


# -- summaries of runs -------------------------------------------------------------------

def homepage_summary(results: DataFrame, ids: int = 5, urls: int = 3, warnings: int = 3) -> DataFrame:
    """One row per crawled homepage of a batch, from ``target`` and ``crawl_result`` structs; nothing leaves its row.

    Samples are taken from the first videos; those without an id or URL are left out of them.
    Absent fields count as blank or 0. Ranked reports sort by video_count descending, then source_name.
    """
    target, crawl = results.schema["target"].dataType.fieldNames(), results.schema["crawl_result"].dataType
    videos = F.coalesce(F.col("crawl_result.videos"), F.lit(None).cast(crawl["videos"].dataType))
    has = crawl.fieldNames()
    counters = crawl["diagnostics"].dataType.fieldNames() if "diagnostics" in has else []
    of = lambda c: text(f"target.{c}") if c in target else F.lit("")
    told = F.coalesce(F.col("crawl_result.warnings"), F.array().cast("array<string>")) if "warnings" in has else F.array().cast("array<string>")

    def sample(c: str, k: int) -> Column:
        found = F.transform(F.slice(videos, 1, k), lambda v: v[c].cast("string"))
        return F.coalesce(F.filter(found, lambda x: x.isNotNull() & (x != "")), F.array().cast("array<string>"))

    return results.select(
        *[of(c).alias(c) for c in ("source_name", "homepage_url", "category_lv1", "category_lv2", "platform")],
        F.coalesce(F.when(videos.isNotNull(), F.size(videos)), F.lit(0)).cast("bigint").alias("video_count"),
        sample("video_id", ids).alias("sample_video_ids"), sample("video_url", urls).alias("sample_video_urls"),
        *[(text(f"crawl_result.{c}") if c in has else F.lit("")).alias(c) for c in ("backend", "extraction_version")],
        *[(F.coalesce(F.col(f"crawl_result.diagnostics.{c}"), F.lit(0)) if c in counters else F.lit(0)).cast("bigint").alias(c)
          for c in ("dom_href_count", "merged_unique_video_ids")],
        F.size(told).cast("bigint").alias("warnings_count"), F.slice(told, 1, warnings).alias("warnings_preview"),
    )


def homepage_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(F.count(F.lit(1)).alias("target_count"), F.coalesce(F.sum("video_count"), F.lit(0)).cast("bigint").alias("video_total"))


def coverage(downloads: DataFrame, details: DataFrame, artifacts: DataFrame, key: str, at: str, artifact: str, count: str = "comment_count") -> DataFrame:
    """Downloaded ids, those with a detail record, and the newest comment artifact of each id: artifacts, non-empty ones, rows."""
    have = downloads.agg(F.count_distinct(key).alias("n"))
    newest = latest_per_key(artifacts.where(F.col(key).isNotNull()), [key], at, artifact)
    rows = newest.agg(
        F.count(F.lit(1)).alias("artifact_videos"), F.count_if(F.col(count) > 0).alias("nonempty_videos"),
        F.coalesce(F.sum(count), F.lit(0)).cast("bigint").alias("total_rows"),
    )
    return rows.withColumns({"detail_covered": shared_count(downloads, details, key).scalar(), "downloaded": have.scalar()})


def download_status(targets: DataFrame, files: DataFrame, processed: DataFrame, source: str = "source_name") -> DataFrame:
    """Per target: local files and processed rows of its account, names compared in their normal form, and whether a refresh is due.

    Targets keep their other columns. An account with a third of all files is one row per task after the partial count.
    """
    name = account_key(source)
    count = lambda df, n: df.groupBy(name.alias("__name")).agg(F.count(F.lit(1)).alias(n))
    out = targets.withColumn("__name", name).join(count(files, "local_count"), "__name", "left").join(count(processed, "processed_count"), "__name", "left")
    filled_ = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("local_count", "processed_count")}
    return out.drop("__name").withColumns(filled_).withColumn("needs_refresh", F.col("local_count") > F.col("processed_count"))


def download_status_totals(status: DataFrame) -> DataFrame:
    return status.agg(F.count(F.lit(1)).alias("target_count"), F.count_if("needs_refresh").alias("needs_refresh_count"))


def run_status(chunks: DataFrame, ok: Column, size: str, total: Column | None = None) -> DataFrame:
    """Chunks of a run: all, done, failed, videos in the done ones; ``ok`` tells which are done, null where one has not ended."""
    done = F.coalesce(ok, F.lit(False))
    whole = F.coalesce(F.sum(size), F.lit(0)).cast("bigint") if total is None else total
    return chunks.agg(
        F.count(F.lit(1)).alias("chunk_count"), F.count_if(done).alias("completed_chunk_count"), F.count_if(~ok).alias("failed_count"),
        F.coalesce(F.sum(F.when(done, F.col(size))), F.lit(0)).cast("bigint").alias("processed_video_count"), whole.alias("total_video_count"),
        (F.count_if(~ok) == 0).alias("ok"),
    )
