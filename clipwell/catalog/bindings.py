"""Views that give the driver's tables the shape of the content model.

``Tables`` holds the Spark side; ``SQL`` holds the same views as DuckDB CTEs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


UTC = ("UTC", "Etc/UTC", "GMT", "Z")


class Tables:
    def __init__(self, spark: SparkSession, folder: str):
        # The twins read timestamps without a zone as UTC; another zone gets a session of its own.
        if spark.conf.get("spark.sql.session.timeZone") not in UTC:
            spark = spark.newSession()
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- relational posts -----------------------------------------------------
    def videos(self) -> DataFrame:
        return self.raw("part").select(
            F.col("p_partkey").alias("video_id"), F.col("p_brand").alias("account_id"), F.col("p_name").alias("title")
        )

    def metrics(self) -> DataFrame:
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_partkey").alias("video_id"))
            .agg(
                F.sum("l_quantity").cast("bigint").alias("view_count"),
                F.count(F.lit(1)).alias("like_count"),
                F.count_if(F.col("l_returnflag") == "R").alias("comment_count"),
                F.count_if(F.col("l_linestatus") == "O").alias("share_count"),
            )
        )

    # -- texts ----------------------------------------------------------------
    def posts(self) -> DataFrame:
        """Documents as posts: first line is the title, the rest stays whole in ``text``."""
        return self.raw("documents").select(
            F.col("doc_id").alias("video_id"),
            F.col("source").alias("account_id"),
            F.split_part("text", F.lit("\n"), F.lit(1)).alias("title"),
            "text",
            "lang",
            "n_chars",
        )

    def comments(self) -> DataFrame:
        return self.raw("conversations").select(
            F.col("conv_id").alias("video_id"),
            F.col("turn"),
            F.concat_ws(":", "conv_id", "turn").alias("comment_id"),
            F.col("role"),
            (F.col("role") == "assistant").alias("is_author_reply"),
            "text",
        )

    # -- crawl batch ----------------------------------------------------------
    def batch_accounts(self) -> DataFrame:
        kind = F.col("event_type")
        return (
            self.raw("events")
            .groupBy(F.col("user_id").alias("account_id"))
            .agg(
                F.count_if(kind == "view").alias("videos_seen"),
                F.count_if(kind == "click").alias("detail_success"),
                F.count_if(kind == "purchase").alias("comments_success"),
                F.count_if((kind == "error") & (F.col("value") > 150)).alias("warnings_count"),
                F.count_if((kind == "signup") & (F.col("value") > 200)).alias("failed_count"),
            )
        )

    def events(self) -> DataFrame:
        return self.raw("events").withColumn("ts", F.col("ts").cast("timestamp"))

    # -- observed features ----------------------------------------------------
    def features(self) -> DataFrame:
        """One row of numeric features per post (from parts and their line items)."""
        v, m = self.videos(), self.metrics()
        p = self.raw("part").select(F.col("p_partkey").alias("video_id"), "p_size", "p_retailprice")
        id_ = F.col("video_id")
        return (
            v.join(m, "video_id")
            .join(p, "video_id")
            .select(
                "video_id",
                F.col("account_id").alias("source_name"),
                "title",
                "view_count", "like_count", "comment_count", "share_count",
                (F.col("like_count") + 3 * F.col("comment_count") + 2 * F.col("share_count")).alias("engagement_score"),
                (F.col("p_size") + 40).cast("double").alias("fit_score"),
                (F.col("p_size") / 50.0).alias("ocr_readability"),
                (F.pmod(id_ * 7, F.lit(11)) / 10.0).alias("subtitle_consistency"),
                (F.pmod(id_ * 3, F.lit(7)) / 6.0).alias("structure_completeness"),
                (F.pmod(id_, F.lit(13)) / 12.0).alias("face_center_score"),
                (F.pmod(id_, F.lit(9)) / 100.0).alias("face_ratio"),
                (F.pmod(id_, F.lit(17)) / 16.0).alias("pose_facing_score"),
                (F.lit(180.0) + F.pmod(id_ * 13, F.lit(220))).alias("speech_rate_cpm"),
                (F.pmod(id_, F.lit(5)) / 2.0).alias("person_count"),
                (F.pmod(id_, F.lit(3)) / 2.0).alias("opening_hook_score"),
                (F.pmod(id_, F.lit(8)) / 7.0).alias("knowledge_density"),
            )
        )


def even(x: str, digits: int) -> str:
    """Half-even rounding of a double's shortest decimal form, as Spark's ``bround`` does it."""
    return f"CAST(round_even(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 17)), {digits}) AS DOUBLE)"


def mean(x: str, digits: int) -> str:
    """Twin of ``rounded``: cut to 10 digits first, then half-even."""
    return even(f"round_even({x}, 10)", digits)


VIDEOS = "videos AS (SELECT p_partkey AS video_id, p_brand AS account_id, p_name AS title FROM part)"
METRICS = """metrics AS (SELECT l_partkey AS video_id, CAST(sum(l_quantity) AS BIGINT) AS view_count,
  count(*) AS like_count, count(*) FILTER (l_returnflag = 'R') AS comment_count,
  count(*) FILTER (l_linestatus = 'O') AS share_count FROM lineitem GROUP BY l_partkey)"""
POSTS = """posts AS (SELECT doc_id AS video_id, source AS account_id, string_split(text, chr(10))[1] AS title,
  text, lang, n_chars FROM documents)"""
COMMENTS = """comments AS (SELECT conv_id AS video_id, turn, concat_ws(':', conv_id, turn) AS comment_id, role,
  role = 'assistant' AS is_author_reply, text FROM conversations)"""
BATCH = """batch AS (SELECT user_id AS account_id, count(*) FILTER (event_type = 'view') AS videos_seen,
  count(*) FILTER (event_type = 'click') AS detail_success,
  count(*) FILTER (event_type = 'purchase') AS comments_success,
  count(*) FILTER (event_type = 'error' AND value > 150) AS warnings_count,
  count(*) FILTER (event_type = 'signup' AND value > 200) AS failed_count FROM events GROUP BY user_id)"""
FEATURES = f"""{VIDEOS}, {METRICS}, features AS (SELECT v.video_id, v.account_id AS source_name, v.title,
  m.view_count, m.like_count, m.comment_count, m.share_count,
  m.like_count + 3 * m.comment_count + 2 * m.share_count AS engagement_score,
  CAST(p_size + 40 AS DOUBLE) AS fit_score, p_size / 50.0::DOUBLE AS ocr_readability,
  ((v.video_id * 7) % 11) / 10.0::DOUBLE AS subtitle_consistency,
  ((v.video_id * 3) % 7) / 6.0::DOUBLE AS structure_completeness,
  (v.video_id % 13) / 12.0::DOUBLE AS face_center_score, (v.video_id % 9) / 100.0::DOUBLE AS face_ratio,
  (v.video_id % 17) / 16.0::DOUBLE AS pose_facing_score,
  180.0::DOUBLE + (v.video_id * 13) % 220 AS speech_rate_cpm, (v.video_id % 5) / 2.0::DOUBLE AS person_count,
  (v.video_id % 3) / 2.0::DOUBLE AS opening_hook_score, (v.video_id % 8) / 7.0::DOUBLE AS knowledge_density
  FROM videos v JOIN metrics m USING (video_id) JOIN part ON p_partkey = v.video_id)"""

# Words of the invented texts, standing in for the default lexicons.
BOUND_TOPICS = {
    "english": ("the ", " and "),
    "french": (" les ", " une "),
    "german": (" der ", " und "),
    "spanish": (" para ", " los "),
    "passive": ("was ", "were "),
    "place": ("where", "then"),
}
BOUND_SENTIMENTS = {"negative": (" no ", "nicht", " pas "), "positive": (" with ", " avec "), "asking": ("when", "qui ")}
BOUND_NOISE = ("ththth", "zzz", "eauxeaux", "ungheit")
BOUND_HEAD = ("The", "Le", "Die", "In ")
