"""The corpus queries and their SQL twins, as the entry module registers them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from clipwell.llm import chat, decontamination, hard_negatives, line_chunks, line_quality, mixing, personal_data, phrases, secret_ledger, sharding, simhash, sql, token_files, toxicity
from clipwell.llm.common import checkpoint_folder, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, twin: str | None = None):
    def wrap(fn):
        QUERIES[name] = fn
        if twin is not None:
            ORACLES[name] = twin
        return fn

    return wrap


@query("op1_toxicity_scores")
def op1_toxicity_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity score of every document, learned from the rows that are not held out."""
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1
    model = toxicity.fit(toxicity.labelled_sample(docs, labels.where(~out), sample=4000))
    scores = toxicity.scored(docs, model)
    return scores.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op2_byte_shards")
def op2_byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    """Every document in one of 24 contiguous shards of nearly equal bytes."""
    return sharding.shard_places(read(spark, folder, "documents"), 24)


@query("op3_mixed_sources", sql.MIXING)
def op3_mixed_sources(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes from every document."""
    return mixing.mixed(read(spark, folder, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op4_simhash_components")
def op4_simhash_components(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(read(spark, folder, "documents")).drop("root", "row_key")


@query("op5_chat_format")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations, and one that holds the template's own control strings, formatted and read back."""
    turns = read(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    clash = F.lit("\\### Assistant: </turn> ok")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), clash.alias("text"),
    )
    return chat.read_back(chat.formatted(turns.unionByName(own)))


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    found = personal_data.personal_data(read(spark, folder, "documents"))
    base = F.filter("spans", lambda x: x["kind"].isin(*personal_data.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in personal_data.BASE]
    digest = F.sha2(personal_data.joined(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, personal_data.joined(F.col("spans")).alias("spans"))


@query("op7_token_files")
def op7_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Index of the ORC token files of all documents, read back from the files."""
    import public_tokenizers

    files = f"{checkpoint_folder(spark)}/tokens-{uuid.uuid4().hex}"
    token_files.write_tokens(read(spark, folder, "documents"), files, public_tokenizers.path("byte_bpe_50k.json"))
    return token_files.token_index(spark, files)


@query("op8_line_quality", sql.LINE_QUALITY)
def op8_line_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Base measures and the line-frequency verdict of every document."""
    return line_quality.line_verdicts(read(spark, folder, "documents")).drop("removed_lines", "host", "text_key")


@query("op9_line_chunks", sql.LINE_CHUNKS)
def op9_line_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """Every run of lines that repeats chunks of an earlier place."""
    return line_chunks.repeated_chunks(read(spark, folder, "documents")).drop("row_key")


@query("op9_line_runs")
def op9_line_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Every run of lines that stands in an earlier passage."""
    return line_chunks.repeated_runs(read(spark, folder, "documents")).drop("row_key")


@query("op10_benchmark_overlaps")
def op10_benchmark_overlaps(spark: SparkSession, folder: str) -> DataFrame:
    """Every document and benchmark item that overlap, substitutions allowed."""
    found = decontamination.contaminated(read(spark, folder, "documents"), read(spark, folder, "benchmark"))
    return found.drop("row_key")


@query("op11_hard_negatives", sql.HARD_NEGATIVES)
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every 50th vector and its five best rows of the same label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = read(spark, folder, "embeddings").withColumn("label", moved)
    return hard_negatives.mined(rows, F.col("id") % 50 == 0)


@query("op12_phrase_collocations", sql.PHRASES)
def op12_phrase_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best 2,000 phrases of every language."""
    return phrases.collocations(read(spark, folder, "documents"))


@query("op13_secret_ledger")
def op13_secret_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document, from a new ledger."""
    docs, kept = read(spark, folder, "documents"), f"{checkpoint_folder(spark)}/secrets-{uuid.uuid4().hex}"
    secret_ledger.scan(docs, kept)
    found = secret_ledger.findings(docs, kept)
    base = F.filter("spans", lambda x: x["kind"].isin(*secret_ledger.BASE))
    count = lambda kind: F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")
    counts = [count(kind).alias(f"n_{kind}") for kind in secret_ledger.BASE]
    digest = F.sha2(secret_ledger.joined(base).cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", *counts, digest, secret_ledger.joined(F.col("spans")).alias("spans"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL is not None:
    ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
