"""Secret scans with an incremental blob ledger.

Every version of a path names its content by the SHA-256 of its text, the blob.
The ledger is a Parquet table with one row for each blob and rule that was
scanned, under the rule's version, with the spans found. A scan takes only the
pairs of blob and rule version that the ledger does not have, reads one version
of each such blob, appends what it found, and joins the findings of the ledger
back to all paths and versions that hold the blob. New versions of known content
cost no scan, a new rule version scans every blob for this one rule only. A scan
that fails appends nothing and is done again; repeated ledger rows change nothing.

Base kinds are assign, access and hex; a match that fails its length is dropped
and the search goes on after it. Further kinds: private_key (PEM blocks), jwt,
forge_token (tokens of code hosts), url_login (a password inside a URL). Spans
of one kind never overlap, spans of different kinds may. Offsets count code
points, ends are exclusive; patterns run in linear time over whole texts.

Null texts are empty and have no spans. Null paths and versions stay. Repeated
rows get equal results, an empty table gives none, other columns play no part.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipwell.llm.common import durable, small, text_of

BASE = ("assign", "access", "hex")
KINDS = (*BASE, "private_key", "jwt", "forge_token", "url_login")
#: Patterns of the base kinds, letters of the first one's names in either case.
_ASSIGN = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_BLOCK = re.compile(r"-----BEGIN (?:[A-Z]+ )?PRIVATE KEY-----")
_BLOCK_END = re.compile(r"-----END (?:[A-Z]+ )?PRIVATE KEY-----")
_JWT = re.compile(r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{8,}+")
_FORGE = re.compile(r"(?<![A-Za-z0-9_])(?:gh[pousr]_[A-Za-z0-9]{36,}|glpat-[A-Za-z0-9_-]{20,}|xox[abprs]-[A-Za-z0-9-]{10,})")
_LOGIN = re.compile(r"://[^\s/:@]{1,64}:([^\s/:@]{3,128})@")
#: Ledger keys of 32 bytes that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST = 500_000
FINDINGS = "blob binary, rule string, version int, spans array<struct<start: bigint, end: bigint>>"

Spans = list[tuple[int, int]]


def _assigned(t: str) -> Spans:
    return [m.span() for m in _ASSIGN.finditer(t) if m.end(1) - m.start(1) >= 6]


def _blocks(t: str) -> Spans:
    """From each BEGIN line to the next END line; a block without an end is its BEGIN line."""
    out, at = [], 0
    while m := _BLOCK.search(t, at):
        end = _BLOCK_END.search(t, m.end())
        if end is None:
            return [*out, *(x.span() for x in _BLOCK.finditer(t, m.start()))]
        out.append((m.start(), at := end.end()))
    return out


def _all(pattern: re.Pattern, mark: str) -> Callable[[str], Spans]:
    return lambda t: [m.span() for m in pattern.finditer(t)] if mark in t else []


def _every(pattern: re.Pattern) -> Callable[[str], Spans]:
    return lambda t: [m.span() for m in pattern.finditer(t)]


#: Rule to its version and its search; a changed search needs a new version.
RULES: dict[str, tuple[int, Callable[[str], Spans]]] = {
    # {16,} and {24,} find the same spans as a search for any length whose short matches are dropped:
    # a match takes the whole run of its characters, so a run that is too short holds no other match
    "assign": (1, _assigned),
    "access": (1, _all(_ACCESS, "AKIA")),
    "hex": (1, _every(_HEX)),
    "private_key": (1, _blocks),
    "jwt": (1, _all(_JWT, "eyJ")),
    "forge_token": (1, _every(_FORGE)),
    "url_login": (1, _all(_LOGIN, "://")),
}


def _scanner(rules: dict[str, tuple[int, Callable[[str], Spans]]]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            out = []
            for blob, names, text in zip(f.blob, f.rules, f.text):
                for name in names:
                    version, search = rules[name]
                    out.append((blob, name, version, [{"start": s, "end": e} for s, e in search(text)]))
            yield pd.DataFrame(out, columns=["blob", "rule", "version", "spans"])

    return run


def _versions(history: DataFrame, key: str, text: str) -> DataFrame:
    """``history`` narrowed to path and blob, with a name for the version: its blob and path."""
    blob = F.unhex(F.sha2(text_of(f"`{text}`").cast("binary"), 256))
    path = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("\x00null"))
    rows = history.select(F.col(f"`{key}`").alias("path"), blob.alias("blob"), text_of(f"`{text}`").alias("text"), path.alias("__path"))
    return rows.withColumn("name", F.unhex(F.md5(F.concat("blob", F.col("__path").cast("binary"))))).drop("__path")


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Scanned pairs and their findings; empty where nothing was scanned yet."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    known = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    return spark.read.schema(FINDINGS).parquet(folder) if known else spark.createDataFrame([], FINDINGS)


def unseen(versions: DataFrame, known: DataFrame, rules: dict) -> DataFrame:
    """(blob, name, rules): blobs with the rules that the ledger has no row for, and the version that is read for each."""
    current = reduce(lambda a, b: a | b, [(F.col("rule") == r) & (F.col("version") == v) for r, (v, _) in rules.items()])
    done = known.where(current).groupBy("blob").agg(F.collect_set("rule").alias("done"))  # at most one entry per rule
    blobs = versions.groupBy("blob").agg(F.min("name").alias("name"))
    wanted = F.array_except(F.array(*map(F.lit, rules)), F.coalesce("done", F.array().cast("array<string>")))
    return blobs.join(done, "blob", "left").select("blob", "name", wanted.alias("rules")).where(F.size("rules") > 0)


def scan(history: DataFrame, folder: str, key: str = "doc_id", text: str = "text", rules: dict = RULES) -> int:
    """Scan what ``folder``'s ledger has not seen and append it; the number of pairs of blob and rule scanned."""
    spark = history.sparkSession
    rows = _versions(history, key, text)
    todo = durable(unseen(rows.select("blob", "name"), ledger(spark, folder), rules))
    pairs = todo.agg(F.sum(F.size("rules"))).first()[0] or 0
    if pairs:
        picked = small(todo.select("name", "rules"), MAX_BROADCAST)
        texts = rows.join(picked, "name").select("blob", "rules", "text")
        found = texts.mapInPandas(_scanner(rules), FINDINGS)
        found.write.mode("append").parquet(folder)
    return pairs


def findings(history: DataFrame, folder: str, key: str = "doc_id", text: str = "text", rules: dict = RULES) -> DataFrame:
    """One row per row of ``history``: doc_id, blob, and spans (kind, start, end) by start and kind, from the ledger."""
    known = ledger(history.sparkSession, folder).where(F.size("spans") > 0)
    order = {r: i for i, r in enumerate(rules)}
    rank = F.create_map(*[F.lit(x) for r, i in order.items() for x in (r, i)])
    current = F.create_map(*[F.lit(x) for r, (v, _) in rules.items() for x in (r, v)])
    one = F.explode("spans").alias("s")
    spans = known.where(F.col("version") == current[F.col("rule")]).select("blob", "rule", one)
    spans = spans.select("blob", F.struct(F.col("s.start").alias("start"), rank[F.col("rule")].alias("at"), F.col("s.end").alias("end"), F.col("rule").alias("kind")).alias("s"))
    # a set: repeated ledger rows give each span once; it holds the spans of one text
    by_blob = spans.groupBy("blob").agg(F.sort_array(F.collect_set("s")).alias("spans"))
    plain = F.transform("spans", lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    by_blob = by_blob.select("blob", plain.alias("spans"))
    rows = _versions(history, key, text).select(F.col("path").alias("doc_id"), "blob")
    none = F.array().cast("array<struct<kind: string, start: bigint, end: bigint>>")
    return rows.join(by_blob, "blob", "left").withColumn("spans", F.coalesce("spans", none))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
