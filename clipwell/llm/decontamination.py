"""Benchmark decontamination by spaced-seed hashing.

Tokens are words in lower case with ASCII punctuation as blanks. A fixed mask
keeps some positions of a window and ignores the others; windows of test items
and of documents meet on the hash of the kept tokens. A hit fixes an item and an
offset; there the two texts are compared token by token. An overlap is a segment
with ``min_words`` equal tokens, or 80 % of a shorter item's but never under six,
of which at least ``min_same`` are equal; of these segments the one with the most
equal tokens is reported, without substitutions at its ends.

The masks hit every overlap within the default bounds and any stricter ones: with
k substitutions it has at least max(10, 4 k) equal tokens in k + 1 runs, so one
run has four, or all are three long and 1110111 meets two of them; items of 6 to
11 tokens are covered by enumeration, with 111001011 for 3-2-3. Looser bounds
find only what a mask hits.

Items are the small side. Each different text is searched once, however many items
have it, and their ids are joined back. A running sum of the texts' tokens cuts them
into blocks of ``block_tokens``. Each block is broadcast and compared with all
documents, so the small side may grow without a larger broadcast; one text is never
divided, so a block may pass the bound by its last text. Items of fewer than six
tokens cannot be told from chance and match nothing.

Null or empty texts have no tokens and match nothing, null ids stay null,
repeated rows are each reported, empty tables give no rows, other columns play
no part. Equal counts: the first segment, of the smallest offset, counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import repeat
from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwell.llm.common import digest, durable, row_key, small, text_of
from clipwell.operators.ordering import with_running_total

#: Kept (1) and ignored (0) positions.
MASKS = ("1111", "1110111", "111001011", "110100111")
#: Fewest equal tokens of an overlap.
LEAST = 6
BLOCK_TOKENS = 500_000
#: Keys of 16 bytes that may be broadcast; more are joined by a shuffle.
MAX_BROADCAST = 500_000
_PUNCTUATION = bytes(b if chr(b).isalnum() or b > 127 else 32 for b in range(256))
#: What ``tokens`` keeps, for counting.
_TOKEN = r"[A-Za-z0-9[^\x00-\x7F]]+"
SCHEMA = "doc_id string, row_key binary, item_key binary, matched_words bigint, substitutions bigint, item_words bigint, start_word bigint, end_word bigint"


def tokens(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "replace").translate(_PUNCTUATION).split()


_FACTORS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB], np.uint64)


def _hashes(ids: np.ndarray, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows whose kept tokens are all known (id >= 0)."""
    n = len(ids) - len(mask) + 1
    if n < 1:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    care = [i for i, c in enumerate(mask) if c == "1"]
    known = ids >= 0
    ok = known[care[0] : care[0] + n].copy()
    for i in care[1:]:
        ok &= known[i : i + n]
    at = np.flatnonzero(ok)
    h = np.zeros(len(at), np.uint64)
    for i, f in zip(care, _FACTORS):
        h += (ids[at + i] + 1).astype(np.uint64) * f
        h ^= h >> np.uint64(29)
    return at, h


class Block:
    """Items with the seed table of their windows; broadcast to the tasks."""

    def __init__(self, items: list[tuple[bytes | int | None, str]]):
        words = [tokens(t or "") for _, t in items]
        self.item_ids = [i for i, _ in items]
        self.vocabulary = {w: k for k, w in enumerate(sorted({w for ws in words for w in ws}))}
        self.items = [np.fromiter(map(self.vocabulary.__getitem__, ws), np.int64, len(ws)) for ws in words]
        self.tables = []
        for mask in MASKS:
            found = [_hashes(x, mask) for x in self.items]
            h = np.concatenate([b for _, b in found]) if found else np.empty(0, np.uint64)
            item = np.repeat(np.arange(len(found)), [len(a) for a, _ in found])
            start = np.concatenate([a for a, _ in found]) if found else np.empty(0, np.int64)
            order = np.argsort(h, kind="stable")
            self.tables.append((h[order], item[order], start[order]))

    def overlaps(self, text: str, min_words: int, min_same: float) -> list[tuple]:
        """(item, matched, substitutions, item words, start, end) of each item that overlaps the text, best segment each."""
        ws = tokens(text)
        ids = np.fromiter(map(self.vocabulary.get, ws, repeat(-1)), np.int64, len(ws))
        seen = []
        for mask, (table, item, start) in zip(MASKS, self.tables):
            at, h = _hashes(ids, mask)
            low = np.searchsorted(table, h)
            hit = low < len(table)
            hit[hit] = table[low[hit]] == h[hit]
            at, low, high = at[hit], low[hit], np.searchsorted(table, h[hit], side="right")
            owner = np.repeat(np.arange(len(at)), high - low)
            place = np.arange(len(owner)) - np.repeat(np.cumsum(high - low) - (high - low), high - low) + low[owner]
            seen.append(np.stack([item[place], at[owner] - start[place]], 1))
        best: dict[int, tuple] = {}
        for k, shift in np.unique(np.concatenate(seen), axis=0).tolist():
            own = self.items[k]
            a, b = max(0, -shift), min(len(own), len(ids) - shift)
            same = own[a:b] == ids[a + shift : b + shift]
            need = min(min_words, max(LEAST, ceil(0.8 * len(own))))
            if int(same.sum()) < need:
                continue
            low, high = _segment(same, min_same)
            n, matched = high - low, int(same[low:high].sum())
            if matched >= need and matched >= min_same * n and (k not in best or matched > best[k][1]):
                first = a + shift + low
                best[k] = (k, matched, n - matched, len(own), first, first + n)
        return list(best.values())


def _segment(same: np.ndarray, min_same: float) -> tuple[int, int]:
    """Bounds of the segment with the most equal tokens among those with a share of ``min_same``, cut to its equal tokens."""
    share = Fraction(str(min_same))
    total = np.concatenate(([0], np.cumsum(np.where(same, share.denominator - share.numerator, -share.numerator))))
    # a sum of 0 or more is a share of min_same or more; to each end belongs the first begin that reaches it
    low = np.searchsorted(-np.minimum.accumulate(total), -total)
    count = np.concatenate(([0], np.cumsum(same)))
    high = int(np.argmax(count - count[low]))
    first = int(low[high])
    return first + (int(np.argmax(same[first:high])) if first < high else 0), high


def _search(block, min_words: int, min_same: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        b = block.value
        for f in frames:
            out = []
            for doc_id, key, text in zip(f.doc_id, f.row_key, f.text):
                for k, *rest in b.overlaps(text, min_words, min_same):
                    out.append((doc_id, key, b.item_ids[k], *rest))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])

    return run


def blocks_of(items: DataFrame, text: str = "text", block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(item_key, t, block): the different texts of at least ``LEAST`` tokens, dealt to blocks by a running sum of their tokens."""
    texts = items.select(text_of(f"`{text}`").alias("t")).distinct()
    texts = texts.select(digest(F.col("t")).alias("item_key"), "t", F.regexp_count("t", F.lit(_TOKEN)).cast("long").alias("size")).where(f"size >= {LEAST}")
    placed = with_running_total(texts, ["item_key"], "size", "upto")
    return placed.select("item_key", "t", F.floor((F.col("upto") - F.col("size")) / block_tokens).cast("long").alias("block"))


def overlapping(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item_text: str = "text",
    min_words: int = 10, min_same: float = 0.8, block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document and item text that overlap: row_key, item_key and the columns of ``contaminated``."""
    spark = docs.sparkSession
    blocks = durable(blocks_of(items, item_text, block_tokens))
    rows = docs.select(
        F.col(f"`{key}`").cast("string").alias("doc_id"), row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_key"),
        text_of(f"`{text}`").alias("text"),
    )
    out = spark.createDataFrame([], SCHEMA)
    last = blocks.agg(F.max("block")).first()[0]
    for b in range(0 if last is None else last + 1):
        own = blocks.where(F.col("block") == b).select("item_key", "t").orderBy("item_key").collect()  # at most block_tokens and one text
        if own:
            block = spark.sparkContext.broadcast(Block([(bytes(k), t) for k, t in own]))
            found = rows.mapInPandas(_search(block, min_words, min_same), SCHEMA)
            out = found if b == 0 else out.unionByName(found)
    return out.withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    **bounds,
) -> DataFrame:
    """One row per document and item that overlap: the words that match, are substituted, and their span in tokens."""
    found = overlapping(docs, benchmark, key, text, item_text, **bounds)
    items = benchmark.select(F.col(f"`{item_key}`").cast("long").alias("item_id"), digest(F.col(f"`{item_text}`")).alias("item_key"))
    columns = [c for c in found.columns if c != "item_key"]
    return found.join(items, "item_key").select(*columns[:2], "item_id", *columns[2:])


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that overlap no item, columns as they are."""
    bad = overlapping(docs, benchmark, key, text, **how).select(F.col("row_key").alias("__bad")).distinct()
    bad = small(durable(bad), MAX_BROADCAST)
    wide = docs.withColumn("__key", row_key(F.col(f"`{key}`"), F.col(f"`{text}`")))
    return wide.join(bad, F.col("__key") == F.col("__bad"), "left_anti").drop("__key")
