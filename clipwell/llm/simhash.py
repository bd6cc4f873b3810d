"""SimHash near-duplicates with BK-trees.

A text is lower-cased (A-Z only) and cut into word shingles; a bit of its
fingerprint is 1 if it is set in over half of the shingles' XXH64 values.
Fingerprints link when they differ in ``RADIUS`` bits or fewer, and linked ones
form components.

Trees. Two fingerprints within two bits agree on two of four 16-bit blocks, so
every pair of blocks is a key, and every bucket of equal keys holds a shard of
the fingerprints. A bucket becomes a BK-tree: the children of a node are keyed
by their Hamming distance to it, and a search follows only edges within the
radius of the distance to the node. Trees meet their queries in the bucket's
task rather than in a broadcast, which would grow with the corpus. A bucket of
more than ``MAX_TREE`` fingerprints is keyed again by pairs of the four 8-bit
blocks of its other 32 bits; 48 bits are then fixed, so no tree has more than
65,536 nodes and no link is lost. Within a bucket only the edges to the
smallest fingerprint of each local component leave the task.

Exact copies collapse to one fingerprint before any of this. A text without
words, a null or an empty one has fingerprint zero, linked like any other.
Null ids: the id of a component is the smallest non-null one, or null. Repeated
rows get equal results; an empty table gives none; other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from clipwell.llm.common import durable, row_key
from clipwell.llm.graph import components

RADIUS = 2
MAX_TREE = 4096
SHINGLE = 3
SEED = 42
_CHUNK = 1 << 16


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """Fingerprint of a UTF-8 text as an unsigned 64-bit number."""
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: lower() and split() know ASCII letters and blanks only
    n = len(words) - shingle + 1
    if not words:
        return 0
    joined = b" ".join(words)
    if n < 1:
        return xxh64_intdigest(joined, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n]
    ends = ends[shingle - 1 :]
    count = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        cut = map(slice, starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist())
        h = np.array(list(map(xxh64_intdigest, map(joined.__getitem__, cut), repeat(SEED))), np.uint64)
        count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0])


@F.pandas_udf(LongType())
def fingerprint_column(texts: pd.Series) -> pd.Series:
    found = np.fromiter((fingerprint(b) if b is not None else 0 for b in texts), np.uint64, len(texts))
    return pd.Series(found.view(np.int64))


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all ranges one after the other, and the range that each comes from."""
    n = ends - starts
    owner = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    return np.arange(n.sum()) - first[owner] + starts[owner], owner


class Forest:
    """BK-trees over the buckets of sorted (bucket, fingerprint) arrays, built level by level."""

    def __init__(self, buckets: np.ndarray, prints: np.ndarray):
        self.prints = prints
        new = np.r_[True, buckets[1:] != buckets[:-1]]
        self.root = np.flatnonzero(new)[np.cumsum(new) - 1]  # root of each item's tree
        keys, nodes = [], []
        items, top = np.flatnonzero(~new), self.root[~new]  # items to place, and the node above each
        while len(items):
            key = top * 65 + np.bitwise_count(prints[items] ^ prints[top])
            order = np.argsort(key, kind="stable")
            items, key = items[order], key[order]
            first = np.r_[True, key[1:] != key[:-1]]
            keys.append(key[first])
            nodes.append(items[first])
            top = items[first][np.cumsum(first) - 1]
            items, top = items[~first], top[~first]
        self.keys = np.concatenate(keys) if keys else np.empty(0, np.int64)
        order = np.argsort(self.keys)
        self.keys, self.nodes = self.keys[order], (np.concatenate(nodes)[order] if nodes else np.empty(0, np.int64))

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) pairs of one tree within the radius, without the query itself."""
        q, node, found = queries, self.root[queries], []
        while len(q):
            d = np.bitwise_count(self.prints[q] ^ self.prints[node]).astype(np.int64)
            hit = (d <= radius) & (q != node)
            found.append((q[hit], node[hit]))
            low = np.searchsorted(self.keys, node * 65 + np.maximum(d - radius, 0))
            high = np.searchsorted(self.keys, node * 65 + np.minimum(d + radius, 64), side="right")
            at, owner = _ranges(low, high)
            q, node = q[owner], self.nodes[at]
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def local_roots(buckets: np.ndarray, prints: np.ndarray, radius: int) -> np.ndarray:
    """Index of the smallest fingerprint of each item's local component; arrays are sorted by bucket and fingerprint."""
    forest, label = Forest(buckets, prints), np.arange(len(prints))
    # queries go in slices, so that the pairs of a dense tree stay few
    size = np.bincount(forest.root, minlength=len(prints))[forest.root]
    slices = np.flatnonzero(np.r_[True, np.diff(np.cumsum(size) // 2_000_000) > 0])
    for a, b in zip(slices, [*slices[1:], len(prints)]):
        q, node = forest.within(np.arange(a, b), radius)
        pairs = np.unique(np.sort(np.stack([label[q], label[node]], 1), axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if not len(pairs):
            continue
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while (y := up.get(x, x)) != x:
                up[x] = up.get(y, y)
                x = y
            return x

        for x, y in pairs.tolist():
            x, y = top(x), top(y)
            if x != y:
                up[max(x, y)] = min(x, y)
        moved = np.array(sorted(up))
        to = np.arange(len(label))
        to[moved] = [top(x) for x in moved.tolist()]
        label = to[label]
    return label


def _links(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Edges to local roots; rows come sorted by bucket and fingerprint, whole buckets are taken together."""
    held = None
    for more in frames:
        held = more if held is None else pd.concat([held, more], ignore_index=True)
        whole = int(held.bucket.searchsorted(held.bucket.iloc[-1])) if len(held) else 0
        if whole >= 1 << 17:
            yield _edges(held.iloc[:whole])
            held = held.iloc[whole:]
    if held is not None and len(held):
        yield _edges(held)


def _edges(rows: pd.DataFrame) -> pd.DataFrame:
    prints = rows.fp.to_numpy()
    root = local_roots(rows.bucket.to_numpy(), prints.view(np.uint64), RADIUS)
    far = root != np.arange(len(root))
    return pd.DataFrame({"a": prints[far], "b": prints[root[far]]})


def _block(at: int, bits: int):
    return F.shiftrightunsigned("fp", at).bitwiseAND(F.lit((1 << bits) - 1))


def linked(prints: DataFrame) -> DataFrame:
    """Distinct fingerprints (fp long) to edges (a, b) that connect every component of links within the radius."""
    pairs = list(combinations(range(4), 2))
    wide = [(i, j, F.shiftleft(_block(16 * i, 16), 16).bitwiseOR(_block(16 * j, 16))) for i, j in pairs]
    keyed = prints.select(
        "fp", F.explode(F.array(*[F.lit(t << 32).bitwiseOR(k) for t, (_, _, k) in enumerate(wide)])).alias("bucket")
    )
    sizes = keyed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    keyed = keyed.join(sizes, "bucket")
    again = []
    for t, (i, j) in enumerate(pairs):
        free = [at for b in range(4) if b not in (i, j) for at in (16 * b, 16 * b + 8)]
        for t2, (x, y) in enumerate(combinations(free, 2)):
            fine = F.shiftleft(_block(x, 8), 8).bitwiseOR(_block(y, 8))
            key = F.shiftleft("bucket", 19).bitwiseOR(F.lit(1 << 58)).bitwiseOR(F.lit(t2 << 16)).bitwiseOR(fine)
            again.append(F.when(F.shiftright("bucket", 32) == t, key))
    hot = keyed.where(F.col("n") > MAX_TREE).select("fp", F.explode(F.array_compact(F.array(*again))).alias("bucket"))
    shards = keyed.where(F.col("n") <= MAX_TREE).select("fp", "bucket").unionByName(hot)
    dealt = shards.repartition("bucket").sortWithinPartitions("bucket", F.col("fp").bitwiseXOR(F.lit(-(1 << 63))))
    return dealt.mapInPandas(_links, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (hex), component_id, root (fingerprint as long that names the component), row_key."""
    rows = docs.select(
        F.col(f"`{key}`").alias("doc_id"),
        row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_key"),
        fingerprint_column(F.col(f"`{text}`").cast("binary")).alias("fp"),
    )
    rows = durable(rows)
    prints = durable(rows.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(linked(prints.select("fp")))
    placed = prints.join(roots, prints["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = durable(placed.join(first, "root").select("fp", "root", "component_id"))
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return rows.join(known, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id", "root", "row_key")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each component, columns as they are: the one whose id names the component.

    Of rows that share this id one stays, the same one in every run.
    """
    named = near_duplicates(docs, key, text).where("doc_id <=> component_id")
    picks = named.groupBy("root").agg(F.min("row_key").alias("__pick")).select("__pick")
    wide = docs.withColumn("__key", row_key(F.col(f"`{key}`"), F.col(f"`{text}`")))
    out = wide.join(picks, F.col("__key") == F.col("__pick"))
    order = Window.partitionBy("__key").orderBy(*[F.col(f"`{c}`") for c, kind in docs.dtypes if c != text and not kind.startswith("map")])
    return out.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
