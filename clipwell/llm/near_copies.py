"""One document of each group of near copies: SimHash links, and word shingles at a stated similarity.

Fingerprints of 64 bits tell texts that differ in a few words from others only
when the texts are long: at a Jaccard similarity of 0.8 they differ in about ten bits, more
than trees over fingerprints can search. So texts also meet by MinHash: of all
``shingle``-word shingles (lower case, A-Z) ``BANDS`` times ``ROWS`` minima are taken, and
texts that share a whole band are candidates. A text is compared with the smallest text of
each of its bands and with the one before it in the band's order, so work grows with the
texts and not with the pairs of a band; a band that a third of all texts share is ranged
over tasks. Candidates whose minima agree too rarely for the similarity are left out, all
others are decided by the exact Jaccard similarity of their whole texts. Links, those of SimHash
within two bits included, form components by star contraction.

A pair of similarity 0.8 shares no band in about 2 of 1,000 cases; pairs of one band that meet
neither way are joined only through others. The tests measure the recall against all pairs.

Exact copies collapse first. Texts of fewer words than a shingle are one shingle; texts without
words are equal to each other. Null ids: the smallest non-null id of a group names the kept row.
Of rows with this id one stays, the same one in every run. An empty table gives none, other columns
stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from clipwell.llm.common import digest, durable, row_key, text_of
from clipwell.llm.graph import components
from clipwell.llm.simhash import SEED, linked
from clipwell.operators.ordering import with_previous

BANDS, ROWS = 12, 4
SHINGLE, SIMILARITY = 5, 0.8
#: Share of equal minima below which a pair is not looked at: 3.5 standard deviations under the similarity.
_SLACK = 0.2
_CHUNK = 4096
_A = np.random.default_rng(SEED).integers(1, 1 << 63, BANDS * ROWS).astype(np.uint64) * np.uint64(2) + np.uint64(1)
FOUND = "doc_id string, row_key binary, d binary, fp bigint, mins array<bigint>"


def shingles(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of all word shingles, repeats included, in pieces of bounded size."""
    words = text.lower().split()
    n = len(words) - shingle + 1
    if n < 1:
        yield np.array([xxh64_intdigest(b" ".join(words), SEED)] if words else [], np.uint64)
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))[:n]
    ends = ends[shingle - 1 :]
    for at in range(0, n, _CHUNK):
        cut = map(slice, starts[at : at + _CHUNK].tolist(), ends[at : at + _CHUNK].tolist())
        yield np.array(list(map(xxh64_intdigest, map(joined.__getitem__, cut), repeat(SEED))), np.uint64)


def sketch(text: bytes, shingle: int) -> tuple[int, np.ndarray]:
    """(SimHash fingerprint, minima) of a text."""
    count, total, mins = np.zeros(64, np.int64), 0, np.full(len(_A), np.uint64(0xFFFFFFFFFFFFFFFF))
    for h in shingles(text, shingle):
        if len(h):
            count += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            total += len(h)
            mins = np.minimum(mins, (h[:, None] * _A[None, :]).min(0))
    return int(np.packbits(2 * count > total, bitorder="little").view(np.int64)[0]) if total else 0, mins


def jaccard(a: bytes, b: bytes, shingle: int) -> float:
    """Exact similarity of the shingle sets; 1.0 for two texts without words."""
    x, y = (np.unique(np.concatenate(list(shingles(t, shingle)))) for t in (a, b))
    both = len(np.intersect1d(x, y, assume_unique=True))
    return both / (len(x) + len(y) - both) if len(x) + len(y) else 1.0


def _sketches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sketch(t.as_py(), shingle) for t in b.column("text")]
            mins = [m.view(np.int64) for _, m in found]
            columns = [b.column("doc_id"), b.column("row_key"), b.column("d"), pa.array([fp for fp, _ in found], pa.int64()), pa.array(mins, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "row_key", "d", "fp", "mins"])

    return run


def _verified(shingle: int, similarity: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            near = [jaccard(x, y, shingle) >= similarity for x, y in zip(f.x, f.y)]
            yield f.loc[near, ["a", "b"]]

    return run


def candidates(nodes: DataFrame, similarity: float) -> DataFrame:
    """(a, b): pairs of nodes (d, mins) that share a band and agree in enough minima."""
    band = lambda i: F.xxhash64(F.lit(i), *[F.get("mins", F.lit(ROWS * i + j)) for j in range(ROWS)])
    held = durable(nodes.select("d", F.explode(F.array(*map(band, range(BANDS)))).alias("band")))
    least = held.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min("d").alias("least")).where("n > 1")
    held = held.join(least, "band")
    before = with_previous(held.select("band", "d"), ["band"], ["d"], ["d"])
    pairs = held.select("d", F.col("least").alias("o")).unionByName(before.select("d", F.col("prev_d").alias("o")))
    pairs = pairs.where("d <> o").select(F.least("d", "o").alias("a"), F.greatest("d", "o").alias("b")).distinct()
    of = lambda name, mins: nodes.select(F.col("d").alias(name), F.col("mins").alias(mins))
    both = pairs.join(of("a", "m"), "a").join(of("b", "n"), "b")
    equal = F.size(F.filter(F.zip_with("m", "n", lambda x, y: x == y), lambda x: x))
    return both.where(equal >= (similarity - _SLACK) * BANDS * ROWS).select("a", "b")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = SHINGLE, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``docs``: doc_id, component_id (smallest id of its near copies), root, row_key."""
    rows = docs.select(
        F.col(f"`{key}`").cast("string").alias("doc_id"), row_key(F.col(f"`{key}`"), F.col(f"`{text}`")).alias("row_key"),
        digest(F.col(f"`{text}`")).alias("d"), text_of(f"`{text}`").cast("binary").alias("text"),
    )
    seen = durable(rows.mapInArrow(_sketches(shingle), FOUND).withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType)))
    # equal texts have equal sketches; the row with the smallest key stands for them
    nodes = durable(seen.groupBy("d").agg(F.min("doc_id").alias("least"), F.min(F.struct("row_key", "fp", "mins")).alias("r")).select("d", "least", "r.*"))
    pairs = durable(candidates(nodes.select("d", "mins"), similarity))
    asked = pairs.select(F.col("a").alias("d")).unionByName(pairs.select(F.col("b").alias("d"))).distinct()
    reps = nodes.join(asked, "d").select(F.col("d").alias("__d"), F.col("row_key").alias("__key"))
    whole = rows.join(reps, F.col("row_key") == F.col("__key")).groupBy(F.col("__d").alias("d")).agg(F.first("text").alias("text"))
    whole = durable(whole)
    of = lambda name, t: whole.select(F.col("d").alias(name), F.col("text").alias(t))
    links = pairs.join(of("a", "x"), "a").join(of("b", "y"), "b").mapInPandas(_verified(shingle, similarity), "a binary, b binary")
    # fingerprints within two bits: texts of one fingerprint meet at their smallest, fingerprints at each other's
    prints = durable(nodes.groupBy("fp").agg(F.min("d").alias("first")))
    same = nodes.join(prints, "fp").select(F.col("d").alias("a"), F.col("first").alias("b"))
    first = lambda c, out: prints.select(F.col("fp").alias(c), F.col("first").alias(out))
    near = linked(prints.select("fp")).join(first("a", "p"), "a").join(first("b", "q"), "b").select(F.col("p").alias("a"), F.col("q").alias("b"))
    roots = components(durable(links.unionByName(same.where("a <> b")).unionByName(near)))
    placed = nodes.join(roots, nodes["d"] == roots["node"], "left").select("d", "least", F.coalesce("root", "d").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("component_id"))
    known = durable(placed.join(named, "root").select("d", "root", "component_id"))
    return seen.select("doc_id", "row_key", "d").join(known, "d").select("doc_id", "component_id", "root", "row_key")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of ``docs`` for each group of near copies, columns as they are."""
    named = near_copies(docs, key, text, **how).where("doc_id <=> component_id")
    picks = named.groupBy("root").agg(F.min("row_key").alias("__pick")).select("__pick")
    wide = docs.withColumn("__key", row_key(F.col(f"`{key}`"), F.col(f"`{text}`")))
    out = wide.join(picks, F.col("__key") == F.col("__pick"))
    order = Window.partitionBy("__key").orderBy(*[F.col(f"`{c}`") for c, kind in docs.dtypes if c != text and not kind.startswith("map")])
    return out.withColumn("__n", F.row_number().over(order)).where("__n = 1").select(*[F.col(f"`{c}`") for c in docs.columns])
