"""Hard negatives by cover trees over norm-augmented vectors.

A vector's components become the integers floor(256 x); a score is the integer
inner product of an anchor and a candidate. A candidate gets one more component
that gives all of a tree the same norm M, an anchor gets a zero there, so that
d² = |q|² + M² - 2 score for their distance d: bounds of distances are bounds of
scores. An anchor's positives are the best rows of its label, and for each of
them the best rows of other labels inside a window of scores are its negatives.

Trees. Every task builds cover trees over slices of at most ``TREE_ROWS`` of its
own rows, so nothing is shuffled by a key. The root's radius covers its points;
below, points are covered level by level with half the radius of the node above,
centres are points and lie more than this radius apart, a node's first child has
its own centre, and every node keeps the true radius of its points. A search
descends best first by the upper bound of the score, skips nodes whose bounds miss
all open windows or cannot beat a window's last place, and leaf points are
verified by exact products. What one tree found is the bar for the task's next.

Anchors are the stated query side. They are searched in rounds of at most
``ROUND`` rows, whose vectors are broadcast; each round reads the stored trees
once and is written before the next begins. A task keeps the best k of each
window, so the output grows with the anchors alone.

Rows with a null label, a null vector, or a null or non-finite component take no
part. Shorter vectors count as padded with zeros. A null id is never an anchor,
and comes first among equal scores. Repeated rows are rows of their own: a copy
of the anchor's row with the same id is another row. Anchors that are repeated
(same id) are told apart by label and vector; equal ones give equal results
once. Scores outside 64 bits are held at the range's end. An empty table gives
no rows; other columns play no part.
"""

from __future__ import annotations

import heapq
import io
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipwell.llm.common import durable
from clipwell.operators.ordering import with_row_number

TREE_ROWS = 4096
LEAF = 16
ROUND = 65_536
SCALE = 256
LOW, HIGH = -(1 << 63), (1 << 63) - 1
FOUND = "anchor bigint, part int, place int, id bigint, score bigint, own boolean"


def products(points: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Exact inner products; by doubles where no sum can pass 2^53, else by Python integers."""
    bound = float(np.abs(points).max(initial=0)) * float(np.abs(q).max(initial=0)) * len(q)
    if bound < 2.0**53:
        return (points @ q).astype(np.int64)
    own = [int(x) for x in q]
    exact = (sum(int(x) * y for x, y in zip(row, own)) for row in points)
    return np.array([min(max(x, LOW), HIGH) for x in exact], np.int64)


class CoverTree:
    """Nodes as arrays in the order of levels; the children of a node are neighbours, and so are the points of a leaf."""

    FIELDS = ("points", "ids", "labels", "centre", "radius", "first", "last", "leaf")

    def __init__(self, points: np.ndarray, ids: np.ndarray, labels: np.ndarray):
        norms = (points**2).sum(1)
        x = np.concatenate([points, np.sqrt(norms.max(initial=0.0) - norms)[:, None]], 1)
        distance = lambda at, c: np.sqrt(((x[at] - x[c]) ** 2).sum(1))
        every = np.arange(len(points))
        nodes = [(every, 0, distance(every, 0))]
        centre, radius, first, last, leaf, order = [], [], [], [], [], []
        for at, c, d in nodes:  # grows meanwhile
            centre.append(c)
            radius.append(d.max())
            leaf.append(len(at) <= LEAF or radius[-1] == 0)
            if leaf[-1]:
                first.append(len(order))
                order.extend(at.tolist())
                last.append(len(order))
                continue
            first.append(len(nodes))
            reach = radius[-1] / 2
            while len(at):  # the first child has the same centre, further ones begin at a point not covered yet
                near = d <= reach
                nodes.append((at[near], c, d[near]))
                at = at[~near]
                if len(at):
                    c = at[0]
                    d = distance(at, c)
            last.append(len(nodes))
        self.points, self.ids, self.labels = points[order], ids[order], labels[order]
        self.centre, self.radius = points[centre], np.array(radius)
        self.first, self.last, self.leaf = np.array(first, np.int64), np.array(last, np.int64), np.array(leaf, bool)
        self.top = float(norms.max(initial=0.0))

    def dump(self) -> bytes:
        whole = float(np.abs(self.points).max(initial=0)) < 2**31
        kind = np.int32 if whole else np.float64
        out = io.BytesIO()
        fields = {f: getattr(self, f) for f in self.FIELDS}
        np.savez(out, top=self.top, **fields | {f: fields[f].astype(kind) for f in ("points", "centre")})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        tree = cls.__new__(cls)
        with np.load(io.BytesIO(data), allow_pickle=False) as f:
            for name in cls.FIELDS:
                setattr(tree, name, f[name])
            tree.top = float(f["top"])
        tree.points, tree.centre = tree.points.astype(np.float64), tree.centre.astype(np.float64)
        return tree

    def search(self, q: np.ndarray, wanted: Callable[[np.ndarray], np.ndarray], windows: Windows) -> int:
        """Offer ``windows`` every point with a wanted label that may belong there; the number of points verified."""
        q = np.pad(q, (0, max(0, self.points.shape[1] - len(q))))[: self.points.shape[1]]
        norm = float(q @ q)
        slack = 1e-9 * (norm + self.top) + 1
        heap, seen = [(-np.inf, 0, -np.inf)], 0
        if self.leaf[0]:
            return self._verify(np.zeros(1, np.int64), q, wanted, windows)
        while heap:
            upper, node, lower = heapq.heappop(heap)
            if not windows.may_hold(np.array([lower]), np.array([-upper]))[0]:
                continue
            kids = np.arange(self.first[node], self.last[node])
            d = np.sqrt(np.maximum(norm + self.top - 2 * (self.centre[kids] @ q), 0))
            r = self.radius[kids]
            high = (norm + self.top - np.maximum(d - r, 0) ** 2) / 2 + slack
            low = (norm + self.top - (d + r) ** 2) / 2 - slack
            hit = windows.may_hold(low, high)
            end = self.leaf[kids] & hit
            if end.any():
                seen += self._verify(kids[end], q, wanted, windows)
            for k in np.flatnonzero(hit & ~end).tolist():
                heapq.heappush(heap, (-high[k], int(kids[k]), low[k]))
        return seen

    def _verify(self, leaves: np.ndarray, q: np.ndarray, wanted: Callable, windows: Windows) -> int:
        first, n = self.first[leaves], self.last[leaves] - self.first[leaves]
        at = np.arange(n.sum()) + np.repeat(first - (np.cumsum(n) - n), n)
        at = at[wanted(self.labels[at])]
        windows.offer(products(self.points[at], q), self.ids[at])
        return len(at)


class Windows:
    """The best ``k`` of each window of scores, ends included; higher scores first, then smaller ids."""

    def __init__(self, low: list[int], high: list[int], k: int):
        self.low, self.high, self.k = np.array(low, np.int64), np.array(high, np.int64), k
        self.scores = [np.empty(0, np.int64) for _ in low]
        self.ids = [np.empty(0, np.int64) for _ in low]
        self.bar = self.low.copy()

    def may_hold(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Which ranges of scores meet a window above its bar."""
        return ((high[:, None] >= self.bar) & (low[:, None] <= self.high)).any(1)

    def offer(self, scores: np.ndarray, ids: np.ndarray) -> None:
        for p in range(len(self.low)):
            new = np.flatnonzero((scores >= self.bar[p]) & (scores <= self.high[p]))
            if not len(new):
                continue
            s, i = np.concatenate([self.scores[p], scores[new]]), np.concatenate([self.ids[p], ids[new]])
            best = np.lexsort((i, ~s))[: self.k]  # ~s falls as s grows and cannot overflow
            self.scores[p], self.ids[p] = s[best], i[best]
            if len(best) == self.k:
                self.bar[p] = self.scores[p][-1]


def _plant(most: int):
    """Rows (id, label, vector) to cover trees of at most ``most`` points."""

    def tree(ids: list[int], labels: list[int], vectors: list[np.ndarray]) -> pa.RecordBatch:
        data = CoverTree(_matrix(vectors), np.array(ids, np.int64), np.array(labels, np.int64)).dump()
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["tree"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = [], [], []
        for b in batches:
            ids += b.column("id").fill_null(LOW).to_pylist()
            labels += b.column("label").to_pylist()
            vectors += list(b.column("vector").to_numpy(zero_copy_only=False))
            while len(ids) >= most:
                yield tree(ids[:most], labels[:most], vectors[:most])
                ids, labels, vectors = ids[most:], labels[most:], vectors[most:]
        if ids:
            yield tree(ids, labels, vectors)

    return run


def _matrix(vectors: list[np.ndarray]) -> np.ndarray:
    out = np.zeros((len(vectors), max(1, max(map(len, vectors)))))
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return np.floor(SCALE * out)


def _search(round_, same: bool, k: int):
    """Trees to the best rows of each anchor's windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, own, labels, vectors, lows, highs = round_.value
        found = [Windows(a, b, k) for a, b in zip(lows, highs)]
        for b in batches:
            for data in b.column("tree"):
                tree = CoverTree.load(data.as_py())
                for label, q, windows in zip(labels, vectors, found):
                    tree.search(q, (lambda x: x == label) if same else (lambda x: x != label), windows)
        for at in range(0, len(found), 1024):
            part = slice(at, at + 1024)
            itself = [(i, int(products(q[None], q)[0])) for i, q in zip(own[part], vectors[part])]
            rows = [
                (n, p, j, i if i != LOW else None, s, (i, s) == me)
                for n, me, w in zip(numbers[part], itself, found[part])
                for p in range(len(w.low))
                for j, (i, s) in enumerate(zip(w.ids[p].tolist(), w.scores[p].tolist()))
            ]
            columns = zip(*rows) if rows else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_())
            names = ["anchor", "part", "place", "id", "score", "own"]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, kinds)], names=names)

    return run


def _best(trees: DataFrame, anchors: DataFrame, rounds: int, same: bool, k: int) -> DataFrame:
    """(anchor, part, id, score, rank): the best k rows of each window of all anchors, over all trees."""
    context, out = trees.sparkSession.sparkContext, None
    for r in range(rounds):
        own = anchors.where((F.col("anchor") > r * ROUND) & (F.col("anchor") <= (r + 1) * ROUND)).toArrow()
        lows, highs = own.column("low").to_pylist(), own.column("high").to_pylist()
        vectors = [np.floor(SCALE * np.array(v, np.float64)) for v in own.column("vector").to_pylist()]
        numbers, ids, labels = (own.column(c).to_pylist() for c in ("anchor", "id", "label"))
        shared = context.broadcast((numbers, ids, labels, vectors, lows, highs))
        found = durable(trees.mapInArrow(_search(shared, same, k), FOUND))
        shared.unpersist()
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = trees.sparkSession.createDataFrame([], FOUND)
    order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), "id", "place")
    return out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).drop("place")


def usable(rows: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    """(id, label, vector) of the rows that take part."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    typed = rows.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{label}`").cast("long").alias("label"),
        F.col(f"`{vector}`").cast("array<double>").alias("vector"),
    )
    return typed.where(F.col("label").isNotNull() & F.col("vector").isNotNull()).where(~F.exists("vector", bad))


def mined(
    rows: DataFrame,
    anchor: Column,
    key: str = "vec_id",
    label: str = "label",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 3,
    low_percent: int = 50,
    high_percent: int = 95,
) -> DataFrame:
    """One row per anchor, positive and negative: ids, rank from 1, both scores.

    ``anchor`` is a condition on ``id``, ``label`` and ``vector``. A negative's
    score is at least ``low_percent`` and at most ``high_percent`` of the positive's.
    """
    spark = rows.sparkSession
    points = usable(rows, key, label, vector)
    trees = durable(points.mapInArrow(_plant(TREE_ROWS), "tree binary"))
    n = trees.count()
    trees = trees.repartition(max(spark.sparkContext.defaultParallelism, -(-n // 32)))
    asked = points.where(F.col("id").isNotNull() & anchor).distinct()
    asked = durable(with_row_number(asked, ["id", "label", "vector"], "anchor"))
    rounds = -(-asked.count() // ROUND)
    whole = asked.withColumns({"low": F.array(F.lit(LOW)), "high": F.array(F.lit(HIGH))})
    # the anchor's own row is among the best of its label, or is not needed: one row with its id and own score goes
    near = _best(trees, whole, rounds, True, positives + 1).drop("part")
    near = near.join(asked.select("anchor", F.col("id").alias("own_id")), "anchor")
    first = F.min(F.when(F.col("own"), F.col("rank"))).over(Window.partitionBy("anchor"))
    near = near.withColumn("itself", first).where(~F.col("rank").eqNullSafe(F.col("itself")))
    near = near.withColumn("part", F.col("rank") - 1 - (F.col("rank") > F.coalesce("itself", F.lit(positives + 2))).cast("int"))
    near = durable(near.where(F.col("part") < positives).select("anchor", "own_id", "part", "id", "score"))
    part = F.struct("part", "score")
    wanted = near.groupBy("anchor").agg(F.sort_array(F.collect_list(part)).alias("parts"))  # at most ``positives`` entries
    edge = lambda percent, shift: F.transform("parts", lambda x: _percent(x["score"], percent, shift))
    wanted = wanted.withColumns({"low": edge(low_percent, 99), "high": edge(high_percent, 0)})
    far = _best(trees, asked.join(wanted, "anchor"), rounds, False, negatives)
    pairs = near.select("anchor", "part", "own_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = far.join(pairs, ["anchor", "part"])
    return out.select(
        F.col("own_id").alias("anchor_id"), "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"),
    )


def _percent(score: Column, percent: int, shift: int) -> Column:
    """``percent`` of a score, cut down; up with a shift of 99."""
    whole = score.cast("decimal(20,0)") * percent + shift
    return F.floor(whole / 100).cast("long")
