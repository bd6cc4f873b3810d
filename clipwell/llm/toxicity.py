"""Toxicity: a character n-gram linear classifier on naive Bayes log-count ratios.

Features are the character n-grams (3 to 6) of the lower-cased text. From the labelled sample, documents of each class that hold an n-gram are
counted; its log-count ratio is

    r = log((toxic + 1) / (all toxic + 2)) - log((other + 1) / (all other + 2))

and the n-grams whose r is furthest from 0 in standard errors are the features.
A feature that occurs n times has the value r * (1 + floor(log2 n)), and a
logistic regression on these values, with equal weight for both classes, gives
the score.

Learning uses at most ``sample`` labelled documents of each class (the rows with
the smallest hashes of their ids) and ``features`` n-grams; both bound what
reaches the driver and the broadcast. Scoring covers every whole text, longer
ones in pieces that overlap by an n-gram, so memory is bounded. Labels, language,
source and id are no inputs of a score.

Null or empty texts have no n-grams: their score is the intercept's. Null labels
and labels without a document teach nothing; of repeated labels of an id the
largest counts; repeated rows get equal scores; an empty table gives no rows.
Without labels of both classes there is nothing to learn: every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipwell.llm.common import durable, text_of

SIZES = (3, 4, 5, 6)
_PIECE = 1 << 18
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 18


def _ngrams(codes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every n-gram of the code points."""
    n = len(codes) - size + 1
    h = np.full(max(n, 0), np.uint64(size))
    for i in range(size if n > 0 else 0):
        h *= _FACTOR
        h += codes[i : i + n]
    h ^= h >> np.uint64(32)
    return h


def _hashes(text: str) -> Iterator[np.ndarray]:
    """Hashes of all n-grams of a text, piece by piece; each n-gram is in the piece where it begins."""
    low = text.lower()
    for at in range(0, max(len(low), 1), _PIECE):
        piece = low[at : at + _PIECE + max(SIZES) - 1]
        codes = np.frombuffer(piece.encode("utf-32-le", "replace"), "<u4").astype(np.uint64)
        for size in SIZES:
            yield _ngrams(codes[: _PIECE + size - 1], size)


def present(text: str) -> np.ndarray:
    """Distinct n-gram hashes of a text."""
    return np.unique(np.concatenate([np.unique(h) for h in _hashes(text)]))


@dataclass
class Lookup:
    """Feature numbers by n-gram hash: a table of the hash's high bits gives the few candidates to compare."""

    grams: np.ndarray  # sorted

    def __post_init__(self) -> None:
        self.may = np.zeros(1 << _TABLE_BITS, bool)
        self.may[(self.grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True

    def features(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features of a text, ascending, and 1 + floor(log2 n) for each."""
        total = np.zeros(0, np.int64)
        for h in _hashes(text) if len(self.grams) else ():
            h = h[self.may[(h >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)]]
            if len(h):
                at = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
                n = np.bincount(at[self.grams[at] == h], minlength=len(self.grams))
                total = n if not len(total) else total + n
        held = np.flatnonzero(total)
        return held, np.frexp(total[held].astype(float))[1]


def _counts(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of each class by n-gram, a partial count for every few hundred documents."""
    for f in frames:
        for at in range(0, len(f), 400):
            g = f.iloc[at : at + 400]
            held = [present(t) for t in g.text]
            gram, inverse = np.unique(np.concatenate(held), return_inverse=True)
            toxic = np.repeat(g.toxic.to_numpy(), [len(x) for x in held])
            n, t = np.bincount(inverse, minlength=len(gram)), np.bincount(inverse, weights=toxic, minlength=len(gram))
            yield pd.DataFrame({"gram": gram.view(np.int64), "toxic": t.astype(np.int64), "other": n - t.astype(np.int64)})


@dataclass
class Model:
    """Weights of the features (log-count ratio times coefficient) and the intercept."""

    lookup: Lookup
    weights: np.ndarray
    intercept: float

    def score(self, text: str) -> float:
        held, level = self.lookup.features(text)
        z = self.intercept + float(self.weights[held] @ level)
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))))


def labelled_sample(docs: DataFrame, labels: DataFrame, sample: int, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """(text, toxic) of at most ``sample`` documents of each class; equal texts count once for a class."""
    known = labels.groupBy(F.col(key).alias("__id")).agg(F.max(label).cast("int").alias("toxic")).where("toxic in (0, 1)")
    order = F.xxhash64(F.lit("sample"), "__id")
    picked = [known.where(f"toxic = {c}").orderBy(order, "__id").limit(sample) for c in (0, 1)]
    ids = picked[0].unionByName(picked[1])
    rows = docs.join(F.broadcast(ids), F.col(f"`{key}`") == F.col("__id"))  # at most 2 * sample ids
    return rows.select(text_of(f"`{text}`").alias("text"), "toxic").dropDuplicates(["text", "toxic"])


def fit(sample: DataFrame, features: int = 4000, min_docs: int = 3, l2: float = 0.005) -> Model:
    """Learn from (text, toxic) rows; the sample is bounded by its maker."""
    rows = durable(sample.repartition(sample.sparkSession.sparkContext.defaultParallelism))
    sizes = {r[0]: r[1] for r in rows.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return Model(Lookup(np.empty(0, np.uint64)), np.empty(0), 0.0)
    counts = rows.mapInPandas(_counts, "gram bigint, toxic bigint, other bigint").groupBy("gram").agg(F.sum("toxic").alias("p"), F.sum("other").alias("q"))
    ratio = F.log((F.col("p") + 1) / (sizes[1] + 2)) - F.log((F.col("q") + 1) / (sizes[0] + 2))
    error = F.sqrt(1 / (F.col("p") + 1) + 1 / (F.col("q") + 1))
    best = counts.where(F.col("p") + F.col("q") >= min_docs).select("gram", ratio.alias("r"), F.abs(ratio / error).alias("z"))
    top = best.orderBy(F.desc("z"), "gram").limit(features).collect()  # as many rows as features
    grams = np.array([r.gram for r in top], np.int64).view(np.uint64)
    order = np.argsort(grams)
    lookup, ratios = Lookup(grams[order]), np.array([r.r for r in top], float)[order]

    def held(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            held = [np.repeat(*lookup.features(t)).astype(str).tolist() for t in f.text]
            yield pd.DataFrame({"label": f.toxic.astype(float), "held": held})

    counted = CountVectorizerModel.from_vocabulary([str(i) for i in range(len(grams))], inputCol="held", outputCol="counts")
    scaled = ElementwiseProduct(scalingVec=Vectors.dense(ratios), inputCol="counts", outputCol="features")
    table = durable(rows.mapInPandas(held, "label double, held array<string>"))
    table = table.withColumn("weight", F.when(F.col("label") == 1, F.lit(sizes[0] / sizes[1])).otherwise(F.lit(1.0)))
    learner = LogisticRegression(regParam=l2, standardization=False, maxIter=60, tol=1e-5, weightCol="weight")
    found = learner.fit(scaled.transform(counted.transform(table)))
    return Model(lookup, ratios * found.coefficients.toArray(), float(found.intercept))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for f in frames:
            yield pd.DataFrame({"doc_id": f.doc_id, "score": [m.score(t) for t in f.text]})

    rows = docs.select(F.col(f"`{key}`").cast("string").alias("doc_id"), text_of(f"`{text}`").alias("text"))
    return rows.mapInPandas(run, "doc_id string, score double").withColumn("doc_id", F.col("doc_id").cast(docs.schema[key].dataType))
