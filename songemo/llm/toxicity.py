"""Toxicity: a linear classifier on character n-grams scaled by naive Bayes log-count ratios.

Features are the character n-grams (3 to 6 characters of the lower-cased
text, hashed) that a text holds, each counted once.  Feature j's value is its
log-count ratio r_j = log((1 + p_j) / (1 + P)) - log((1 + q_j) / (1 + Q)):
p_j and q_j are the numbers of toxic and other training texts with it, P and
Q those of the texts.  A logistic regression with an L2 penalty is fitted on
these scaled features, over the n-grams whose share differs between the two
classes by ``MIN_Z`` standard errors; all others weigh nothing.  The intercept is
moved from the sample's to the labelled rows' share of toxic texts.

Training uses a bounded sample: ``PER_CLASS`` labelled ids of each class (all,
if fewer) among those with a text of at most ``MAX_TRAIN_CHARS`` characters,
those with the smallest hashes; an id with several texts gives the one of the
smallest hash.  Scoring runs over every whole text, in
``mapInArrow`` without a shuffle; the weights are one table of fixed size.

Defined cases: a null or empty text has no feature and gets the score of the
intercept; labels that are null count as no label, and a document with
several labels is toxic if one says so; without labelled rows of both classes
every score is the share of toxic rows (0 without any); extra columns are not
read; a null ``doc_id`` is never held out and never learned from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .base import by_batch, discard, held_out, partitions, remainder4, stored

SIZES = (3, 4, 5, 6)
BITS = 20
PER_CLASS = 3000
MAX_TRAIN_CHARS = 20_000
MIN_Z = 4.0
MIN_TEXTS = 4
PENALTY = 0.3
STEPS = 150
THRESHOLD = 0.3

_MULTIPLIER, _SPREAD = np.uint32(0x01000193), np.uint32(0x9E3779B1)


def ngrams(text: str, sizes: tuple[int, ...] = SIZES, bits: int = BITS) -> list[np.ndarray]:
    """Feature numbers of all n-grams of ``text``, one array per size, in order of place."""
    c = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    out, h, n = [], c, 1
    for size in sizes:
        while n < size and len(h) > 1:
            h = h[:-1] * _MULTIPLIER + c[n:]
            n += 1
        if n < size or not len(h):
            break
        out.append(((h + np.uint32(size)) * _SPREAD) >> np.uint32(32 - bits))
    return out


@dataclass(frozen=True)
class Model:
    """``weights[j]`` is the regression weight times r_j; zero for features that are not used."""

    weights: np.ndarray
    intercept: float

    def score(self, text: str | None) -> float:
        used, w, z = [], self.weights, self.intercept
        for a in ngrams(text) if text else ():
            x = w[a]
            used.append(a[x != 0])
        if used:
            z += float(w[np.unique(np.concatenate(used))].sum(dtype=np.float64))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


def features(text: str | None) -> np.ndarray:
    """The distinct feature numbers of ``text``, in ascending order."""
    grams = ngrams(text) if text else ()
    return np.unique(np.concatenate(grams)).astype(np.int32) if grams else np.zeros(0, np.int32)


def fit(rows: list[np.ndarray], toxic: list[int], kept: np.ndarray, ratios: np.ndarray, share: float) -> Model:
    """Fits on a sample: ``rows`` holds for each text the places in ``kept`` (feature numbers, of log-count ratio
    ``ratios``) of the features that it has; ``share`` is the share of toxic rows to score for."""
    y = np.asarray(toxic, np.float64)
    weights = np.zeros(1 << BITS, np.float32)
    odds = float(np.log(max(share, 1e-12) / max(1 - share, 1e-12)))
    n1, n0 = y.sum(), len(y) - y.sum()
    if not n1 or not n0:
        return Model(weights, odds)
    col = np.concatenate(rows)
    row = np.repeat(np.arange(len(rows), dtype=np.int32), [len(x) for x in rows])
    val = ratios[col]
    w, b = np.zeros(len(kept)), 0.0
    m, v, mb, vb = np.zeros(len(kept)), np.zeros(len(kept)), 0.0, 0.0
    for step in range(1, STEPS + 1):                     # full-batch Adam
        s = 1 / (1 + np.exp(-np.clip(np.bincount(row, val * w[col], len(y)) + b, -500, 500)))
        g = np.bincount(col, val * (s - y)[row], len(kept)) / len(y) + PENALTY * w / len(y)
        gb = float((s - y).mean())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.999 * vb + 0.001 * gb * gb
        c1, c2 = 1 - 0.9 ** step, 1 - 0.999 ** step
        w -= 0.03 * (m / c1) / (np.sqrt(v / c2) + 1e-8)
        b -= 0.03 * (mb / c1) / (np.sqrt(vb / c2) + 1e-8)
    weights[kept] = w * ratios
    return Model(weights, b + odds - float(np.log(n1 / n0)))


def _sample(docs: DataFrame, known: DataFrame, per_class: int) -> DataFrame:
    """(doc_id, toxic, text) of the bounded sample, one row an id."""
    rows = docs.select("doc_id", "text").filter(F.length("text") <= MAX_TRAIN_CHARS)
    usable = known.join(rows.select("doc_id"), "doc_id", "left_semi")
    pick = [usable.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    few = F.broadcast(pick[0].unionByName(pick[1]))         # at most 2 * per_class pairs of numbers
    texts = rows.join(few, "doc_id").groupBy(F.col("doc_id").cast("long").alias("doc_id"), "toxic").agg(
        F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text"))
    return stored(texts.repartition(partitions(docs.sparkSession)), "toxic-sample")


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, p, q) of a task's texts: the numbers of toxic and other texts with the feature."""
    n = np.zeros((2, 1 << BITS), np.int32)
    for b in batches:
        for t, toxic in zip(b.column("text"), b.column("toxic").to_pylist()):
            n[0 if toxic else 1][features(t.as_py())] += 1
    f = np.flatnonzero(n.any(axis=0)).astype(np.int32)
    for i in range(0, len(f), 1 << 16):
        x = f[i:i + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(n[0][x]), pa.array(n[1][x])], names=["feature", "p", "q"])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fits on the bounded sample of the labelled rows that are not held out.

    The executors count the features of the sample's texts and choose those that are used; the driver gets
    these and, for each text, the places of those that it has, never the texts.
    """
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).dropna()
             .filter(remainder4(F.col("doc_id")) != 2)
             .groupBy("doc_id").agg(F.max((F.col("toxic") != 0).cast("int")).alias("toxic")))
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    sample = _sample(docs, known, per_class)
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = float(size.get(1, 0)), float(size.get(0, 0))
    if not n1 or not n0:
        discard(sample)
        return fit([], [], np.zeros(0, np.int32), np.zeros(0), share)
    p, q = F.col("p"), F.col("q")
    mean = (p + q) / F.lit(n1 + n0)
    z = (p / F.lit(n1) - q / F.lit(n0)) / F.sqrt(F.greatest(mean * (1 - mean), F.lit(1e-9)) * F.lit(1 / n1 + 1 / n0))
    chosen = (sample.select("text", "toxic").mapInArrow(_counted, "feature int, p int, q int")
              .groupBy("feature").agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
              .filter((F.abs(z) >= MIN_Z) & (p + q >= MIN_TEXTS)).orderBy("feature").toArrow())   # at most 2 ** BITS rows of numbers
    kept, p1, q0 = (chosen.column(c).to_numpy() for c in ("feature", "p", "q"))
    ratios = np.log((1 + p1) / (1 + n1)) - np.log((1 + q0) / (1 + n0))
    number = np.full(1 << BITS, -1, np.int32)
    number[kept] = np.arange(len(kept))
    shared = docs.sparkSession.sparkContext.broadcast(number)

    def places(b: pa.RecordBatch) -> pa.RecordBatch:
        of = (shared.value[features(t.as_py())] for t in b.column("text"))
        return pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("toxic"),
                                           pa.array([x[x >= 0].tobytes() for x in of], pa.binary())], names=["doc_id", "toxic", "places"])
    rows = sample.select("doc_id", "toxic", "text").mapInArrow(by_batch(places), "doc_id long, toxic int, places binary").toArrow()
    rows = rows.sort_by("doc_id")                           # the sums of the fit do not depend on the order of tasks
    model = fit([np.frombuffer(x.as_buffer(), np.int32) for x in rows.column("places")], rows.column("toxic").to_pylist(),
                kept, ratios, share)
    shared.destroy()
    discard(sample)
    return model


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with columns ``toxicity`` (double, 0 to 1) and ``toxic_predicted`` (int) added."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = docs.columns
    if {"toxicity", "toxic_predicted"} & set(names):
        raise ValueError("columns toxicity and toxic_predicted are in the way")
    text_at = names.index("text")

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        m = shared.value
        s = [m.score(t.as_py()) for t in b.column(text_at)]
        return pa.RecordBatch.from_arrays(
            [*b.columns, pa.array(s, pa.float64()), pa.array([int(x >= threshold) for x in s], pa.int32())],
            names=[*names, "toxicity", "toxic_predicted"])
    schema = T.StructType([*docs.schema.fields, T.StructField("toxicity", T.DoubleType()),
                           T.StructField("toxic_predicted", T.IntegerType())])
    return docs.mapInArrow(by_batch(run), schema)


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("toxicity").alias("score"),
                         F.col("toxic_predicted").alias("predicted"))
