"""Exact top-k by inner product with norm-bucketed retrieval.

Candidates are sorted by length and cut into buckets.  A first pass scores
every query against the bucket of the longest vectors: its k-th score there
is a threshold that the answer must reach.  The second pass pairs query
blocks with buckets.  In a bucket with longest vector l, a query of length |q|
and threshold T needs a cosine of at least T / (|q| l):

* above 1 nothing in the bucket can reach it;
* from ``COORDINATE_FROM`` on, coordinate pruning: a unit vector with that
  cosine must lie, in the query's largest coordinate, in an interval; only
  rows inside it are kept (a sorted column per coordinate finds them);
* below, length pruning: only the rows of length T / |q| or more, which are
  the front of the bucket.

What is left is verified by its inner product.  Bounds are loosened by 1e-9,
so rounding never prunes an answer.  Query blocks against buckets are blocks
of rows, not pairs; buckets whose longest vector cannot reach the lowest
threshold of a query block are not even sent to it.

Defined cases: see ``vectors.usable`` for rows that take no part; ties go to
the smaller id; fewer candidates than k give all of them; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import partitions, stored
from .vectors import BLOCK, best_of, packed, query_blocks, ranked, unpacked, usable

COORDINATE_FROM = 0.6
QUERY_BLOCK = 1024
LOOSE = 1e-9
FOUND = "query_id long, vec_id long, score long"


def scaled(embedding: Column | str, scale: int = 256) -> Column:
    """floor(scale * x) of every component."""
    return F.transform(embedding, lambda x: F.floor(F.lit(float(scale)) * x).cast("double"))


def _slack(a: np.ndarray, b: np.ndarray) -> float:
    """How far float64 products of integral rows may be off: 0 where every sum stays below 2 ** 53."""
    if not a.size or not b.size:
        return 0.0
    most = a.shape[1] * float(np.abs(a).max()) * float(np.abs(b).max())
    return 0.0 if most < 2.0 ** 53 else most * a.shape[1] * 2.0 ** -51


def _best(ids: np.ndarray, p: np.ndarray, q: np.ndarray, scores: np.ndarray, k: int, least: float, slack: float) -> list[tuple[int, int]]:
    """(place, exact score) of the k best rows; where float64 is not exact, all rows that close are multiplied as integers."""
    at = best_of(scores, ids, k, least - slack, 2 * slack)
    if not slack:
        return [(int(j), int(scores[j])) for j in at]
    exact = p[at].astype(np.int64) @ q.astype(np.int64)
    order = np.lexsort((ids[at], -exact))[:k]
    return [(int(at[j]), int(exact[j])) for j in order]


def search_block(q_ids: np.ndarray, q: np.ndarray, threshold: np.ndarray, ids: np.ndarray, p: np.ndarray,
                 k: int) -> list[tuple[int, int, int]]:
    """The k best rows of one bucket (longest first) for each query, of those that can reach its threshold."""
    q_len, p_len = np.sqrt((q * q).sum(axis=1)), np.sqrt((p * p).sum(axis=1))
    # Local cosine thresholds; a threshold of 0 or less prunes nothing.
    with np.errstate(divide="ignore", invalid="ignore"):
        need = np.where(threshold > 0, threshold / (q_len * p_len[0]), -1.0)
        reach = np.where(threshold > 0, threshold / q_len, -1.0)
    alive = ~(need > 1 + LOOSE)
    by_coordinate = alive & (need >= COORDINATE_FROM)
    by_length = np.flatnonzero(alive & ~by_coordinate)
    out = []

    slack = _slack(q, p)

    def add(i: int, rows: np.ndarray, scores: np.ndarray) -> None:
        scores = np.where(ids[rows] == q_ids[i], -np.inf, scores)
        for j, score in _best(ids[rows], p[rows], q[i], scores, k, threshold[i], slack):
            out.append((int(q_ids[i]), int(ids[rows[j]]), score))

    if len(by_length):
        front = np.searchsorted(-p_len, -(reach[by_length] * (1 - LOOSE)), side="right")
        front[reach[by_length] <= 0] = len(p)
        scores = q[by_length] @ p[: front.max()].T
        for i, n, row in zip(by_length.tolist(), front.tolist(), scores):
            add(i, np.arange(n), row[:n])
    if by_coordinate.any():
        unit = p / np.maximum(p_len, 1e-300)[:, None]
        columns: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for i in np.flatnonzero(by_coordinate).tolist():
            u = q[i] / q_len[i]
            f = int(np.abs(u).argmax())
            if f not in columns:
                order = np.argsort(unit[:, f], kind="stable")
                columns[f] = (order, unit[order, f])
            order, values = columns[f]
            t = min(1.0, need[i])
            # unit . u >= t bounds the coordinate; shorter rows than the longest need more, never less.
            wide = np.sqrt(max(0.0, 1 - u[f] ** 2)) * np.sqrt(max(0.0, 1 - t * t))
            # The interval reaches the pole that the query itself is that close to.
            low = -1.0 if -u[f] >= t else t * u[f] - wide
            high = 1.0 if u[f] >= t else t * u[f] + wide
            lo, hi = np.searchsorted(values, [low - 1e-7, high + 1e-7], side="left")
            rows = np.sort(order[lo:hi])
            rows = rows[p_len[rows] >= reach[i] * (1 - LOOSE)]
            if len(rows):
                add(i, rows, p[rows] @ q[i])
    return out


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in range(b.num_rows):
                q_ids, q = unpacked(b.column(0)[r].as_py(), b.column(1)[r].as_py())
                t = np.frombuffer(b.column(2)[r].as_py(), "<f8")
                ids, p = unpacked(b.column(3)[r].as_py(), b.column(4)[r].as_py())
                out += search_block(q_ids, q, t, ids, p, k)
            cols = list(zip(*out)) if out else [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["query_id", "vec_id", "score"])
    return run


def _with_thresholds(blocks: DataFrame, top: tuple[bytes, bytes] | None, k: int) -> DataFrame:
    """Query blocks with each query's k-th score in the top bucket, and the block's least needed length."""
    shared = blocks.sparkSession.sparkContext.broadcast(top)            # one bucket: at most BLOCK vectors

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                q_ids, q = unpacked(b.column(0)[r].as_py(), b.column(1)[r].as_py())
                ids, p = unpacked(*shared.value)
                s = q @ p.T
                s[q_ids[:, None] == ids[None, :]] = -np.inf
                t = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k] if s.shape[1] >= k else np.full(len(q), -np.inf)
                t = t - _slack(q, p)
                q_len = np.sqrt((q * q).sum(axis=1))
                with np.errstate(divide="ignore"):
                    least = np.where(t > 0, t / q_len, -1.0).min()
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(r, 1), b.column(1).slice(r, 1),
                     pa.array([t.astype("<f8").tobytes()], pa.binary()), pa.array([least], pa.float64())],
                    names=["ids", "vectors", "thresholds", "least"])
    return blocks.select("ids", "vectors").mapInArrow(run, "ids binary, vectors binary, thresholds binary, least double")


def _needed(queries: DataFrame, buckets: DataFrame) -> DataFrame:
    """(key, bucket): the buckets whose longest vector reaches the least length that a query block needs.

    Sorted by length, what a query block needs is the front of the buckets:
    one running count over both lists (a row per block) gives its end.
    """
    by_length = Window.orderBy(F.desc("longest"), "bucket")
    placed = buckets.withColumn("place", F.row_number().over(by_length).cast("long"))
    none = F.lit(None).cast("long")
    marks = (buckets.select(F.col("longest").alias("v"), F.lit(1).alias("is_bucket"), none.alias("key"))
             .unionByName(queries.select((F.col("least") * (1 - LOOSE)).alias("v"), F.lit(0).alias("is_bucket"), "key")))
    ahead = F.sum("is_bucket").over(Window.orderBy(F.desc("v"), F.desc("is_bucket"))
                                    .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = marks.withColumn("n", ahead).filter("key is not null and n > 0")
    return (ends.select("key", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("place"))
            .join(placed, "place").select("key", "bucket"))


def top_k(table: DataFrame, query_step: int = 50, k: int = 5, scale: int = 256, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k highest integer inner products of every query.

    Queries are the rows whose ``vec_id`` is divisible by ``query_step``.
    """
    spark = table.sparkSession
    rows, _ = usable(table)
    rows = rows.withColumn("embedding", scaled("embedding", scale))
    rows = stored(rows.withColumn("norm2", F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x * x)), "scaled")
    n = partitions(spark)
    buckets = packed(rows, ["norm2", "vec_id"], n, block=block, descending=True).select(
        F.col("ids").alias("p_ids"), F.col("vectors").alias("p"))

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            of = [float(np.sqrt((unpacked(i.as_py(), v.as_py())[1][0] ** 2).sum())) for i, v in zip(*b.columns)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(of, pa.float64())], names=["p_ids", "p", "longest"])
    buckets = stored(buckets.mapInArrow(longest, "p_ids binary, p binary, longest double"), "norm-buckets")
    asked = rows.filter(F.col("vec_id") % query_step == 0)
    queries = query_blocks(asked, max(1, -(-asked.count() // min(block, QUERY_BLOCK))))
    top = buckets.orderBy(F.desc("longest"), F.desc(F.length("p_ids")), "p_ids").select("p_ids", "p").first()
    queries = stored(_with_thresholds(queries, top, k), "query-blocks")

    needed = _needed(queries.select(F.xxhash64("ids").alias("key"), "least"),
                     buckets.select(F.xxhash64("p_ids").alias("bucket"), "longest"))
    cells = (needed.join(queries.select(F.xxhash64("ids").alias("key"), "ids", "vectors", "thresholds"), "key")
             .join(buckets.select(F.xxhash64("p_ids").alias("bucket"), "p_ids", "p"), "bucket"))
    found = cells.select("ids", "vectors", "thresholds", "p_ids", "p").mapInArrow(_search(k), FOUND)
    return ranked(found, k)


ORACLE_SQL = """
WITH ok AS (
  SELECT vec_id, min(embedding) AS embedding FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  GROUP BY vec_id),
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM ok),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
    vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""
