"""Approximate nearest neighbours with learned partitions.

1. On a bounded sample of vectors (``SAMPLE`` rows, smallest hashes of the id)
   the neighbour graph is built and cut into balanced parts: halving along
   principal directions, then moving vectors to the part of most of their
   neighbours while no part exceeds its share by more than 10 %.
2. A small network (one hidden layer, softmax) learns from a row in which part it
   lies, and from a query in which parts its neighbours lie.  A row's input tells
   its length: its direction shrunk to length / ``LONG_QUANTILE`` of the lengths, and
   one coordinate more that makes it a unit vector; a query's has 0 there, so
   that nearness of inputs is the inner product up to that length.
3. Every row of the table is indexed under its most probable part.
4. A query goes to its ``probes`` most probable parts, and to further ones while
   these hold fewer than k rows, and all their rows are reranked by the true
   inner product in double precision.

``probes`` is chosen on ``CHECKED`` rows of the sample that the network does not
learn from: the fewest parts that hold ``TARGET`` of their true neighbours in the
whole table, which one scan against this bounded block of queries finds.  There
are at least ``min_parts`` parts at any size that a sample of eight rows a part
allows; their number grows with the table (about ``ROWS_PER_PART`` rows each, at
most ``MAX_PARTS``, which the sample bounds).  Parts are packed into blocks of at
most 4096 rows, so a part that holds a third of all rows is many tasks.  Nothing
is dropped: blocks only split the work.

Defined cases: see ``vectors.usable``; zero vectors take no part; repeated
vectors tie and go by id; queries are found among all rows but never find
themselves; fewer candidates than k give all of them; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import by_batch, partitions, stored
from .vectors import best_of, packed, query_blocks, ranked, unpacked, usable

SAMPLE = 4096
NEIGHBOURS = 16
ROWS_PER_PART = 4096
MAX_PARTS = 64
HIDDEN = 64
STEPS = 300
MIN_PARTS = 8
TARGET = 0.95
CHECKED = 256
LONG_QUANTILE = 0.9


def neighbour_graph(x: np.ndarray, k: int, q: np.ndarray | None = None) -> np.ndarray:
    """(n, k) places of each row's neighbours by inner product (of the rows ``q`` that stand for them as queries)."""
    s = (x if q is None else q) @ x.T
    np.fill_diagonal(s, -np.inf)
    k = min(k, len(x) - 1)
    return np.argpartition(-s, k - 1, axis=1)[:, :k] if k > 0 else np.zeros((len(x), 0), np.int64)


def balanced_parts(x: np.ndarray, graph: np.ndarray, n_parts: int, rounds: int = 8) -> np.ndarray:
    """A part for every row; no part has more than 1.1 of its share."""
    part = np.zeros(len(x), np.int64)
    made = 1
    while made < n_parts:                                  # halve every part at the median of its main direction
        for p in range(made):
            rows = np.flatnonzero(part == p)
            c = x[rows] - x[rows].mean(axis=0)
            d = np.linalg.svd(c, full_matrices=False)[2][0] if len(rows) > 1 else c[0]
            order = np.argsort(c @ d, kind="stable")
            part[rows[order[len(rows) // 2:]]] = p + made
        made *= 2
    room = int(np.ceil(1.1 * len(x) / made))
    size = np.bincount(part, minlength=made)
    for _ in range(rounds):
        votes = np.zeros((len(x), made))
        np.add.at(votes, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].reshape(-1)), 1)
        np.add.at(votes, (graph.reshape(-1), np.repeat(part, graph.shape[1])), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable").tolist():
            if gain[i] <= 0:
                break
            if size[best[i]] < room:
                size[part[i]] -= 1
                size[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-300)


@dataclass(frozen=True)
class Router:
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray
    length: float = 1.0              # from here on rows count as equally long

    @property
    def parts(self) -> int:
        return len(self.b2)

    def as_row(self, x: np.ndarray) -> np.ndarray:
        share = np.minimum(np.sqrt((x * x).sum(axis=1, keepdims=True)) / self.length, 1.0)
        return np.hstack([_unit(x) * share, np.sqrt(np.maximum(1.0 - share * share, 0.0))])

    def as_query(self, x: np.ndarray) -> np.ndarray:
        return np.hstack([_unit(x), np.zeros((len(x), 1))])

    def order(self, u: np.ndarray) -> np.ndarray:
        """Parts for every input, most probable first."""
        return np.argsort(-(np.maximum(u @ self.w1 + self.b1, 0) @ self.w2 + self.b2), axis=1, kind="stable")

    def part(self, x: np.ndarray) -> np.ndarray:
        """The part under which each row is indexed."""
        return self.order(self.as_row(x))[:, 0]


def fit_router(u: np.ndarray, goal: np.ndarray, length: float, steps: int = STEPS, seed: int = 11) -> Router:
    """Adam on the cross entropy of inputs ``u`` to ``goal``, shares of the parts."""
    rng = np.random.default_rng(seed)
    d, m = u.shape[1], goal.shape[1]
    par = [rng.normal(0, d ** -.5, (d, HIDDEN)) * 4, np.zeros(HIDDEN), rng.normal(0, HIDDEN ** -.5, (HIDDEN, m)), np.zeros(m)]
    m1, m2 = [np.zeros_like(p) for p in par], [np.zeros_like(p) for p in par]
    for step in range(1, steps + 1):
        pick = rng.integers(0, len(u), min(len(u), 1024))
        h = np.maximum(u[pick] @ par[0] + par[1], 0)
        z = h @ par[2] + par[3]
        s = np.exp(z - z.max(axis=1, keepdims=True))
        s = (s / s.sum(axis=1, keepdims=True) - goal[pick]) / len(pick)
        back = (s @ par[2].T) * (h > 0)
        for i, g in enumerate((u[pick].T @ back, back.sum(0), h.T @ s, s.sum(0))):
            m1[i] = 0.9 * m1[i] + 0.1 * g
            m2[i] = 0.999 * m2[i] + 0.001 * g * g
            par[i] = par[i] - 0.01 * (m1[i] / (1 - 0.9 ** step)) / (np.sqrt(m2[i] / (1 - 0.999 ** step)) + 1e-8)
    return Router(*par, length)


def train(x: np.ndarray, n_parts: int) -> Router:
    """Fits on sample rows ``x``; with fewer than eight rows a part there are fewer parts."""
    while n_parts > 1 and len(x) < 8 * n_parts:
        n_parts //= 2
    lengths = np.sqrt((x * x).sum(axis=1))
    length = float(np.quantile(lengths, LONG_QUANTILE)) if len(x) else 1.0
    none = Router(np.zeros((x.shape[1] + 1, 1)), np.zeros(1), np.zeros((1, 1)), np.zeros(1), length)
    if n_parts == 1:
        return none
    rows, queries = none.as_row(x), none.as_query(x)
    graph = neighbour_graph(rows, NEIGHBOURS, queries)
    part = balanced_parts(rows, graph, n_parts)
    n_parts = int(part.max()) + 1
    own = np.eye(n_parts)[part]
    near = np.zeros((len(x), n_parts))
    np.add.at(near, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph].reshape(-1)), 1 / max(1, graph.shape[1]))
    return fit_router(np.vstack([rows, queries]), np.vstack([own, near]), length)


def parts_needed(rows: DataFrame, router: Router, ids: np.ndarray, x: np.ndarray, k: int, target: float) -> int:
    """The fewest parts, in each query's order, that hold ``target`` of the true k nearest rows of the queries ``x``."""
    shared = rows.sparkSession.sparkContext.broadcast((router, ids, x))        # at most CHECKED queries

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, q_ids, q = shared.value
        score, who, part = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0), np.int64)
        for b in batches:
            if not b.num_rows:
                continue
            v = b.column(0).to_numpy(zero_copy_only=False)
            p = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            s = q @ p.T
            s[q_ids[:, None] == v[None, :]] = -np.inf
            score = np.hstack([score, s])
            who, part = (np.hstack([a, np.broadcast_to(n, s.shape)]) for a, n in ((who, v), (part, r.part(p))))
            top = np.argsort(-score, axis=1, kind="stable")[:, :k]
            score, who, part = (np.take_along_axis(a, top, axis=1) for a in (score, who, part))
        n = np.repeat(q_ids, score.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(n), pa.array(who.ravel()), pa.array(score.ravel()), pa.array(part.ravel())],
                                         names=["query", "vec_id", "score", "part"])
    found = rows.select("vec_id", "embedding").mapInArrow(run, "query long, vec_id long, score double, part long")
    w = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    found = (found.filter(F.col("score") > float("-inf")).withColumn("r", F.row_number().over(w)).filter(F.col("r") <= k)
             .select("query", "part").collect())                                # at most CHECKED * k
    if not found:
        return router.parts
    place = np.argsort(router.order(router.as_query(x)), axis=1)
    at = {int(i): n for n, i in enumerate(ids)}
    places = np.array([place[at[r["query"]], r["part"]] for r in found])
    share = np.cumsum(np.bincount(places, minlength=router.parts)) / len(places)
    return min(router.parts, int(np.searchsorted(share, target - 1e-12)) + 1)


def _indexed(rows: DataFrame, router: Router) -> DataFrame:
    """(vec_id, embedding, part) of every row."""
    shared = rows.sparkSession.sparkContext.broadcast(router)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        return pa.RecordBatch.from_arrays([*b.columns, pa.array(shared.value.part(x))], names=["vec_id", "embedding", "part"])
    return rows.select("vec_id", "embedding").mapInArrow(by_batch(run), "vec_id long, embedding array<double>, part long")


def _probed(rows: DataFrame, router: Router, probes: int, sizes: np.ndarray, k: int) -> DataFrame:
    """(vec_id, embedding, part) with one row for each part that a query goes to: ``probes``, or until they hold k others."""
    shared = rows.sparkSession.sparkContext.broadcast((router, sizes))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        r, n = shared.value
        x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        order = r.order(r.as_query(x))
        enough = (np.cumsum(n[order], axis=1) <= k).sum(axis=1) + 1              # itself may be among them
        take = np.arange(r.parts)[None, :] < np.maximum(probes, enough)[:, None]
        at = pa.array(np.repeat(np.arange(b.num_rows), take.sum(axis=1)))
        return pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(order[take])],
                                          names=["vec_id", "embedding", "part"])
    return rows.select("vec_id", "embedding").mapInArrow(by_batch(run), "vec_id long, embedding array<double>, part long")


def _rerank(k: int):
    def rows(held: dict[int, list]) -> pa.RecordBatch:
        out = [(q, v, s) for q, found in held.items() for v, s in found]
        cols = list(zip(*out)) if out else [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["query_id", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Blocks of one part follow each other for a block of queries: its best rows leave once, not per block.
        block, held = None, {}
        for b in batches:
            for r in range(b.num_rows):
                if block != (new := (b.column(4)[r].as_py(), b.column(0)[r].as_py())):
                    if held:
                        yield rows(held)
                    block, held = new, {}
                q_ids, q = unpacked(b.column(0)[r].as_py(), b.column(1)[r].as_py())
                ids, p = unpacked(b.column(2)[r].as_py(), b.column(3)[r].as_py())
                rough = q @ p.T
                rough[q_ids[:, None] == ids[None, :]] = -np.inf
                for i, row in enumerate(rough):
                    near = best_of(row, ids, k, slack=1e-9 * max(1.0, float(np.abs(row[np.isfinite(row)]).max(initial=0))))
                    exact = (p[near] * q[i]).sum(axis=1)          # the same for equal vectors wherever they stand
                    best = held.get(int(q_ids[i]), []) + [(int(ids[near[j]]), float(exact[j])) for j in best_of(exact, ids[near], k)]
                    held[int(q_ids[i])] = sorted(best, key=lambda x: (-x[1], x[0]))[:k]
        if held:
            yield rows(held)
    return run


def nearest(table: DataFrame, query_step: int = 20, k: int = 20, target: float = TARGET, min_parts: int = MIN_PARTS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k nearest rows found for every query.

    Queries are the rows whose ``vec_id`` is divisible by ``query_step``.
    """
    spark = table.sparkSession
    rows, dim = usable(table)
    rows = stored(rows.filter(F.exists("embedding", lambda x: x != 0)), "vectors")
    total = rows.count()
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).collect()      # bounded: SAMPLE rows
    x = np.array([r["embedding"] for r in sample], np.float64).reshape(len(sample), dim)
    ids = np.array([r["vec_id"] for r in sample], np.int64)
    parts = 1
    while parts < min(min_parts, MAX_PARTS) or (parts < MAX_PARTS and parts * ROWS_PER_PART < total):
        parts *= 2
    held = min(CHECKED, len(x) // 5)
    router = train(x[:len(x) - held], parts)
    probes = parts_needed(rows, router, ids[len(x) - held:], x[len(x) - held:], k, target) if held else router.parts
    n = partitions(spark)
    indexed = stored(_indexed(rows, router), "indexed")
    sizes = np.zeros(router.parts, np.int64)
    for r in indexed.groupBy("part").count().collect():                                # one row per part
        sizes[r["part"]] = r["count"]
    index = packed(indexed, ["part", "vec_id"], n, key="part")
    queries = rows.filter(F.col("vec_id") % query_step == 0)
    asked = query_blocks(_probed(queries, router, probes, sizes, k), max(1, -(-queries.count() // 1024)), key="part")
    cells = (asked.withColumnsRenamed({"ids": "q_ids", "vectors": "q"})
             .join(index.withColumnsRenamed({"ids": "p_ids", "vectors": "p"}), "key"))
    cells = cells.select("q_ids", "q", "p_ids", "p", "key").sortWithinPartitions("key", "q_ids")
    return ranked(cells.mapInArrow(_rerank(k), "query_id long, vec_id long, score double"), k)
