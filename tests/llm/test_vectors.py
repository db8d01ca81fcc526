import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from songemo.llm import learned_partitions, norm_buckets
from songemo.llm.base import table


def frame(spark, vecs, ids=None):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], 1) for i, v in zip(ids or range(len(vecs)), vecs)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")


def brute(ids, vecs, step, k):
    out = {}
    for i, q in zip(ids, vecs):
        if i % step == 0:
            s = sorted((-float((q * p).sum()), j) for j, p in zip(ids, vecs) if j != i)[:k]
            out[i] = [(j, -x) for x, j in s]
    return out


def collected(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return {q: [x[1:] for x in sorted(v)] for q, v in out.items()}, out


@pytest.mark.parametrize("kind", ["even", "skewed", "clustered"])
def test_norm_buckets_equal_brute_force(spark, kind):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 12))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "skewed":
        x *= rng.lognormal(0, 2, (600, 1))
    if kind == "clustered":
        x = x[rng.integers(0, 20, 600)] + rng.normal(size=(600, 12)) * 0.01
        x[50:90] = x[50]                                   # exact ties
    x = x.astype(np.float32).astype(float)
    x[7] = 0
    got, raw = collected(norm_buckets.top_k(frame(spark, x), query_step=10, k=5, block=64))
    want = brute(range(600), np.floor(256 * x), 10, 5)
    assert got == {q: [(j, int(s)) for j, s in v] for q, v in want.items()}
    assert all([r[0] for r in sorted(v)] == [1, 2, 3, 4, 5] for v in raw.values())


def test_prunings_are_used_and_exact():
    rng = np.random.default_rng(0)
    p = np.floor(rng.normal(size=(500, 8)) * 100)
    p[::3, 0] += 500
    p = p[np.argsort(-np.linalg.norm(p, axis=1))]
    q = p[:40] + 1
    q[::2, 0] = 0
    ids, q_ids = np.arange(500), np.arange(1000, 1040)
    s = q @ p.T
    t = np.sort(s, axis=1)[:, -5]
    need = t / (np.linalg.norm(q, axis=1) * np.linalg.norm(p[0]))
    assert (need >= norm_buckets.COORDINATE_FROM).any() and (need < norm_buckets.COORDINATE_FROM).any()
    out = norm_buckets.search_block(q_ids, q, t, ids, p, 5)
    for i in range(40):
        assert [x[1] for x in out if x[0] == 1000 + i] == sorted(ids, key=lambda j: (-s[i, j], j))[:5]


def test_scores_beyond_doubles_are_exact(spark):
    """Products above 2 ** 53 that differ by one: exact integers, in their order."""
    big = 2.0 ** 20
    vecs = [[big, big, 1 / 256], [big, big, 0], [big, big, 2 / 256], [big, big - 1, 0], [-big, 0, 0]]
    got, _ = collected(norm_buckets.top_k(frame(spark, vecs), query_step=1, k=3))
    ints = [[int(np.floor(256 * c)) for c in v] for v in vecs]
    for i, q in enumerate(ints):
        want = sorted(((-sum(a * b for a, b in zip(q, p)), j) for j, p in enumerate(ints) if j != i))[:3]
        assert got[i] == [(j, -s) for s, j in want]


def test_odd_vectors(spark):
    vecs = [[1, 0], None, [None, 1], [float("nan"), 1], [float("inf"), 0], [0, 0], [0.5, 0.5], [1, 0], [2, 0, 1], []]
    got, _ = collected(norm_buckets.top_k(frame(spark, vecs), query_step=1, k=5))
    assert set(got) == {0, 5, 6, 7} and [v for v, _ in got[6]] == [0, 7, 5]
    got, _ = collected(learned_partitions.nearest(frame(spark, vecs), query_step=1, k=5))
    assert set(got) == {0, 6, 7} and [v for v, _ in got[0]] == [7, 6]
    for empty in (frame(spark, vecs).limit(0), frame(spark, [[0, 0], None])):
        assert learned_partitions.nearest(empty).count() == 0
    assert norm_buckets.top_k(frame(spark, vecs).limit(0)).count() == 0
    twice = frame(spark, [[1, 0], [1, 0], [0, 1]], ids=[0, 0, 50])
    assert collected(norm_buckets.top_k(twice))[0] == {0: [(50, 0)], 50: [(0, 0)]}


def test_balanced_parts():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(800, 6)) + np.repeat(rng.normal(size=(4, 6)) * 5, 200, axis=0)
    graph = learned_partitions.neighbour_graph(x, 8)
    part = learned_partitions.balanced_parts(x, graph, 8)
    assert np.bincount(part).max() <= np.ceil(1.1 * 100) and len(np.unique(part)) == 8
    assert (part[graph] == part[:, None]).mean() > 0.5


@pytest.mark.parametrize("kind, parts", [("even", 8), ("clustered", 8), ("hot", 16), ("long", 16), ("longer", 64)])
def test_nearest_recall(spark, kind, parts):
    """Even and clustered directions, a hot spot, and lengths spread log-normally, at 8 to 64 parts."""
    rng = np.random.default_rng(2)
    n = 4500
    x = rng.normal(size=(n, 16))
    if kind == "clustered":
        x = rng.normal(size=(30, 16))[rng.integers(0, 30, n)] * 3 + x
    if kind == "hot":
        x[: n // 3] = x[0] + rng.normal(size=(n // 3, 16)) * 0.01
        x[10:60] = x[10]
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    if kind in ("long", "longer"):
        x *= rng.lognormal(0, 1.0 if kind == "long" else 1.5, (n, 1))
    x = x.astype(np.float32).astype(float)
    asked = []
    def spy(*a, **b):
        asked.append((a[1].parts, needed(*a, **b)))
        return asked[-1][1]
    needed, learned_partitions.parts_needed = learned_partitions.parts_needed, spy
    try:
        got, raw = collected(learned_partitions.nearest(frame(spark, x), query_step=20, k=20, min_parts=parts))
    finally:
        learned_partitions.parts_needed = needed
    assert asked[0][0] > parts // 2 and asked[0][1] <= asked[0][0]
    want = brute(range(n), x, 20, 20)
    assert got.keys() == want.keys() and all(len(v) == 20 for v in got.values())
    hit = np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want])
    print(kind, asked, hit)
    assert hit >= 0.9
    for q, v in got.items():
        assert v == sorted(v, key=lambda p: (-p[1], p[0])) and q not in {j for j, _ in v}
        assert all(abs(s - float(x[q] @ x[j])) < 1e-9 * max(1.0, abs(s)) for j, s in v)


def test_small_parts_are_widened(spark):
    """A query whose parts hold fewer than k rows goes to further ones: k answers where there are k candidates."""
    rng = np.random.default_rng(9)
    x = np.concatenate([rng.normal(size=(90, 4)), np.eye(4)[:1] * 50 + rng.normal(size=(10, 4)) * 0.01])
    got, _ = collected(learned_partitions.nearest(frame(spark, x), query_step=1, k=30, target=0.01))
    assert all(len(v) == 30 for v in got.values()) and len(got) == 100


def test_recall_on_table(spark):
    emb = table(spark, SF001, "embeddings")
    rows = emb.orderBy("vec_id").collect()
    ids, x = [r.vec_id for r in rows], np.array([r.embedding for r in rows], float)
    got, _ = collected(learned_partitions.nearest(emb.withColumn("rank", F.lit(0))))
    want = brute(ids, x, 20, 20)
    assert np.mean([len({j for j, _ in got[q]} & {j for j, _ in want[q]}) / 20 for q in want]) >= 0.9
