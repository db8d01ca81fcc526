import random

import pytest
from brute import near, shingles
from pyspark.sql import functions as F

from songemo.llm import minhash
from songemo.llm.base import table
from songemo.llm.links import components

from conftest import SF001  # noqa: I001


def check(spark, make_docs, rows, k, percent):
    got = {r.doc_id: r for r in minhash.near_duplicates(make_docs(rows, extra=("rep", "band")), k, percent).collect()}
    want, _ = near(rows, k, percent)
    assert {d: r.component_id for d, r in got.items()} == want
    for d, t in rows:
        assert got[d].n_shingles == len(shingles(t, k)) and got[d].kept == (want[d] == d)


def variants(seed, n, length, edits):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    base = [rng.choice(vocab) for _ in range(length)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            w[rng.randrange(length)] = rng.choice(vocab)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates_equal_brute_force(spark, make_docs, k):
    texts = ["", None, "   ", "one", "ONE", "one two", "one  two\t", "Ärger", "ärger", "a b c", "a b c d e f", "a b c d e f g"]
    texts += variants(1, 60, 80, 12) + variants(2, 25, 30, 6) + variants(3, 3, 4000, 300) + ["same text here now"] * 5
    rng = random.Random(5)
    ids = rng.sample(range(1000), len(texts))
    check(spark, make_docs, list(zip(ids, texts)), k, 80)


@pytest.mark.parametrize("dense", [0, 4, 1000])
def test_chain_in_one_large_bucket(spark, make_docs, monkeypatch, dense):
    """A common core with many outliers: links that the bucket's first member does not see are found in blocks."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    monkeypatch.setattr(minhash, "DENSE", dense)
    core = [f"c{i}" for i in range(40)]
    texts = [" ".join(core + [f"x{g}_{i}" for i in range(9)] + [f"y{g}_{m}"]) for g in range(12) for m in range(3)]
    texts += variants(9, 40, 60, 9)
    check(spark, make_docs, list(enumerate(texts)), 2, 80)


def test_whole_table_equals_brute_force(spark):
    docs = table(spark, SF001, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want, links = near(rows, 2, 80)
    got = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, 2, 80).collect()}
    assert got == want and links


def test_repeated_and_null_ids(spark, make_docs):
    rows = [(5, "a b c d"), (5, "a b c d"), (None, "a b c d"), (3, "a b c d"), (7, "p q r"), (7, "zz yy xx"), (8, "zz yy xx")]
    got = minhash.near_duplicates(make_docs(rows), 2, 80).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.component_id for r in got}
    assert by[5] == by[3] == 3 and by[None] is None
    assert minhash.near_duplicates(make_docs([(1, "x")]).limit(0)).count() == 0


def test_texts_of_a_repeated_id_stay(spark, make_docs):
    """A row goes only if its own text has a near copy under a smaller id, or is a copy of it."""
    rows = [(7, "p q r s t u"), (7, "zz yy xx ww vv uu"), (7, "zz yy xx ww vv uu"), (8, "zz yy xx ww vv uu"), (9, "p q r s t u"),
            (9, "only here a b c"), (4, "only once d e f"), (None, "p q r s t u"), (3, ""), (3, None)]
    got = minhash.without_near_duplicates(make_docs(rows)).select("doc_id", "text").collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, (rows[i] for i in (0, 1, 5, 6, 7, 8, 9))))


def test_estimate_tracks_similarity(spark, make_docs):
    a, b = (" ".join(f"w{i}" for i in range(s, s + 901)) for s in (0, 100))
    sig = minhash.signatures(make_docs([a, b]), 2).orderBy("doc_id").select("sig")
    x, y = (r.sig for r in sig.collect())
    e = spark.createDataFrame([(x, y)], "x array<long>, y array<long>").select(minhash.estimate(F.col("x"), F.col("y"))).first()[0]
    assert abs(e - 800 / 1000) < 0.14


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(90)]
    comp = {}
    def root(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x
    for a, b in edges:
        ra, rb = root(a), root(b)
        comp[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame([*edges, (None, 3), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {n: root(n) for e in edges if e[0] != e[1] for n in e}


def test_groups_stay_whole_across_batches():
    import numpy as np
    import pyarrow as pa
    keys = [(1, 0)] * 3 + [(1, 1)] * 5 + [(2, 0)] + [(2, 1)] * 4
    t = pa.table({"k": [k for k, _ in keys], "m": [m for _, m in keys], "v": list(range(len(keys)))})
    for size in (1, 2, 3, 4, 100):
        got = [np.concatenate([b.column(2).to_numpy() for b in g]).tolist() for g in minhash._groups(t.to_batches(max_chunksize=size), 2)]
        assert sum(got, []) == list(range(len(keys)))
        for g in got[1:]:
            assert keys[g[0]] != keys[g[0] - 1]
