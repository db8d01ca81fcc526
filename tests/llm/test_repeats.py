import hashlib
import random

import numpy as np
import pytest
from brute import repeated
from conftest import SF001
from hypothesis import given, settings
from hypothesis import strategies as st

from songemo.llm import anchors, repeats, suffix
from songemo.llm.base import table


@pytest.mark.parametrize("small_buckets", [0, 2, 32])
@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=60), st.booleans())
def test_suffix_array(small_buckets, s, twice):
    suffix.SMALL_BUCKETS, before = small_buckets, suffix.SMALL_BUCKETS
    try:
        s = s + s if twice else s
        a = np.array(s, np.int64)
        sa = suffix.suffix_array(a)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:])
        plcp, phi = suffix.permuted_lcp(a, sa)
        for i, j in enumerate(phi.tolist()):
            n = 0
            while j >= 0 and max(i, j) + n < len(s) and s[i + n] == s[j + n]:
                n += 1
            assert plcp[i] == n
    finally:
        suffix.SMALL_BUCKETS = before


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=500), st.binary(max_size=100), st.binary(max_size=100))
def test_equal_strings_have_equal_anchors(core, a, b):
    core = (core * 3)[:400]
    def by_string(data):
        return {data[i:i + 200]: (int(k), int(at) - i) for k, s, n, at in zip(*anchors.segments(data, 200)) for i in range(s, s + n)}
    x, y = by_string(a + core), by_string(core + b)
    assert all(x[w] == y[w] for w in x.keys() & y.keys())


def texts(seed):
    rng = random.Random(seed)
    def prose(n):
        return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) for _ in range(n))
    shared = [prose(60) for _ in range(4)]
    out = [prose(rng.randint(0, 150)) for _ in range(15)]
    for _ in range(40):
        p = rng.choice(shared)
        a = rng.randrange(0, 60)
        out.append(prose(rng.randint(0, 40)) + " " + p[a:a + rng.randint(150, 330)] + " " + prose(rng.randint(0, 40)))
    copy = out[-1]
    return [*out, copy, copy[:250], "", None, "x" * 199, "y" * 200, "z" * 201, "ab" * 400, copy[7:]]


def check(spark, docs, rows, length=200):
    got = {}
    for r in repeats.removal_digests(docs, length).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
    want = {}
    for (d, _), (data, flag) in zip(rows, repeated([t for _, t in rows], length)):
        kept = bytes(c for c, f in zip(data, flag) if not f)
        want.setdefault(d, []).append((len(data), sum(flag), len([1 for x in bytes(flag).split(b"\0") if x]),
                                       hashlib.sha256(kept).hexdigest()))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return sum(x[1] for v in want.values() for x in v)


@pytest.mark.parametrize("limit", [400_000, 5_000])
def test_removal_equals_brute_force(spark, make_docs, monkeypatch, limit):
    """With shards of 5000 bytes large keys are halved instead of sorted."""
    monkeypatch.setattr(repeats, "SHARD_BYTES", limit)
    split, halved = repeats._split_spans, []
    monkeypatch.setattr(repeats, "_split_spans", lambda hot, length: halved.append(1) or split(hot, length))
    rows = [*enumerate(texts(1)), (3, "q" * 500), (None, "r" * 300), (9, "again " * 50), (9, "again " * 50)]
    assert check(spark, make_docs(rows, extra=("key", "digest", "spans", "_n")), rows) > 5000
    assert len(halved) == (limit < 400_000)


def test_whole_table_equals_brute_force(spark):
    docs = table(spark, SF001, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert check(spark, docs, rows) > 0


def test_empty_and_nothing_repeated(spark, make_docs):
    assert repeats.removal_digests(make_docs([(1, "x")]).limit(0)).count() == 0
    r = repeats.removal_digests(make_docs([(1, "x" * 150), (2, None)])).orderBy("doc_id").collect()
    assert [(x.n_bytes, x.n_removed) for x in r] == [(150, 0), (0, 0)]


def test_text_without_repeats(spark, make_docs):
    p = "é" * 150
    docs = make_docs(["a" + p, "b" + p + "b", "only here", None])
    got = [r.text for r in repeats.without_repeats(docs).orderBy("doc_id").collect()]
    assert got == ["a", "bb", "only here", None]


def test_slices_hold_whole_keys(monkeypatch):
    monkeypatch.setattr(repeats, "SHARD_BYTES", 10)
    key, size = np.array([1, 1, 2, 3, 3, 3, 4, 5]), np.array([4, 4, 2, 9, 9, 9, 3, 3])
    assert list(repeats._slices(key, size)) == [(0, 3), (3, 6), (6, 8)]
    assert list(repeats._slices(key[:0], size[:0])) == []
