import random
import re
from collections import Counter

import pytest
from conftest import DOCS, SF001
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from songemo.llm import licenses, mixing
from songemo.llm.base import table


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8))
def test_period_meets_windows_and_deviates_by_less_than_a_block(parts):
    total, slots = sum(parts), mixing.period(parts)
    assert sorted(t for s in slots for t in s) == list(range(total))
    for w, s in zip(parts, slots):
        for j, t in enumerate(s):
            assert j * total // w <= t < -(-(j + 1) * total // w)
        for t in range(total + 1):
            assert abs(sum(x < t for x in s) - t * w / total) < 1


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 6)), min_size=1, max_size=6))
def test_phases_equal_a_simulation(spec):
    blocks, parts = [b for b, _ in spec], [w for _, w in spec]
    got = {}
    for i, a, b, start, total, w, p in mixing.phases(blocks, parts):
        for k in range(b - a):
            got[start + k // w * total + p[k % w]] = (i, a + k)
    left, want, phase_start, given_ = list(blocks), {}, 0, [0] * len(blocks)
    t = 0
    while any(left):
        active = [i for i in range(len(left)) if left[i]]
        total = sum(parts[i] for i in active)
        ready = [(-(-(given_[i] + 1) * total // parts[i]), i) for i in active if given_[i] * total // parts[i] <= t - phase_start]
        _, i = min(ready)
        want[t] = (i, blocks[i] - left[i])
        left[i] -= 1
        given_[i] += 1
        t += 1
        if not left[i]:
            phase_start, given_ = t, [0] * len(blocks)
    assert got == want


def test_mixture_of_documents(spark):
    rng = random.Random(1)
    rows = [(i, f"t{i}", "en", rng.choices(["a", "b", "c", None], [60, 25, 10, 5])[0], 2) for i in range(400)]
    rows += [(7, "again", "en", "a", 1), (None, None, None, "b", None), (None, "", None, "b", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.schedule(docs, {"a": 3, "b": 2, None: 1}, block=4).collect()
    assert sorted(str((r.doc_id, r.source)) for r in got) == sorted(str((r[0], r[3])) for r in rows)
    by_slot = {}
    for r in got:
        assert r.release <= r.slot < r.deadline
        by_slot.setdefault(r.slot, set()).add((r.source, r.block))
    assert sorted(by_slot) == list(range(len(by_slot))) and all(len(v) == 1 for v in by_slot.values())
    # Until the first source runs out every source is within a block of its share.
    n = Counter(r[3] for r in rows)
    order, seen = [next(iter(by_slot[t]))[0] for t in range(len(by_slot))], Counter()
    for t, s in enumerate(order, 1):
        seen[s] += 1
        if any(seen[x] * 4 >= n[x] for x in n):
            break
        assert all(abs(seen[x] - t * w / 7) < 1 for x, w in {"a": 3, "b": 2, "c": 1, None: 1}.items())
    assert t > 15
    for s in n:
        mine = sorted((r.slot, r.place) for r in got if r.source == s)
        ids = [r.doc_id for r in sorted(got, key=lambda r: (r.slot, r.place)) if r.source == s]
        assert len(set(mine)) == len(mine) and ids == sorted(ids, key=lambda x: (x is not None, x or 0))


def test_rows_alike_take_a_place_each(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPIES", 7)                 # the copies of a row are made in several tasks
    rows = [(1, "same", "en", "a", 4)] * 200 + [(None, None, None, "b", None)] * 90 + [(i, "x", "en", "b", 1) for i in range(110)]
    docs = spark.createDataFrame(rows, DOCS).withColumns({c: F.lit(c) for c in ("_row", "_part", "c1")})
    got = mixing.interleaved(docs, {"a": 1, "b": 1}, block=16).collect()
    assert sorted(map(str, (tuple(r)[:5] for r in got))) == sorted(map(str, rows))
    assert all((r["_row"], r["_part"], r["c1"]) == ("_row", "_part", "c1") for r in got)
    n = Counter((r.mix_slot, r.mix_place) for r in got)
    assert len(n) == 400 and max(n.values()) == 1 and all(place < 16 for _, place in n)
    sources = [next(r.source for r in got if r.mix_slot == t) for t in range(26)]
    assert all(abs(sources[:t].count("a") - t / 2) < 1 for t in range(27))
    assert sum(r.mix_slot == 0 for r in got) == sum(r.mix_slot == 1 for r in got) == 16


def test_mixed_keeps_rows_and_order(spark):
    rows = [(i, "x", "en", f"s{i % 3}", 1) for i in range(100)] + [(5, "x", "en", "s2", 1)]
    docs = spark.createDataFrame(rows, DOCS)
    out = mixing.mixed(docs, block=2)
    assert out.columns == docs.columns and sorted(map(tuple, out.collect())) == sorted(rows)
    assert [r.source for r in out.limit(2).collect()] in (["s0"] * 2, ["s1"] * 2, ["s2"] * 2)
    assert mixing.mixed(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        mixing.mixed(docs.withColumnRenamed("lang", "mix_slot"))


def base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    at, labels = [], set()
    for p, label in licenses.PHRASES.items():
        p = p.split()
        for i in range(len(w)):
            if w[i:i + len(p)] == p:
                at.append(i)
                labels.add(label)
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def check_base(docs):
    got = {}
    for r in licenses.scan(docs).collect():
        assert 0 <= r.score <= 1 and set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(","))
        got.setdefault(r.doc_id, []).append((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
    want = {}
    for r in docs.collect():
        want.setdefault(r.doc_id, []).append(base(r.text))
    assert {k: sorted(v, key=str) for k, v in got.items()} == {k: sorted(v, key=str) for k, v in want.items()}


def test_base_equals_brute_force(spark, make_docs):
    rng = random.Random(2)
    pool = "gnu general public license apache cc by mit MIT License, the of version Ärger 日本 under work is licensed".split()
    texts = [" ".join(rng.choices(pool, k=rng.randint(0, 60))) for _ in range(60)]
    texts += ["", None, "MIT LICENSE", "cc-by cc by", "mit  \n license", "mitlicense", "K license", "apache license " * 300]
    check_base(make_docs([*enumerate(texts), (3, "mit license"), (3, "mit license"), (None, "cc by")], extra=("row", "gram", "label")))
    check_base(table(spark, SF001, "documents"))
    assert licenses.scan(make_docs(["x"]).limit(0)).count() == 0


def test_voting_finds_changed_licenses(spark, make_docs):
    mit = dict((v, t) for v, t in reversed(licenses.TEMPLATES))["mit"]
    w = mit.split()
    changed = " ".join([*w[:6], "extra", "words", *w[6:12], *w[14:]])
    texts = [f"before {mit} after", f"Some text. {changed}.", " ".join(w[:8]), " ".join(reversed(w)),
             "Licensed under CC BY-NC 4.0.", "Redistribution and use in source and binary forms, with or without "
             "modification, are permitted provided that the following conditions are met:"]
    got = {r.doc_id: r for r in licenses.scan(make_docs(texts)).collect()}
    assert got[0].labels == "mit" and got[0].score == 1.0 and got[0].n_base == 0
    assert got[1].labels == "mit" and 0.6 <= got[1].score < 1
    assert got[2].labels == "" and got[3].labels == "" and got[2].score < 0.6
    assert got[4].labels == "cc-by,cc-by-nc" and got[4].base_labels == "cc-by"
    assert got[5].labels == "bsd"
