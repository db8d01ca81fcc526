"""Spelling variants against brute force over all pairs."""

import random
import re
import zlib
from collections import Counter
from itertools import combinations

import pytest

from conftest import SF001
from songemo.llm import queries, variants
from songemo.llm.base import table


def near(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(docs, min_count=5, ratio=5):
    counts = Counter()
    for i, t in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= min_count}
    with_near = {w: [] for w in n}
    keys = {}
    for w in n:
        for i in range(len(w) + 1):
            for k in ({("r", i, w[:i] + w[i + 1:]), ("w", w[:i] + w[i + 1:])} if i < len(w) else {("w", w)}):
                keys.setdefault(k, set()).add(w)
    pairs = {p for ws in keys.values() for p in combinations(sorted(ws), 2) if near(*p)}
    for a, b in pairs:
        with_near[a].append(b)
        with_near[b].append(a)
    form = {}
    for w, others in with_near.items():
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    def root(w):
        while form[w]:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(with_near[w]), n[form[w]] if form[w] else None) for w in n}


def rows(df):
    out = df.collect()
    assert len({r.word for r in out}) == len(out)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in out}


def test_whole_table(spark):
    docs = [(r.doc_id, r.text) for r in table(spark, SF001, "documents").collect()]
    got = rows(queries.op12_variants(spark, SF001))
    assert got == plain(docs) and len(got) > 100


@pytest.mark.parametrize("seed", range(2))
def test_random_words(spark, make_docs, seed):
    """Few letters, repeated grams, accents: many near words, ties and chains."""
    rng = random.Random(seed)
    letters = "abé"
    base = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 9))) for _ in range(60)]
    words = list(base)
    for w in base:
        i = rng.randrange(len(w))
        words += [w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]]
    docs = []
    for i in range(60):
        text = " ".join(w.upper() if rng.random() < 0.1 and w.isascii() else w
                        for w in rng.choices(words, weights=[1 / (1 + k % 40) ** 2 for k in range(len(words))], k=200))
        docs.append((i if i % 7 else None, text))
    docs += [(61, None), (62, ""), (61, docs[1][1]), (61, docs[1][1]), (63, "×÷" * 4 + " " + "ÀÀÀÀÀÀ " * 6)]
    got = rows(variants.groups(make_docs(docs, extra=("word", "n", "gram"))))
    want = plain(docs)
    assert got == want and any(f for f, *_ in want.values())


def test_chain_ties_and_empty(spark, make_docs):
    """A chain of forms leads to its end; equally frequent near words go by code point."""
    text = ("abcdef " * 5 + "abcdeff " * 25 + "abcdefff " * 125 + "abcdefffg " * 700
            + "zzzzzzz " * 5 + "zzzzzzza " * 30 + "zzzzzzzb " * 30)
    docs = [(3, text)]
    want = plain(docs)
    assert want["abcdef"][:2] == ("abcdeff", "abcdefffg") and want["zzzzzzz"][0] == "zzzzzzza"
    assert rows(variants.groups(make_docs(docs))) == want
    assert variants.groups(make_docs([])).count() == 0
    assert variants.groups(make_docs(["short a b", None])).count() == 0


def test_pivots_by_trying_all():
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 12)))
        counts = {a + b: rng.randint(1, 9) for a in "abc" for b in "abc"}
        prefix, pivot = variants.signature(word, counts)
        weight = lambda ps: sum(counts[word[i:i + 2]] for i in ps)
        best = min(weight(p) for p in combinations(sorted(prefix), 2) if p[1] - p[0] >= 2)
        assert len(pivot) == 2 and abs(pivot[0] - pivot[1]) >= 2 and set(pivot) <= set(prefix) and weight(pivot) == best


def test_long_runs(spark, make_docs):
    """Words of 64 and 65 letters are near across the bound; a very long word of two grams has few rows."""
    a = "ab" * 32
    long = "ab" * 100_000
    text = " ".join([a + "c"] * 30 + [a] * 6 + [a + "dc"] * 5 + [long] * 5 + [long + "c"] * 5)
    assert rows(variants.groups(make_docs([(1, text), (2, "wordsix " * 6)]))) == {
        a: (a + "c", a + "c", 6, 1, 30), a + "c": (None, a + "c", 30, 2, None), a + "dc": (a + "c", a + "c", 5, 1, 30),
        long: (None, long, 5, 1, None), long + "c": (None, long + "c", 5, 1, None), "wordsix": (None, "wordsix", 6, 0, None)}


def test_words_are_never_broadcast(spark, make_docs, monkeypatch):
    """Files of some KB stand for many more rows: joins of words and grams are merged, whatever their size looks like."""
    plans = []
    stored = variants.stored
    monkeypatch.setattr(variants, "stored", lambda df, name: plans.append((name, df._jdf.queryExecution().executedPlan().toString())) or stored(df, name))
    out = variants.groups(make_docs(["abcdef " * 5 + "abcdeff " * 25 + "abcdefff " * 125]))
    plans.append(("groups", out._jdf.queryExecution().executedPlan().toString()))
    joins = [(name, "SortMergeJoin" in p, "Broadcast" in p) for name, p in plans if "Join" in p]
    assert [j[0] for j in joins] == ["near", "forms", "roots", "roots", "groups"] and all(j[1:] == (True, False) for j in joins)


def test_one_edit_of_long_words(spark):
    from pyspark.sql import functions as F
    rng = random.Random(4)
    words = ["".join(rng.choice("aé") for _ in range(rng.randint(66, 70))) for _ in range(20)]
    words += ["a" * n for n in (65, 66, 67, 68)] + ["a" * 66 + "b", "b" + "a" * 66, "a" * 33 + "b" + "a" * 33]
    words += [v for w in words[:20] for i in (0, 1, 40, len(w) - 1) for v in (w[:i] + w[i + 1:], w[:i] + "x" + w[i + 1:], w[:i] + "ax" + w[i:])]
    pairs = [(a, b) for a in words for b in words if a != b and abs(len(a) - len(b)) < 2]
    got = spark.createDataFrame(pairs, "x string, y string").select("x", "y", variants._one_edit(F.col("x"), F.col("y")).alias("e")).collect()
    assert [r.e for r in got] == [near(r.x, r.y) for r in got] and 50 < sum(r.e for r in got) < len(got)
