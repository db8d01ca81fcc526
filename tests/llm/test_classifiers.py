import math
import random
import zlib

import numpy as np
import pytest
from conftest import DOCS
from pyspark.sql import functions as F

from songemo.llm import language, toxicity

SYLLABLES = {"en": "th er on an re he in ed nd ha at en es of or nt ea ti to it".split(),
             "de": "en er ch de ei un ie te ge in be sch ü ö ß heit ung zu ver keit".split(),
             "fr": "es le de en re nt on er ai te é è ç eau ou que ment tion un la".split()}


def prose(rng, lang, n):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 4))) for _ in range(n))


def rem(i):
    return zlib.crc32(str(i).encode()) % 4


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(1200):
        lang = rng.choice(list(SYLLABLES))
        toxic = rng.random() < 0.15
        w = prose(rng, lang, rng.randint(5, 250)).split()
        if toxic:
            for _ in range(rng.randint(1, 3)):
                w.insert(rng.randrange(len(w) + 1), rng.choice(["vileword", "Nastyterm", "awfulthing"]))
        rows.append((i, " ".join(w), lang, "s", 1))
        labels.append((i, 1, int(toxic)))
    return rows, labels


def test_toxicity_held_out(spark, corpus):
    rows, labels = corpus
    more = [(2000, "", None, None, 0), (2001, None, None, None, None), (None, "vileword here", None, None, 1),
            (2002, "x" * 100_000 + " vileword", "en", "s", 1), (5, rows[5][1], "en", "s", 1)]
    docs = spark.createDataFrame(rows + more, DOCS).withColumn("score", F.lit("x"))
    lab = spark.createDataFrame([*labels, (3, 1, None), (None, 1, 1), (9999, 0, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.predictions(docs, lab).collect()
    assert len(got) == len(rows) + len(more)
    by = {r.doc_id: r for r in got}
    truth = dict((i, t) for i, _, t in labels)
    held = [i for i in truth if rem(i) == 2]
    assert all(by[i].held_out == (rem(i) == 2) for i in truth) and len(held) > 200
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    hit = sum(by[i].predicted == truth[i] for i in held) / len(held)
    assert hit > 0.97
    assert by[2000].predicted == 0 and by[2001].score == by[2000].score and by[2002].predicted == 1 and not by[None].held_out


def test_toxicity_learns_nothing_from_held_out_rows(spark, corpus):
    rows, labels = corpus
    docs = spark.createDataFrame(rows, DOCS)
    a = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    turned = [(i, q, 1 - t if rem(i) == 2 else t) for i, q, t in labels]
    b = toxicity.train(docs, spark.createDataFrame(turned, "doc_id long, quality int, toxic int"))
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_toxicity_without_labels(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = toxicity.predictions(make_docs(["a", None]), none).collect()
    assert [r.predicted for r in got] == [0, 0] and all(r.score < 1e-6 for r in got)
    assert toxicity.predictions(make_docs(["a"]).limit(0), none).count() == 0


def plain_grams(text):
    """The distinct feature numbers, by the definition, one n-gram at a time."""
    out, t = set(), [ord(c) for c in (text or "").lower()]
    for n in toxicity.SIZES:
        for i in range(len(t) - n + 1):
            h = t[i]
            for c in t[i + 1:i + n]:
                h = (h * 0x01000193 + c) % 2 ** 32
            out.add(((h + n) * 0x9E3779B1) % 2 ** 32 >> 32 - toxicity.BITS)
    return out


def test_toxicity_equals_plain_loops(spark, monkeypatch):
    """Choice of features, ratios, regression and scores with dicts and loops over rows; long texts take no place."""
    monkeypatch.setattr(toxicity, "MAX_TRAIN_CHARS", 60)
    monkeypatch.setattr(toxicity, "STEPS", 20)
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["calm", "words", "here", "vile" if i % 3 == 0 else "kind"], k=6)), "en", "s", 1) for i in range(140)]
    rows += [(i, "vile " * 40, "en", "s", 1) for i in range(140, 200)] + [(1, "zzz", "en", "s", 1), (200, None, "en", "s", 1)]
    labels = [(i, 1, int(i % 3 == 0)) for i in range(201)]
    docs = spark.createDataFrame(rows, DOCS)
    lab = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    h = {r.doc_id: r.h for r in lab.select("doc_id", F.xxhash64("doc_id").alias("h")).collect()}
    th = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).collect()}
    per = 30
    text = {}
    for i, t, *_ in rows:
        if t is not None and len(t) <= 60 and rem(i) != 2:
            text[i] = min(text.get(i, t), t, key=lambda x: (th[x], x))
    picked = sorted(sorted((i for i in text if i % 3 == 0), key=lambda i: (h[i], i))[:per]
                    + sorted((i for i in text if i % 3), key=lambda i: (h[i], i))[:per])
    y = [int(i % 3 == 0) for i in picked]
    n1, n0 = sum(y), len(y) - sum(y)
    sets = [plain_grams(text[i]) for i in picked]
    p, q = {}, {}
    for s, t in zip(sets, y):
        for f in s:
            d = p if t else q
            d[f] = d.get(f, 0) + 1
    r = {}
    for f in p.keys() | q.keys():
        a, b = p.get(f, 0), q.get(f, 0)
        mean = (a + b) / len(y)
        z = (a / n1 - b / n0) / (max(mean * (1 - mean), 1e-9) * (1 / n1 + 1 / n0)) ** .5
        if abs(z) >= toxicity.MIN_Z and a + b >= toxicity.MIN_TEXTS:
            r[f] = math.log((1 + a) / (1 + n1)) - math.log((1 + b) / (1 + n0))
    assert len(r) > 5
    par, first, second = dict.fromkeys([*r, "bias"], 0.0), dict.fromkeys([*r, "bias"], 0.0), dict.fromkeys([*r, "bias"], 0.0)
    for step in range(1, toxicity.STEPS + 1):
        grad = {f: toxicity.PENALTY * par[f] / len(y) for f in r} | {"bias": 0.0}
        for s, t in zip(sets, y):
            e = 1 / (1 + math.exp(-par["bias"] - sum(r[f] * par[f] for f in s if f in r))) - t
            grad["bias"] += e / len(y)
            for f in s:
                if f in r:
                    grad[f] += e * r[f] / len(y)
        for f, g in grad.items():
            first[f] = 0.9 * first[f] + 0.1 * g
            second[f] = 0.999 * second[f] + 0.001 * g * g
            par[f] -= 0.03 * (first[f] / (1 - 0.9 ** step)) / ((second[f] / (1 - 0.999 ** step)) ** .5 + 1e-8)
    known = [t for i, _, t in labels if rem(i) != 2]
    share = sum(known) / len(known)
    bias = par["bias"] + math.log(share / (1 - share)) - math.log(n1 / n0)
    model = toxicity.train(docs, lab, per_class=per)
    assert set(np.flatnonzero(model.weights)) == set(r)
    got = toxicity.score(docs, model).collect()
    assert len(got) == len(rows)
    for x in got:
        s = bias + sum(r[f] * par[f] for f in plain_grams(x.text) if f in r)
        assert x.toxicity == pytest.approx(1 / (1 + math.exp(-s)), abs=1e-5)


def test_language_equals_plain_loops():
    """Windows, filters, pooling, softmax and the mean over a text, one number at a time."""
    rng = np.random.default_rng(2)
    texts = ["le chat et le chien " * 30, "the cat and the dog " * 4, "ß"]
    fitted = language.fit([language.some_windows(t) for t in texts], ["fr", "en", "de"], steps=3)
    net = language.Network(fitted.languages, fitted.embed, fitted.kernel, rng.normal(0, .1, fitted.bias.shape).astype(np.float32),
                           fitted.dense, fitted.dense_bias)
    embed, kernel = net.embed.astype(float).tolist(), net.kernel.astype(float).tolist()
    widths = [w for w in language.WIDTHS for _ in range(language.FILTERS)]
    for text, (lang, score) in zip(texts, language.predict(net, texts)):
        data = text.encode()
        total, mass = [0.0] * len(net.languages), 0
        for a in range(0, max(1, len(data)), language.STRIDE):
            x = list(data[a:a + language.WINDOW])
            x += [0] * (language.WINDOW - len(x))
            pooled = []
            for f, w in enumerate(widths):
                best = max(sum(embed[x[i + o]][e] * kernel[o * language.EMBED + e][f] for o in range(w) for e in range(language.EMBED))
                           for i in range(language.STRIDE))
                pooled.append(max(0.0, best + float(net.bias[f])))
            z = [sum(v * float(net.dense[f][k]) for f, v in enumerate(pooled)) + float(net.dense_bias[k]) for k in range(len(total))]
            s = sum(math.exp(v) for v in z)
            n = max(1, min(language.STRIDE, len(data) - a))
            total = [t + n * math.exp(v) / s for t, v in zip(total, z)]
            mass += n
        best = max(range(len(total)), key=lambda k: total[k])
        assert lang == net.languages[best] and score == pytest.approx(total[best] / mass, abs=1e-5)


def test_ngrams_are_all_substrings():
    t = "Ärger am"
    grams = toxicity.ngrams(t)
    assert [len(g) for g in grams] == [6, 5, 4, 3]
    assert toxicity.ngrams("xx" + t.upper())[0][2:].tolist() == grams[0].tolist()
    assert toxicity.ngrams("") == [] and toxicity.ngrams("ab") == []


def test_language_held_out(spark, corpus):
    rows, _ = corpus
    more = [(2000, "", "en", None, 0), (2001, None, "en", None, None), (2002, "123 !?", "en", "s", 1),
            (2003, prose(random.Random(3), "de", 9000), None, "s", 1), (None, rows[0][1], rows[0][2], "s", 1)]
    docs = spark.createDataFrame(rows + more, DOCS).withColumn("lang_pred", F.lit("x"))
    got = language.predictions(docs).collect()
    assert len(got) == len(rows) + len(more)
    by = {r.doc_id: r for r in got}
    held = [r for r in rows if rem(r[0]) == 2]
    assert sum(by[r[0]].lang_pred == r[2] for r in held) / len(held) > 0.95
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (2000, 2001, 2002))
    assert by[2003].lang_pred == "de" and all(0 <= r.score <= 1 for r in got)
    turned = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "xx").otherwise(F.col("lang")))
    assert {r.doc_id: r.lang_pred for r in language.predictions(turned).collect()} == {d: r.lang_pred for d, r in by.items()}


def test_language_few_labels(spark, make_docs):
    got = language.predictions(make_docs(["some text", None, "more"], lang=None)).collect()
    assert {r.lang_pred for r in got} == {"und"}
    one = {r.doc_id: (r.lang_pred, r.score) for r in language.predictions(make_docs(["some text", "", "more", "x", "y"])).collect()}
    assert one[0] == ("en", 1.0) and one[1] == ("und", 0.0)
    assert language.predictions(make_docs(["x"]).limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 252, 253, 254, 255, 256, 257, 600, 5000])
def test_windows_cover_every_byte(n):
    data = bytes(1 + i % 250 for i in range(n))
    w, adds = language.windows(data)
    assert adds.sum() == max(1, n)
    seen = {bytes(x[i:i + 4]) for x in w for i in range(language.STRIDE)}
    assert {data[i:i + 4] for i in range(n - 3)} <= seen


def test_language_of_long_texts_is_learned(spark, make_docs):
    docs = make_docs([(i, "the cat and the dog ") for i in range(9)]).unionByName(
        make_docs([(i, "żółw łąka święto źdźbło " * 1000) for i in range(9, 18)], lang="pl"))
    assert {r.doc_id: r.lang_pred for r in language.predictions(docs).collect()} == {
        i: "en" if i < 9 else "pl" for i in range(18)}
