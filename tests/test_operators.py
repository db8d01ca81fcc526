"""Operator checks: validation cases, runs, listings, linear fits, invariants, plans."""

import os
import tempfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF001
from songemo.config import SONG_FEATURE_COLUMNS
from songemo.modeling import linear
from songemo.operators import analyst, quality, semantic
from songemo.plans.catalog import queries
from songemo.sources import bindings as B
from songemo.sources import files


def _features(spark, n, tempo_missing=0, bpm=None, dup=False, drop=None, extra=False):
    rows = []
    for i in range(n):
        t = None if i < tempo_missing else (bpm[i % len(bpm)] if bpm else 120.0)
        rows.append(tuple([str(i)] + [1.0] * 10 + [t, "unknown", "C major", "C", "major", "natural", True]))
    if dup:
        rows.append(rows[0])
    schema = ", ".join(f"{c} {'string' if c in ('song_id', 'genre', 'key', 'key_note', 'key_mode', 'key_signature') else 'boolean' if c == 'is_major' else 'double'}"
                       for c in SONG_FEATURE_COLUMNS)
    df = spark.createDataFrame(rows, schema)
    if drop:
        df = df.drop(drop)
    if extra:
        df = df.withColumn("extra_col", F.lit(1))
    return df


def _levels(rep):
    return {r.check: r.level for r in rep.collect()}


def test_validation_cases(spark):
    ok = _levels(quality.validate_song_features(spark, _features(spark, 10, tempo_missing=1)))
    assert ok["audio_coverage"] == "ok" and ok["duplicate_keys"] == "ok"
    low = _levels(quality.validate_song_features(spark, _features(spark, 100, tempo_missing=11)))
    assert low["audio_coverage"] == "error"          # 89 % tempo coverage
    edge = _levels(quality.validate_song_features(spark, _features(spark, 100, tempo_missing=10)))
    assert edge["audio_coverage"] == "ok"            # exactly 90 %
    assert _levels(quality.validate_song_features(spark, _features(spark, 3, dup=True)))["duplicate_keys"] == "error"
    miss = _levels(quality.validate_song_features(spark, _features(spark, 3, drop="zcr")))
    assert miss["missing_columns"] == "error"
    extra = _levels(quality.validate_song_features(spark, _features(spark, 3, extra=True)))
    assert extra["unexpected_columns"] == "info"
    rng = {r.check: r for r in quality.validate_song_features(spark, _features(spark, 3, bpm=[20.0, 300.0, 19.9])).collect()}
    assert rng["tempo_out_of_range"].value == 1.0
    pred = spark.createDataFrame([("1", 5.0, None), ("2", float("nan"), 5.0)], "song_id string, predicted_arousal double, predicted_valence double")
    p = _levels(quality.validate_predictions(spark, pred, _features(spark, 3)))
    assert p["nan:predicted_arousal"] == "error" and p["nan:predicted_valence"] == "error"
    assert p["row_count_match"] == "error"
    summ = {r.table: r.passed for r in quality.summary(quality.validate_predictions(spark, pred)).collect()}
    assert summ == {"emotion_predictions": False, "overall": False}


def test_latest_run_and_listing(spark):
    runs = spark.createDataFrame([("20250101_000000",), ("20250102_000000",), ("latest",), ("2025_01",)], "run_id string")
    assert files.latest_runs(runs).first().latest_run == "20250102_000000"
    none = spark.createDataFrame([("latest",)], "run_id string")
    assert files.latest_runs(none, base="models").first().latest_run == "models"
    d = tempfile.mkdtemp(prefix="songemo-audio-")
    for name in ("b.mp3", "a.wav", "a.flac", "c.txt", "x.y.mp3"):
        with open(os.path.join(d, name), "wb") as f:
            f.write(b"\0" * 10)
    got = files.audio_files(spark, d).collect()
    assert [r.song_id for r in got] == ["a", "a", "b", "x.y"]
    assert [r.song_id for r in files.audio_files(spark, d, limit=2).collect()] == ["a", "a"]


def test_read_table_null_tokens(spark):
    d = tempfile.mkdtemp(prefix="songemo-csv-")
    p = os.path.join(d, "t.csv")
    with open(p, "w") as f:
        f.write("song_id,genre,x\n007,NA,1.5\n8,rock,\n")
    df = files.read_table(spark, p, schema="song_id string, genre string, x double")
    rows = {r.song_id: (r.genre, r.x) for r in df.collect()}
    assert rows == {"007": (None, 1.5), "8": ("rock", None)}


def test_ridge_matches_numpy(spark):
    rng = np.random.default_rng(0)
    n, p = 500, 4
    X = rng.normal(size=(n, p)) * [1, 10, 100, 0.1] + [5, -3, 1000, 0]
    y = X @ [0.5, -0.2, 0.01, 3.0] + rng.normal(size=n)
    df = spark.createDataFrame([tuple(map(float, r)) + (float(t),) for r, t in zip(X, y)],
                               ", ".join(f"x{i} double" for i in range(p)) + ", y double")
    feats = [f"x{i}" for i in range(p)]
    shift = linear.column_means(df, feats)
    m = linear.gram_moments(df, feats, ["y"], None, shift, np.zeros(1))[None]
    for alpha in (0.001, 1.0, 100.0):
        v, c = linear.fit_ridge(m, 0, alpha)
        mu, sd = X.mean(0), X.std(0)
        Z = (X - mu) / sd
        w = np.linalg.solve(Z.T @ Z + alpha * np.eye(p), Z.T @ (y - y.mean()))
        np.testing.assert_allclose(v, w / sd, rtol=1e-8)
        assert c - shift @ v == pytest.approx(y.mean() - mu @ (w / sd), rel=1e-8)
        sse = linear.sse_of(m, 0, v, c)
        pred = (X - shift) @ v + c
        assert sse == pytest.approx(float(((y - pred) ** 2).sum()), rel=1e-8)
    # elastic net: l1 = 0 equals ridge with alpha * n (sklearn's scaling)
    v1, _ = linear.fit_elasticnet(m, 0, 0.2, 0.0, max_iter=5000, tol=1e-12)
    v2, _ = linear.fit_ridge(m, 0, 0.2 * n)
    np.testing.assert_allclose(v1, v2, rtol=1e-6)
    v3, _ = linear.fit_elasticnet(m, 0, 50.0, 1.0)
    assert np.allclose(v3, 0.0)   # large L1 zeroes every coefficient


def test_partition_independence(spark):
    p = B.predictions(spark, SF001)
    a = sorted(semantic.tag_counts(p.repartition(1)).collect())
    b = sorted(semantic.tag_counts(p.repartition(16)).collect())
    assert a == b
    t1 = [r.song_id for r in analyst.answer(p.repartition(1), "calm", k=7).collect()]
    t2 = [r.song_id for r in analyst.answer(p.repartition(16), "calm", k=7).collect()]
    assert t1 == t2


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans(spark):
    qs = queries()
    topk = _plan(qs["analyst_topk"](spark, SF001))
    assert "TakeOrderedAndProject" in topk
    batch = qs["analyst_batch"](spark, SF001)
    batch.collect()
    plan = batch._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "BroadcastExchange" in plan
    for name in ("tags", "song_features_rich", "enrich_left_join", "key_estimation", "map_points",
                 "labels_keep_first", "validate_features", "similar_to_calm_focus", "tempo_from_onsets"):
        s = _plan(qs[name](spark, SF001))
        assert "BatchEvalPython" not in s and "ArrowEvalPython" not in s, name
        assert "CartesianProduct" not in s and "BroadcastNestedLoopJoin" not in s, name


def test_large_values_beside_small_spread(spark):
    """Targets near 1e8 that differ by hundredths, features near 1e6: fits, folds and metrics keep their digits."""
    rng = np.random.default_rng(8)
    n = 2000
    x = rng.normal(size=(n, 2)) * [1.0, 1e-3] + [0.0, 1e6]
    y = 1e8 + 0.03 * x[:, 0] + 10.0 * (x[:, 1] - 1e6) + 1e-3 * rng.normal(size=n)
    f = rng.integers(0, 3, n)
    df = spark.createDataFrame([(float(a), float(b), float(t), int(k)) for (a, b), t, k in zip(x, y, f)], "a double, b double, y double, f int")
    means = linear.column_means(df, ["a", "b", "y"])
    folds = linear.gram_moments(df, ["a", "b"], ["y"], "f", means[:2], means[2:])
    for held in folds:
        m = linear.merged([folds[k] for k in sorted(folds) if k != held])
        v, c = linear.fit_ridge(m, 0, 1e-3)
        got = linear.metrics_of(folds[held], 0, v, c)
        tr, te = f != held, f == held
        z = x - x[tr].mean(0)
        w = np.linalg.lstsq(z[tr], y[tr] - y[tr].mean(), rcond=None)[0]
        pred = z[te] @ w + y[tr].mean()
        assert got["rmse"] == pytest.approx(float(np.sqrt(((y[te] - pred) ** 2).mean())), rel=1e-3)
        assert got["r2"] > 0.99 and got["pearson_r"] == pytest.approx(np.corrcoef(y[te], pred)[0, 1], rel=1e-6)


def test_elastic_net_path_and_gap():
    """Warm starts end where cold ones do, at the optimum."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 5)) @ rng.normal(size=(5, 5))
    y = x @ [1.0, 0, -2, 0, 0.5] + rng.normal(size=300)
    x, yc = x - x.mean(0), y - y.mean()
    m = linear.Moments(300.0, np.zeros(5), np.zeros(1), x.T @ x, (x.T @ yc)[:, None], np.array([yc @ yc]))
    settings = [{"alpha": a, "l1_ratio": r, "max_iter": 5000} for a in (0.5, 0.01, 0.1) for r in (0.1, 0.9)]
    for s, (v, _) in zip(settings, linear._fits("elasticnet", m, 0, settings)):
        cold, _ = linear.fit_elasticnet(m, 0, s["alpha"], s["l1_ratio"], 50000, tol=1e-12)
        sd = x.std(0)

        def cost(v):
            return (((yc - x @ v) ** 2).mean() / 2 + s["alpha"] * s["l1_ratio"] * np.abs(v * sd).sum()
                    + s["alpha"] * (1 - s["l1_ratio"]) / 2 * ((v * sd) ** 2).sum())
        assert cost(v) - cost(cold) <= 1e-4 * (yc @ yc) / 300
        np.testing.assert_allclose(v, cold, atol=0.05)


def test_nan_chroma_falls_to_next_method(spark):
    from songemo.operators import audio
    nan = float("nan")
    good = [1.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, 1.0, 0.0, 0.0, 0.0, 0.0]
    rows = [("a", "stft", 0, [nan] * 12), ("a", "cqt", 0, good), ("b", "stft", 0, [nan] * 11 + [2.0]), ("c", "stft", 0, [nan] * 12)]
    df = spark.createDataFrame(rows, "song_id string, method string, frame_idx long, chroma array<double>")
    got = {r.song_id: r.method for r in audio.first_usable_chroma(audio.chroma_sums(df)).collect()}
    assert got == {"a": "cqt", "b": "stft"}
    assert {r.song_id: r.key for r in audio.song_keys(df).collect()}["a"] != "unknown"


def test_key_of_white_space_is_unknown(spark):
    from songemo.operators import quality
    df = spark.createDataFrame([("1", 100.0, "\t"), ("2", 100.0, " \n"), ("3", 100.0, "C major"), ("4", None, "Unknown"), ("5", 1.0, None)],
                               "song_id string, tempo_bpm double, key string")
    assert quality.coverage(df).first().n_key_known == 1


def test_similar_songs_with_shared_points(spark):
    """Many songs on few points: answers equal brute force, with ties by id; the cell join sees points, not songs."""
    import random
    from songemo.operators import similarity
    rng = random.Random(4)
    pts = [(rng.randint(0, 6) / 2, rng.randint(0, 6) / 2) for _ in range(12)]
    rows = [(f"s{i:03d}", *rng.choice(pts)) for i in range(300)] + [("far", 40.0, 1.0), ("nan", float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "song_id string, predicted_arousal double, predicted_valence double")
    ok = rows[:-1]
    def brute(s, k):
        _, a, v = next(r for r in ok if r[0] == s)
        return [x for _, x in sorted(((r[1] - a) ** 2 + (r[2] - v) ** 2, r[0]) for r in ok if r[0] != s)[:k]]
    seeds = ["s000", "s007", "far", "s123", "nan", "none"]
    table = spark.createDataFrame([(s,) for s in seeds], "song_id string")
    for k in (1, 5, 40, 400):
        for out in (similarity.similar_songs(df, seeds, k), similarity.similar_songs_grid(df, table, k)):
            got = {}
            for r in out.collect():
                got.setdefault(r.seed_id, []).append((r["rank"], r.song_id))
            assert {s: [x for _, x in sorted(v)] for s, v in got.items()} == {s: brute(s, k) for s in seeds[:4]}


def test_model_queries(spark):
    """cv_scores has every setting of the full search; the tree queries' scores agree with each other."""
    qs = queries()
    got = {(r.model, r.target): r["count"] for r in qs["cv_scores"](spark, SF001).groupBy("model", "target").count().collect()}
    assert got == {(m, t): n for m, n in (("ridge", 40), ("elasticnet", 64)) for t in ("arousal", "valence")}
    fitted = {r.target: r for r in qs["gbt_fit"](spark, SF001).collect()}
    assert set(fitted) == {"arousal", "valence"} and all(r.rmse > 0 and r.cv_rmse_mean > 0 and r.best_params for r in fitted.values())
    pred = qs["ml_predict"](spark, SF001)
    assert pred.columns == ["song_id", "predicted_arousal", "predicted_valence"]
    assert pred.filter("predicted_arousal is null or predicted_valence is null").count() == 0 and pred.count() > 1000


def test_default_search_is_full(spark, monkeypatch):
    """train_all's defaults search 64 settings of both tree kinds and of the linear ones."""
    from songemo.modeling import train, trees
    from songemo.plans import catalog
    asked = []
    fit = trees.fit_tree_models
    monkeypatch.setattr(trees, "fit_tree_models", lambda q, kind, **more: asked.append((kind, more["tune"], more["n_iter"])) or fit(
        q, kind, space={k: v[:1] for k, v in trees.SPACES[kind][0].items()} | {"n_estimators": (2,), "max_depth": (2, 3)}, **more))
    res, prep, _ = train.train_all(catalog.modeling_of(spark, SF001))
    prep.release()
    assert asked == [("random_forest", True, 64), ("boosted_trees", True, 64)]
    assert {m[0] for m in res.metrics} == {"ridge", "elasticnet", "random_forest", "boosted_trees"} and len(res.metrics) == 8


def test_model_comparison_searches_in_full(spark, monkeypatch):
    """The query asks for 64 settings of every kind, trees included, and reports all kinds and targets."""
    from songemo.modeling import linear, train, trees
    from songemo.plans import catalog
    asked = []
    fit, search = trees.fit_tree_models, linear.search_linear
    monkeypatch.setattr(catalog, "modeling_of", lambda spark, d: spark.range(400).select(
        F.col("id").cast("string").alias("song_id"), *[((F.col("id") * k) % 31).cast("double").alias(c) for k, c in enumerate(train.MODEL_FEATURES, 2)],
        (F.col("id") % 9).cast("double").alias("arousal"), (F.col("id") % 7).cast("double").alias("valence")))
    monkeypatch.setattr(linear, "search_linear", lambda kind, *a, **more: asked.append((kind, more["tune"], more["n_iter"])) or search(kind, *a, **more))
    monkeypatch.setattr(trees, "fit_tree_models", lambda q, kind, **more: asked.append((kind, more["tune"], more["n_iter"])) or fit(
        q, kind, space={k: v[:1] for k, v in trees.SPACES[kind][0].items()} | {"n_estimators": (2,), "max_depth": (2, 3)}, **more))
    rows = queries()["model_comparison"](spark, "").collect()
    assert set(asked) == {(k, True, 64) for k in ("random_forest", "boosted_trees", "ridge", "elasticnet")}
    assert {(r.model, r.target) for r in rows} == {(k, t) for k, _, _ in asked for t in train.TARGETS}
