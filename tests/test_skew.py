"""The skew-safe operators give the same answers as their naive definitions."""

import numpy as np
import pandas as pd

from songemo.functions.tags import tags
from songemo.operators import analyst, ordered
from pyspark.sql import functions as F


def test_position_and_lag_with_a_hot_group(spark):
    rng = np.random.default_rng(11)
    rows = [("hot", int(t), i) for i, t in enumerate(rng.integers(0, 500, size=3000))]   # repeated ts values
    rows += [(f"g{i % 7}", int(t), 10_000 + i) for i, t in enumerate(rng.integers(0, 50, size=300))]
    df = spark.createDataFrame(rows, "song string, ts bigint, id bigint")
    got = ordered.position(df, "song", ["ts", "id"], n_slices=16).select("song", "ts", "id", "_pos", "_n").toPandas()
    ref = pd.DataFrame(rows, columns=["song", "ts", "id"]).sort_values(["song", "ts", "id"])
    ref["_pos"] = ref.groupby("song").cumcount()
    ref["_n"] = ref.groupby("song")["id"].transform("size")
    m = got.merge(ref, on=["song", "ts", "id"], suffixes=("", "_ref"))
    assert len(m) == len(rows)
    assert (m["_pos"] == m["_pos_ref"]).all() and (m["_n"] == m["_n_ref"]).all()
    lagged = ordered.lag(df, "song", ["ts", "id"], ["ts"], n_slices=16).select("song", "id", "prev_ts").toPandas()
    ref["prev_ts"] = ref.groupby("song")["ts"].shift(1)
    m2 = lagged.merge(ref[["song", "id", "prev_ts"]], on=["song", "id"], suffixes=("", "_ref"))
    assert ((m2["prev_ts"] == m2["prev_ts_ref"]) | (m2["prev_ts"].isna() & m2["prev_ts_ref"].isna())).all()


def _brute(preds, question_tags, k):
    """Python ranking: per song, count (row, requested tag) matches; top k by (count desc, id)."""
    counts = {}
    for sid, tl in preds:
        n = sum(1 for t in question_tags if t in tl)
        if n:
            counts[sid] = counts.get(sid, 0) + n
    return sorted(counts.items(), key=lambda kv: (-kv[1], kv[0]))[:k]


def test_batch_answers_with_duplicate_song_rows(spark):
    rng = np.random.default_rng(5)
    pts = [(str(i), float(1 + 0.25 * rng.integers(0, 33)), float(1 + 0.5 * rng.integers(0, 17))) for i in range(400)]
    pts += [("7", 3.0, 7.0)] * 30 + [("8", 7.0, 2.0)] * 5      # a hot duplicated id and a warm one
    pred = spark.createDataFrame(pts, "song_id string, predicted_arousal double, predicted_valence double")
    qs = spark.createDataFrame([(1, "calm"), (2, "upbeat"), (3, "dark and sad"), (4, "hello")],
                               "question_id bigint, text string")
    k = 6
    got = {}
    for r in analyst.answer_batch(qs, pred, k=k).collect():
        if r.song_id is not None:
            got.setdefault(r.question_id, []).append((r.rank, r.song_id, r.match_count))
    tl = [(r.song_id, r.t) for r in pred.select("song_id", tags(F.col("predicted_arousal"),
                                                                F.col("predicted_valence")).alias("t")).collect()]
    intents = {1: ["Calm Focus"], 2: ["High Energy", "Positive"], 3: ["Dramatic"], 4: ["Neutral"]}
    for q, req in intents.items():
        want = [(i + 1, s, n) for i, (s, n) in enumerate(_brute(tl, req, k))]
        assert sorted(got.get(q, [])) == want, q


def test_batch_answers_from_replies_with_repeated_tags(spark):
    rng = np.random.default_rng(9)
    pts = [(str(i), float(1 + 0.25 * rng.integers(0, 33)), float(1 + 0.5 * rng.integers(0, 17))) for i in range(300)]
    pred = spark.createDataFrame(pts, "song_id string, predicted_arousal double, predicted_valence double")
    qs = spark.createDataFrame([(1, "x"), (2, "y"), (3, "calm")], "question_id bigint, text string")
    rp = spark.createDataFrame([(1, '{"tags": ["Positive", "Positive", "High Energy"], "explanation": "e"}'),
                                (2, '{"tags": "Negative, Low Energy", "explanation": ""}'),
                                (3, "not json")], "question_id bigint, content string")
    k = 5
    got = {}
    for r in analyst.answer_batch(qs, pred, k=k, replies=rp).collect():
        got.setdefault(r.question_id, []).append((r.rank, r.song_id, r.match_count, r.explanation))
    tl = [(r.song_id, r.t) for r in pred.select("song_id", tags(F.col("predicted_arousal"),
                                                                F.col("predicted_valence")).alias("t")).collect()]
    intents = {1: (["Positive", "Positive", "High Energy"], "e"),
               2: (["Negative", "Low Energy"], "Songs matching your request."),
               3: (["Calm Focus"], "Songs matching: Calm Focus (rule-based).")}
    for q, (req, expl) in intents.items():
        want = [(i + 1, s, n, expl) for i, (s, n) in enumerate(_brute(tl, req, k))]
        assert sorted(got[q]) == want, q


def test_middle_segment_dense_fast_path_matches_general(spark):
    from songemo.operators import audio
    rows = [("long", i) for i in range(40)] + [("short", i) for i in range(6)] + [("odd", i) for i in range(13)]
    df = spark.createDataFrame(rows, "song_id string, frame_idx bigint")
    a = sorted(audio.middle_segment(df, frame_rate_hz=1.0, min_seconds=10.0).collect())
    b = sorted(audio.middle_segment(df, frame_rate_hz=1.0, min_seconds=10.0, dense_index=True).collect())
    assert a == b
    kept = {}
    for r in a:
        kept.setdefault(r.song_id, []).append(r.frame_idx)
    assert kept["long"] == list(range(10, 30)) and kept["short"] == list(range(6)) and kept["odd"] == list(range(3, 9))


def test_similar_songs_grid_matches_brute_force(spark):
    from songemo.operators.similarity import similar_songs_grid
    rng = np.random.default_rng(2)
    pts = [(f"s{i}", float(a), float(v)) for i, (a, v) in enumerate(rng.uniform(1, 9, size=(400, 2)))]
    pts += [(f"h{i}", 5.0, 5.0) for i in range(150)]            # a hot point: many identical coordinates
    pts += [("far", 100.0, 100.0), ("nan", float("nan"), 3.0)]
    pred = spark.createDataFrame(pts, "song_id string, predicted_arousal double, predicted_valence double")
    seeds = ["s1", "s2", "h3", "far", "nan", "missing"] + [f"s{i}" for i in range(10, 60)]
    k = 7
    got = {}
    for r in similar_songs_grid(pred, spark.createDataFrame([(s,) for s in seeds], "song_id string"), k).collect():
        got.setdefault(r.seed_id, []).append((r.rank, r.song_id, round(r.distance, 12)))
    ok = [(s, a, v) for s, a, v in pts if np.isfinite(a) and np.isfinite(v)]
    pos = {s: (a, v) for s, a, v in ok}
    for sd in seeds:
        if sd not in pos:
            assert sd not in got
            continue
        a0, v0 = pos[sd]
        d = sorted(((a - a0) ** 2 + (v - v0) ** 2, s) for s, a, v in ok if s != sd)[:k]
        assert sorted(got[sd]) == [(i + 1, s, round(x, 12)) for i, (x, s) in enumerate(d)], sd


def test_similar_songs_grid_with_outliers_and_clusters(spark):
    """Far-off points and a dense cluster: answers equal brute force, and cells stay sparse."""
    import numpy as np
    from songemo.operators import similarity
    rng = np.random.default_rng(6)
    xy = np.concatenate([rng.normal(size=(400, 2)), rng.normal(size=(400, 2)) * 1e-4 + 3, [[1e3, 0], [1e3, 1], [-5e5, 7e5]]])
    rows = [(f"s{i:04d}", float(a), float(v)) for i, (a, v) in enumerate(xy)]
    df = spark.createDataFrame(rows, "song_id string, predicted_arousal double, predicted_valence double")
    got = {}
    for r in similarity.similar_songs_grid(df, df.select("song_id"), 4).collect():
        got.setdefault(r.seed_id, []).append((r["rank"], r.song_id))
    for i, (s, a, v) in enumerate(rows):
        d = (xy[:, 0] - a) ** 2 + (xy[:, 1] - v) ** 2
        want = [f"s{j:04d}" for j in sorted(range(len(rows)), key=lambda j: (d[j], j)) if j != i][:4]
        assert [x for _, x in sorted(got[s])] == want, s
    pts = df.selectExpr("predicted_arousal a", "predicted_valence v")
    ext = pts.agg(*[f(c).alias(n) for c, f, n in (("a", F.min, "a0"), ("a", F.max, "a1"), ("v", F.min, "v0"), ("v", F.max, "v1"))],
                  F.percentile_approx("a", [0.01, 0.99]).alias("qa"), F.percentile_approx("v", [0.01, 0.99]).alias("qv"),
                  F.count(F.lit(1)).alias("n")).first()
    h = similarity._cell_size(pts, ext, 4)
    cells = pts.groupBy(F.floor(F.col("a") / h), F.floor(F.col("v") / h)).count()
    assert cells.agg(F.sum(F.col("count") * F.col("count"))).first()[0] <= 8 * 5 * len(rows)
