"""End-to-end job on small file fixtures: enrich, labels, train, predict, validate, manifest."""

import os
import tempfile

from pyspark.sql import functions as F

from songemo.modeling import train
from songemo.plans import flows
from songemo.sinks import writers

C = "pcm_fftMag_spectralCentroid_sma_amean"
E = "pcm_RMSenergy_sma_amean"
Z = "pcm_zcr_sma_amean"


def test_run_all_end_to_end(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="songemo-flow-")
    fdir = os.path.join(base, "features")
    os.makedirs(fdir)
    n = 60
    for s in range(n):
        rows = [f"{i};{100 + 3 * s + i};{0.1 * (s % 7) + 0.01 * i};{(s * i) % 5 / 10}" for i in range(4)]
        with open(os.path.join(fdir, f"{s}.csv"), "w") as f:
            f.write(f"frameTime;{C};{E};{Z}\n" + "\n".join(rows) + "\n")
    ann = os.path.join(base, "ann", "annotations averaged per song", "song_level")
    os.makedirs(ann)
    with open(os.path.join(ann, "static_annotations_averaged_songs_1_2000.csv"), "w") as f:
        f.write("song_id;arousal_mean;valence_mean\n")
        f.write("\n".join(f"{s};{1 + (s * 7) % 9};{1 + (s * 5) % 9}" for s in range(n)) + "\n")
    chroma = spark.createDataFrame(
        [(str(s), m, i, [float((s + k + i) % 4) for k in range(12)]) for s in range(n) for m in ("stft", "cqt")
         for i in range(3)], "song_id string, method string, frame_idx bigint, chroma array<double>")
    chroma_path = os.path.join(base, "chroma")
    chroma.write.parquet(chroma_path)
    onsets = spark.createDataFrame([(str(s), i, i * (0.4 + 0.01 * s)) for s in range(n) for i in range(6)],
                                   "song_id string, onset_id bigint, sec double").select(
        "song_id", "onset_id", F.timestamp_seconds(F.col("sec")).alias("ts"))
    onsets_path = os.path.join(base, "onsets")
    onsets.write.parquet(onsets_path)
    paths = flows.PipelinePaths(fdir, os.path.join(base, "ann"), os.path.join(base, "out"), chroma_path, onsets_path)

    report = flows.run_all(spark, paths, fast=True, tune=False, include_boosted=False)
    sf = spark.read.parquet(paths.table("song_features"))
    assert sf.count() == n and "key_note" in sf.columns
    assert report.filter((F.col("table") == "song_features") & (F.col("check") == "audio_coverage")).first().level == "ok"
    pred = spark.read.parquet(paths.table("emotion_predictions"))
    assert pred.count() == n and pred.filter(F.col("predicted_arousal").isNull()).count() == 0
    man = flows.manifest_json(spark, paths.out_dir)
    assert man[-1]["status"] == "ok" and [s["name"] for s in man[-1]["steps"]][:2] == ["enrich", "labels_and_join"]

    # second run reuses both finished table steps
    flows.run_all(spark, paths, fast=True, tune=False, include_boosted=False)
    man = sorted(flows.manifest_json(spark, paths.out_dir), key=lambda m: m["started_utc"])
    assert [s["status"] for s in man[-1]["steps"]][:4] == ["skipped"] * 4
    assert spark.read.text(paths.table("metrics_report")).filter("value = '--- ridge ---'").count() == 1

    # a saved run predicts the same from its files alone; an edit of equal length is noticed
    models, medians, rid = train.load_models(spark, paths.table("models"))
    assert rid and set(models) == {(k, t) for k in ("random_forest", "ridge", "elasticnet") for t in ("arousal", "valence")}
    again = train.predict(sf, models, medians, kind="ridge")
    assert sorted(again.collect()) == sorted(spark.read.parquet(paths.table("emotion_predictions")).collect())
    file = os.path.join(ann, "static_annotations_averaged_songs_1_2000.csv")
    before = flows._fingerprint(spark, [paths.annotations_dir])
    text = open(file).read()
    with open(file, "w") as f:
        f.write(text.replace("0;1;1", "0;2;1"))
    os.utime(file, (1, 1))
    assert flows._fingerprint(spark, [paths.annotations_dir]) != before

    metrics = spark.read.parquet(paths.table("metrics"))
    lines = [r.line for r in writers.metrics_report(metrics).collect()]
    assert lines[0] == "--- random_forest ---"
    assert lines[1] == "target,rmse,r2,pearson_r,n_train,n_val,cv_rmse_mean,model_path"

    from songemo import cli
    assert cli.main(["validate", "--out", paths.out_dir]) == 0   # all checks pass on this output

    # the default path: searched linear and tree models of all kinds, predictions by the boosted trees' node tables
    other = flows.PipelinePaths(fdir, os.path.join(base, "ann"), os.path.join(base, "out2"), chroma_path, onsets_path)
    monkeypatch.setattr(train, "N_ITER_FAST", 1)
    flows.run_all(spark, other, fast=True)
    models, medians, _ = train.load_models(spark, other.table("models"))
    assert set(models) == {(k, t) for k in ("random_forest", "boosted_trees", "ridge", "elasticnet") for t in ("arousal", "valence")}
    pred = {r.song_id: r.predicted_arousal for r in spark.read.parquet(other.table("emotion_predictions")).collect()}
    again = {r.song_id: r.predicted_arousal for r in train.predict(spark.read.parquet(other.table("song_features")), models, medians).collect()}
    assert pred == again and len(pred) == n and None not in pred.values()
