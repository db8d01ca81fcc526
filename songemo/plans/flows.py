"""End-to-end jobs: features -> enrich -> labels + join -> train -> predict -> validate.

Each step reads its inputs, runs as Spark jobs and writes a Parquet table;
the next step reads that table back.  Writing between steps cuts the
lineage, so a lost executor only recomputes inside the current step, and a
finished step is reused on the next run when its ``_SUCCESS`` marker exists
and the fingerprint of its inputs (paths, sizes, modification times) is
unchanged.  The run manifest is appended to a ``runs`` table, also when a
step fails (deviation: the original exited before writing it).
"""

from __future__ import annotations

import hashlib
import json
import os
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SONG_FEATURE_COLUMNS
from ..modeling import train as T
from ..operators import audio, features, joins, quality
from ..sinks import writers
from ..sources import annotations, frames_csv


def run_features(spark: SparkSession, frames_dir: str, rich: bool = True) -> DataFrame:
    """Frame CSVs -> one feature row per song."""
    return features.song_features(frames_csv.scan_frames(spark, frames_dir), rich=rich)


def audio_table(spark: SparkSession, chroma_path: str | None, onsets_path: str | None) -> DataFrame | None:
    """(song_id, tempo_bpm, key) from chroma frames and onsets tables (either may be missing)."""
    keys = audio.song_keys(spark.read.parquet(chroma_path)).select("song_id", "key") if chroma_path else None
    tempo = (audio.tempo_from_onsets(spark.read.parquet(onsets_path)).select("song_id", "tempo_bpm")
             if onsets_path else None)
    if keys is None and tempo is None:
        return None
    if keys is None:
        return tempo.withColumn("key", F.lit("unknown"))
    if tempo is None:
        return keys.withColumn("tempo_bpm", F.lit(None).cast("double"))
    return keys.join(tempo, "song_id", "full")


def run_enrich(spark: SparkSession, frames_dir: str, chroma_path: str | None = None,
               onsets_path: str | None = None) -> DataFrame:
    """Features + audio-derived tempo / key (left join) + parsed key columns."""
    feats = run_features(spark, frames_dir, rich=True)
    aud = audio_table(spark, chroma_path, onsets_path)
    if aud is None:
        aud = spark.createDataFrame([], "song_id string, tempo_bpm double, key string")
    return joins.enrich(feats, aud).select(*SONG_FEATURE_COLUMNS)


def run_labels(spark: SparkSession, annotations_dir: str) -> DataFrame:
    """Static labels if present, else dynamic."""
    return annotations.load_labels(spark, annotations_dir).select("song_id", "arousal", "valence")


@dataclass
class PipelinePaths:
    frames_dir: str
    annotations_dir: str
    out_dir: str
    chroma_path: str | None = None
    onsets_path: str | None = None

    def table(self, name: str) -> str:
        return os.path.join(self.out_dir, name)


def _fs(spark: SparkSession, path: str):
    """Hadoop FileSystem and Path for ``path`` (local, HDFS, object stores alike)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _fingerprint(spark: SparkSession, paths: list[str | None], *settings) -> str:
    """Hash of the settings and of every file below each input: its path, size and modification time.

    The files are a table (listed by Spark, without their content) that is
    aggregated to one row, so nothing per file is handled here.
    """
    h = hashlib.sha256(repr(settings).encode())
    for path in paths:
        if not path or not _exists(spark, path):
            continue
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        row = files.agg(F.count(F.lit(1)), F.sum("length"),
                        F.bit_xor(F.xxhash64("path", "length", "modificationTime"))).first()
        h.update(f"{path}|{tuple(row)}".encode())
    return h.hexdigest()


def _done(spark: SparkSession, path: str, fp: str, table: bool = True) -> bool:
    if not (table and _exists(spark, path.rstrip("/") + "/_SUCCESS") or not table) or not _exists(spark, path.rstrip("/") + "/_fingerprint"):
        return False
    fs, p = _fs(spark, path.rstrip("/") + "/_fingerprint")
    stream = fs.open(p)
    try:
        got = bytes(stream.readAllBytes()).decode().strip()
    finally:
        stream.close()
    return got == fp


def _mark(spark: SparkSession, path: str, fp: str) -> None:
    fs, p = _fs(spark, path.rstrip("/") + "/_fingerprint")
    out = fs.create(p, True)
    out.write(bytearray(fp.encode()))
    out.close()


def run_all(spark: SparkSession, paths: PipelinePaths, force: bool = False, fast: bool = False,
            tune: bool = True, include_boosted: bool = True) -> DataFrame:
    """C4: the whole chain with step reuse; returns the validation report.

    ``fast`` searches 5 settings per model instead of 64.

    Steps: enrich -> labels + modeling_dataset -> train -> predict -> validate
    (validation always runs).  Appends a manifest row to ``<out>/runs``.
    """
    started = datetime.now(timezone.utc).isoformat()
    run_id = datetime.now(timezone.utc).strftime("%Y%m%d_%H%M%S")
    steps: list[tuple[str, str, str]] = []
    error = None
    sf, lb, md, pr = (paths.table(n) for n in ("song_features", "song_labels", "modeling_dataset",
                                                "emotion_predictions"))
    report = None
    for table in (sf, lb, md, pr):
        writers.recover(spark, table)       # a run that was ended inside a swap
    try:
        fp = _fingerprint(spark, [paths.frames_dir, paths.chroma_path, paths.onsets_path])
        if not force and _done(spark, sf, fp):
            steps.append(("enrich", "skipped", "reused song_features"))
        else:
            writers.write_table(run_enrich(spark, paths.frames_dir, paths.chroma_path, paths.onsets_path), sf)
            _mark(spark, sf, fp)
            steps.append(("enrich", "ok", sf))
        fp2 = _fingerprint(spark, [paths.annotations_dir, sf])
        if not force and _done(spark, md, fp2):
            steps.append(("labels_and_join", "skipped", "reused modeling_dataset"))
        else:
            writers.write_table(run_labels(spark, paths.annotations_dir), lb)
            writers.write_table(joins.modeling_dataset(spark.read.parquet(sf), spark.read.parquet(lb)), md)
            _mark(spark, md, fp2)
            steps.append(("labels_and_join", "ok", md))
        models = paths.table("models")
        fp3 = _fingerprint(spark, [md], fast, tune, include_boosted)
        if not force and _done(spark, models, fp3, table=False):
            steps.append(("train", "skipped", "reused the latest run's models"))
        else:
            res, prep, rid = T.train_all(spark.read.parquet(md), fast=fast, tune=tune, include_boosted=include_boosted,
                                         run_id=run_id, models_dir=models)
            metrics = T.metrics_frame(spark, res)
            writers.write_table(metrics, paths.table(f"metrics/run_id={rid}"))
            writers.write_metrics_report(metrics, paths.table(f"metrics_report/run_id={rid}"))
            prep.release()
            _mark(spark, models, fp3)
            steps.append(("train", "ok", f"{len(res.metrics)} models, run {rid}"))
        fp4 = _fingerprint(spark, [sf, models], include_boosted)
        if not force and _done(spark, pr, fp4):
            steps.append(("predict", "skipped", "reused emotion_predictions"))
        else:
            kind = "boosted_trees" if include_boosted else "ridge"
            loaded, medians, _ = T.load_models(spark, models)
            writers.write_table(T.predict(spark.read.parquet(sf), loaded, medians, kind=kind), pr)
            _mark(spark, pr, fp4)
            steps.append(("predict", "ok", pr))
    except Exception as e:  # noqa: BLE001 - recorded in the manifest, then re-raised
        error = f"{type(e).__name__}: {e}"
        steps.append(("pipeline", "fail", error))
    finally:
        rep = None
        try:
            if _exists(spark, os.path.join(sf, "_SUCCESS")):
                s = spark.read.parquet(sf)
                rep = quality.validate_song_features(spark, s)
                if _exists(spark, os.path.join(lb, "_SUCCESS")):
                    rep = rep.unionByName(quality.validate_labels(spark, spark.read.parquet(lb)))
                if _exists(spark, os.path.join(md, "_SUCCESS")):
                    rep = rep.unionByName(quality.validate_modeling_dataset(spark, spark.read.parquet(md)))
                if _exists(spark, os.path.join(pr, "_SUCCESS")):
                    rep = rep.unionByName(quality.validate_predictions(spark, spark.read.parquet(pr), s))
                writers.write_table(rep, paths.table("validation"))
                report = spark.read.parquet(paths.table("validation"))
                ok = report.filter(F.col("level") == "error").isEmpty()
                steps.append(("validate", "ok" if ok else "fail", "validation report written"))
            else:
                steps.append(("validate", "fail", "song_features missing"))
        except Exception as e:  # noqa: BLE001
            steps.append(("validate", "fail", f"{type(e).__name__}: {e}"))
        writers.append_manifest(writers.manifest_row(spark, run_id, started, steps, error,
                                                     {"fast": fast, "force": force, "tune": tune}),
                                paths.table("runs"))
    if error:
        raise RuntimeError(error)
    return report


def manifest_json(spark: SparkSession, out_dir: str) -> list[dict]:
    """All manifests of the runs table (small)."""
    return [json.loads(r.value) for r in spark.read.text(os.path.join(out_dir, "runs")).collect()]
