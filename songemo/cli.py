"""Command line: the pipeline and the question / tag / validation reports as Spark jobs.

    python -m songemo run --frames DIR --annotations DIR --out DIR [--chroma P] [--onsets P] [--force] [--fast]
    python -m songemo ask "Find calm music" --predictions PATH [-k 20]
    python -m songemo tags --predictions PATH
    python -m songemo validate --out DIR

Tables are Parquet (or CSV with a header when the path ends in .csv).  The
session is the one ``spark-submit`` provides; only when none exists is a
local one built.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .operators import analyst, quality, semantic
from .plans import flows
from .session import apply_defaults, build_session
from .sources.files import read_table

PRED_SCHEMA = "song_id string, predicted_arousal double, predicted_valence double"


def _spark() -> SparkSession:
    active = SparkSession.getActiveSession()
    return apply_defaults(active) if active is not None else build_session()


def _predictions(spark: SparkSession, path: str):
    return read_table(spark, path, schema=PRED_SCHEMA if path.endswith(".csv") else None)


def cmd_run(a) -> int:
    spark = _spark()
    paths = flows.PipelinePaths(a.frames, a.annotations, a.out, a.chroma, a.onsets)
    report = flows.run_all(spark, paths, force=a.force, fast=a.fast)
    bad = report.filter(F.col("level") == "error").count() if report is not None else 1
    print("Overall:", "PASSED" if bad == 0 else "FAILED")
    return 0 if bad == 0 else 1


def cmd_ask(a) -> int:
    spark = _spark()
    out = analyst.answer(_predictions(spark, a.predictions), a.question, k=a.k).collect()  # <= k rows
    explanation = out[0]["explanation"] if out else analyst.resolve_intent(spark, a.question)[1]
    print(explanation)
    print()
    if not out:
        print(analyst.NO_MATCH_MESSAGE)
    for r in out:
        print(r["song_id"])
    return 0


def cmd_tags(a) -> int:
    spark = _spark()
    pred = _predictions(spark, a.predictions)
    print("Tag counts (songs with at least that tag):")
    for r in semantic.tag_counts(pred).orderBy("tag_order").collect():  # 7 rows
        print(f"  {r['tag']}: {r['n_songs']}")
    print("\nExample: first 5 'Calm Focus' song_ids:")
    ids = [r["song_id"] for r in semantic.head_by(semantic.filter_by_tag(pred, "Calm Focus").select("song_id"), 5).collect()]
    print(ids if ids else "  (none)")
    return 0


def cmd_validate(a) -> int:
    spark = _spark()
    t = flows.PipelinePaths("", "", a.out).table
    sf = spark.read.parquet(t("song_features"))
    rep = quality.validate_song_features(spark, sf)
    for name, fn in (("song_labels", quality.validate_labels), ("modeling_dataset", quality.validate_modeling_dataset)):
        if flows._exists(spark, t(name)):
            rep = rep.unionByName(fn(spark, spark.read.parquet(t(name))))
    if flows._exists(spark, t("emotion_predictions")):
        rep = rep.unionByName(quality.validate_predictions(spark, spark.read.parquet(t("emotion_predictions")), sf))
    rows = rep.collect()  # a few dozen report rows
    for r in rows:
        if r["level"] in ("error", "info"):
            print(f"  [{r['table']}] {r['level']}: {r['message']}")
    ok = not any(r["level"] == "error" for r in rows)
    print("\nOverall:", "PASSED" if ok else "FAILED")
    return 0 if ok else 1


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="songemo")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="features -> labels -> train -> predict -> validate")
    r.add_argument("--frames", required=True)
    r.add_argument("--annotations", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--chroma")
    r.add_argument("--onsets")
    r.add_argument("--force", action="store_true")
    r.add_argument("--fast", action="store_true", help="5 search iterations instead of 64")
    r.set_defaults(fn=cmd_run)
    q = sub.add_parser("ask", help="ranked songs for a question")
    q.add_argument("question", nargs="+")
    q.add_argument("--predictions", required=True)
    q.add_argument("-k", type=int, default=20)
    q.set_defaults(fn=cmd_ask)
    t = sub.add_parser("tags", help="tag counts and Calm Focus examples")
    t.add_argument("--predictions", required=True)
    t.set_defaults(fn=cmd_tags)
    v = sub.add_parser("validate", help="data-quality report of a pipeline output folder")
    v.add_argument("--out", required=True)
    v.set_defaults(fn=cmd_validate)
    a = p.parse_args(argv)
    if a.cmd == "ask":
        a.question = " ".join(a.question)
    return a.fn(a)


if __name__ == "__main__":
    sys.exit(main())
