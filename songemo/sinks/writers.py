"""Sinks: pipeline tables, metrics reports and run manifests.

Tables are written as Parquet by Spark (optionally also as CSV with a
header) into a new folder that then takes the former one's place.  Reports and manifests are tiny (one row per model or step); they
are built as DataFrames and written by Spark too, so the same code writes to
a shared filesystem on a cluster.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _beside(spark: SparkSession, path: str, what: str):
    """File system, the path and the hidden path ``.<name>.<what>`` in the same folder (Spark does not read it)."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    p = make(path.rstrip("/"))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    p = fs.makeQualified(p)
    return fs, p, make(p.getParent(), f".{p.getName()}.{what}")


def recover(spark: SparkSession, path: str) -> None:
    """Puts the former table back if a swap ended between its two renames; otherwise drops what it left."""
    fs, p, old = _beside(spark, path, "former")
    if fs.exists(old):
        if fs.exists(p):
            fs.delete(old, True)
        else:
            fs.rename(old, p)


def swapped(spark: SparkSession, path: str, write) -> None:
    """Runs ``write(folder)`` on a new folder and puts it in the place of ``path`` once it is whole.

    Until then ``path`` holds the former table, which may also be what is read;
    a write that fails leaves it as it was.
    """
    recover(spark, path)
    fs, p, new = _beside(spark, path, f"new-{uuid.uuid4().hex}")
    try:
        write(new.toString())
        _, _, old = _beside(spark, path, "former")
        if fs.exists(p) and not fs.rename(p, old):
            raise OSError(f"{path} could not be set aside")
        if not fs.rename(new, p):
            recover(spark, path)
            raise OSError(f"{path} could not be replaced")
        fs.delete(old, True)
    finally:
        fs.delete(new, True)


def write_table(df: DataFrame, path: str, columns: list[str] | None = None, csv_path: str | None = None,
                write: bool = True) -> DataFrame:
    """Replace ``path`` by ``df`` in a fixed column order, whole or not at all; ``write=False`` only returns it."""
    out = df.select(*columns) if columns else df
    if write:
        swapped(df.sparkSession, path, lambda folder: out.write.parquet(folder))
        out = df.sparkSession.read.schema(out.schema).parquet(path)     # what ``df`` reads may have been replaced
        if csv_path:
            swapped(df.sparkSession, csv_path, lambda folder: out.write.option("header", True).csv(folder))
    return out


def _fmt4(c: str):
    return F.format_string("%.4f", F.col(c))


def metrics_report(metrics: DataFrame) -> DataFrame:
    """Text lines of the metrics report, one DataFrame row per line, in order.

    Per model: '--- model ---', the header 'target,rmse,r2,pearson_r,n_train,n_val,cv_rmse_mean,model_path',
    one line per target (4 decimals, blank CV mean when not tuned), then the
    best parameters of each tuned target.
    """
    m = metrics.withColumn("_m", F.dense_rank().over(_model_order()))
    head = m.select("_m", F.lit(0).alias("_k"), F.lit("").alias("target"),
                    F.concat(F.lit("--- "), F.col("model"), F.lit(" ---")).alias("line")).distinct()
    cols = m.select("_m", F.lit(1).alias("_k"), F.lit("").alias("target"),
                    F.lit("target,rmse,r2,pearson_r,n_train,n_val,cv_rmse_mean,model_path").alias("line")).distinct()
    body = m.select("_m", F.lit(2).alias("_k"), "target", F.concat_ws(
        ",", F.col("target"), _fmt4("rmse"), _fmt4("r2"), _fmt4("pearson_r"), F.col("n_train").cast("string"),
        F.col("n_val").cast("string"), F.coalesce(_fmt4("cv_rmse_mean"), F.lit("")),
        F.coalesce(F.col("model_path"), F.lit(""))).alias("line"))
    params = m.filter(F.size("best_params") > 0).select(
        "_m", F.lit(3).alias("_k"), "target",
        F.concat(F.lit("  "), F.col("target"), F.lit(" best_params: "), F.to_json("best_params")).alias("line"))
    return (head.unionByName(cols).unionByName(body).unionByName(params)
            .orderBy("_m", "_k", "target").select("line"))


def _model_order():
    from pyspark.sql.window import Window
    # a handful of rows (models x targets): one partition is fine
    return Window.orderBy(F.when(F.col("model") == "random_forest", 0).when(F.col("model") == "ridge", 1)
                          .when(F.col("model") == "elasticnet", 2).otherwise(3), "model")


def write_metrics_report(metrics: DataFrame, path: str) -> None:
    metrics_report(metrics).coalesce(1).write.mode("overwrite").text(path)


MANIFEST_SCHEMA = ("run_id string, started_utc string, finished_utc string, status string, "
                   "steps array<struct<name:string,status:string,detail:string>>, error string, "
                   "settings string")


def manifest_row(spark: SparkSession, run_id: str, started: str, steps: list[tuple[str, str, str]],
                 error: str | None = None, settings: dict | None = None) -> DataFrame:
    """One manifest row; status is 'ok' unless a step failed or an error is given."""
    failed = error is not None or any(s[1] == "fail" for s in steps)
    row = (run_id, started, datetime.now(timezone.utc).isoformat(), "fail" if failed else "ok",
           [{"name": n, "status": st, "detail": d} for n, st, d in steps], error,
           json.dumps(settings or {}, sort_keys=True))
    return spark.createDataFrame([row], MANIFEST_SCHEMA)


def append_manifest(manifest: DataFrame, runs_path: str) -> None:
    """Append the run to the runs table (JSON lines, one row per run)."""
    manifest.select(F.to_json(F.struct("*")).alias("value")).write.mode("append").text(runs_path)
