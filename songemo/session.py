"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile

import pyarrow.fs as pafs
from pyspark.sql import SparkSession

# Settings every job relies on: UTC session clock, AQE with skew-join
# splitting and partition coalescing, and Arrow for the rare pandas hop.
SESSION_DEFAULTS: dict[str, str] = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8, app: str = "songemo",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session for local runs and tests; on a cluster use the cluster's session."""
    b = SparkSession.builder.master(master).appName(app)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL defaults on an existing session (UTC clock, AQE)."""
    for k, v in SESSION_DEFAULTS.items():
        if k.startswith("spark.sql."):
            spark.conf.set(k, v)
    return spark


def _plain(path: str) -> str:
    """A path without the ways to write the local scheme, and without an end slash."""
    return "/" + path.removeprefix("file:").strip("/") if path.startswith(("/", "file:")) else path.rstrip("/")


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster that setting must name a folder of a shared filesystem and is
    used as is.  Only a local master (tests, single-machine runs) gets a
    private folder when it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get(
        "spark.checkpoint.dir", None
    )
    if not d:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="songemo-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if _plain(spark.sparkContext.getCheckpointDir() or "").rsplit("/", 1)[0] != _plain(d):
        spark.sparkContext.setCheckpointDir(d)
    return d


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme and host that Spark resolves it to, so that executors' Arrow opens the same place."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def arrow_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """Arrow filesystem and path for a URI or a plain local path."""
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)
