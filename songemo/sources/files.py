"""File-level sources: pipeline tables, audio listings and run folders.

Listings read only file metadata (path, size, time) through Spark's
``binaryFile`` source without its ``content`` column, so no file bytes are
loaded.  Run folders are resolved with a filter and a max aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RUN_ID_PATTERN
from ..functions.scalars import song_id_from_path

# pandas' default NULL tokens for text read from CSV
NULL_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
               "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")


def read_table(spark: SparkSession, path: str, schema: str | None = None, fmt: str | None = None) -> DataFrame:
    """A pipeline table: Parquet by default, CSV (header, explicit schema) when ``fmt='csv'``.

    For CSV, every string column has the NULL tokens turned into NULL, as the
    original tables were written and read by pandas.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "parquet":
        return spark.read.parquet(path)
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    df = r.schema(schema).csv(path) if schema else r.csv(path)
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.dataType.simpleString() == "string":
            c = F.when(c.isin(*NULL_TOKENS), F.lit(None).cast("string")).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def audio_files(spark: SparkSession, directory: str, extensions: tuple[str, ...] = (".mp3", ".wav", ".flac"),
                limit: int | None = None) -> DataFrame:
    """(path, song_id, length, modification_time) of audio files, sorted by path.

    Non-recursive; a stem present in two formats gives two rows.  ``limit``
    keeps the first n paths (a sampling option of the listing).
    """
    globs = "{" + ",".join(f"*{e}" for e in extensions) + "}"
    df = (spark.read.format("binaryFile").option("pathGlobFilter", globs)
          .option("recursiveFileLookup", "false").load(directory)
          .select("path", "length", F.col("modificationTime").alias("modification_time")))
    df = df.select("path", song_id_from_path(F.col("path")).alias("song_id"), "length", "modification_time")
    df = df.dropDuplicates(["path"]).orderBy("path")
    return df.limit(limit) if limit is not None else df


def latest_runs(runs: DataFrame, run_col: str = "run_id", group_col: str | None = None,
                base: str = "") -> DataFrame:
    """Latest run id (lexicographic max of names like 20250101_000000).

    Names not matching the pattern are ignored; with none left the result is
    ``base`` (the un-versioned folder).  ``group_col`` gives one answer per
    group, as one aggregate.
    """
    valid = F.when(F.col(run_col).rlike(RUN_ID_PATTERN), F.col(run_col))
    keys = [group_col] if group_col else []
    g = runs.groupBy(*keys).agg(F.max(valid).alias("_latest"))
    return g.select(*keys, F.coalesce(F.col("_latest"), F.lit(base)).alias("latest_run"))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Whether a path or glob names anything, on any Hadoop filesystem."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0
