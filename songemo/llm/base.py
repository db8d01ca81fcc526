"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import gc
import re
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import arrow_fs, checkpoint_dir, qualified  # noqa: F401 (the other modules take them from here)


#: Bytes of an Arrow batch that goes to a Python worker; ten thousand long texts would be far more.
BATCH_BYTES = 8 << 20


def bounded(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session by bytes besides by rows."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run_folder(spark: SparkSession, name: str) -> str:
    """A new folder of this run inside the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back.

    This cuts the lineage: later steps read the written files, which survive
    the loss of any executor, and every reader sees the same rows.
    """
    path = run_folder(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes ``stored`` tables that nothing reads any more."""
    for t in tables:
        path = t.sparkSession.sparkContext._jvm.org.apache.hadoop.fs.Path(t._stored_at)
        path.getFileSystem(t.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def in_file_order(df: DataFrame, name: str = "position") -> DataFrame:
    """``df`` with the number of each row in the order in which it was written.

    Reading Parquet files again deals them out by size, so the order survives only
    in the files' names and the rows' places in them.  A table that was not read
    straight from files is written first.  The driver holds one number per file.
    """
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":
        df = stored(df, "in-order")
    taken = {c.lower() for c in [*df.columns, name]}
    mark = next(m for m in ("_" * n for n in range(1, len(taken) + 2)) if not any(m + x in taken for x in ("file", "at", "path", "start")))
    file, at, to, start_ = (mark + x for x in ("file", "at", "path", "start"))
    rows = df.select("*", F.col("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(at))
    ends = {r[file]: r["n"] for r in rows.groupBy(file).agg((F.max(at) + 1).alias("n")).collect()}  # one per file
    before, starts = 0, []
    for path in sorted(ends, key=lambda x: [int(y) if y.isdigit() else y for y in re.split("([0-9]+)", x)]):
        starts.append((path, before))
        before += ends[path]
    start = df.sparkSession.createDataFrame(starts, f"{to} string, {start_} long")
    return (rows.join(F.broadcast(start), F.col(file) == F.col(to))
            .select(*[rows[f"`{c}`"] for c in df.columns], (F.col(start_) + F.col(at)).alias(name)))


def release(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of finished steps whose DataFrames are gone.

    Spark removes them when the driver's heap is collected, which may be long
    after; a job of several large steps asks for it in between.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def by_batch(fn: Callable[[pa.RecordBatch], pa.RecordBatch | None]):
    """A ``mapInArrow`` function from one that maps a single batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield out
    return run


def remainder4(doc_id: Column) -> Column:
    """crc32(doc_id as text) mod 4; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def held_out(doc_id: Column) -> Column:
    """True for documents that no model of this package learns from (remainder 2)."""
    return F.coalesce(remainder4(doc_id) == 2, F.lit(False))


def byte_chars() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


def vocabulary(name: str) -> str:
    """Place of a public tokenizer file (the operators take any path)."""
    import public_tokenizers
    return public_tokenizers.path(name)


#: DuckDB CTEs (after WITH RECURSIVE): ``crc_table`` has the 256 entries of the checksum as the list t.
CRC_CTES = """crc_bits(i, k, c) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END) FROM crc_bits WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8)"""


def crc_sql(text: str, table: str = "t") -> str:
    """DuckDB SQL of the unsigned crc32 of a string's UTF-8 bytes (code points below U+0800); ``table`` is crc_table's t."""
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ord(x) AS BIGINT))"
    each = f"list_transform({codes}, lambda x: CASE WHEN x < 128 THEN [x] ELSE [192 + (x >> 6), 128 + (x & 63)] END)"
    steps = f"list_reduce(list_concat([4294967295::BIGINT], flatten({each})), lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"
