"""Order-dependent per-song operators that stay skew-safe.

``position`` numbers the rows of every group in a total order without a
``Window.partitionBy(group)``: a window would pull a whole song into one
task, and one song may hold a third of all rows.  Instead the table is
range-partitioned on (group, order...), so a hot group is cut into many
contiguous slices; each slice is sorted locally; a small table with one row
per (slice, group) gives every slice its offset inside the group; a join
adds the offset back.  The only window runs on that small table, where a
group has at most one row per slice.

The slice id and local row index come from the partition index, so the
sliced table is checkpointed into the shared checkpoint folder once: both
uses below then read the same materialised numbering, whatever AQE later
does to partitions, and a lost executor cannot renumber it.

``lag`` takes each row's predecessor inside its slice (a window per slice)
and fills the first row of a group in a slice from the group's last row in
the previous slice (a small per-(slice, group) table).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id = partition index << 33 | row index


def _n_slices(df: DataFrame, n: int | None) -> int:
    if n:
        return n
    spark = df.sparkSession
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def _sliced(df: DataFrame, group: str, order: list[str], n: int) -> DataFrame:
    """Range slices of (group, order...) with slice id and local row index, checkpointed."""
    keys = [group, *order]
    r = (df.repartitionByRange(n, *[F.col(k) for k in keys])
         .sortWithinPartitions(*keys)
         .withColumn("_slice", F.spark_partition_id())
         .withColumn("_local", F.monotonically_increasing_id()
                     - F.shiftleft(F.spark_partition_id().cast("bigint"), _ROW_BITS)))
    checkpoint_dir(df.sparkSession)
    return r.checkpoint(eager=True)


def position(df: DataFrame, group: str, order: list[str], n_slices: int | None = None) -> DataFrame:
    """Add ``_pos`` (0-based rank of the row inside its group) and ``_n`` (group size).

    ``order`` must be a total order inside a group (add a unique tie-break);
    then the numbering is deterministic and survives task retries.
    """
    r = _sliced(df, group, order, _n_slices(df, n_slices))
    per_slice = r.groupBy("_slice", group).agg(F.min("_local").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    w = Window.partitionBy(group).orderBy("_slice")
    offsets = per_slice.select(
        "_slice", group, "_first",
        (F.sum("_cnt").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("_cnt"))
        .alias("_off"),
        F.sum("_cnt").over(Window.partitionBy(group)).alias("_n"),
    )
    out = r.join(offsets, ["_slice", group])
    return out.withColumn("_pos", F.col("_off") + F.col("_local") - F.col("_first")).drop(
        "_slice", "_local", "_first", "_off")


def lag(df: DataFrame, group: str, order: list[str], cols: list[str],
        n_slices: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` for each c in ``cols``: the value of the previous row in the group.

    Inside a range slice the predecessor is the previous row of the slice (a
    window over one slice, bounded by the slice size).  Only the first row of
    a group in a slice looks further back: it takes the group's last row of
    the nearest earlier slice, from a small table with one row per
    (slice, group).
    """
    r = _sliced(df, group, order, _n_slices(df, n_slices))
    w = Window.partitionBy("_slice").orderBy("_local")
    x = r.select("*", F.lag(F.col(group)).over(w).alias("_pg"),
                 *[F.lag(F.col(c)).over(w).alias(f"_p_{c}") for c in cols])
    last = r.groupBy("_slice", group).agg(
        F.max_by(F.struct(*[F.col(c).alias(c) for c in cols]), "_local").alias("_last"))
    prev_last = last.select("_slice", group, F.lag("_last").over(
        Window.partitionBy(group).orderBy("_slice")).alias("_pl"))   # <= one row per slice for a group
    y = x.join(prev_last, ["_slice", group])
    same = F.col("_pg").isNotNull() & (F.col("_pg") == F.col(group))
    return y.select(*[F.col(f"`{c}`") for c in df.columns],
                    *[F.when(same, F.col(f"_p_{c}")).otherwise(F.col("_pl").getField(c)).alias(f"prev_{c}")
                      for c in cols])
