"""Exact per-group median that stays bounded for hot groups.

Spark's exact ``median`` keeps every distinct value of a group in one task.
That is fine for ordinary groups and not for a group holding a third of all
rows.  So groups are first counted (a partial aggregate); groups with at most
``max_local`` values use ``median`` directly.  Larger ("hot") groups are
narrowed in rounds, all hot groups at once, with their state in a small
DataFrame of two rows per group (the two middle ranks).

A round takes a fixed grid of approximate quantiles of each bracket (a bounded
sketch) and counts the rows below, at and between two of its values.  A rank
that falls on one of the values is found; otherwise the bracket shrinks to the
open interval beside or between them.  Brackets exclude the values tried, so
every round makes progress, ties of any number are found by their count, and
no list of values is ever built.  The state is broadcast only after its row
count was checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import nan_to_null
from ..session import checkpoint_dir

GRID = 1000          # quantile grid per hot group and round
ACCURACY = 20000     # sketch accuracy (rank error <= n / ACCURACY, well inside one grid step)
MAX_BROADCAST_GROUPS = 100_000


def _small(state: DataFrame, n_hot: int) -> DataFrame:
    return F.broadcast(state) if n_hot <= MAX_BROADCAST_GROUPS else state


def _inside(x: Column) -> Column:
    return ((F.col("lo").isNull() | (x > F.col("lo"))) & (F.col("hi").isNull() | (x < F.col("hi"))))


def _round(hx: DataFrame, state: DataFrame, n_hot: int) -> DataFrame:
    """One narrowing of every bracket; ``value`` is set where the rank was found."""
    x = F.col("_x")
    grid = [i / GRID for i in range(GRID + 1)]
    inside = hx.join(_small(state, n_hot), "_g").filter(_inside(x))
    q = inside.groupBy("_g", "rank").agg(F.percentile_approx("_x", grid, ACCURACY).alias("_q"))
    at = (F.col("rank") - F.col("below")) / F.col("inside") * GRID          # the rank's place on the grid
    tried = state.join(q, ["_g", "rank"]).select(
        *state.columns,
        F.element_at("_q", F.greatest(F.lit(0), F.floor(at) - 1).cast("int") + 1).alias("a"),
        F.element_at("_q", F.least(F.lit(GRID), F.ceil(at) + 1).cast("int") + 1).alias("b"))
    n = (hx.join(_small(tried, n_hot), "_g").filter(_inside(x)).groupBy("_g", "rank").agg(
        F.count_if(x < F.col("a")).alias("_lt"), F.count_if(x == F.col("a")).alias("_at_a"),
        F.count_if((x > F.col("a")) & (x < F.col("b"))).alias("_mid"),
        F.count_if((x == F.col("b")) & (F.col("b") > F.col("a"))).alias("_at_b"),
        F.count_if(x > F.col("b")).alias("_gt")))
    t = F.col("rank") - F.col("below")
    c1 = F.col("_lt")
    c2 = c1 + F.col("_at_a")
    c3 = c2 + F.col("_mid")
    c4 = c3 + F.col("_at_b")

    def by_region(left, at_a, mid, at_b, right):
        return F.when(t < c1, left).when(t < c2, at_a).when(t < c3, mid).when(t < c4, at_b).otherwise(right)
    none = F.lit(None).cast("double")
    return tried.join(n, ["_g", "rank"]).select(
        "_g", "rank",
        by_region(F.col("lo"), none, F.col("a"), none, F.col("b")).alias("lo"),
        by_region(F.col("a"), none, F.col("b"), none, F.col("hi")).alias("hi"),
        (F.col("below") + by_region(F.lit(0), F.lit(0), c2, F.lit(0), c4)).cast("bigint").alias("below"),
        by_region(F.col("_lt"), F.lit(0), F.col("_mid"), F.lit(0), F.col("_gt")).cast("bigint").alias("inside"),
        by_region(none, F.col("a"), none, F.col("b"), none).alias("value"))


def grouped_median(df: DataFrame, group: str, value: Column, max_local: int = 1_000_000) -> DataFrame:
    """(group, median) of ``value`` per group, NULL / NaN ignored; groups without a value are absent."""
    x = df.select(F.col(group).alias("_g"), nan_to_null(value).alias("_x")).filter(F.col("_x").isNotNull())
    sizes = x.groupBy("_g").agg(F.count(F.lit(1)).alias("_n"))
    checkpoint_dir(df.sparkSession)
    hot = sizes.filter(F.col("_n") > max_local).checkpoint(eager=True)
    n_hot = hot.count()
    if n_hot == 0:
        return x.groupBy("_g").agg(F.median("_x").alias("median")).withColumnRenamed("_g", group)
    hot_keys = _small(hot.select("_g"), n_hot)
    normal = x.join(hot_keys, "_g", "left_anti").groupBy("_g").agg(F.median("_x").alias("median"))
    hx = x.join(hot_keys, "_g", "left_semi")
    none = F.lit(None).cast("double")
    ranks = F.explode(F.array_distinct(F.array(((F.col("_n") - 1) / 2).cast("bigint"), (F.col("_n") / 2).cast("bigint"))))
    state = hot.select("_g", ranks.alias("rank"), none.alias("lo"), none.alias("hi"),
                       F.lit(0).cast("bigint").alias("below"), F.col("_n").alias("inside"))
    found = None
    while True:
        done = _round(hx, state, n_hot).checkpoint(eager=True)      # two rows per hot group; cuts the round lineage
        values = done.filter(F.col("value").isNotNull()).select("_g", "rank", "value")
        found = values if found is None else found.unionByName(values)
        state = done.filter(F.col("value").isNull()).drop("value")
        if state.isEmpty():
            break
    a, b = F.min_by("value", "rank"), F.max_by("value", "rank")
    out = found.groupBy("_g").agg((a + (b - a) * F.lit(0.5)).alias("median"))
    return normal.unionByName(out).withColumnRenamed("_g", group)
