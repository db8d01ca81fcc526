"""Nearest songs in (arousal, valence) space and single-song profiles.

``similar_songs`` takes a short list of seed ids and scans the songs once for
all of them.  ``similar_songs_grid`` takes a seed table of any
size and answers all seeds together through equi-joins on grid cells.
Neither builds a pair table of seeds x songs.  Profiles are point lookups by id.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.scalars import nan_to_null
from ..functions.tags import finite, tags
from ..session import checkpoint_dir
from .views import A, V, extent, quadrant


def similar_songs(predictions: DataFrame, seeds: list[str], k: int = 10) -> DataFrame:
    """(seed_id, rank, song_id, distance) for the k nearest other songs of each seed.

    The seeds' points are looked up first (a list given by the caller, one row
    each); then one scan computes every song's distance to each of them and
    keeps k per seed and task before the shuffle.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    ok = predictions.filter(finite(F.col(A)) & finite(F.col(V)))
    points = {r["song_id"]: (r["a"], r["v"]) for r in ok.filter(F.col("song_id").isin(*seeds)).groupBy("song_id").agg(
        F.min(A).alias("a"), F.min(V).alias("v")).collect()} if seeds else {}
    if not points or k == 0:
        return predictions.sparkSession.createDataFrame([], "seed_id string, rank int, song_id string, distance double")
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("id"), F.lit(a).alias("a"), F.lit(v).alias("v"))
                               for s, (a, v) in points.items()]))
    d2 = (F.col(A) - F.col("s.a")) ** 2 + (F.col(V) - F.col("s.v")) ** 2
    w = Window.partitionBy("seed_id").orderBy("distance", "song_id")
    return (ok.select("song_id", A, V, each.alias("s")).filter(F.col("song_id") != F.col("s.id"))
            .select(F.col("s.id").alias("seed_id"), "song_id", d2.alias("distance"))
            .withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("seed_id", F.col("rank").cast("int").alias("rank"), "song_id", "distance"))


def song_profile(predictions: DataFrame, song_ids: list[str] | DataFrame) -> DataFrame:
    """(song_id, arousal, valence, tags, quadrant) for the given songs.

    ``song_ids`` is a list of ids or a DataFrame with a song_id column (e.g. a
    top-k result).  The quadrant splits at the midpoints of the whole table's
    extent.
    """
    mids = extent(predictions).select(F.struct("arousal_mid", "valence_mid")).scalar()
    if isinstance(song_ids, DataFrame):
        sel = predictions.join(song_ids.select("song_id"), "song_id", "left_semi")
    else:
        sel = predictions.filter(F.col("song_id").isin(*song_ids))
    a, v = F.col(A), F.col(V)
    q = F.when(finite(a) & finite(v), quadrant(v, a, mids.getField("valence_mid"), mids.getField("arousal_mid")))
    return sel.select("song_id", nan_to_null(a).alias("arousal"), nan_to_null(v).alias("valence"),
                      tags(a, v).alias("tags"), q.alias("quadrant"))


#: Points that a seed's own cell may hold at first, as a multiple of k + 1 (mean over points).
FULL_CELL = 8
#: Seed points that are few enough to be compared with every point in one scan.
SCAN_SEEDS = 64


def similar_songs_grid(predictions: DataFrame, seeds: DataFrame, k: int = 10) -> DataFrame:
    """Exact k nearest songs for every seed of a seed table, in one plan per round.

    Songs are first reduced to their distinct points, each with its k + 1
    smallest ids; no answer can need more of a point's songs, so what is
    compared are points, however many songs share one.  Points fall into
    square cells.  The first cell size follows the middle 98 % of the points, and
    is halved until a point's cell holds few others on average, so neither
    far-off points nor dense clusters make cells crowded.  Each round joins every
    pending seed point with the nine cells around it on the cell key and ranks the
    candidates.  A seed point is done when its k + 1 nearest songs (itself among
    them) lie within one cell size (no point outside the nine cells can be
    closer) or when the nine cells cover the whole extent; the others go on with
    cells four times as wide, which are still sparse where they are pending.  As
    soon as few are left, one scan of the points answers them.  The seeds' own
    songs are joined back last.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    spark = predictions.sparkSession
    songs = predictions.filter(finite(F.col(A)) & finite(F.col(V))).select("song_id", F.col(A).alias("a"),
                                                                         F.col(V).alias("v"))
    empty = spark.createDataFrame([], "seed_id string, rank int, song_id string, distance double")
    of_point = Window.partitionBy("a", "v").orderBy("song_id")
    pts = _stable(songs.distinct().withColumn("_n", F.row_number().over(of_point)).filter(F.col("_n") <= k + 1)
                  .groupBy("a", "v").agg(F.collect_list("song_id").alias("ids")))       # <= k + 1 ids each
    middle = [0.01, 0.99]
    ext = pts.agg(F.min("a").alias("a0"), F.max("a").alias("a1"), F.min("v").alias("v0"), F.max("v").alias("v1"),
                  F.percentile_approx("a", middle).alias("qa"), F.percentile_approx("v", middle).alias("qv"),
                  F.count(F.lit(1)).alias("n")).first()   # one row
    if not ext["n"] or k == 0:
        return empty
    asked = _stable(songs.join(seeds.select("song_id").distinct(), "song_id", "left_semi")
                    .select(F.col("song_id").alias("seed_id"), F.col("a").alias("sa"), F.col("v").alias("sv")).distinct())
    h = _cell_size(pts, ext, k)
    pending = _stable(asked.select("sa", "sv").distinct())
    point = ["sa", "sv"]
    by_distance = Window.partitionBy(*point).orderBy("distance")
    by_song = Window.partitionBy(*point).orderBy("distance", "song_id")
    d2 = (F.col("a") - F.col("sa")) ** 2 + (F.col("v") - F.col("sv")) ** 2

    def nearest(pairs: DataFrame) -> DataFrame:
        # every point holds at least one song: k + 1 nearest points, with ties, hold the k + 1 nearest songs
        cand = (pairs.select(*point, "ids", d2.alias("distance"))
                .withColumn("_r", F.rank().over(by_distance)).filter(F.col("_r") <= k + 1))
        return (cand.select(*point, "distance", F.explode("ids").alias("song_id"))
                .withColumn("_r", F.row_number().over(by_song)).filter(F.col("_r") <= k + 1))
    near = []
    while left := pending.count():
        if left <= SCAN_SEEDS:
            each = F.inline(F.array(*[F.struct(F.lit(r["sa"]).alias("sa"), F.lit(r["sv"]).alias("sv")) for r in pending.collect()]))
            near.append(_stable(nearest(pts.select("*", each)).select(*point, "song_id", "distance")))
            break
        around = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
        ring = (pending.withColumns({"scx": _cell("sa", h), "scy": _cell("sv", h)}).select(*point, "scx", "scy", F.inline(around))
                .select(*point, (F.col("scx") + F.col("dx")).alias("cx"), (F.col("scy") + F.col("dy")).alias("cy")))
        grid = pts.select("ids", "a", "v", _cell("a", h).alias("cx"), _cell("v", h).alias("cy"))
        top = _stable(nearest(ring.join(grid, ["cx", "cy"])).select(*point, "song_id", "distance"))
        stat = top.groupBy(*point).agg(F.count(F.lit(1)).alias("_found"), F.max("distance").alias("_dk"))
        covers = F.lit(True)
        for c, lo, hi in (("sa", ext["a0"], ext["a1"]), ("sv", ext["v0"], ext["v1"])):
            covers &= (_cell(c, h) - 1 <= math.floor(lo / h)) & (_cell(c, h) + 1 >= math.floor(hi / h))
        # accept below 0.999 cells: a point that rounding put one cell off is still
        # at least that far away, so it cannot be missed
        safe = (0.999 * h) ** 2
        ok = _stable(pending.join(stat, point).filter(
            covers | ((F.col("_found") == k + 1) & (F.col("_dk") <= F.lit(safe)))).select(*point))
        near.append(top.join(ok, point, "left_semi"))
        pending = _stable(pending.join(ok, point, "left_anti"))
        h *= 4
    if not near:
        return empty
    found = reduce(lambda x, y: x.unionByName(y), near)
    of_seed = Window.partitionBy("seed_id").orderBy("distance", "song_id")
    return (asked.join(found, point).filter(F.col("song_id") != F.col("seed_id"))
            .withColumn("rank", F.row_number().over(of_seed)).filter(F.col("rank") <= k)
            .select("seed_id", F.col("rank").cast("int").alias("rank"), "song_id", "distance"))


def _cell(col: str, h: float) -> Column:
    return F.floor(F.col(col) / F.lit(h)).cast("bigint")


def _cell_size(pts: DataFrame, ext, k: int) -> float:
    """A cell size at which a point's cell holds at most FULL_CELL * (k + 1) points, on average over the points."""
    far = max(abs(ext[c]) for c in ("a0", "a1", "v0", "v1"))
    least = max(far, 1e-9) * 2.0 ** -50                        # cell numbers stay exact
    h = max(ext["qa"][1] - ext["qa"][0], ext["qv"][1] - ext["qv"][0], least) / max(1, int((ext["n"] / k) ** 0.5))
    while h > 2 * least:
        cells = pts.groupBy(_cell("a", h).alias("cx"), _cell("v", h).alias("cy")).agg(F.count(F.lit(1)).cast("double").alias("c"))
        if cells.agg(F.sum(F.col("c") * F.col("c")) / F.sum("c")).first()[0] <= FULL_CELL * (k + 1):
            break
        h /= 2
    return max(h, least)


def _stable(df: DataFrame) -> DataFrame:
    """Checkpoint a small per-seed table into the shared checkpoint folder (cuts round lineage)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
