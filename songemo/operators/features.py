"""Frame table -> one feature row per song.

Means are ``avg`` over NaN-nullified values (``avg`` alone turns NaN into
the result).  Band variance needs the per-band means first; it is computed
from 26 partial ``avg`` aggregates and then plain arithmetic across the band
columns (mean first, then squared deviations), so frames are never exploded and a song with a third of all frames is
still combined map-side before the shuffle.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    BAND_MAX_INDEX,
    BAND_PREFIX,
    BAND_SUFFIX,
    FRAME_MEASURES,
    MINIMAL_FEATURES,
    RICH_FEATURES,
)
from ..functions.scalars import nan_to_null

def _null_d() -> Column:
    return F.lit(None).cast("double")


_BAND = re.compile(re.escape(BAND_PREFIX) + r"([0-9]{1,9})\]" + re.escape(BAND_SUFFIX))


def band_columns(columns: list[str]) -> list[str]:
    """Names audSpec_Rfilt_sma[i]_amean with digit-only i in 0..25, sorted by i."""
    bands = {c: int(m[1]) for c in columns if (m := _BAND.fullmatch(c)) and int(m[1]) <= BAND_MAX_INDEX}
    return sorted(bands, key=bands.get)


def with_sample_variance(df: DataFrame, cols: list[str], out: str) -> DataFrame:
    """Add ``out`` = sample variance (ddof 1) of the non-NULL values of ``cols`` (< 2 values: NULL).

    Two projections (count and mean first), so the mean is computed once per
    row; plain arithmetic that whole-stage codegen compiles."""
    n = " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols)
    total = "0.0D" + "".join(f" + coalesce({c}, 0.0D)" for c in cols)
    staged = df.selectExpr("*", f"({n}) AS _vn",
                           f"CASE WHEN ({n}) > 0 THEN ({total}) / CAST(({n}) AS DOUBLE) END AS _vmean")
    ss = "0.0D" + "".join(f" + CASE WHEN {c} IS NULL THEN 0.0D ELSE ({c} - _vmean) * ({c} - _vmean) END"
                         for c in cols)
    return staged.selectExpr("*", f"CASE WHEN _vn >= 2 THEN ({ss}) / CAST(_vn - 1 AS DOUBLE) END AS `{out}`").drop(
        "_vn", "_vmean")


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def song_features(frames: DataFrame, rich: bool = True, measures: dict[str, str] | None = None,
                  bands: list[str] | None = None, id_col: str = "song_id") -> DataFrame:
    """Per-song means of the frame measures plus the band variance.

    rich:    song_id + the 10 acoustic features.
    minimal: song_id, tempo (NULL), spectral_centroid, energy, mfcc_coef1,
             auditory_band_variance.
    ``measures`` maps feature -> frame column (default: the acoustic file
    names); an absent column gives NULL.  ``bands`` defaults to the band
    columns found by name.
    """
    measures = dict(FRAME_MEASURES if measures is None else measures)
    present = {f: c for f, c in measures.items() if c in frames.columns}
    bands = band_columns(frames.columns) if bands is None else [b for b in bands if b in frames.columns]
    aggs = [F.avg(nan_to_null(_q(c))).alias(f) for f, c in present.items()]
    aggs += [F.avg(nan_to_null(_q(b))).alias(f"_band{i}") for i, b in enumerate(bands)]
    if not aggs:
        aggs = [F.count(F.lit(1)).alias("_n")]
    # group on the key as stored (a numeric id hashes cheaper); cast after aggregating
    g = frames.groupBy(F.col(id_col).alias("_sid")).agg(*aggs).withColumn("song_id", F.col("_sid").cast("string"))
    if bands:
        g = with_sample_variance(g, [f"_band{i}" for i in range(len(bands))], "_bandvar")
    bv = F.col("_bandvar") if bands else _null_d()
    cols = {f: (F.col(f) if f in present else _null_d()) for f in FRAME_MEASURES}
    cols["auditory_band_variance"] = bv
    cols["tempo"] = _null_d()
    order = RICH_FEATURES if rich else MINIMAL_FEATURES
    return g.select("song_id", *[cols[f].alias(f) for f in order])


def band_variance(frames: DataFrame, id_col: str = "song_id") -> DataFrame:
    """(song_id, auditory_band_variance, n_bands) over the band columns that are found by name."""
    bands = band_columns(frames.columns)
    cols = [f"_b{i}" for i in range(len(bands))]
    g = frames.groupBy(F.col(id_col).alias("song_id")).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.avg(nan_to_null(_q(b))).alias(c) for b, c in zip(bands, cols)])
    if not bands:
        return g.select("song_id", _null_d().alias("auditory_band_variance"), F.lit(0).alias("n_bands"))
    g = with_sample_variance(g, cols, "auditory_band_variance")
    return g.selectExpr("song_id", "auditory_band_variance",
                        " + ".join(f"CASE WHEN {c} IS NULL THEN 0 ELSE 1 END" for c in cols) + " AS n_bands")
