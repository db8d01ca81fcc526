"""Emotion-map views: filtered points, extent, counts, colour groups, table.

The view's extent (min/max of both axes) is one aggregate used as a scalar
subquery, so points are labelled by quadrant without a join against it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    COLOR_BY_OPTIONS,
    QUADRANT_HIGH_AROUSAL_HIGH_VALENCE,
    QUADRANT_HIGH_AROUSAL_LOW_VALENCE,
    QUADRANT_LOW_AROUSAL_HIGH_VALENCE,
    QUADRANT_LOW_AROUSAL_LOW_VALENCE,
    TABLE_VIEW_METADATA,
    UNKNOWN_LABEL,
)
from ..functions.scalars import nan_to_null, round3, tempo_bucket
from .joins import map_base

A, V = "predicted_arousal", "predicted_valence"


def with_tempo_bucket(df: DataFrame) -> DataFrame:
    if "tempo_bpm" not in df.columns:
        return df
    return df.withColumn("tempo_bucket", tempo_bucket(F.col("tempo_bpm")))


def map_table(predictions: DataFrame, song_features: DataFrame | None) -> DataFrame:
    """Predictions + metadata + tempo bucket (the map's base table)."""
    return with_tempo_bucket(map_base(predictions, song_features))


def range_filter(df: DataFrame, arousal_range: tuple[float, float] | None,
                 valence_range: tuple[float, float] | None) -> DataFrame:
    """Rows inside both inclusive ranges (NULL / NaN never inside); None = no filter."""
    cond = F.lit(True)
    if arousal_range is not None:
        a = nan_to_null(F.col(A))
        cond = cond & a.between(F.lit(arousal_range[0]), F.lit(arousal_range[1]))
    if valence_range is not None:
        v = nan_to_null(F.col(V))
        cond = cond & v.between(F.lit(valence_range[0]), F.lit(valence_range[1]))
    return df.filter(F.coalesce(cond, F.lit(False)))


def extent(df: DataFrame, ui_rounding: bool = False) -> DataFrame:
    """One row: min/max of both axes (NaN skipped), slider step, padding and midpoints.

    ``ui_rounding`` rounds the bounds to 2 decimals, as a slider shows them (the
    extreme rows may then lie outside); step, padding and midpoints stay exact.
    """
    a, v = nan_to_null(F.col(A)), nan_to_null(F.col(V))
    g = df.agg(F.min(a).alias("arousal_min"), F.max(a).alias("arousal_max"),
               F.min(v).alias("valence_min"), F.max(v).alias("valence_max"))

    def pad(lo: str, hi: str) -> Column:
        p = (F.col(hi) - F.col(lo)) * 0.05
        return F.when(p == 0, F.lit(0.3)).otherwise(p)

    bounds = ["arousal_min", "arousal_max", "valence_min", "valence_max"]
    return g.select(
        *[F.bround(F.col(c), 2).alias(c) if ui_rounding else F.col(c) for c in bounds],
        F.bround((F.col("arousal_max") - F.col("arousal_min")) / 100, 3).alias("arousal_step"),
        F.bround((F.col("valence_max") - F.col("valence_min")) / 100, 3).alias("valence_step"),
        pad("arousal_min", "arousal_max").alias("arousal_pad"),
        pad("valence_min", "valence_max").alias("valence_pad"),
        ((F.col("arousal_min") + F.col("arousal_max")) / 2).alias("arousal_mid"),
        ((F.col("valence_min") + F.col("valence_max")) / 2).alias("valence_mid"),
    )


def quadrant(valence: Column, arousal: Column, valence_mid: Column, arousal_mid: Column) -> Column:
    """Quadrant label; a coordinate at or above the midpoint counts as high."""
    hi_a, hi_v = arousal >= arousal_mid, valence >= valence_mid
    return (F.when(hi_a & ~hi_v, F.lit(QUADRANT_HIGH_AROUSAL_LOW_VALENCE))
            .when(hi_a & hi_v, F.lit(QUADRANT_HIGH_AROUSAL_HIGH_VALENCE))
            .when(~hi_a & ~hi_v, F.lit(QUADRANT_LOW_AROUSAL_LOW_VALENCE))
            .when(~hi_a & hi_v, F.lit(QUADRANT_LOW_AROUSAL_HIGH_VALENCE)))


def with_quadrants(df: DataFrame) -> DataFrame:
    """Add ``quadrant`` split at the midpoints of this (filtered) table's extent."""
    ext = extent(df)
    mids = ext.select(F.struct("arousal_mid", "valence_mid")).scalar()
    return df.withColumn("quadrant", quadrant(F.col(V), F.col(A), mids.getField("valence_mid"),
                                              mids.getField("arousal_mid")))


def color_group(df: DataFrame, color_by: str | None) -> Column:
    """Colour group column; NULL -> 'Unknown'; unsupported or absent option -> NULL."""
    if color_by in COLOR_BY_OPTIONS and color_by in df.columns:
        return F.coalesce(F.col(color_by).cast("string"), F.lit(UNKNOWN_LABEL))
    return F.lit(None).cast("string")


def color_groups(df: DataFrame, color_by: str) -> DataFrame:
    """(color_group, n_songs) sorted by name."""
    g = color_group(df, color_by)
    return df.groupBy(g.alias("color_group")).agg(F.count(F.lit(1)).alias("n_songs")).orderBy("color_group")


def map_points(df: DataFrame, color_by: str | None, arousal_range=None, valence_range=None) -> DataFrame:
    """(song_id, valence, arousal, color_group, quadrant) of the points in view."""
    f = range_filter(df, arousal_range, valence_range)
    # points without finite coordinates are never drawn (the default sliders
    # span the finite extent)
    f = f.filter(nan_to_null(F.col(A)).isNotNull() & nan_to_null(F.col(V)).isNotNull())
    q = with_quadrants(f)
    return q.select("song_id", F.col(V).alias("valence"), F.col(A).alias("arousal"),
                    color_group(q, color_by).alias("color_group"), "quadrant")


def count_in_view(df: DataFrame, arousal_range=None, valence_range=None) -> DataFrame:
    """(n_shown, n_total, text) with comma-grouped numbers, one scan."""
    a, v = nan_to_null(F.col(A)), nan_to_null(F.col(V))
    cond = F.lit(True)
    if arousal_range is not None:
        cond = cond & a.between(F.lit(arousal_range[0]), F.lit(arousal_range[1]))
    if valence_range is not None:
        cond = cond & v.between(F.lit(valence_range[0]), F.lit(valence_range[1]))
    g = df.agg(F.count_if(F.coalesce(cond, F.lit(False))).alias("n_shown"), F.count(F.lit(1)).alias("n_total"))
    text = F.concat(F.lit("Showing "), F.format_number("n_shown", 0), F.lit(" of "),
                    F.format_number("n_total", 0), F.lit(" songs"))
    return g.select("n_shown", "n_total", text.alias("text"))


def song_table(df: DataFrame, arousal_range=None, valence_range=None) -> DataFrame:
    """Id, predictions at 3 decimals (half-even), then present metadata in fixed order."""
    f = range_filter(df, arousal_range, valence_range)
    extra = [c for c in TABLE_VIEW_METADATA if c in f.columns]
    return f.select("song_id", round3(F.col(A)).alias(A), round3(F.col(V)).alias(V), *extra)
