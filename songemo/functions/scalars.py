"""Small scalar helpers: numeric coercion, id cleanup, rounding, buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TEMPO_BUCKET_TOP, TEMPO_BUCKETS, UNKNOWN_LABEL


def nan_to_null(c: Column) -> Column:
    """NaN becomes NULL so that avg / var / median skip it."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def to_numeric_or_null(c: Column) -> Column:
    """Text -> DOUBLE; unparsable text, NaN and NULL give NULL.

    try_cast: with ANSI on, a plain cast of 'abc' raises.
    """
    return nan_to_null(strip(c.cast("string")).try_cast("double"))


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace (not only spaces)."""
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def round3(c: Column) -> Column:
    """Display rounding, half-to-even like numpy."""
    return F.bround(c, 3)


def tempo_bucket(bpm: Column) -> Column:
    """BPM -> tempo bucket label; NULL or NaN -> 'Unknown'."""
    out = F.lit(TEMPO_BUCKET_TOP)
    for upper, label in reversed(TEMPO_BUCKETS):
        out = F.when(bpm < F.lit(upper), F.lit(label)).otherwise(out)
    return F.when(bpm.isNull() | F.isnan(bpm), F.lit(UNKNOWN_LABEL)).otherwise(out)


def impute(c: Column, fill: Column) -> Column:
    """Replace NULL / NaN by ``fill`` (e.g. a training median)."""
    return F.coalesce(nan_to_null(c), fill)


def song_id_from_path(path: Column) -> Column:
    """File stem: last path element without its last suffix ('a.b.csv' -> 'a.b')."""
    name = F.regexp_extract(F.url_decode(path), r"([^/]+)$", 1)
    # a leading dot is part of the name, not a suffix (".hidden" stays)
    return F.regexp_replace(name, r"(?<=.)\.[^.]*$", "")
