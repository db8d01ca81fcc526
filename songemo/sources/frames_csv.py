"""Per-song acoustic frame files (one ';'-separated CSV per song) -> frames table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

from ..config import BAND_MAX_INDEX, BAND_PREFIX, BAND_SUFFIX, FRAME_MEASURES
from .text_tables import read_by_header

BAND_NAMES = [f"{BAND_PREFIX}{i}]{BAND_SUFFIX}" for i in range(BAND_MAX_INDEX + 1)]


def scan_frames(spark: SparkSession, directory: str, sep: str = ";") -> DataFrame:
    """frames(song_id, path, line_key, <measure and band columns>) from ``directory/*.csv``.

    Non-recursive.  Columns are bound by header name in every file; a
    missing column is NULL; non-numeric cells are NULL (deviation: the
    original run failed on them); a header-only file gives one all-NULL row.
    """
    if not os.path.isdir(directory) and "://" not in directory:
        raise FileNotFoundError(f"Features directory not found: {directory}")
    wanted = list(FRAME_MEASURES.values()) + BAND_NAMES
    return read_by_header(spark, os.path.join(directory, "*.csv"), wanted, sep=sep)
