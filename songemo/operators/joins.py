"""Song-keyed equi-joins: enrich features, build the modeling set, map metadata.

Both sides are keyed by song_id and pruned to the needed columns before the
join.  The join strategy is left to AQE: a small side is broadcast at run
time from measured sizes, a large one goes through a sort-merge join whose
skewed partitions AQE splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import KEY_DERIVED, MAP_METADATA, RICH_FEATURES
from ..functions.keys import add_key_columns


def _sid(df: DataFrame, id_col: str = "song_id") -> DataFrame:
    return df.withColumn(id_col, F.col(id_col).cast("string"))


def enrich(features: DataFrame, audio: DataFrame) -> DataFrame:
    """Left join audio-derived (tempo_bpm, key) onto every feature song.

    genre is 'unknown'; missing key -> 'unknown'; tempo stays NULL; parsed
    key columns are added.  A song id present twice in ``audio`` fans out.
    """
    a = _sid(audio).select("song_id", "tempo_bpm", "key", F.lit("unknown").alias("genre"))
    m = _sid(features).join(a, "song_id", "left")
    m = m.withColumns({
        "genre": F.coalesce(F.col("genre"), F.lit("unknown")),
        "key": F.coalesce(F.col("key"), F.lit("unknown")),
        "tempo_bpm": F.col("tempo_bpm").cast("double"),
    })
    m = add_key_columns(m, "key")
    return m.select("song_id", *RICH_FEATURES, "tempo_bpm", "genre", "key", *KEY_DERIVED)


def modeling_dataset(features: DataFrame, labels: DataFrame) -> DataFrame:
    """Inner join of every feature column with (arousal, valence)."""
    lab = _sid(labels).select("song_id", "arousal", "valence")
    return _sid(features).join(lab, "song_id", "inner")


def map_base(predictions: DataFrame, song_features: DataFrame | None) -> DataFrame:
    """Predictions left-joined with the metadata columns present in song_features."""
    p = _sid(predictions)
    if song_features is None:
        return p
    extra = [c for c in MAP_METADATA if c in song_features.columns]
    if not extra:
        return p
    return p.join(_sid(song_features).select("song_id", *extra), "song_id", "left")
