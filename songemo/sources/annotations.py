"""Mood annotation files: song-level static tables and per-second dynamic matrices.

Static files are read as text; per file the delimiter is sniffed and the id /
arousal / valence columns are found by alias (exact names in order, then the
first name containing the word), all as Spark expressions on the header.
Dynamic matrices are unpivoted into long form so that row / column means are
ordinary aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import AROUSAL_ALIASES, ID_ALIASES, VALENCE_ALIASES
from ..functions.scalars import nan_to_null, strip, to_numeric_or_null
from ..operators import labels as L
from .files import matches
from .text_tables import _unquote as unquote
from .text_tables import read_text_by_header

SONG_LEVEL_SUBDIR = "annotations averaged per song/song_level"
DYNAMIC_SUBDIR = "annotations averaged per song/dynamic (per second annotations)"
STATIC_GLOB = "static_annotations_averaged_songs_*.csv"


def _role_position(names: Column, aliases: tuple[str, ...], word: str, is_id: bool) -> Column:
    """1-based position of the role's column in a header array; 0 if none."""
    exact = [F.array_position(names, F.lit(a)) for a in aliases]
    if is_id:
        fuzzy = F.array_position(F.transform(names, lambda c: F.lower(c).contains(word) | (F.lower(c) == "id")),
                                 F.lit(True))
    else:
        fuzzy = F.array_position(F.transform(names, lambda c: F.lower(c).contains(word)), F.lit(True))
    out = fuzzy
    for e in reversed(exact):
        out = F.when(e > 0, e).otherwise(out)
    return out.cast("int")


def static_rows(spark: SparkSession, annotations_dir: str) -> DataFrame | None:
    """(file_name, line_no, song_id, arousal, valence) text rows of the static files, or None."""
    pattern = f"{annotations_dir.rstrip('/')}/{SONG_LEVEL_SUBDIR}/{STATIC_GLOB}"
    if not matches(spark, pattern):
        return None
    h, data = read_text_by_header(spark, pattern, sep=None)
    h = h.select("path", _role_position(F.col("names"), ID_ALIASES, "song", True).alias("p_id"),
                 _role_position(F.col("names"), AROUSAL_ALIASES, "arousal", False).alias("p_a"),
                 _role_position(F.col("names"), VALENCE_ALIASES, "valence", False).alias("p_v"))
    h = h.filter((F.col("p_id") > 0) & (F.col("p_a") > 0) & (F.col("p_v") > 0))  # files lacking a role: skipped
    j = data.join(h, "path")
    cell = lambda p: unquote(F.try_element_at(F.col("cells"), F.col(p)))
    return j.select(F.col("path").alias("file_name"), F.col("line_key").alias("line_no"),
                    cell("p_id").alias("song_id"), cell("p_a").alias("arousal"), cell("p_v").alias("valence"))


def static_labels(spark: SparkSession, annotations_dir: str) -> DataFrame | None:
    rows = static_rows(spark, annotations_dir)
    return None if rows is None else L.static_labels(rows)


def _long(h: DataFrame, data: DataFrame) -> DataFrame:
    """Unpivot a matrix file: (path, line_key, pos, name, first, value) for every cell after the first."""
    j = data.join(h, "path")
    cells = F.arrays_zip(F.col("names"), F.col("cells"))
    return j.select("path", "line_key", unquote(F.element_at("cells", 1)).alias("first"),
                    F.posexplode(cells).alias("pos", "nc")).filter("pos > 0").select(
        "path", "line_key", "first", "pos", F.col("nc.names").alias("name"),
        to_numeric_or_null(unquote(F.col("nc.cells"))).alias("value"))


def dynamic_labels(spark: SparkSession, annotations_dir: str) -> DataFrame | None:
    """Per-song means of the per-second matrices (both files needed, >= 2 columns each).

    Layout: if the first header cell contains 'time' / 'segment' or is '0' / '1',
    columns are songs (column means; valence matched by column name when
    every arousal song is present in it, else by position); otherwise rows
    are songs (row means; ids present in both files).  Deviation: the
    delimiter is sniffed per file here too.
    """
    pa, pv = (f"{annotations_dir.rstrip('/')}/{DYNAMIC_SUBDIR}/{n}.csv" for n in ("arousal", "valence"))
    if not (matches(spark, pa) and matches(spark, pv)):
        return None
    ha, da = read_text_by_header(spark, pa, sep=None)
    hv, dv = read_text_by_header(spark, pv, sep=None)
    na, nv = ha.first()["names"], hv.first()["names"]   # two header rows (metadata only)
    if len(na) < 2 or len(nv) < 2:
        return None
    first = na[0].lower()
    la, lv = _long(ha, da), _long(hv, dv)
    if "time" in first or "segment" in first or first in ("0", "1"):
        by_name = all(c in nv for c in na[1:])
        if not by_name and len(na) != len(nv):
            raise ValueError("Dynamic arousal / valence files differ in song columns and in count")
        key = "name" if by_name else "pos"
        a = la.groupBy("pos", "name").agg(F.avg(nan_to_null(F.col("value"))).alias("arousal"))
        v = lv.groupBy(key).agg(F.avg(nan_to_null(F.col("value"))).alias("valence"))
        out = a.join(v, key, "inner").select(strip(F.col("name")).alias("song_id"),
                                                                  "arousal", "valence")
    else:
        a = la.groupBy(F.col("first").alias("_id")).agg(F.avg(nan_to_null(F.col("value"))).alias("arousal"))
        v = lv.groupBy(F.col("first").alias("_id")).agg(F.avg(nan_to_null(F.col("value"))).alias("valence"))
        out = a.join(v, "_id", "inner").select(strip(F.col("_id")).alias("song_id"), "arousal", "valence")
    return L.drop_missing_targets(out)


def load_labels(spark: SparkSession, annotations_dir: str) -> DataFrame:
    """Static labels unless absent or empty, else dynamic; neither -> FileNotFoundError."""
    static = static_labels(spark, annotations_dir)
    if static is not None and not static.isEmpty():
        return static                               # the dynamic files are not opened
    return L.prefer_static(None, dynamic_labels(spark, annotations_dir))
