"""Audio-derived song attributes computed from frame tables.

Decoding audio and computing spectra are per-file library work and are not
part of this engine; their outputs arrive as tables:
``chroma_frames(song_id, method, frame_idx, chroma ARRAY<DOUBLE>[12])`` and
``onsets(song_id, ts, onset_id)``.  From those, everything is Spark work:
chroma sums are 12 partial ``sum`` aggregates per (song, method); the method
fallback is a ``min_by``; key estimation is plain per-row arithmetic against
24 literal templates; middle segments and inter-onset gaps use the
skew-safe ordering in ``ordered``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import CHROMA_METHODS, DEFAULT
from ..functions.keys import with_key_estimate
from .ordered import lag, position
from .quantiles import grouped_median


def chroma_sums(frames: DataFrame, id_col: str = "song_id", method_col: str = "method",
                chroma_col: str = "chroma") -> DataFrame:
    """(song_id, method, chroma ARRAY<DOUBLE>[12], n_frames, usable) summed over time.

    usable: every frame has 12 bins and some summed bin is > 0 (NaN, which Spark
    orders above every number, is not).
    """
    c = F.col(chroma_col)
    aggs = [F.sum(F.try_element_at(c, F.lit(i + 1)).cast("double")).alias(f"_s{i}") for i in range(12)]
    aggs += [F.count(F.lit(1)).alias("n_frames"), F.count_if(F.size(c) != 12).alias("_bad")]
    g = frames.groupBy(F.col(id_col).alias("song_id"), F.col(method_col).alias("method")).agg(*aggs)
    vec = F.array(*[F.col(f"_s{i}") for i in range(12)])
    usable = (F.col("_bad") == 0) & F.exists(vec, lambda x: ~F.isnan(x) & (x > 0))
    return g.select("song_id", "method", vec.alias("chroma"), "n_frames", usable.alias("usable"))


def method_rank(method: F.Column, methods: tuple[str, ...] = CHROMA_METHODS) -> F.Column:
    return F.array_position(F.array(*[F.lit(m) for m in methods]), method)


def first_usable_chroma(sums: DataFrame, methods: tuple[str, ...] = CHROMA_METHODS) -> DataFrame:
    """(song_id, method, chroma): per song the first usable method in fallback order."""
    ok = sums.filter(F.col("usable") & F.col("method").isin(*methods))
    best = F.min_by(F.struct("method", "chroma"), method_rank(F.col("method"), methods))
    return ok.groupBy("song_id").agg(best.alias("_b")).select("song_id", "_b.method", "_b.chroma")


def song_keys(frames: DataFrame, songs: DataFrame | None = None) -> DataFrame:
    """(song_id, method, key, score, margin); songs without usable chroma get 'unknown'."""
    chosen = first_usable_chroma(chroma_sums(frames))
    out = with_key_estimate(chosen).select("song_id", "method", "key", "score", "margin")
    if songs is not None:
        out = songs.select(F.col("song_id").cast("string")).distinct().join(out, "song_id", "left").withColumn(
            "key", F.coalesce(F.col("key"), F.lit("unknown")))
    return out


def middle_segment(frames: DataFrame, frame_rate_hz: float = DEFAULT.frame_rate_hz,
                   min_seconds: float = DEFAULT.middle_min_seconds, id_col: str = "song_id",
                   order_col: str = "frame_idx", tie_break: str | None = None,
                   dense_index: bool = False) -> DataFrame:
    """Frames of the middle half [n//4, 3n//4) for songs of at least ``min_seconds``; all frames otherwise.

    ``dense_index=True`` declares that ``order_col`` numbers each song's frames
    0..n-1 (how a framer writes them); the position is then the index itself
    and only a per-song count is needed (an aggregate and a join, no range
    shuffle).  Otherwise positions come from ``ordered.position``.
    """
    if dense_index:
        n_tab = frames.groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
        p = frames.join(n_tab, id_col).withColumn("_pos", F.col(order_col))
        n = F.col("_n")
        long_song = n >= F.lit(frame_rate_hz * min_seconds)
        keep = ~long_song | ((F.col("_pos") >= F.floor(n / 4)) & (F.col("_pos") < F.floor(n * 3 / 4)))
        return p.filter(keep).drop("_pos", "_n")
    order = [order_col] + ([tie_break] if tie_break else [])
    p = position(frames, id_col, order)
    n = F.col("_n")
    long_song = n >= F.lit(frame_rate_hz * min_seconds)
    keep = ~long_song | ((F.col("_pos") >= F.floor(n / 4)) & (F.col("_pos") < F.floor(n * 3 / 4)))
    return p.filter(keep).drop("_pos", "_n")


def clip_first_seconds(onsets: DataFrame, seconds: float = DEFAULT.clip_seconds, id_col: str = "song_id",
                       ts_col: str = "ts") -> DataFrame:
    """Rows within the first ``seconds`` after each song's first timestamp."""
    first = onsets.groupBy(id_col).agg(F.min(ts_col).alias("_t0"))
    j = onsets.join(first, id_col)
    return j.filter(F.col(ts_col) < F.col("_t0") + F.make_dt_interval(secs=F.lit(seconds))).drop("_t0")


def tempo_from_onsets(onsets: DataFrame, id_col: str = "song_id", ts_col: str = "ts",
                      tie_break: str = "onset_id") -> DataFrame:
    """(song_id, n_onsets, median_gap_s, tempo_bpm): 60 / median inter-onset gap.

    Fewer than two onsets, or a zero median gap, give NULL tempo.  The
    median is exact and bounded per task also for a hot song (``quantiles``).
    """
    pairs = lag(onsets, id_col, [ts_col, tie_break], [ts_col])
    gap = (F.unix_micros(F.col(ts_col)) - F.unix_micros(F.col(f"prev_{ts_col}"))) / F.lit(1e6)
    counts = pairs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_onsets"))
    med = grouped_median(pairs, id_col, gap).withColumnRenamed("median", "median_gap_s")
    g = counts.join(med, id_col, "left")
    return g.select(F.col(id_col).alias("song_id"), "n_onsets", "median_gap_s",
                    F.try_divide(F.lit(60.0), F.col("median_gap_s")).alias("tempo_bpm"))
