"""Tag-based table operators: tag, filter, count, match-count, top-k.

All are single-scan expressions.  Counting uses one aggregate with a
``count_if`` per tag (partial aggregation, one row shuffled per map task),
instead of one scan per tag.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..config import TAG_ORDER, Thresholds
from ..functions.tags import tag_predicate, tag_predicates, tags

AROUSAL = "predicted_arousal"
VALENCE = "predicted_valence"


def filter_by_tag(df: DataFrame, tag: str, arousal: str = AROUSAL, valence: str = VALENCE,
                  t: Thresholds = Thresholds()) -> DataFrame:
    """Rows carrying ``tag``; all columns kept.  Unknown tag -> empty, same schema.

    The predicate is a plain comparison, so it reaches the parquet scan as a
    pushed filter; for an unknown tag Catalyst prunes the scan entirely.
    """
    if tag not in TAG_ORDER:
        return df.filter(F.lit(False))
    return df.filter(tag_predicate(tag, F.col(arousal), F.col(valence), t))


def tag_counts(df: DataFrame, arousal: str = AROUSAL, valence: str = VALENCE,
               t: Thresholds = Thresholds()) -> DataFrame:
    """(tag_order, tag, n_songs): rows per tag, canonical order, zero counts kept."""
    preds = tag_predicates(F.col(arousal), F.col(valence), t)
    agg = df.agg(*[F.count_if(preds[name]).alias(f"_c{i}") for i, name in enumerate(TAG_ORDER)])
    rows = F.array(*[
        F.struct(F.lit(i + 1).cast("int").alias("tag_order"), F.lit(name).alias("tag"),
                 F.col(f"_c{i}").cast("bigint").alias("n_songs"))
        for i, name in enumerate(TAG_ORDER)
    ])
    return agg.select(F.inline(rows))


def match_counts_for(df: DataFrame, requested: list[str], id_col: str = "song_id", arousal: str = AROUSAL,
                     valence: str = VALENCE, t: Thresholds = Thresholds()) -> DataFrame:
    """(song_id, match_count) for songs matching at least one requested tag (codegen'd sum of predicates).

    A duplicated song row counts again (sum per song); the sum combines map-side."""
    preds = tag_predicates(F.col(arousal), F.col(valence), t)
    n = sum((F.when(preds[tag], 1).otherwise(0) for tag in requested if tag in preds), F.lit(0))
    return (df.select(F.col(id_col).alias("song_id"), n.alias("_n")).filter(F.col("_n") > 0)
            .groupBy("song_id").agg(F.sum("_n").cast("bigint").alias("match_count")))


def union_ids(df: DataFrame, requested: list[str], id_col: str = "song_id", arousal: str = AROUSAL,
              valence: str = VALENCE, t: Thresholds = Thresholds()) -> DataFrame:
    """Distinct ids matching any requested tag, written as a UNION DISTINCT."""
    parts = [filter_by_tag(df, tag, arousal, valence, t).select(F.col(id_col).alias("song_id"))
             for tag in requested]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out.distinct()


def top_k(df: DataFrame, k: int, score: str = "match_count", id_col: str = "song_id") -> DataFrame:
    """k rows by score desc, then id ascending (string order); adds ``rank``.

    orderBy + limit plans as TakeOrderedAndProject: every task keeps its own
    top k and only k rows per task reach the final merge.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    best = df.orderBy(F.desc(score), F.asc(id_col)).limit(k)
    # numbering k rows in one partition is bounded by k
    w = Window.orderBy(F.desc(score), F.asc(id_col))
    return best.withColumn("rank", F.row_number().over(w))


def head_by(df: DataFrame, n: int, order_col: str = "song_id") -> DataFrame:
    """First n rows in an explicit order (deterministic ``head``)."""
    return df.orderBy(order_col).limit(n)
