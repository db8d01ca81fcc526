"""Mood tags derived from (arousal, valence) as native column expressions.

Every tag is a plain comparison, so a filter on one tag stays a pushed-down
parquet predicate and runs inside whole-stage codegen; no Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import TAG_ORDER, Thresholds

_INF = float("inf")


def finite(c: Column) -> Column:
    """True for a real number: not NULL, not NaN, not +/-inf.

    Spark orders NaN above every number (``NaN >= 6`` is true), so every tag
    predicate is guarded by this.
    """
    return c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(_INF))


def tag_predicates(arousal: Column, valence: Column, t: Thresholds = Thresholds()) -> dict[str, Column]:
    """One boolean column per tag, keyed by tag name, canonical order."""
    ok = finite(arousal) & finite(valence)
    hi = arousal >= F.lit(t.arousal_high)
    lo = arousal <= F.lit(t.arousal_low)
    pos = valence >= F.lit(t.valence_positive)
    neg = valence <= F.lit(t.valence_negative)
    return {
        "High Energy": ok & hi,
        "Low Energy": ok & lo,
        "Positive": ok & pos,
        "Negative": ok & neg,
        "Calm Focus": ok & lo & (valence >= F.lit(t.valence_calm_focus_min)),
        "Dramatic": ok & hi & neg,
        "Neutral": ok
        & (arousal > F.lit(t.arousal_low))
        & (arousal < F.lit(t.arousal_high))
        & (valence > F.lit(t.valence_negative))
        & (valence < F.lit(t.valence_positive)),
    }


def tag_predicate(tag: str, arousal: Column, valence: Column, t: Thresholds = Thresholds()) -> Column:
    """Predicate for one tag; an unknown tag matches nothing."""
    preds = tag_predicates(arousal, valence, t)
    return preds.get(tag, F.lit(False))


def tags(arousal: Column, valence: Column, t: Thresholds = Thresholds()) -> Column:
    """ARRAY<STRING> of the point's tags in canonical order ([] if not finite)."""
    preds = tag_predicates(arousal, valence, t)
    return F.array_compact(F.array(*[F.when(preds[name], F.lit(name)) for name in TAG_ORDER]))


def list_tags() -> list[str]:
    return list(TAG_ORDER)
