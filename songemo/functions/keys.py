"""Musical key: parse key strings, and estimate a key from a chroma vector.

Both are native expressions.  Key estimation scores the 12-bin chroma
against 24 rotated key profiles whose numbers are literals in generated SQL
arithmetic (``with_key_estimate``), so there is no join, no broadcast, no
Python per row, and whole-stage codegen compiles it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MAJOR_PROFILE, MINOR_PROFILE, NORM_EPS, PITCH_NAMES, UNKNOWN_LABEL

VALID_NOTES = ("A", "B", "C", "D", "E", "F", "G")


def _strip(c: Column) -> Column:
    # SQL trim() removes spaces only; the parser strips any whitespace.
    return F.regexp_replace(F.regexp_replace(c, r"^\s+", ""), r"\s+$", "")


def parse_key(key: Column) -> Column:
    """STRUCT<key_note, key_mode, key_signature> from strings like 'F# minor'.

    NULL, empty, blank and 'unknown' (any case) give (Unknown, major, natural).
    The root is split off at the first whitespace run; the mode is minor iff
    the rest contains 'minor'; a root ending in '#' is sharp, in lower-case
    'b' flat; the note must be one letter A-G, else Unknown.
    """
    s = _strip(key)
    parts = F.split(s, r"\s+", 2)
    root = F.element_at(parts, 1)
    rest = F.coalesce(F.try_element_at(parts, F.lit(2)), F.lit(""))
    mode = F.when(F.lower(rest).contains("minor"), F.lit("minor")).otherwise(F.lit("major"))
    sig = (
        F.when(root.endswith("#"), F.lit("sharp"))
        .when(root.endswith("b"), F.lit("flat"))
        .otherwise(F.lit("natural"))
    )
    # root without its accidental (length - 1 characters)
    head = F.when(sig == "natural", root).otherwise(F.left(root, F.length(root) - F.lit(1)))
    note = F.upper(_strip(head))
    note = F.when(note.isin(*VALID_NOTES), note).otherwise(F.lit(UNKNOWN_LABEL))
    unknown = key.isNull() | (s == "") | (F.lower(s) == "unknown")
    return (
        F.when(unknown, F.struct(F.lit(UNKNOWN_LABEL).alias("key_note"), F.lit("major").alias("key_mode"),
                                 F.lit("natural").alias("key_signature")))
        .otherwise(F.struct(note.alias("key_note"), mode.alias("key_mode"), sig.alias("key_signature")))
    )


def add_key_columns(df, key_col: str = "key"):
    """Add key_note, key_mode, key_signature, is_major; unchanged if no key column.

    is_major is True for Unknown keys as well (mode defaults to major).
    """
    if key_col not in df.columns:
        return df
    p = parse_key(F.col(key_col))
    return df.withColumns({
        "key_note": p.getField("key_note"),
        "key_mode": p.getField("key_mode"),
        "key_signature": p.getField("key_signature"),
        "is_major": p.getField("key_mode") == "major",
    })


# ----------------------------------------------------------------- estimation
def _unit(v: tuple[float, ...]) -> list[float]:
    n = math.sqrt(sum(x * x for x in v))
    return [x / (n + NORM_EPS) for x in v]


def key_templates() -> list[tuple[str, list[float]]]:
    """24 (name, unit profile rotated to the root) in scoring order.

    Order is shift 0..11 with major before minor, so with a strict maximum the
    earliest template wins ties.
    """
    maj, mnr = _unit(MAJOR_PROFILE), _unit(MINOR_PROFILE)
    out = []
    for shift in range(12):
        rot = lambda p: [p[(i - shift) % 12] for i in range(12)]
        out.append((f"{PITCH_NAMES[shift]} major", rot(maj)))
        out.append((f"{PITCH_NAMES[shift]} minor", rot(mnr)))
    return out


def _num(x: float) -> str:
    return repr(float(x)) + "D"


def with_key_estimate(df: DataFrame, chroma_col: str = "chroma", score_digits: int = 9) -> DataFrame:
    """Add key, score (best) and margin (lead over the runner-up).

    Plain arithmetic on 12 bin columns in staged projections (clean -> unit
    -> 24 scores), so whole-stage codegen compiles it; the expressions are
    generated as SQL text, a few calls instead of one per operator.
    """
    c = f"`{chroma_col}`"
    keep = [f"`{col}`" for col in df.columns]
    clean = [f"CASE WHEN try_element_at({c}, {i + 1}) IS NULL OR isnan(try_element_at({c}, {i + 1})) "
             f"OR abs(try_element_at({c}, {i + 1})) = double('inf') THEN 0D "
             f"ELSE CAST(try_element_at({c}, {i + 1}) AS DOUBLE) END AS _x{i}" for i in range(12)]
    s1 = df.selectExpr(*keep, *clean)
    norm = "sqrt(" + " + ".join(f"_x{i} * _x{i}" for i in range(12)) + ")"
    xs = ", ".join(f"_x{i}" for i in range(12))
    s2 = s1.selectExpr(*keep, *[f"_x{i}" for i in range(12)],
                       f"CASE WHEN {norm} < {_num(NORM_EPS)} THEN greatest({xs}) + {_num(NORM_EPS)} "
                       f"ELSE {norm} END AS _d",
                       f"({c} IS NOT NULL AND size({c}) = 12 AND greatest({xs}) > 0) AS _usable")
    s3 = s2.selectExpr(*keep, "_usable", *[f"_x{i} / _d AS _u{i}" for i in range(12)])
    scores = []
    for j, (_, prof) in enumerate(key_templates()):
        scores.append(" + ".join(f"_u{i} * {_num(prof[i])}" for i in range(12)) + f" AS _k{j}")
    s4 = s3.selectExpr(*keep, "_usable", *scores)
    ks = ", ".join(f"_k{j}" for j in range(24))
    rounded = ", ".join(f"round(_k{j}, {score_digits})" for j in range(24))
    names = ", ".join(f"'{n}'" for n, _ in key_templates())
    s5 = s4.selectExpr(*keep, "_usable", f"array({rounded}) AS _r", f"array_sort(array({ks})) AS _sorted")
    return s5.selectExpr(
        *keep,
        f"CASE WHEN _usable THEN element_at(array({names}), CAST(array_position(_r, array_max(_r)) AS INT)) "
        f"ELSE 'unknown' END AS key",
        "CASE WHEN _usable THEN element_at(_sorted, 24) END AS score",
        "CASE WHEN _usable THEN element_at(_sorted, 24) - element_at(_sorted, 23) END AS margin",
    )
