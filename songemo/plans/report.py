"""Final projections for reported results: stable names and types.

Reported doubles are rounded to 9 decimals so sums taken in a different
order (by another engine or another partitioning) print the same; integer
counts are BIGINT; arrays are joined with '|'.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DIGITS = 9
_EXACT = float(2 ** 52)  # beyond this every double is an integer


def round_binary(c, digits: int = DIGITS):
    """Round half away from zero on the binary value (x * 10^d, round, / 10^d).

    Spark's ``round`` rounds the shortest decimal text of the double instead,
    which differs on values that sit exactly on a tie in decimal but not in
    binary; this form gives the same double as C's round() based engines.
    """
    m = float(10 ** digits)
    y = c.cast("double") * F.lit(m)
    r = F.when(F.abs(y) < F.lit(_EXACT), F.signum(y) * F.floor(F.abs(y) + F.lit(0.5)).cast("double")).otherwise(y)
    return F.when(F.isnan(y), y).otherwise(r / F.lit(m))


def round_binary_sql(expr: str, digits: int = DIGITS) -> str:
    """SQL text of ``round_binary`` (one parse instead of a dozen Column calls)."""
    m = f"{float(10 ** digits)!r}D"
    y = f"(CAST({expr} AS DOUBLE) * {m})"
    # NaN is reported as NULL (the engine treats NaN as missing everywhere)
    return (f"CASE WHEN isnan({y}) THEN CAST(NULL AS DOUBLE) ELSE (CASE WHEN abs({y}) < {_EXACT!r}D "
            f"THEN signum({y}) * CAST(floor(abs({y}) + 0.5D) AS DOUBLE) ELSE {y} END) / {m} END")


def finalize(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles rounded (binary, 9 dp; NaN as NULL), small integers as BIGINT, arrays joined by '|'."""
    exprs = []
    for f in df.schema.fields:
        q = "`" + f.name.replace("`", "``") + "`"
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            e = round_binary_sql(q, digits)
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            e = f"CAST({q} AS BIGINT)"
        elif isinstance(f.dataType, T.ArrayType):
            e = f"array_join(CAST({q} AS ARRAY<STRING>), '|')"
        else:
            e = q
        exprs.append(f"{e} AS {q}")
    return df.selectExpr(*exprs)
