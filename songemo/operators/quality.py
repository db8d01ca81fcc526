"""Data-quality report: one aggregate pass per table -> report rows.

Every measure of a table (row count, duplicate keys, NULL counts, coverage,
out-of-range values) comes from a single ``agg`` plus one grouped count for
duplicates, then is turned into rows (table, check, level, value, message).
The report is tiny; the data is only scanned by Spark.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import RICH_FEATURES, SONG_FEATURE_COLUMNS, QualityLimits
from ..functions.scalars import strip

REPORT_SCHEMA = "table string, check string, level string, value double, message string"
NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def duplicate_count(df: DataFrame, key: str = "song_id") -> DataFrame:
    """One row: rows beyond the first per key (NULL is a key value)."""
    g = df.groupBy(F.col(key).alias("_k")).count()
    return g.agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("bigint").alias("duplicate_rows"))


def null_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column, n_null, pct_null) for columns with at least one NULL/NaN; pct at 1 dp."""
    def missing(c: str) -> Column:
        x = F.col(f"`{c}`")
        dt = df.schema[c].dataType
        return x.isNull() | F.isnan(x) if isinstance(dt, (T.FloatType, T.DoubleType)) else x.isNull()
    agg = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(missing(c)).alias(f"_m{i}") for i, c in enumerate(cols)])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").cast("bigint").alias("n_null"))
                     for i, c in enumerate(cols)])
    out = agg.select("_n", F.inline(rows)).filter(F.col("n_null") > 0)
    return out.select("column", "n_null",
                      F.round(F.col("n_null") * 100.0 / F.col("_n"), 1).alias("pct_null"))


def _key_known(key: Column) -> Column:
    # known <=> stripped text non-empty and lower-cased text != 'unknown'.
    # NULL counts as unknown (deviation: the reference saw the text 'nan').
    return key.isNotNull() & (strip(key) != "") & (F.lower(key) != "unknown")


def coverage(df: DataFrame, tempo: str = "tempo_bpm", key: str = "key",
             limits: QualityLimits = QualityLimits()) -> DataFrame:
    """One row: n_rows, tempo non-missing count and %, tempo out of range, key known count and %."""
    t = F.col(tempo)
    valid = t.isNotNull() & ~F.isnan(t)
    agg = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(valid).alias("n_tempo"),
        F.count_if(valid & ((t < limits.tempo_min) | (t > limits.tempo_max))).alias("n_tempo_out_of_range"),
        F.count_if(_key_known(F.col(key))).alias("n_key_known"),
    )
    pct = lambda c: F.when(F.col("n_rows") > 0, F.col(c) * 100.0 / F.col("n_rows")).otherwise(F.lit(0.0))
    return agg.select("n_rows", "n_tempo", pct("n_tempo").alias("tempo_pct"), "n_tempo_out_of_range",
                      "n_key_known", pct("n_key_known").alias("key_pct"))


# ------------------------------------------------------------ report rows
def _schema_rows(spark, table: str, df: DataFrame, required: list[str], numeric: list[str]) -> DataFrame:
    """Rows for missing / unexpected columns and non-numeric declared types (schema only)."""
    rows = []
    missing = [c for c in required if c not in df.columns]
    extra = [c for c in df.columns if c not in required]
    if missing:
        rows.append((table, "missing_columns", "error", float(len(missing)), f"Missing columns: {missing}"))
    if extra:
        rows.append((table, "unexpected_columns", "info", float(len(extra)), f"Unexpected columns: {extra}"))
    for c in numeric:
        if c in df.columns and not isinstance(df.schema[c].dataType, NUMERIC):
            rows.append((table, f"numeric:{c}", "error", None,
                         f"Column '{c}' should be numeric, got {df.schema[c].dataType.simpleString()}"))
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def _q(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _lit(x: str) -> str:
    return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _row_sql(table: str, check: str, level: str, value: str, message: str) -> str:
    return (f"named_struct('table', {_lit(table)}, 'check', {_lit(check)}, 'level', {level}, "
            f"'value', CAST({value} AS DOUBLE), 'message', {message})")


def validate(spark, table: str, df: DataFrame, required: list[str], key: str = "song_id",
             numeric: list[str] | None = None, nan_info: list[str] | None = None,
             nan_error: list[str] | None = None, coverage_check: bool = False,
             expected_rows: DataFrame | None = None, limits: QualityLimits = QualityLimits()) -> DataFrame:
    """Report rows (table, check, level, value, message) for one table.

    errors: missing columns, non-numeric types, empty table, duplicate keys,
    NULLs in ``nan_error`` columns, coverage below the limits, row count
    different from ``expected_rows``.  info: unexpected columns, row count,
    NULL counts of ``nan_info`` columns, coverage figures, out-of-range tempo.
    All measures come from one grouped pass (the grouping gives the duplicate
    count; sums of the per-key counts give the rest).
    """
    numeric = numeric or []
    nan_info = [c for c in (nan_info or []) if c in df.columns]
    nan_error = [c for c in (nan_error or []) if c in df.columns]

    def missing(c: str) -> str:
        if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)):
            return f"({_q(c)} IS NULL OR isnan({_q(c)}))"
        return f"({_q(c)} IS NULL)"

    aggs = ["count(1) AS n"]
    aggs += [f"count_if({missing(c)}) AS _i{i}" for i, c in enumerate(nan_info)]
    aggs += [f"count_if({missing(c)}) AS _e{i}" for i, c in enumerate(nan_error)]
    has_cov = coverage_check and "tempo_bpm" in df.columns and "key" in df.columns
    if has_cov:
        valid = "(tempo_bpm IS NOT NULL AND NOT isnan(tempo_bpm))"
        aggs += [f"count_if({valid}) AS _tv",
                 f"count_if({valid} AND (tempo_bpm < {limits.tempo_min}D OR tempo_bpm > {limits.tempo_max}D)) AS _to",
                 "count_if(_known) AS _kk"]
    names = [a.rsplit(" AS ", 1)[1] for a in aggs]
    measured = df.withColumn("_known", _key_known(F.col("key"))) if has_cov else df
    if key in df.columns:
        per_key = measured.groupBy(F.col(_q(key)).alias("_k")).agg(*[F.expr(a) for a in aggs])
        stats = per_key.selectExpr(
            "CAST(coalesce(sum(n), 0) AS BIGINT) AS n",
            "CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_rows",
            *[f"CAST(coalesce(sum({c}), 0) AS BIGINT) AS {c}" for c in names if c != "n"])
    else:
        stats = measured.agg(*[F.expr(a) for a in aggs]).withColumn("duplicate_rows", F.lit(0).cast("bigint"))
    if expected_rows is not None:
        # scalar subquery: the other table's row count, no join
        stats = stats.withColumn("_exp", expected_rows.select(F.count(F.lit(1))).scalar())

    pct1 = lambda x: f"format_number(CASE WHEN n > 0 THEN {x} * 100.0D / n ELSE 0.0D END, 1)"
    rows = [
        _row_sql(table, "row_count", "CASE WHEN n = 0 THEN 'error' ELSE 'info' END", "n",
                 "CASE WHEN n = 0 THEN 'Table is empty' ELSE concat('Row count: ', CAST(n AS STRING)) END"),
        _row_sql(table, "duplicate_keys", "CASE WHEN duplicate_rows > 0 THEN 'error' ELSE 'ok' END",
                 "duplicate_rows", f"concat({_lit('Duplicate ' + key + ': ')}, CAST(duplicate_rows AS STRING), ' rows')"),
    ]
    for i, c in enumerate(nan_info):
        rows.append(_row_sql(table, f"nan:{c}", f"CASE WHEN _i{i} > 0 THEN 'info' ELSE 'ok' END", f"_i{i}",
                             f"concat({_lit(c + ': ')}, CAST(_i{i} AS STRING), ' NaN (', {pct1(f'_i{i}')}, '%)')"))
    for i, c in enumerate(nan_error):
        rows.append(_row_sql(table, f"nan:{c}", f"CASE WHEN _e{i} > 0 THEN 'error' ELSE 'ok' END", f"_e{i}",
                             f"concat({_lit(f'Column {chr(39)}{c}{chr(39)} has ')}, CAST(_e{i} AS STRING), ' NaN values')"))
    if has_cov:
        tp = "(CASE WHEN n > 0 THEN _tv * 100.0D / n ELSE 0.0D END)"
        kp = "(CASE WHEN n > 0 THEN _kk * 100.0D / n ELSE 0.0D END)"
        rows.append(_row_sql(table, "tempo_coverage", "'info'", tp,
                             f"concat('tempo_bpm: ', CAST(_tv AS STRING), ' non-NaN (', {pct1('_tv')}, '%)')"))
        rows.append(_row_sql(table, "tempo_out_of_range", "CASE WHEN _to > 0 THEN 'info' ELSE 'ok' END", "_to",
                             f"concat('tempo_bpm: ', CAST(_to AS STRING), "
                             f"{_lit(f' values outside {limits.tempo_min}-{limits.tempo_max} BPM')})"))
        rows.append(_row_sql(table, "key_coverage", "'info'", kp,
                             f"concat('key: ', CAST(_kk AS STRING), ' non-unknown (', {pct1('_kk')}, '%)')"))
        low = (f"n > 0 AND ({tp} < {limits.min_tempo_coverage_pct}D OR {kp} < {limits.min_key_coverage_pct}D)")
        rows.append(_row_sql(table, "audio_coverage", f"CASE WHEN {low} THEN 'error' ELSE 'ok' END",
                             f"least({tp}, {kp})",
                             "'Audio-derived data missing or failed: tempo_bpm and/or key coverage below the minimum'"))
    if expected_rows is not None:
        rows.append(_row_sql(table, "row_count_match", "CASE WHEN _exp <> n THEN 'error' ELSE 'ok' END", "n - _exp",
                             "concat('Row count ', CAST(n AS STRING), ' vs expected ', CAST(_exp AS STRING))"))
    data_rows = stats.selectExpr(f"inline(array({', '.join(rows)}))")
    return _schema_rows(spark, table, df, required, numeric).unionByName(data_rows)


def validate_song_features(spark, df: DataFrame, limits: QualityLimits = QualityLimits()) -> DataFrame:
    return validate(spark, "song_features", df, list(SONG_FEATURE_COLUMNS),
                    numeric=list(RICH_FEATURES) + ["tempo_bpm"], nan_info=list(RICH_FEATURES),
                    coverage_check=True, limits=limits)


def validate_labels(spark, df: DataFrame) -> DataFrame:
    return validate(spark, "song_labels", df, ["song_id", "arousal", "valence"], numeric=["arousal", "valence"])


def validate_modeling_dataset(spark, df: DataFrame) -> DataFrame:
    return validate(spark, "modeling_dataset", df, list(SONG_FEATURE_COLUMNS) + ["arousal", "valence"],
                    numeric=["arousal", "valence"])


def validate_predictions(spark, df: DataFrame, song_features: DataFrame | None = None) -> DataFrame:
    cols = ["predicted_arousal", "predicted_valence"]
    return validate(spark, "emotion_predictions", df, ["song_id"] + cols, numeric=cols, nan_error=cols,
                    expected_rows=song_features)


def summary(report: DataFrame) -> DataFrame:
    """(table, passed) per table and an overall row; passed = no error row."""
    per = report.groupBy("table").agg(F.bool_and(F.col("level") != "error").alias("passed"))
    overall = report.agg(F.lit("overall").alias("table"),
                         F.coalesce(F.bool_and(F.col("level") != "error"), F.lit(False)).alias("passed"))
    return per.unionByName(overall)
