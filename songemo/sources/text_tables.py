"""Delimited text files whose columns are bound by header name, per file.

A directory ``read.csv(schema=...)`` binds columns by position, so files
with the same columns in another order would be read wrong.  Here one numeric
pass over the lines finds the hash of every file's first line; files with the same
header form a group (usually there is one), and each group is one positional CSV
scan that reads the wanted columns only.  The largest group is read by the
pattern less the other groups' files.  No line is joined with its file's header.
Files of very many different headers (more than ``GROUPS``, or more than
``LISTED_FILES`` files outside the largest group) are read as lines instead, joined
by path with each file's column positions.  Files with a header and no data
still yield one row (all values NULL), so a header-only song is kept; zero-byte
files yield nothing.
"""

from __future__ import annotations

import re
from urllib.parse import unquote as unquote_uri

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.scalars import song_id_from_path, strip
from ..session import checkpoint_dir

GROUPS = 64
LISTED_FILES = 10_000


def read_lines(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, line_key STRUCT<block, rid>, value) for every line of the matching files."""
    df = spark.read.option("lineSep", "\n").text(pattern)
    return df.select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("block"),
                 F.monotonically_increasing_id().alias("rid")).alias("line_key"),
        F.regexp_replace("value", "\r$", "").alias("value"),
    )


def headers(lines: DataFrame) -> DataFrame:
    """(path, header, header_key, n_data): first line of each file (UTF-8 BOM removed) and its non-blank lines after it.

    The first line is found by number: the smallest row id of the file's
    first block, a numeric aggregate that combines without sorting any text;
    only then is that line's text fetched by its id.
    """
    filled = F.length(F.trim("value")) > 0
    first = lines.groupBy("path").agg(F.min(F.when(F.col("line_key.block") == 0, F.col("line_key.rid"))).alias("rid"),
                                      F.count_if(filled).alias("filled"))
    at = lines.filter(F.col("line_key.block") == 0).withColumn("rid", F.col("line_key.rid")).join(first, ["path", "rid"])
    return at.select("path", F.regexp_replace("value", "^\uFEFF", "").alias("header"),
                     F.col("line_key").alias("header_key"),
                     (F.col("filled") - filled.cast("int")).alias("n_data"))


def _unquote(c: Column) -> Column:
    """A field wrapped in double quotes loses them ("" inside becomes ")."""
    return F.when(c.rlike('^".*"$'), F.regexp_replace(F.regexp_replace(c, '^"|"$', ""), '""', '"')).otherwise(c)


def sniff_sep(header: Column, preferred: str = ";", fallback: str = ",") -> Column:
    """';' unless the header has no ';' but has a ',' (then ',')."""
    return F.when(~header.contains(preferred) & header.contains(fallback), F.lit(fallback)).otherwise(
        F.lit(preferred))


def _split(value: Column, sep: Column) -> Column:
    """Cells of a line, still quoted; a separator inside a quoted cell does not split."""
    plain = F.split(value, F.concat(F.lit("\\Q"), sep, F.lit("\\E")), -1)

    def quoted(s: str) -> Column:
        cells = F.regexp_extract_all(value, F.lit(f'("(?:[^"]|"")*"[^{s}]*|[^{s}]*)(?:{s}|$)'), F.lit(1))
        # the match at the very end is a cell of its own only after a separator
        return F.when(value.endswith(s), cells).otherwise(F.slice(cells, 1, F.size(cells) - 1))
    return F.when(~value.contains('"'), plain).when(sep == ";", quoted(";")).otherwise(quoted(","))


def split_header(header: Column, sep: Column) -> Column:
    """Header names, unquoted (once per file, so an array lambda is fine here)."""
    return F.transform(_split(header, sep), _unquote)


def _line_key() -> Column:
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("rid"))


def file_signatures(spark: SparkSession, pattern: str) -> DataFrame:
    """(path, signature, n_data) of every file with a line: the hash of its first filled line and its filled lines after it.

    A numeric aggregate, combined before the shuffle; one row per file, checkpointed.
    """
    checkpoint_dir(spark)
    lines = read_lines(spark, pattern).filter(F.length(F.trim("value")) > 0)
    first = F.when(F.col("line_key.block") == 0, F.col("line_key.rid"))
    per = lines.groupBy("path").agg(F.min_by(F.xxhash64("value"), first).alias("signature"), (F.count(F.lit(1)) - 1).alias("n_data"))
    return per.checkpoint(eager=True)


def _header_names(spark: SparkSession, path: str, sep: str | None) -> tuple[list[str], str]:
    """Header names and separator of one file."""
    lines = read_lines(spark, path).filter(F.length(F.trim("value")) > 0)
    h = lines.orderBy("line_key.block", "line_key.rid").limit(1).select(F.regexp_replace("value", "^\uFEFF", "").alias("header"))
    h = h.withColumn("sep", sniff_sep(F.col("header")) if sep is None else F.lit(sep))
    row = h.select(F.transform(split_header(F.col("header"), F.col("sep")), lambda c: strip(c)).alias("names"), "sep").first()
    return row["names"], row["sep"]


def _as_path(uri: str) -> str:
    """A file's URI as a path that stands for this file alone."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote_uri(uri))


def read_by_header(spark: SparkSession, pattern: str, wanted: list[str], sep: str | None = ";",
                   keep_header_only: bool = True) -> DataFrame:
    """(path, song_id, line_key, <wanted> as DOUBLE) with columns found by header name.

    ``sep=None`` sniffs the delimiter per file.  Cells that are empty or not
    numbers become NULL (``try_cast``).
    """
    files = file_signatures(spark, pattern)
    groups = files.groupBy("signature").agg(F.count(F.lit(1)).alias("files"), F.min("path").alias("one"),
                                            F.count_if(F.col("n_data") == 0).alias("empty"))
    groups = groups.orderBy(F.desc("files"), "signature").limit(GROUPS + 1).collect()          # one per header
    others = sum(g["files"] for g in groups[1:])
    if len(groups) > GROUPS or others > LISTED_FILES:
        return _read_by_join(spark, pattern, wanted, sep, keep_header_only)
    paths: dict[int, list[str]] = {}
    if others:
        for r in files.filter(F.col("signature") != groups[0]["signature"]).collect():        # at most LISTED_FILES
            paths.setdefault(r["signature"], []).append(r["path"])
    parts = []
    for g in groups:
        names, s = _header_names(spark, _as_path(g["one"]), sep)
        schema = StructType([StructField(f"c{i}", StringType()) for i in range(len(names))])
        reader = (spark.read.schema(schema).option("header", True).option("sep", s).option("quote", '"').option("escape", '"')
                  .option("maxColumns", len(names) + 1))
        largest = g is groups[0]
        rows = reader.csv(pattern if largest else [_as_path(p) for p in paths[g["signature"]]])
        if largest and others:
            rows = rows.filter(~F.col("_metadata.file_path").isin([p for ps in paths.values() for p in ps]))
        at = {n: i for i, n in reversed(list(enumerate(names)))}                              # the first of equal names
        vals = [strip(F.col(f"c{at[w]}")).try_cast("double").alias(w) if w in at else F.lit(None).cast("double").alias(w) for w in wanted]
        parts.append(rows.select(F.col("_metadata.file_path").alias("path"), _line_key().alias("line_key"), *vals))
    if keep_header_only and any(g["empty"] for g in groups) or not parts:
        parts.append(files.filter("n_data = 0").select(
            "path", F.lit(None).cast("struct<block:bigint,rid:bigint>").alias("line_key"),
            *[F.lit(None).cast("double").alias(w) for w in wanted]))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out.withColumn("song_id", song_id_from_path(F.col("path")))


def _read_by_join(spark: SparkSession, pattern: str, wanted: list[str], sep: str | None, keep_header_only: bool) -> DataFrame:
    """As ``read_by_header``, for files of very many different headers."""
    lines = read_lines(spark, pattern)
    h = headers(lines)
    sep_col = sniff_sep(F.col("header")) if sep is None else F.lit(sep)
    h = h.withColumn("sep", sep_col)
    names = F.transform(split_header(F.col("header"), F.col("sep")), lambda c: strip(c))
    h = h.select("path", "header_key", "sep", "n_data",
                 F.array(*[F.array_position(names, F.lit(w)).cast("int") for w in wanted]).alias("pos"))
    data = lines.join(h, "path").filter((F.col("line_key") != F.col("header_key"))
                                        & (F.length(F.trim("value")) > 0))  # blank lines are skipped
    cells = _split(F.col("value"), F.col("sep"))
    vals = []
    for j, w in enumerate(wanted):
        p = F.col("pos")[j]
        cell = F.when(p > 0, _unquote(F.try_element_at(cells, p)))
        vals.append(strip(cell).try_cast("double").alias(w))
    rows = data.select("path", "line_key", *vals)
    if keep_header_only:
        empty = h.filter("n_data = 0").select(
            "path", F.lit(None).cast("struct<block:bigint,rid:bigint>").alias("line_key"),
            *[F.lit(None).cast("double").alias(w) for w in wanted])
        rows = rows.unionByName(empty)
    return rows.withColumn("song_id", song_id_from_path(F.col("path")))


def read_text_by_header(spark: SparkSession, pattern: str, sep: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(headers with split names and sep, data lines with split cells) for text-valued files."""
    lines = read_lines(spark, pattern)
    h = headers(lines)
    sep_col = sniff_sep(F.col("header")) if sep is None else F.lit(sep)
    h = h.withColumn("sep", sep_col).withColumn("names", split_header(F.col("header"), F.col("sep")))
    data = lines.join(h.select("path", "header_key", "sep"), "path").filter(
        (F.col("line_key") != F.col("header_key")) & (F.length(F.trim("value")) > 0))
    data = data.select("path", "line_key", _split(F.col("value"), F.col("sep")).alias("cells"))
    return h.select("path", "names", "sep"), data
