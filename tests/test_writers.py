"""Tables are replaced whole or not at all."""

import os

import pytest
from pyspark.sql import functions as F

from songemo.sinks import writers


def ids(spark, path):
    return sorted(r.id for r in spark.read.parquet(path).collect())


def hidden(path):
    return [x for x in os.listdir(os.path.dirname(path)) if x.startswith(f".{os.path.basename(path)}.") and not x.endswith(".crc")]


def test_a_failed_write_leaves_the_former_table(spark, tmp_path):
    path = f"{tmp_path}/songs"
    writers.write_table(spark.range(5), path)
    bad = spark.range(100).repartition(4).select(
        F.when(F.col("id") == 77, F.raise_error(F.lit("broken row")).cast("long")).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="broken row"):
        writers.write_table(bad, path)
    assert ids(spark, path) == list(range(5)) and not hidden(path)


def test_a_table_may_be_made_from_itself(spark, tmp_path):
    path, csv = f"{tmp_path}/songs", f"{tmp_path}/songs_csv"
    writers.write_table(spark.range(5), path, csv_path=csv)
    writers.write_table(spark.read.parquet(path).filter("id > 2"), path + "/", csv_path=csv)
    assert ids(spark, path) == [3, 4] and os.path.exists(f"{path}/_SUCCESS") and not hidden(path)
    assert sorted(r.id for r in spark.read.option("header", True).csv(csv).collect()) == ["3", "4"]


def test_a_swap_that_was_ended_is_mended(spark, tmp_path):
    path = f"{tmp_path}/songs"
    writers.write_table(spark.range(5), path)
    os.rename(path, f"{tmp_path}/.songs.former")            # ended after the first rename
    writers.recover(spark, path)
    assert ids(spark, path) == list(range(5)) and not hidden(path)
    spark.range(9).write.parquet(f"{tmp_path}/.songs.former")   # ended after the second
    writers.recover(spark, path)
    assert ids(spark, path) == list(range(5)) and not hidden(path)
    writers.recover(spark, f"{tmp_path}/none")
    assert not os.path.exists(f"{tmp_path}/none")
