"""A training corpus from documents: five stages, each over all that the one before it kept.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from songemo.llm import bpe, minhash, mixing, repeats, toxicity
from songemo.llm.base import bounded, in_file_order, stored, table, vocabulary

OWN = ("doc_id", "text", "lang", "source", "n_chars")
Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _apart(stage: Stage) -> Stage:
    """``stage`` over a table whose other columns have names of their own while it runs, whatever they are called."""
    @wraps(stage)
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        bounded(spark)
        safe = docs.toDF(*[c if c in OWN else f"other_{i}" for i, c in enumerate(docs.columns)])
        return stage(spark, safe, sf_dir).toDF(*docs.columns)
    return run


@_apart
def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic; it learns from the labelled ones among them.

    Null and empty texts are scored like others; every row of an id is scored for itself; null ids are never learned from.
    """
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter("toxic_predicted = 0").select(*docs.columns)


@_apart
def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, similarity 0.8): the smallest id.

    Texts without words and rows without an id stay; of rows alike in id and text one stays, and
    different texts of one id are judged each for itself.
    """
    return minhash.without_near_duplicates(docs, k=5, percent=80)


@_apart
def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 200-byte strings that occur more than once; ``n_chars`` follows.

    No row goes: a text that repeats whole becomes empty, a null one stays null, and rows alike repeat each other.
    """
    out = repeats.without_repeats(docs, length=200)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


@_apart
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which sources share by their target weights.

    A null source is a source of its own; rows alike in all columns take one place after another.
    """
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, position) of every document, ids as little-endian unsigned 32-bit integers.

    ``position`` numbers the documents from 0 in the order the mixing stage wrote them.
    Null and empty texts have no tokens; rows with the same id are encoded each for itself; other columns are left out.
    """
    bounded(spark)
    place = "position" if "position" not in docs.columns else "position_" + "_".join(docs.columns)
    out = bpe.encode(in_file_order(docs, place), vocabulary("word_bpe_49k.json"), more=[place])
    return out.withColumnRenamed(place, "position")


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("repeats", remove_repeats),
    ("mixing", mix_sources),
    ("bpe", encode),
]

#: SQL cannot express the classifier, the schedule or the encoding; the tests check each stage by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is a table in the shared folder that the next one reads."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
