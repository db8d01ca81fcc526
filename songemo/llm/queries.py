"""Queries of this subpackage: one ``opN_<name>`` per operator, and the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from . import (bpe, language, learned_partitions, licenses, merkle, minhash, mixing, norm_buckets, repeats, secrets,
               token_blocks, toxicity, variants)
from .base import table, vocabulary


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.schedule(table(spark, sf_dir, "documents"))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_blocks.digests(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op5_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.nearest(table(spark, sf_dir, "embeddings"), query_step=20, k=20)


def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removal_digests(table(spark, sf_dir, "documents"), length=200)


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(table(spark, sf_dir, "documents"))


def op8_norm_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return norm_buckets.top_k(table(spark, sf_dir, "embeddings"), query_step=50, k=5, scale=256)


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(table(spark, sf_dir, "documents"))


def op12_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.groups(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mixing, op2_licenses, op3_token_blocks, op4_minhash, op5_learned_partitions,
                                     op6_suffix_array, op7_language, op8_norm_buckets, op9_bpe, op10_toxicity,
                                     op11_secrets, op12_variants, op13_merkle)} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {"op2_licenses": licenses.oracle_sql(), "op4_minhash": minhash.ORACLE_SQL,
            "op8_norm_buckets": norm_buckets.ORACLE_SQL, "op12_variants": variants.ORACLE_SQL, "op13_merkle": merkle.oracle_sql()}
