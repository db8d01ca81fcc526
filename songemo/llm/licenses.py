"""License scan by diagonal voting.

Texts and license templates are word sequences (A-Z lower-cased; words are
runs of digits, letters a-z and all characters from U+0080 up).  The rolling
word k-grams of every whole text are joined with the templates' k-grams on
their keys.  A match of text place p and template place t lies on the diagonal
p - t, and votes for the template standing there.  Votes are counted per
diagonal, diagonals at most ``NEIGHBOUR`` apart (words left out or put in) are
merged, and a merged group counts if its votes cover at least ``COVERAGE`` of
the template's k-grams within a span of at most ``STRETCH`` template lengths.

A k-gram's key packs the places of its words in the templates' vocabulary, so
equal keys are equal words, not just equal hashes.  k-grams with a word that
no template has cannot match and are not sent to the join.

Short phrases are templates of bigrams of their own that count only when one
diagonal has all their votes, that is where all words stand consecutively.

The template table is a constant of this module (a few hundred rows), which is
why it may be broadcast.  Texts are read once; what is shuffled are matches and
one row per document.

Defined cases: a null or empty text has no words, no places and no labels
(empty strings), null first and last words and score 0; repeated rows are
scanned each; a null ``doc_id`` is passed on; other columns are not read.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .base import by_batch

NEIGHBOUR = 3
COVERAGE = 0.6
STRETCH = 1.5
K = 3
BITS = 16

#: Phrases and their labels (fixed values).
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: License texts, their characteristic sentences (fixed values).
TEMPLATES = [
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance "
               "with the license"),
    ("apache", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that "
            "the following conditions are met"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general "
            "public license as published by the free software foundation"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby "
            "granted"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
            "documentation files the software to deal in the software without restriction"),
    ("mit", "released under the mit license"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
]

#: Lower-cases A-Z and turns every ASCII byte that is no word byte into a space.
_WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def _specs() -> list[tuple[str, bool, int, list[bytes]]]:
    """(label, phrase?, k, words) of every template."""
    return ([(v, True, 2, words(p)) for p, v in PHRASES.items()] + [(v, False, K, words(t)) for v, t in TEMPLATES])


@cache
def _vocabulary() -> dict[bytes, int]:
    return {w: i + 1 for i, w in enumerate(sorted({w for s in _specs() for w in s[3]}))}


def _keys(codes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, key) of every k-gram whose words are all in the vocabulary."""
    n = len(codes) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    ok = np.ones(n, bool)
    key = np.full(n, k, np.int64)
    for j in range(k):
        ok &= codes[j:j + n] > 0
        key = key << BITS | codes[j:j + n]
    at = np.flatnonzero(ok)
    return at, key[at]


def template_table(spark: SparkSession) -> DataFrame:
    """(gram, template, label, phrase, grams, size, offset), one row per template place."""
    v, rows = _vocabulary(), []
    for i, (label, phrase, k, w) in enumerate(_specs()):
        at, key = _keys(np.array([v[x] for x in w], np.int64), k)
        rows += [(int(g), i, label, phrase, len(at), len(w), int(o)) for o, g in zip(at, key)]
    return spark.createDataFrame(rows, "gram long, template int, label string, phrase boolean, grams int, size int, offset int")


def grams(docs: DataFrame) -> DataFrame:
    """(row, doc_id, n_words, place, gram): k-grams of template words, and per document one row without a gram."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        get, n_words, rows, places, keys = _vocabulary().get, [], [], [], []
        for i, t in enumerate(b.column(2)):
            w = words(t.as_py())
            n_words.append(len(w))
            codes = np.fromiter((get(x, 0) for x in w), np.int64, len(w))
            for k in (2, K):
                at, key = _keys(codes, k)
                rows.append(np.full(len(at), i))
                places.append(at)
                keys.append(key)
        n = b.num_rows
        row = pa.array(np.concatenate([np.arange(n), *rows]))
        none = pa.nulls(n, pa.int64())
        return pa.RecordBatch.from_arrays(
            [b.column(0).take(row), b.column(1).take(row), pa.array(n_words, pa.int64()).take(row),
             pa.concat_arrays([none, pa.array(np.concatenate(places))]),
             pa.concat_arrays([none, pa.array(np.concatenate(keys))])], names=["row", "doc_id", "n_words", "place", "gram"])
    t = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    return t.mapInArrow(by_batch(run), "row long, doc_id long, n_words long, place long, gram long")


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every document."""
    spark = docs.sparkSession
    votes = grams(docs).join(F.broadcast(template_table(spark)), "gram", "left").filter("gram is null or template is not null")
    # One row per document, template and diagonal; the row without a gram keeps documents without a match.
    diagonal = (votes.groupBy("row", "doc_id", "template", "label", "phrase", "grams", "size",
                              (F.col("place") - F.col("offset")).alias("diagonal"))
                .agg(F.max("n_words").alias("n_words"), F.count("gram").alias("votes"), F.min("place").alias("lo"),
                     F.max("place").alias("hi"), F.collect_set("offset").alias("offsets")))
    # A window over one document's diagonals of one template.
    w = Window.partitionBy("row", "template").orderBy("diagonal")
    apart = F.when(F.col("phrase"), F.lit(0)).otherwise(F.lit(NEIGHBOUR))
    new = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(w) > apart, F.lit(True)).cast("int")
    group = diagonal.withColumn("new", new).withColumn("group", F.sum("new").over(w))
    span = (group.groupBy("row", "doc_id", "template", "label", "phrase", "grams", "size", "group")
            .agg(F.max("n_words").alias("n_words"), F.min("diagonal").alias("start"), F.min("lo").alias("lo"),
                 F.max("hi").alias("hi"), F.size(F.array_distinct(F.flatten(F.collect_list("offsets")))).alias("covered")))
    share = F.col("covered") / F.col("grams")
    length = F.col("hi") - F.col("lo") + F.lit(K)
    whole = F.col("phrase") & (F.col("covered") == F.col("grams"))
    near = ~F.col("phrase") & (share >= COVERAGE) & (length <= STRETCH * F.col("size"))
    def labels(c):
        return F.concat_ws(",", F.array_sort(F.collect_set(F.when(c, F.col("label")))))
    score = F.when(F.col("phrase"), F.when(whole, 1.0).otherwise(0.0)).otherwise(
        F.when(length <= STRETCH * F.col("size"), share).otherwise(0.0))
    return span.groupBy("row", "doc_id").agg(
        F.max("n_words").alias("n_words"),
        F.count(F.when(whole, 1)).alias("n_base"),
        F.min(F.when(whole, F.col("start"))).alias("first_word"),
        F.max(F.when(whole, F.col("start"))).alias("last_word"),
        labels(whole).alias("base_labels"), labels(whole | near).alias("labels"),
        F.coalesce(F.max(score), F.lit(0.0)).alias("score")).drop("row")


def oracle_sql() -> str:
    """DuckDB SQL with the same result, its template table written out from this module's templates."""
    rows = []
    for i, (label, phrase, k, w) in enumerate(_specs()):
        w = [x.decode() for x in w]
        n = len(w) - k + 1
        rows += [f"({i}, '{label}', {phrase}, {k}, {n}, {len(w)}, {o}, '{' '.join(w[o:o + k])}')" for o in range(n)]
    return f"""
WITH templates(template, label, phrase, k, grams, size, offs, gram) AS (VALUES {", ".join(rows)}),
words AS (
  SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
places AS (SELECT doc, w, unnest(range(1, len(w) + 1)) AS i FROM words),
grams AS (
  SELECT doc, i - 1 AS place, k, array_to_string(w[i:i + k - 1], ' ') AS gram
  FROM places, (SELECT DISTINCT k FROM templates) WHERE i + k - 1 <= len(w)),
diagonals AS (
  SELECT doc, template, label, phrase, t.grams AS grams, size, place - offs AS diagonal, min(place) AS lo, max(place) AS hi,
    list(offs) AS covered
  FROM grams g JOIN templates t ON g.k = t.k AND g.gram = t.gram GROUP BY ALL),
marked AS (
  SELECT *, coalesce(diagonal - lag(diagonal) OVER (PARTITION BY doc, template ORDER BY diagonal)
                     > CASE WHEN phrase THEN 0 ELSE {NEIGHBOUR} END, true) AS new FROM diagonals),
grouped AS (
  SELECT *, sum(CAST(new AS INTEGER)) OVER (PARTITION BY doc, template ORDER BY diagonal) AS grp FROM marked),
spans AS (
  SELECT doc, label, phrase, grams, min(diagonal) AS start, max(hi) - min(lo) + {K} <= {STRETCH} * size AS compact,
    len(list_distinct(flatten(list(covered)))) AS covered
  FROM grouped GROUP BY doc, template, label, phrase, grams, size, grp),
hits AS (
  SELECT doc, label, start, phrase AND covered = grams AS whole,
    NOT phrase AND compact AND covered / grams >= {COVERAGE} AS near,
    CASE WHEN phrase THEN CASE WHEN covered = grams THEN 1.0 ELSE 0.0 END WHEN compact THEN covered / grams ELSE 0.0 END AS score
  FROM spans),
found AS (
  SELECT doc, count(*) FILTER (WHERE whole) AS n_base, min(start) FILTER (WHERE whole) AS first_word,
    max(start) FILTER (WHERE whole) AS last_word,
    array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE whole))), ',') AS base_labels,
    array_to_string(list_sort(list_distinct(list(label) FILTER (WHERE whole OR near))), ',') AS labels, max(score) AS score
  FROM hits GROUP BY doc)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels,
  coalesce(labels, '') AS labels, coalesce(CAST(score AS DOUBLE), 0.0) AS score
FROM words LEFT JOIN found USING (doc)
"""
