"""Vectors as packed blocks of rows: the common ground of the two vector searches.

A block is one row that holds up to ``BLOCK`` vectors, cut from a range
partition in sort order, so no group of rows is ever gathered whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 4096


def usable(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, int]:
    """((vec_id, embedding array<double>) of the rows that take part, their dimension).

    Out are null ids, null vectors, and vectors with null, NaN or infinite
    components.  Rows of one id count once, with their smallest vector.  Where
    dimensions differ the most frequent one counts (the smaller of several).
    """
    t = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("embedding"))
    ok = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    t = t.filter(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()).filter(ok & (F.size("embedding") > 0))
    t = t.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))
    sizes = t.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = sizes["d"] if sizes else 0
    return t.filter(F.size("embedding") == dim), dim


def packed(rows: DataFrame, keys: list[str], n_parts: int, key: str | None = None, block: int = BLOCK,
           descending: bool = False) -> DataFrame:
    """Blocks (key long, ids binary, vectors binary) of (vec_id, embedding, ...) rows in the order of ``keys``.

    ``vectors`` are float64 rows.  With ``key``, a block holds rows of one value of that column only.
    """
    order = [F.col(k).desc() if descending and k == keys[0] else F.col(k).asc() for k in keys]
    t = rows.select("vec_id", "embedding", *([key] if key else []), *[k for k in keys if k not in ("vec_id", key)])
    t = t.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)

    def out(part: int, ids: list[np.ndarray], vecs: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({
            "key": pa.array([part], pa.int64()), "ids": pa.array([np.concatenate(ids).astype("<i8").tobytes()], pa.binary()),
            "vectors": pa.array([np.concatenate(vecs).astype("<f8").tobytes()], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, ids, vecs, have = None, [], [], 0
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            i = b.column(0).to_numpy(zero_copy_only=False)
            v = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
            k = b.column(2).to_numpy(zero_copy_only=False) if key else np.zeros(n, np.int64)
            cuts = np.concatenate([[0], np.flatnonzero(k[1:] != k[:-1]) + 1, [n]])
            for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                while a < z:
                    if have and (held != k[a] or have >= block):
                        yield out(held, ids, vecs)
                        ids, vecs, have = [], [], 0
                    held, take = int(k[a]), min(z - a, block - have)
                    ids.append(i[a:a + take])
                    vecs.append(v[a:a + take])
                    have, a = have + take, a + take
        if have:
            yield out(held, ids, vecs)
    return t.mapInArrow(run, "key long, ids binary, vectors binary")


def query_blocks(rows: DataFrame, n_blocks: int, key: str | None = None) -> DataFrame:
    """Blocks (key, ids, vectors) of queries, dealt by the hash of the id into ``n_blocks`` (of each key)."""
    def pack(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values("vec_id")
        return pd.DataFrame({"key": [int(g["key"].iloc[0])], "ids": [g["vec_id"].to_numpy("<i8").tobytes()],
                             "vectors": [np.stack(g["embedding"].to_numpy()).astype("<f8").tobytes()]})
    t = rows.select("vec_id", "embedding", (F.col(key) if key else F.lit(0).cast("long")).alias("key"))
    t = t.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)))
    return t.groupBy("key", "block").applyInPandas(pack, "key long, ids binary, vectors binary")


def unpacked(ids: bytes, vectors: bytes) -> tuple[np.ndarray, np.ndarray]:
    i = np.frombuffer(ids, "<i8")
    return i, np.frombuffer(vectors, "<f8").reshape(len(i), -1)


def best_of(scores: np.ndarray, ids: np.ndarray, k: int, least: float = -np.inf, slack: float = 0.0) -> np.ndarray:
    """Places of the k highest scores (ties: smaller id), in order; with ``slack`` also those that close to the k-th.

    ``-inf`` marks rows that are out.
    """
    at = np.flatnonzero((scores >= least) & (scores > -np.inf))
    if len(at) > k:
        kth = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= kth - slack]
    at = at[np.lexsort((ids[at], -scores[at]))]
    return at if slack else at[:k]


def ranked(found: DataFrame, k: int, score: Column | str = "score") -> DataFrame:
    """The k best rows (query_id, vec_id, score) of each query, with ``rank`` from 1; repeated finds count once."""
    w = Window.partitionBy("query_id").orderBy(F.desc(score), "vec_id")
    return (found.distinct().withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
