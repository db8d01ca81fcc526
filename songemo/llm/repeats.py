"""Removal of repeated 200-byte strings with suffix arrays over shards that anchors deal out.

A suffix array of all texts would have to be one array.  Instead every string
of ``length`` bytes goes where its anchor says (``anchors``): equal strings
have equal anchors, so whatever repeats meets under one key.

1. Keys that occur once hold nothing that repeats; a grouped count finds the
   others.  Each of their segments (the bytes that an anchor's strings cover)
   is known by a digest.  Segments with equal digests repeat whole.
2. Keys with several different segments go to shards of about 400 kB.  A
   shard's segments are joined by a symbol smaller than all bytes, sorted by
   induced sorting, and a string repeats if its permuted common prefix with a
   neighbour in the order has ``length`` bytes.
3. A key whose different segments hold more bytes than a shard (a passage in very
   many texts) is halved: the strings of an anchor that start left of the
   middle share more bytes than all of them do, and so do the others.  Under
   the longer shared bytes parts either stand alone, or are equal whole, or are
   halved again, so each round keeps at most the part across a passage's edge.
4. The repeated strings' bytes become spans of each text, and the text is
   joined with its spans once.

Matches never cross texts: segments are cut from single texts.

Defined cases: a null text is empty; texts under ``length`` bytes have no
string and keep everything; rows with the same ``doc_id`` are told apart by
the hash of their text, and identical rows repeat each other; a null
``doc_id`` is treated like any other value; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import anchors
from .base import by_batch, discard, partitions, release, stored
from .suffix import permuted_lcp, suffix_array

LENGTH = 200
SHARD_BYTES = 400_000


def _bytes(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _identified(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")


def keys(docs: DataFrame, length: int) -> DataFrame:
    """(key) of every segment of every text."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        k = [anchors.segments(_bytes(t.as_py()), length)[0] for t in b.column(0)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(k))], names=["key"])
    return docs.select("text").mapInArrow(by_batch(run), "key long")


def segments(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_hash, key, digest, place) of every segment; place packs start, anchor's distance and number.

    ``place`` = start << 32 | anchor distance of the first string << 16 | number of strings.
    """
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out, n_of = [], []
        for t in b.column(2):
            data = _bytes(t.as_py())
            key, start, n, anchor = anchors.segments(data, length)
            d = anchors.digests(data, start, n, length)
            out.append((key, d, start << 32 | (anchor - start) << 16 | n))
            n_of.append(len(key))
        row = pa.array(np.repeat(np.arange(len(n_of)), n_of))
        key, d, place = (np.concatenate(x) for x in zip(*out))
        return pa.RecordBatch.from_arrays([b.column(0).take(row), b.column(1).take(row), pa.array(key), pa.array(d),
                                           pa.array(place)], names=["doc_id", "text_hash", "key", "digest", "place"])
    return _identified(docs).mapInArrow(by_batch(run), "doc_id long, text_hash long, key long, digest long, place long")


def _runs(flag: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs [from, to) of true places."""
    edge = np.flatnonzero(np.diff(flag.astype(np.int8), prepend=0, append=0))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def repeated_strings(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, which of its strings of ``length`` bytes occur at another place of the parts."""
    sizes = np.array([len(p) + 1 for p in parts])
    s = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8).astype(np.int64) + 1
    ends = np.cumsum(sizes)
    s[ends - 1] = 0
    sa = suffix_array(s)
    plcp, _ = permuted_lcp(s, sa)
    shared = plcp[sa]                                      # with the suffix before it in the order
    hit = shared >= length
    hit[:-1] |= shared[1:] >= length
    flag = np.zeros(len(s), bool)
    flag[sa] = hit
    return [flag[e - n:e - length] for e, n in zip(ends.tolist(), sizes.tolist())]


SPAN = "key long, digest long, first int, last int"


def _slices(keys: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """[from, to) of whole keys (in order) with at most SHARD_BYTES bytes together, or of one key."""
    ends = np.append(np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys))
    total = np.append(0, np.cumsum(sizes))
    a = last = 0
    for z in ends.tolist():
        if last > a and total[z] - total[a] > SHARD_BYTES:
            yield a, last
            a = last
        last = z
    if last > a:
        yield a, last


def _shard_spans(length: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.drop_duplicates(["key", "digest"]).sort_values("key", kind="stable")
        key, digest, data = rows["key"].to_numpy(), rows["digest"].to_numpy(), rows["data"].tolist()
        # Keys share nothing, so a shard that came out larger than others is worked through in slices.
        out = [(k, d, a, b + length - 1)
               for lo, hi in _slices(key, np.array([len(x) for x in data], np.int64))
               for k, d, flag in zip(key[lo:hi], digest[lo:hi], repeated_strings(data[lo:hi], length))
               for a, b in _runs(flag)]
        return pd.DataFrame(out, columns=["key", "digest", "first", "last"]).astype(
            {"key": "int64", "digest": "int64", "first": "int32", "last": "int32"})
    return run


def _halves(length: int, level: int):
    """Each part as its two halves by the strings' distance to the anchor, with the bytes that a half shares."""
    reach = length - anchors.GRAM + 1
    step = -(-reach // (1 << level))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for key, digest, off, dist, under, data in zip(*(c.to_pylist() for c in b.columns)):
                n = len(data) - length + 1                 # strings; string i stands dist - i before the anchor
                for cell in range((dist - n + 1) // step, dist // step + 1):
                    lo, hi = max(0, dist - (cell + 1) * step + 1), min(n, dist - cell * step + 1)
                    if lo >= hi:
                        continue
                    # What all strings of the cell hold, whichever of them this part has.
                    shared = data[max(0, dist - cell * step):max(0, dist - (cell + 1) * step + 1 + length)]
                    part = data[lo:hi + length - 1]
                    h = hashlib.blake2b(under.to_bytes(8, "little", signed=True) + bytes([level]) + cell.to_bytes(2, "little")
                                        + shared, digest_size=8).digest()
                    same = hashlib.blake2b(part, digest_size=8).digest()
                    out.append((key, digest, off + lo, dist - lo, int.from_bytes(h, "little", signed=True),
                                int.from_bytes(same, "little", signed=True), part))
            cols = list(zip(*out)) if out else [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["key", "digest", "off", "dist", "under", "same", "data"])
    return run


def _split_spans(hot: DataFrame, length: int) -> DataFrame:
    """Spans of the segments (key, digest, dist, data) of keys that are too many for a shard."""
    spans = []
    cur = hot.select("key", "digest", F.lit(0).cast("int").alias("off"), "dist", F.col("key").alias("under"), "data")
    level = 0
    while True:
        level += 1
        parts = stored(cur.mapInArrow(_halves(length, level), "key long, digest long, off int, dist int, under long, "
                                                              "same long, data binary"), "halves")
        # One text per (under, same) goes on; several equal ones repeat whole.
        kinds = parts.groupBy("under", "same").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "digest")).alias("one"))
        many = kinds.groupBy("under").agg(F.count(F.lit(1)).alias("kinds"))
        seen = parts.join(kinds.withColumn("go", F.col("one")).drop("one"), ["under", "same"]).join(many, "under")
        seen = stored(seen.filter("n > 1 or kinds > 1"), "halves")
        spans.append(seen.filter("n > 1").select("key", "digest", F.col("off").alias("first"),
                                                 (F.col("off") + F.length("data")).cast("int").alias("last")))
        cur = (seen.filter("kinds > 1").filter((F.col("n") == 1) | (F.col("go") == F.struct("key", "digest")))
               .select("key", "digest", "off", "dist", "under", "data"))
        if (1 << level) >= length - anchors.GRAM + 1 or cur.isEmpty():
            break
    out = spans[0]
    for s in spans[1:]:
        out = out.unionByName(s)
    return out


def spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, text_hash, spans array<struct<first, last>>): repeated bytes of each text, runs of strings."""
    spark: SparkSession = docs.sparkSession
    # A stored table: only a join of two plain shuffles is split where one key is hot.
    often = stored(keys(docs, length).groupBy("key").count().filter("count > 1").select("key"), "keys")
    hits = stored(segments(docs, length).join(often, "key"), "segments")
    release(spark)
    kinds = hits.groupBy("key", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("doc_id", "text_hash", "place")).alias("at"))
    size = F.col("at.place").bitwiseAND(F.lit(0xFFFF)) + (length - 1)
    per_key = kinds.groupBy("key").agg(F.count(F.lit(1)).alias("kinds"), F.sum(size).alias("size"))
    kinds = stored(kinds.join(per_key, "key"), "kinds")

    # The bytes of one segment of each kind, for keys that have several.
    wanted = (kinds.filter("kinds > 1").groupBy(F.col("at.doc_id").alias("w_id"), F.col("at.text_hash").alias("w_hash"))
              .agg(F.collect_list(F.struct("key", "digest", "at.place", "size")).alias("want")))   # of one text
    t = _identified(docs)
    t = t.join(wanted, t["doc_id"].eqNullSafe(wanted["w_id"]) & (t["text_hash"] == wanted["w_hash"])).select("text", "want")

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, want in zip(b.column(0), b.column(1).to_pylist()):
            data = _bytes(text.as_py())
            for w in want:
                p = w["place"]
                start, n = p >> 32, p & 0xFFFF
                out.append((w["key"], w["digest"], p >> 16 & 0xFFFF, w["size"], data[start:start + n + length - 1]))
        cols = list(zip(*out))
        kinds_ = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds_)],
                                          names=["key", "digest", "dist", "size", "data"])
    parts = stored(t.mapInArrow(by_batch(cut), "key long, digest long, dist int, size long, data binary"), "parts")
    release(spark)

    few = parts.filter(F.col("size") <= SHARD_BYTES)
    total = few.agg(F.sum(F.length("data").cast("long"))).first()[0] or 0
    shards = max(partitions(spark), -(-total // SHARD_BYTES))
    found = (few.withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
             .groupBy("shard").applyInPandas(_shard_spans(length), SPAN))
    whole = kinds.filter("n > 1").select("key", "digest", F.lit(0).alias("first"),
                                         (F.col("at.place").bitwiseAND(F.lit(0xFFFF)) + (length - 1)).cast("int").alias("last"))
    found = found.unionByName(whole)
    hot = parts.filter(F.col("size") > SHARD_BYTES)
    if not hot.isEmpty():
        found = found.unionByName(_split_spans(hot, length))
    found = stored(found.groupBy("key", "digest").agg(F.collect_set(F.struct("first", "last")).alias("found")), "found")
    start = F.shiftright("place", 32)
    out = hits.join(found, ["key", "digest"]).select(
        "doc_id", "text_hash", F.transform("found", lambda x: F.struct((x["first"] + start).alias("first"),
                                                                       (x["last"] + start).alias("last"))).alias("s"))
    out = stored(out.groupBy("doc_id", "text_hash").agg(F.flatten(F.collect_list("s")).alias("spans")), "spans")
    discard(often, hits, kinds, parts, found)
    release(spark)
    return out


def _covered(n: int, spans_: list[dict] | None) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover."""
    if not spans_:
        return []
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, [s["first"] for s in spans_], 1)
    np.add.at(step, [s["last"] for s in spans_], -1)
    return _runs(np.cumsum(step)[:n] > 0)


def _with_spans(docs: DataFrame, length: int) -> DataFrame:
    """``docs`` with a last column ``_spans``."""
    s = spans(docs, length)
    s = s.select(F.col("doc_id").alias("_s_id"), F.col("text_hash").alias("_s_hash"), F.col("spans").alias("_spans"))
    return docs.join(s, F.col("doc_id").cast("long").eqNullSafe(s["_s_id"]) & (F.xxhash64("text") == s["_s_hash"]),
                     "left").drop("_s_id", "_s_hash")


def _kept(text: str | None, spans_: list[dict] | None) -> tuple[bytes, bytes, list[tuple[int, int]]]:
    data = _bytes(text)
    runs = _covered(len(data), spans_)
    if not runs:
        return data, data, runs
    cuts = [0, *(x for r in runs for x in r), len(data)]
    return data, b"".join(data[a:b] for a, b in zip(cuts[::2], cuts[1::2])), runs


def removal_digests(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, s in zip(b.column(1), b.column(2)):
            data, kept, runs = _kept(text.as_py(), s.as_py())
            out.append((len(data), len(data) - len(kept), len(runs), hashlib.sha256(kept).hexdigest()))
        n, r, k, h = zip(*out)
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(r, pa.int64()),
                                           pa.array(k, pa.int64()), pa.array(h)],
                                          names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])
    joined = _with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length)
    return joined.mapInArrow(by_batch(run), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def without_repeats(docs: DataFrame, length: int = LENGTH, text_col: str = "text") -> DataFrame:
    """``docs`` with the repeated bytes cut from ``text``; half characters at a cut go too, null texts stay null."""
    names = docs.columns
    joined = _with_spans(docs, length)
    at = names.index(text_col)

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        cols = list(b.columns)
        cols[at] = pa.array([None if not t.is_valid else
                             t.as_py() if not s.is_valid else _kept(t.as_py(), s.as_py())[1].decode("utf-8", "ignore")
                             for t, s in zip(b.column(at), b.column(len(names)))], pa.string())
        return pa.RecordBatch.from_arrays(cols[:-1], names=names)
    return joined.mapInArrow(by_batch(run), docs.schema)
