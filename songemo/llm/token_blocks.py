"""Token ids in binary shards of patched frame-of-reference blocks.

``write`` deals the documents by range of their id, encodes each one inside
its range and streams the ids of a range into one shard file, in ascending
``doc_id`` order.  A shard cuts its stream into blocks of 128 ids.  A block
subtracts its minimum, packs the low bits at the width that a given
percentile of its values needs, and lists the rest (position and high bits)
as exceptions.  A footer holds the byte offset at which each block starts,
its minimum, width and number of exceptions, and the documents' ids and
lengths, so any document can be read without the blocks before it.

A task writes a file of a new name and returns one manifest row for it; the
manifest is a table in the shared folder.  A repeated or lost task leaves at
most a file that no manifest names.  One partition's rows stream through;
what a task holds besides the batch is the footer.

Files are written with Arrow's filesystems, so the folder must be one that
they can open on the executors (a mounted folder, hdfs, s3, gs).

Defined cases: a null text is empty, so the document is its end id alone; a
null ``doc_id`` sorts first; rows with the same id keep one order, by the
hash of their text; an empty table gives no shard; other columns are not read.
"""

from __future__ import annotations

import io
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import byte_bpe
from .base import arrow_fs, partitions, qualified, run_folder, stored

BLOCK = 128
PERCENTILE = 95
END_ID = 0
MAGIC = b"PFOR0001"
FOOT = struct.Struct("<QQQ8s")          # blocks, documents, ids, magic
FLUSH = 4096 * BLOCK                    # ids packed at once


def pack(ids: np.ndarray, percentile: float = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Blocks of ``ids`` (the last one padded) and per block: bytes, minimum, width, exceptions."""
    n = -(-len(ids) // BLOCK)
    v = np.full(n * BLOCK, ids[-1] if len(ids) else 0, np.uint32)
    v[: len(ids)] = ids
    v = v.reshape(n, BLOCK)
    low = v.min(axis=1)
    rest = v - low[:, None]
    k = min(BLOCK - 1, int(np.ceil(percentile / 100 * BLOCK)) - 1)
    at = np.partition(rest, k, axis=1)[:, k]
    width = np.ceil(np.log2(at.astype(np.float64) + 1)).astype(np.uint32)
    high = rest >> width[:, None] if n else rest
    high[width == 32] = 0
    block, pos = np.nonzero(high)
    n_exc = np.bincount(block, minlength=n)
    packed: list[bytes] = [b""] * n
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            kind = "<u2" if w <= 16 else "<u4"
            bits = np.unpackbits(rest[rows].astype(kind).view(np.uint8).reshape(len(rows), BLOCK, -1),
                                 axis=2, bitorder="little", count=int(w))
            data = np.packbits(bits.reshape(len(rows), -1), axis=1, bitorder="little")
            for r, d in zip(rows.tolist(), data):
                packed[r] = d.tobytes()
    exc = np.empty(len(pos), [("pos", "u1"), ("high", "<u4")])
    exc["pos"], exc["high"] = pos, high[block, pos]
    ends = np.cumsum(n_exc).tolist()
    out, start = [], 0
    for p, e in zip(packed, ends):
        out.append(p + exc[start:e].tobytes())
        start = e
    meta = np.empty(n, [("bytes", "<u4"), ("low", "<u4"), ("width", "u1"), ("exc", "u1")])
    meta["bytes"], meta["low"], meta["width"], meta["exc"] = [len(x) for x in out], low, width, n_exc
    return b"".join(out), meta


def _unpack_bits(data: np.ndarray, w: int) -> np.ndarray:
    """(rows, BLOCK) values from (rows, BLOCK * w / 8) bytes: eight values share w bytes."""
    n = len(data)
    group = np.zeros((n * BLOCK // 8, w + 4), np.uint8)
    group[:, :w] = data.reshape(-1, w)
    out = np.empty((n * BLOCK // 8, 8), np.uint32)
    for j in range(8):
        at, shift = j * w >> 3, j * w & 7
        x = np.zeros(len(group), np.uint64)
        for k in range((shift + w + 7) // 8):
            x |= group[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (x >> np.uint64(shift)) & np.uint64((1 << w) - 1)
    return out.reshape(n, BLOCK)


def unpack(data: bytes, meta: np.ndarray) -> np.ndarray:
    """All ids of the blocks in ``data``, the padding of the last one included."""
    n = len(meta)
    v = np.zeros((n, BLOCK), np.uint32)
    raw = np.frombuffer(data, np.uint8)
    starts = np.cumsum(meta["bytes"].astype(np.int64)) - meta["bytes"]
    size = BLOCK // 8 * meta["width"].astype(np.int64)
    for w in np.unique(meta["width"]).tolist():
        if w:
            rows = np.flatnonzero(meta["width"] == w)
            v[rows] = _unpack_bits(raw[starts[rows][:, None] + np.arange(BLOCK // 8 * w)], w)
    if n_exc := int(meta["exc"].sum()):
        block = np.repeat(np.arange(n), meta["exc"])
        nth = np.arange(n_exc) - np.repeat(np.cumsum(meta["exc"], dtype=np.int64) - meta["exc"], meta["exc"])
        exc = raw[((starts + size)[block] + 5 * nth)[:, None] + np.arange(5)]
        high = np.ascontiguousarray(exc[:, 1:]).view("<u4")[:, 0]
        v[block, exc[:, 0]] |= high << meta["width"][block].astype(np.uint32)
    return (v + meta["low"][:, None]).reshape(-1)


class ShardWriter:
    """Streams documents' ids into one shard."""

    def __init__(self, out, percentile: float = PERCENTILE):
        self._out, self._percentile = out, percentile
        self._wait, self._waiting = [], 0
        self._meta, self._ids, self._null, self._n = [], [], [], []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self._ids.append(doc_id or 0)
        self._null.append(doc_id is None)
        self._n.append(len(ids))
        self._wait.append(ids)
        self._waiting += len(ids)
        if self._waiting >= FLUSH:
            self._flush(self._waiting // BLOCK * BLOCK)

    def _flush(self, n: int) -> None:
        ids = np.concatenate(self._wait) if self._wait else np.zeros(0, np.uint32)
        for a in range(0, n, FLUSH):
            data, meta = pack(ids[a:min(n, a + FLUSH)], self._percentile)
            self._out.write(data)
            self._meta.append(meta)
        self._wait, self._waiting = [ids[n:]], len(ids) - n

    def close(self) -> tuple[int, int]:
        """Writes the footer; the shard's documents and ids."""
        self._flush(self._waiting)
        meta = np.concatenate(self._meta) if self._meta else pack(np.zeros(0, np.uint32))[1]
        starts = np.concatenate([[0], np.cumsum(meta["bytes"].astype("<u8"))]).astype("<u8")
        for x in (starts, meta, np.asarray(self._ids, "<i8"), np.asarray(self._null, "u1"), np.asarray(self._n, "<u8")):
            self._out.write(x.tobytes())
        self._out.write(FOOT.pack(len(meta), len(self._n), sum(self._n), MAGIC))
        return len(self._n), sum(self._n)


class ShardReader:
    """Reads a shard through a seekable file; holds the footer and one stretch of blocks."""

    def __init__(self, f):
        self._f = f
        end = f.seek(0, io.SEEK_END)
        f.seek(end - FOOT.size)
        n_blocks, n_docs, self.n_ids, magic = FOOT.unpack(f.read(FOOT.size))
        if magic != MAGIC:
            raise ValueError("not a shard of token blocks")
        kind = [("bytes", "<u4"), ("low", "<u4"), ("width", "u1"), ("exc", "u1")]
        size = (n_blocks + 1) * 8 + n_blocks * np.dtype(kind).itemsize + n_docs * 17
        f.seek(end - FOOT.size - size)
        raw = f.read(size)
        foot = io.BytesIO(raw)
        def take(dtype, n):
            return np.frombuffer(foot.read(n * np.dtype(dtype).itemsize), dtype)
        self.starts = take("<u8", n_blocks + 1)
        self.meta = take(kind, n_blocks)
        self.doc_ids = take("<i8", n_docs)
        self.null = take("u1", n_docs)
        self.lengths = take("<u8", n_docs).astype(np.int64)
        self._held = (0, 0, np.zeros(0, np.uint32))

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` of the shard's stream."""
        a, b = start // BLOCK, -(-(start + n) // BLOCK)
        lo, hi, held = self._held
        if not (lo <= a and b <= hi):
            lo, hi = a, min(max(b, a + FLUSH // BLOCK), len(self.meta))
            self._f.seek(int(self.starts[lo]))
            held = unpack(self._f.read(int(self.starts[hi] - self.starts[lo])), self.meta[lo:hi])
            self._held = (lo, hi, held)
        return held[start - lo * BLOCK: start - lo * BLOCK + n]

    def documents(self) -> Iterator[tuple[int | None, int, np.ndarray]]:
        at = 0
        for d, null, n in zip(self.doc_ids.tolist(), self.null.tolist(), self.lengths.tolist()):
            yield (None if null else d), at, self.ids(at, n)
            at += n


MANIFEST = "shard int, path string, n_docs long, n_ids long"


def write(docs: DataFrame, folder: str, tokenizer: str, end_id: int = END_ID,
          percentile: float = PERCENTILE, shards: int | None = None) -> DataFrame:
    """Encode ``docs`` (doc_id, text) into shards under ``folder``; the manifest, one row per shard.

    ``shards`` ranges (by default the session's shuffle partitions) are dealt by (doc_id, hash of text).
    A folder without a scheme is one of the file system that Spark uses for it.
    """
    folder = qualified(docs.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, out, writer = byte_bpe.encoder(tokenizer), None, None
        end = np.asarray([end_id], np.uint32)
        for b in batches:
            for d, t in zip(b.column(0).to_pylist(), enc.encode(b.column(1))):
                if writer is None:
                    fs, path = arrow_fs(folder)
                    fs.create_dir(path, recursive=True)
                    name = f"shard-{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.pfor"
                    out = fs.open_output_stream(f"{path}/{name}")
                    writer = ShardWriter(out, percentile)
                writer.add(d, np.concatenate([t, end]))
        if writer is not None:
            n_docs, n_ids = writer.close()
            out.close()
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array([TaskContext.get().partitionId()], pa.int32()), "path": [f"{folder}/{name}"],
                "n_docs": [n_docs], "n_ids": [n_ids]})
    keys = [F.col("doc_id"), F.xxhash64("text")]
    dealt = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
             .repartitionByRange(shards or partitions(docs.sparkSession), *keys).sortWithinPartitions(*keys))
    return stored(dealt.mapInArrow(run, MANIFEST), "token-manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, shard, start, n_tokens, token_ids binary) of every document, ``start`` counted over all shards."""
    return _read(manifest, "token_ids", "binary", pa.binary(), lambda ids: ids.tobytes())


def read_digests(manifest: DataFrame) -> DataFrame:
    """(doc_id, shard, start, n_tokens, ids_crc32) of every document."""
    return _read(manifest, "ids_crc32", "long", pa.int64(), lambda ids: zlib.crc32(ids.tobytes()))


def _read(manifest: DataFrame, name: str, sql: str, kind: pa.DataType, value) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out():
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows), (pa.int64(), pa.int32(), pa.int64(), pa.int64(), kind))],
                names=["doc_id", "shard", "start", "n_tokens", name])
        for b in batches:
            for m in b.to_pylist():
                fs, path = arrow_fs(m["path"])
                with fs.open_input_file(path) as f:
                    rows = []
                    for d, at, ids in ShardReader(f).documents():
                        rows.append((d, m["shard"], m["before"] + at, len(ids), value(ids.astype("<u4"))))
                        if len(rows) >= 2000:
                            yield out()
                            rows = []
                    if rows:
                        yield out()
    # One row per shard: the running count is over the manifest, not over documents.
    w = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    at = manifest.withColumn("before", F.coalesce(F.sum("n_ids").over(w), F.lit(0)))
    at = at.repartition(partitions(manifest.sparkSession), "path")
    return at.mapInArrow(run, f"doc_id long, shard int, start long, n_tokens long, {name} {sql}")


def digests(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write ``docs`` into shards of the shared folder and read them back as digests."""
    folder = run_folder(docs.sparkSession, "token-shards")
    return read_digests(write(docs, folder, tokenizer)).select("doc_id", "start", "n_tokens", "ids_crc32", "shard")
