"""Near-duplicate documents by b-bit MinHash.

A document's set is its distinct k-word shingles (words between ASCII white
space, A-Z lower-cased; fewer than k words: the whole sequence as one
shingle).  Two documents are linked when ``100 * |A n B| >= percent * |A u B|``.

1. Each text gives 240 minima.  Their low 4 bits are packed into 15 longs
   (the b-bit signature); 40 bands of 6 whole minima are hashed.  A pair of
   similarity 0.8 shares no band with probability (1 - 0.8**6)**40 = 5e-6.
2. Texts with the same set form a class (128-bit digest of the whole set),
   held by its smallest id, so copies are never paired with each other.
3. In every band bucket each class is paired with the bucket's smallest
   class: pairs grow with the rows, not with the square of a bucket.
4. A pair goes on if its signatures' similarity, corrected for chance
   collisions (bit counts of the XOR), is at least ``percent / 100 - 0.14``
   (five standard deviations), and is linked if the full shingle sets say so.
5. Links give components.  Two classes of a bucket that are still in different
   components are compared by signature, in blocks of bounded size, in the
   first band that they share; those above the same bound are verified as
   well.  Where a block pair has more than ``DENSE`` such pairs per member, the
   pairs are not sent anywhere: the members' full sets come to the block pair,
   and only links that connect components there leave it.  Pairs that are
   already connected need no test, so what is sent stays linear in the rows.

Defined cases: null texts and texts without words have an empty set and are
linked with nothing; rows with the same ``doc_id`` are one node, for which the
text with the smallest hash stands; a null ``doc_id`` is linked with nothing
(its component is null, it is kept); other columns are not read.
"""

from __future__ import annotations

from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .base import by_batch, in_file_order, partitions, release, stored
from .links import components

BANDS, ROWS = 40, 6
HASHES = BANDS * ROWS
LOW_BITS = 4
LONGS = HASHES * LOW_BITS // 64
MARGIN = 0.14
BLOCK = 2048
DENSE = 4

_rng = np.random.default_rng(20240229)
_A = (_rng.integers(0, 2**32, HASHES, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_B = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
_BYTE = _rng.integers(0, 2**64, 256, dtype=np.uint64, endpoint=False)
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 2**64)
_powers = {"p": np.ones(1, np.uint64), "i": np.ones(1, np.uint64)}


def _power(n: int) -> tuple[np.ndarray, np.ndarray]:
    """First n powers of the odd base and of its inverse, modulo 2**64."""
    if len(_powers["p"]) < n:
        n = max(n, 1 << 16)
        for k, base in (("p", _ODD), ("i", _INVERSE)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _powers[k] = np.cumprod(x)
    return _powers["p"], _powers["i"]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of the whole text."""
    b = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)
    word = ~((b == 32) | ((b >= 9) & (b <= 13)))
    edge = np.flatnonzero(np.diff(word.astype(np.int8), prepend=0, append=0))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    p, inv = _power(len(b) + 1)
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[b] * p[: len(b)])])
    words = _mix((total[ends] - total[starts]) * inv[starts] + (ends - starts).astype(np.uint64))
    k = min(k, len(words))
    h = words[: len(words) - k + 1]
    for j in range(1, k):
        h = _mix(h * np.uint64(_ODD) + words[j: len(words) - k + 1 + j])
    return np.unique(h)


def signature(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed low bits as LONGS int64, BANDS int64 band keys) of a set that is not empty."""
    x = (hashes >> np.uint64(32)).astype(np.uint32)
    low = np.full(HASHES, 2**32 - 1, np.uint32)
    for a in range(0, len(x), 4096):
        np.minimum(low, (_A * x[None, a:a + 4096] + _B).min(axis=1), out=low)
    bits = ((low * np.uint32(0x85EBCA6B)) >> np.uint32(32 - LOW_BITS)).astype(np.uint64).reshape(LONGS, -1)
    packed = (bits << (np.arange(64 // LOW_BITS, dtype=np.uint64) * np.uint64(LOW_BITS))).sum(axis=1, dtype=np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for c in low.reshape(BANDS, ROWS).T:
        key = _mix(key * np.uint64(_ODD) + c)
    return packed.view(np.int64), key.view(np.int64)


def signatures(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, d1, d2, sig, bands) of every row; sig and bands are null for an empty set."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        n, d1, d2, sig, bands = [], [], [], [], []
        for t in b.column(2):
            h = shingle_hashes(t.as_py(), k)
            n.append(len(h))
            s, keys = signature(h) if len(h) else (None, None)
            place = np.arange(1, len(h) + 1, dtype=np.uint64)
            for out, c in ((d1, 1), (d2, 0x1F3D5B79)):
                out.append(int(_mix(h * np.uint64(2 * c + 1) + place * np.uint64(c)).sum(dtype=np.uint64).astype(np.int64)))
            sig.append(s)
            bands.append(keys)
        long = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(d1, pa.int64()), pa.array(d2, pa.int64()),
             pa.array(sig, long), pa.array(bands, long)], names=names)
    t = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    names = ["doc_id", "text_hash", "n_shingles", "d1", "d2", "sig", "bands"]
    return t.mapInArrow(by_batch(run), "doc_id long, text_hash long, n_shingles long, d1 long, d2 long, "
                                       "sig array<long>, bands array<long>")


def estimate(a: Column, b: Column) -> Column:
    """Similarity of two packed signatures: share of equal low bits, corrected for chance collisions."""
    def differ(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        for s in (1, 2):
            d = d.bitwiseOR(F.shiftrightunsigned(d, s))
        return F.bit_count(d.bitwiseAND(F.lit(0x1111111111111111)))
    unequal = F.aggregate(F.zip_with(a, b, differ), F.lit(0), lambda n, x: n + x)
    chance = 2.0 ** -LOW_BITS
    return ((F.lit(1.0) - unequal / F.lit(float(HASHES))) - F.lit(chance)) / F.lit(1 - chance)


def _shingles(text: str, k: int) -> set[bytes]:
    w = text.encode("utf-8", "replace").lower().split()
    return {b" ".join(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough; ``texts`` is (doc_id, text), one row an id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: OrderedDict[int, set[bytes]] = OrderedDict()
        def shingles(i, t):
            if i not in kept:
                kept[i] = _shingles(t, k)
                if len(kept) > 8:
                    kept.popitem(last=False)
            return kept[i]
        for batch in batches:
            ok = []
            for a, b, ta, tb in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    batch.column(2), batch.column(3)):
                y = shingles(b, tb.as_py())
                x = _shingles(ta.as_py(), k)
                both = len(x & y)
                ok.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(ok, pa.bool_())) for c in batch.columns[:2]], names=["a", "b"])
    with_texts = (pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a")
                  .join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b"))
    return with_texts.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[pa.RecordBatch]]:
    """Lists of batches that hold whole groups of the first ``keys`` columns, of rows sorted by them."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy() for i in range(keys)])
        new = np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1
        same = bool(held) and all(held[-1].column(i)[-1].as_py() == k[i, 0] for i in range(keys))
        if held and not same:
            yield held
            held = []
        if len(new):
            yield [*held, b.slice(0, int(new[-1]))]
            held = [b.slice(int(new[-1]))]
        else:
            held.append(b)
    if held:
        yield held


def _blocks(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[dict]:
    """Block pairs of buckets: keys band, i, j and the members' columns as arrays."""
    for part in _groups(batches, 3):
        t = pa.Table.from_batches(part).combine_chunks()
        cols = {}
        for c in t.column_names:
            x = t[c].combine_chunks() if t[c].num_chunks != 1 else t[c].chunk(0)
            cols[c] = x.flatten().to_numpy().reshape(len(x), -1) if c in ("sig", "bands") else x if c == "data" else x.to_numpy()
        k = np.stack([cols[c] for c in ("band", "i", "j")])
        cuts = np.concatenate([[0], np.flatnonzero((k[:, 1:] != k[:, :-1]).any(axis=0)) + 1, [t.num_rows]]).tolist()
        for a, z in zip(cuts, cuts[1:]):
            if z - a > 1:
                yield {c: cols[c][a:z] for c in columns} | {"band": int(k[0, a]), "i": int(k[1, a]), "j": int(k[2, a])}


def _candidates(g: dict, need: float) -> Iterator[tuple[int, np.ndarray]]:
    """(member, members) of a block pair: pairs of different components whose signatures are near enough.

    A pair counts only in the first band that its members share, and in a pair of
    two blocks only across them.
    """
    sig, bands, comp, rep = g["sig"].view(np.uint64), g["bands"], g["component"], g["rep"]
    first = int((bands[0] == g["band"]).argmax())
    for n in range(len(rep) - 1):
        ok = np.flatnonzero(comp[n + 1:] != comp[n]) + n + 1
        if g["i"] != g["j"]:
            ok = ok[g["block"][ok] != g["block"][n]]
        if not len(ok):
            continue
        d = sig[ok] ^ sig[n]
        d |= d >> np.uint64(1)
        d |= d >> np.uint64(2)
        ok = ok[np.bitwise_count(d & np.uint64(0x1111111111111111)).sum(axis=1) <= need]
        if first and len(ok):
            ok = ok[~(bands[ok, :first] == bands[n, :first]).any(axis=1)]
        if len(ok):
            yield n, ok


def _need(bound: float) -> float:
    """How many low-bit values of a signature may differ at the given similarity."""
    chance = 2.0 ** -LOW_BITS
    return (1 - (bound * (1 - chance) + chance)) * HASHES


def _sparse_pairs(bound: float):
    """Pairs of a block pair, or one row (null, null, band, i, j) if they are more than DENSE per member."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        for g in _blocks(batches, ("rep", "component", "block", "sig", "bands")):
            pairs: list[tuple] = []
            rep = g["rep"]
            for n, ok in _candidates(g, _need(bound)):
                pairs += [(max(int(rep[n]), x), min(int(rep[n]), x)) for x in rep[ok].tolist()]
                if len(pairs) > DENSE * len(rep):
                    break
            if len(pairs) > DENSE * len(rep):
                out.append((None, None, g["band"], g["i"], g["j"]))
            else:
                out += [(a, b, None, None, None) for a, b in pairs]
            if len(out) >= 10_000:
                yield _rows(out, _PAIR)
                out = []
        yield _rows(out, _PAIR)
    return run


def _dense_links(bound: float, percent: int):
    """Links of a dense block pair that connect its components, found on the full shingle sets."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for g in _blocks(batches, ("rep", "component", "block", "sig", "bands", "data")):
            sets = [np.frombuffer(x.as_buffer(), "<u8") for x in g["data"]]            # sorted, distinct
            rep, root, out = g["rep"].tolist(), {}, []

            def top(c: int) -> int:
                while (up := root.get(c, c)) != c:
                    root[c] = c = root.get(up, up)
                return c
            comp = g["component"].tolist()
            for n, ok in _candidates(g, _need(bound)):
                for m in ok.tolist():
                    x, y = top(comp[n]), top(comp[m])
                    if x != y:
                        both = len(np.intersect1d(sets[n], sets[m], assume_unique=True))
                        if 100 * both >= percent * (len(sets[n]) + len(sets[m]) - both):
                            root[max(x, y)] = min(x, y)
                            out.append((max(rep[n], rep[m]), min(rep[n], rep[m])))
            if out:
                yield _rows(out, _PAIR[:2])
    return run


_PAIR = [("a", pa.int64()), ("b", pa.int64()), ("band", pa.int64()), ("i", pa.int32()), ("j", pa.int32())]


def _rows(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(cols, fields)], names=[n for n, _ in fields])


def _sets(texts: DataFrame, k: int) -> DataFrame:
    """(rep, data): all shingle hashes of each text."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([shingle_hashes(t.as_py(), k).astype("<u8").tobytes() for t in b.column(1)], pa.binary())],
            names=["rep", "data"])
    return texts.select("doc_id", "text").mapInArrow(by_batch(run), "rep long, data binary")


def near_links(docs: DataFrame, k: int = 2, percent: int = 80) -> tuple[DataFrame, DataFrame]:
    """(signatures with class ``rep`` of every document, verified links (a, b) between classes)."""
    sig = stored(signatures(docs, k), "signatures")
    key = ["d1", "d2", "n_shingles"]
    some = sig.filter("n_shingles > 0 and doc_id is not null")
    # The text that stands for an id is the one with the smallest hash, should an id have several.
    canon = (sig.filter("doc_id is not null").groupBy("doc_id")
             .agg(F.min_by(F.struct(*key), "text_hash").alias("c")).select("doc_id", "c.*"))
    reps = canon.filter("n_shingles > 0").groupBy(*key).agg(F.min("doc_id").alias("rep"))
    sets = some.groupBy(*key).agg(F.first("sig").alias("sig"), F.first("bands").alias("bands"))
    classes = stored(sets.join(reps, key).select(*key, "rep", "sig", "bands"), "classes")
    member = sig.select("doc_id", "n_shingles").join(
        canon.join(classes.select(*key, "rep"), key).select("doc_id", "rep"), "doc_id", "left")
    rows = classes.select("rep", F.explode("bands").alias("band"))
    full = rows.groupBy("band").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    buckets = stored(rows.join(full, "band"), "buckets")
    bound = percent / 100 - MARGIN
    packed = classes.select("rep", "sig")

    star = (buckets.filter("rep != first").select(F.col("rep").alias("a"), F.col("first").alias("b")).distinct()
            .join(packed.select(F.col("rep").alias("a"), F.col("sig").alias("sa")), "a")
            .join(packed.select(F.col("rep").alias("b"), F.col("sig").alias("sb")), "b")
            .filter(estimate(F.col("sa"), F.col("sb")) >= bound).select("a", "b"))
    star = stored(star, "pairs")
    # Texts of all classes that stand in some bucket with another: the only ones a pair can name.
    named = buckets.select(F.col("rep").alias("doc_id")).distinct()
    release(docs.sparkSession)
    texts = stored(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(named, "doc_id", "left_semi")
                   .groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text")), "texts")
    linked = stored(verified(star, texts, k, percent), "verified")
    release(docs.sparkSession)

    comp = components(linked)
    placed = buckets.join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn(
        "component", F.coalesce("component", "rep"))
    open_ = (placed.groupBy("band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
             .filter("lo != hi").select("band"))
    blocks = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    left = (placed.join(open_, "band")
            .withColumn("block", F.pmod(F.xxhash64("rep"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"),
                    "block", "rep", "component"))
    left = stored(left, "blocks")
    side = classes.select("rep", "sig", "bands")
    order = ["band", "i", "j"]

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition(partitions(docs.sparkSession), *order).sortWithinPartitions(*order, "rep")
    found = stored(dealt(left.join(side, "rep").select(*order, "block", "rep", "component", "sig", "bands"))
                   .mapInArrow(_sparse_pairs(bound), "a long, b long, band long, i int, j int"), "pairs")
    rest = found.filter("a is not null").select("a", "b").distinct().join(star, ["a", "b"], "left_anti")
    dense = found.filter("a is null").select(*order)
    if not dense.isEmpty():
        full = left.join(dense, order).join(side, "rep").join(_sets(texts, k), "rep")
        rest = rest.unionByName(dealt(full.select(*order, "block", "rep", "component", "sig", "bands", "data"))
                                .mapInArrow(_dense_links(bound, percent), "a long, b long").distinct())
    rest = stored(rest, "pairs")
    more = verified(rest, texts, k, percent)
    return member, linked.unionByName(more)


def near_duplicates(docs: DataFrame, k: int = 2, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    member, links = near_links(docs, k, percent)
    comp = components(links).withColumnRenamed("node", "rep")
    return (member.join(comp, "rep", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "rep", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component: the one with the smallest id; rows without an id stay.

    Here a node is a text of an id, so of several texts of one id each goes only
    if it has a near duplicate itself.  Of rows alike in id and text one stays.
    """
    names = docs.columns
    node, rows = "doc_id", docs
    if not docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty():
        # nodes are numbered in the order of their ids, so the smallest node has the smallest id
        pairs = (docs.filter("doc_id is not null").select(F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash"))
                 .distinct().orderBy("_id", "_hash"))
        node, number = "_node", in_file_order(stored(pairs, "nodes"), "_node")
        rows = docs.join(number, (F.col("doc_id") == F.col("_id")) & (F.xxhash64("text") == F.col("_hash")), "left")
        rows = stored(rows.drop("_id", "_hash"), "numbered")
    found = stored(near_duplicates(rows.select(F.col(node).alias("doc_id"), "text"), k, percent), "near-duplicates")
    out = rows.join(found.filter("not kept").select(F.col("doc_id").alias(node)).distinct(), node, "left_anti")
    if node != "doc_id":
        w = Window.partitionBy(node).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in names]))
        out = out.withColumn("_nth", F.row_number().over(w)).filter("_nth = 1 or _node is null")
    return out.select(*[F.col(f"`{c}`") for c in names])


ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
shingles AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) < 2 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words),
places AS (SELECT doc_id, unnest(s) AS x FROM shingles),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM places a JOIN places b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id),
links AS (
  SELECT a, b FROM shared JOIN shingles x ON x.doc_id = a JOIN shingles y ON y.doc_id = b
  WHERE 100 * n >= 80 * (len(x.s) + len(y.s) - n)),
both_ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, l.b FROM reach r JOIN both_ways l ON r.other = l.a),
lowest AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id, s.doc_id = l.component_id AS kept
FROM shingles s JOIN lowest l ON s.doc_id = l.doc_id
"""
