"""Mixing sources to target weights by Pfair scheduling.

Each source's documents are cut into blocks, in order of their id.  A source
with w of H parts of the weight must have its j-th block in the window from
slot floor((j - 1) H / w) (release) to ceil(j H / w) (deadline).  Earliest
deadline first over the released blocks meets every window, so after any slot
each source has less than one block more or fewer than its share.

The windows repeat every H slots, so only one period is scheduled (a heap of
one entry per source); a block's slot follows from its number by arithmetic,
and the documents get theirs by a join with one row per source and phase.
Nothing is dropped or repeated: when a source runs out, a new phase begins in
which the others share by their weights.  The schedule is made on the driver from
one count per source; it has a row per source and phase, at most half the square
of the number of sources, and does not grow with the documents.

The numbering inside a source cuts it into range slices (no task holds a
source), and the text is not moved for it.

Weights are whole parts.  Without given ones, a source's parts go with the
square root of its number of documents.

Defined cases: a null source is a source of its own; a source without a given
weight gets one part; documents of an id keep one order by the hash of their
columns, and rows alike in all columns take a place each, one after another;
null ids come first; null and empty texts are documents like others; an empty
table stays empty; columns keep their names, and a table that already has a
``mix_...`` column is refused.
"""

from __future__ import annotations

import heapq
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import position
from .base import stored

BLOCK = 16
PARTS = 100
#: Copies of a row that one task at most makes from it.
COPIES = 1024
ADDED = {"mix_block": "long", "mix_release": "long", "mix_deadline": "long", "mix_slot": "long", "mix_place": "long"}


def period(parts: list[int]) -> list[list[int]]:
    """For each source the slots of its blocks in one period of ``sum(parts)`` slots, earliest deadline first."""
    total = sum(parts)
    if any(p < 1 for p in parts):
        raise ValueError("every source needs at least one part")
    slots: list[list[int]] = [[] for _ in parts]
    future = [(0, i) for i in range(len(parts))]           # (release, source) of each source's next block
    ready: list[tuple[int, int]] = []                      # (deadline, source)
    heapq.heapify(future)
    for t in range(total):
        while future and future[0][0] <= t:
            _, i = heapq.heappop(future)
            heapq.heappush(ready, (-(-(len(slots[i]) + 1) * total // parts[i]), i))
        _, i = heapq.heappop(ready)
        slots[i].append(t)
        if len(slots[i]) < parts[i]:
            heapq.heappush(future, (len(slots[i]) * total // parts[i], i))
    return slots


def phases(blocks: list[int], parts: list[int]) -> list[tuple[int, int, int, int, int, int, list[int]]]:
    """(source, first block, end block, first slot, period, parts, slots in the period) until all are placed."""
    out, done, start = [], [0] * len(blocks), 0
    while active := [i for i in range(len(blocks)) if done[i] < blocks[i]]:
        total = sum(parts[i] for i in active)
        pattern = dict(zip(active, period([parts[i] for i in active])))

        def slot_of(i: int, k: int) -> int:
            return k // parts[i] * total + pattern[i][k % parts[i]]
        end = min(slot_of(i, blocks[i] - done[i] - 1) for i in active) + 1
        for i in active:
            n = end // total * parts[i] + sum(s < end % total for s in pattern[i])
            if n:
                out.append((i, done[i], done[i] + n, start, total, parts[i], pattern[i]))
                done[i] += n
        start += end
    return out


def root_parts(counts: Mapping[str, int], parts: int = PARTS) -> dict[str, int]:
    """Parts that go with the square root of the counts, at least one each."""
    total = sum(n ** 0.5 for n in counts.values())
    parts = max(parts, 4 * len(counts))
    return {k: max(1, round(parts * n ** 0.5 / total)) for k, n in counts.items()}


def _key(source: Column) -> Column:
    return F.when(source.isNull(), F.lit("null")).otherwise(F.concat(F.lit("s:"), source.cast("string")))


def interleaved(docs: DataFrame, weights: Mapping[str | None, int] | None = None, block: int = BLOCK,
                id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """``docs`` with mix_block, mix_release, mix_deadline, mix_slot and mix_place (order inside the block) added.

    ``weights`` gives whole parts by source; sorting by (mix_slot, mix_place) is the mixture.
    """
    if clash := set(ADDED) & set(docs.columns):
        raise ValueError(f"columns {sorted(clash)} are in the way")
    spark, names = docs.sparkSession, docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])     # names of the table cannot meet those used here
    column = dict(zip(names, plain.columns))
    rows = plain.select("*", _key(F.col(column[source_col])).alias("_src"), F.col(column[id_col]).cast("long").alias("_id"),
                        F.xxhash64(*plain.columns).alias("_row"))
    same = ["_src", "_id", "_row"]
    units = stored(rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_copies")), "mix-units")
    counts = {r["_src"]: r["n"] for r in units.groupBy("_src").agg(F.sum("_copies").alias("n")).collect()}  # one per source
    sources = sorted(counts)
    if weights is None:
        parts = root_parts(counts)
    else:
        given = {"null" if k is None else f"s:{k}": int(v) for k, v in weights.items()}
        parts = {s: given.get(s, 1) for s in sources}
    table = [(sources[i], a, b, t, h, w, p)
             for i, a, b, t, h, w, p in phases([-(-counts[s] // block) for s in sources], [parts[s] for s in sources])]
    plan = spark.createDataFrame(table, "_src string, _from long, _to long, _start long, _period long, _parts long, "
                                        "_slots array<long>")
    placed = position(units.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("_copies").cast("int") - 1))),
                      "_src", ["_id", "_row", "_copy"])
    number = F.floor(F.col("_pos") / F.lit(block))
    placed = placed.withColumn("_block", number).join(plan, "_src").filter("_block >= _from and _block < _to")
    k = F.col("_block") - F.col("_from")
    slot = F.col("_start") + F.floor(k / F.col("_parts")) * F.col("_period") + F.element_at(
        "_slots", (F.pmod(k, F.col("_parts")) + 1).cast("int"))
    placed = placed.select(
        F.col("_src").alias("_p_src"), F.col("_id").alias("_p_id"), F.col("_row").alias("_p_row"),
        F.floor(F.col("_copy") / COPIES).alias("_p_part"), F.col("_block").alias("mix_block"),
        (F.col("_start") + F.floor(k * F.col("_period") / F.col("_parts"))).alias("mix_release"),
        (F.col("_start") + F.ceil((k + 1) * F.col("_period") / F.col("_parts"))).alias("mix_deadline"),
        slot.alias("mix_slot"), F.pmod(F.col("_pos"), F.lit(block)).alias("mix_place"))
    # Rows that are alike are interchangeable: one of them meets the places of all, dealt by parts of bounded size.
    one = (rows.groupBy(*same).agg(F.count(F.lit(1)).alias("_n"), *[F.first(c).alias(c) for c in plain.columns])
           .withColumn("_part", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_n") - 1) / COPIES)))))
    joined = one.join(placed, (F.col("_row") == F.col("_p_row")) & (F.col("_src") == F.col("_p_src"))
                      & F.col("_id").eqNullSafe(F.col("_p_id")) & (F.col("_part") == F.col("_p_part")))
    return joined.select(*[F.col(c).alias(n) for n, c in column.items()], *[F.col(c).cast(t) for c, t in ADDED.items()])


def schedule(docs: DataFrame, weights: Mapping[str | None, int] | None = None, block: int = BLOCK) -> DataFrame:
    """(doc_id, source, block, release, deadline, slot, place) of every document."""
    out = interleaved(docs, weights, block)
    return out.select("doc_id", "source", *[F.col(c).alias(c.removeprefix("mix_")) for c in ADDED])


def mixed(docs: DataFrame, weights: Mapping[str | None, int] | None = None, block: int = BLOCK) -> DataFrame:
    """``docs`` in the order of the mixture."""
    return interleaved(docs, weights, block).orderBy("mix_slot", "mix_place").drop(*ADDED)
