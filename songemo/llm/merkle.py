"""Merkle manifest of a dataset: a tree per source, a tree over the sources, and a proof for every row.

A row's leaf is the hash of its fields.  Leaves ascend by ``doc_id`` within a
source; every ``FANOUT`` consecutive nodes become one until one is left, the
source's subroot; subroots, ordered by source, become the root likewise.

Checkpoint and recompute: only every ``EVERY``-th level is stored (leaves,
then nodes of 4096 leaves, then of 4096 of these).  An aligned subtree is
the at most 4096 stored nodes below one stored node of the level above; it is
one group, whatever its source holds.

1. Up: each subtree's stored nodes are hashed level by level inside a task, and
   only its top is stored.  A source of n rows needs log(n) / log(4096) rounds.
2. Down: from the top, each subtree meets the path of its top (one row), makes
   the missing levels between again, gives each stored node its own
   path and throws the levels away.  The last round has the rows themselves: a
   row's proof is hashed from its path where it arises and no path of a row is
   kept.

A path is a list of (hashes of the run's members on the left, on the right),
from the node up to the root.

Defined cases: null fields count as ``-``; a null source is a source of its own,
first in order, and a null ``doc_id`` comes first in its source; rows with the
same ``doc_id`` are ordered by their leaf, identical rows are leaves of their
own; an empty table gives an empty result; only the five fields are read, so other
columns cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import position
from .base import CRC_CTES, crc_sql, stored

FANOUT = 16
EVERY = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"
_SIDES = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))


def leaf(values: dict[str, Column]) -> Column:
    """Hash of a row's fields."""
    def field(c: Column) -> Column:
        s = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))
    return F.sha2(F.concat(*[field(values[f]) for f in FIELDS]), 256)


def _h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int, limit: int = EVERY) -> int:
    """Levels above ``n`` nodes until one is left, at most ``limit``."""
    k = 0
    while n > 1 and k < limit:
        n, k = -(-n // FANOUT), k + 1
    return k


def subtree(nodes: list[str], levels: int) -> list[list[str]]:
    """All levels of a subtree, from its stored nodes up to its top."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([_h(*below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def siblings(levels: list[list[str]], i: int) -> list[tuple[str, str]]:
    """(left, right) of node ``i`` of the lowest level and of its ancestors below the top."""
    out = []
    for level in levels[:-1]:
        run = level[i // FANOUT * FANOUT:i // FANOUT * FANOUT + FANOUT]
        at = i % FANOUT
        out.append(("".join(run[:at]), "".join(run[at + 1:])))
        i //= FANOUT
    return out


def folded(node: str, path: list[tuple[str, str]]) -> str:
    """The root that ``node`` and its path give."""
    for left, right in path:
        node = _h(left, node, right)
    return node


def _column(t: pa.Table, name: str) -> list:
    return t[name].to_pylist()


def _up(t: pa.Table) -> pa.Table:
    """The top of one subtree: (grp, pos, n, node)."""
    t = t.sort_by("pos")
    n, pos = t["n"][0].as_py(), t["pos"][0].as_py()
    k = height(n)
    size = FANOUT ** k
    return pa.table({"grp": [t["grp"][0].as_py()], "pos": pa.array([pos // size], pa.int64()),
                     "n": pa.array([-(-n // size)], pa.int64()), "node": [subtree(_column(t, "node"), k)[-1][0]]})


def _cell() -> Column:
    """Number of a stored node's subtree inside its tree."""
    return F.floor(F.col("pos") / F.lit(FANOUT ** EVERY)).cast("long").alias("cell")


def stored_levels(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """(stored levels from ``nodes`` on, tops) of the trees over (grp, pos, n, node); tops are (grp, node, level)."""
    levels, tops = [nodes], None
    while True:
        cur = levels[-1]
        done = cur.filter("n = 1").select("grp", "node", F.lit(len(levels) - 1).alias("level"))
        tops = done if tops is None else tops.unionByName(done)
        more = cur.filter("n > 1")
        if more.isEmpty():
            return levels, tops
        levels.append(stored(more.select("grp", "pos", "n", "node", _cell()).groupBy("grp", "cell")
                             .applyInArrow(_up, "grp string, pos long, n long, node string"), "merkle-level"))


def _meet(level: DataFrame, above: DataFrame, fn, schema: str) -> DataFrame:
    """``fn(nodes of a subtree, row of its top)`` for every subtree of ``level``."""
    return (level.withColumn("cell", _cell()).groupBy("grp", "cell")
            .cogroup(above.select("grp", F.col("pos").alias("cell"), "subroot", "path").groupBy("grp", "cell"))
            .applyInArrow(fn, schema))


def _with_siblings(nodes: pa.Table, top: pa.Table) -> Iterator[tuple[int, list[tuple[str, str]]]]:
    """(place, path to the root) of each stored node of a subtree, in the order of places; the levels between are made again."""
    rest = [(s["left"], s["right"]) for s in top["path"][0].as_py()]
    levels = subtree(_column(nodes, "node"), height(nodes["n"][0].as_py()))
    for i in range(nodes.num_rows):
        yield i, siblings(levels, i) + rest


def _paths(nodes: pa.Table, top: pa.Table) -> pa.Table:
    nodes = nodes.sort_by("pos")
    path = [[{"left": a, "right": b} for a, b in p] for _, p in _with_siblings(nodes, top)]
    sub = top["subroot"][0]
    return pa.table({"grp": nodes["grp"], "pos": nodes["pos"], "node": nodes["node"],
                     "subroot": pa.array([sub.as_py()] * nodes.num_rows, pa.string()), "path": pa.array(path, _SIDES)})


def paths_down(levels: list[DataFrame], tops: DataFrame, fn=_paths,
               schema: str = f"grp string, pos long, node string, subroot string, path {_PATH}") -> DataFrame:
    """The lowest level's nodes with their paths; ``tops`` are (grp, level, subroot, path), ``fn`` takes the lowest level."""
    found = None
    for i in reversed(range(len(levels))):
        above = tops.filter(F.col("level") == i).select("grp", F.lit(0).cast("long").alias("pos"), "subroot", "path")
        if found is not None:
            above = above.unionByName(found.select("grp", "pos", "subroot", "path"))
        if i:
            found = stored(_meet(levels[i], above, _paths, f"grp string, pos long, node string, subroot string, path {_PATH}"),
                           "merkle-paths")
        else:
            found = _meet(levels[i], above, fn, schema)
    return found


def tampered(text: Column) -> Column:
    """A-Z lower-cased."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _rows(root: str):
    def run(nodes: pa.Table, top: pa.Table) -> pa.Table:
        nodes = nodes.sort_by("pos")
        proof, fold = [], []
        for (i, path), own, other in zip(_with_siblings(nodes, top), _column(nodes, "node"), _column(nodes, "changed")):
            proof.append(_h(*(x for side in path for x in side)))
            fold.append(folded(own if other is None else other, path))
        n = nodes.num_rows
        return pa.table({"doc_id": nodes["doc_id"], "leaf": nodes["node"],
                         "subroot": pa.array([top["subroot"][0].as_py()] * n, pa.string()), "root": pa.array([root] * n, pa.string()),
                         "proof_sha256": pa.array(proof, pa.string()), "folded_root": pa.array(fold, pa.string()),
                         "verified": pa.array([x == root for x in fold], pa.bool_())})
    return run


def manifest(docs: DataFrame, tamper: Column | None = None) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    Rows for which ``tamper`` holds are checked with a text whose A-Z are
    lower-cased: by default those whose unsigned crc32 of the id is divisible by 5.
    """
    if tamper is None:
        tamper = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    fields = {f: F.col(f) for f in FIELDS}
    # Sources ordered as the contract says, null first; a byte in front tells null from an empty name.
    grp = F.coalesce(F.concat(F.lit("1"), F.col("source").cast("string")), F.lit("0"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), grp.alias("grp"), leaf(fields).alias("node"),
                       F.when(tamper, leaf(fields | {"text": tampered(F.col("text"))})).alias("changed"))
    rows = stored(position(rows, "grp", ["doc_id", "node"]).withColumnsRenamed({"_pos": "pos", "_n": "n"}), "merkle-leaves")
    rows = rows.select("doc_id", "grp", F.col("pos").cast("long"), F.col("n").cast("long"), "node", "changed")
    levels, tops = stored_levels(rows)
    tops = stored(tops, "merkle-tops")
    over = stored(position(tops.withColumn("_all", F.lit("")), "_all", ["grp"])
                  .select(F.col("_all").alias("grp"), F.col("_pos").cast("long").alias("pos"), F.col("_n").cast("long").alias("n"),
                          "node", F.col("grp").alias("source")), "merkle-sources")
    top_levels, top = stored_levels(over)
    root = top.select("node").first()                       # one row; none of an empty table
    none = F.array().cast(_PATH)
    of_source = paths_down(top_levels, top.select("grp", "level", F.col("node").alias("subroot"), none.alias("path")))
    sub = (of_source.join(over.select("pos", "source"), "pos")
           .select(F.col("source").alias("grp"), F.col("node").alias("subroot"), "path").join(tops.select("grp", "level"), "grp"))
    return paths_down(levels, stored(sub, "merkle-tops"), _rows(root["node"] if root else ""),
                      "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
                      "verified boolean")


def oracle_sql(levels: int = 5) -> str:
    """DuckDB SQL that builds every level (enough for 16 ** ``levels`` rows a source and as many sources)."""
    def field(x: str) -> str:
        return f"CASE WHEN {x} IS NULL THEN '-' ELSE strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR) END"

    def leaf_sql(text: str) -> str:
        return f"sha256({' || '.join(field(text if f == 'text' else f) for f in FIELDS)})"

    def tree(name: str, nodes: str) -> str:
        """CTEs <name>0.. of (g, pos, h, n) and <name>s0.. of each node's siblings (g, pos, l, r)."""
        out = [f"{name}0 AS ({nodes})"]
        for k in range(levels):
            a, b = f"{name}{k}", f"{name}{k + 1}"
            out.append(f"""{name}s{k} AS (SELECT x.g, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
  coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
  FROM {a} x JOIN {a} y ON x.g = y.g AND x.pos // {FANOUT} = y.pos // {FANOUT} WHERE x.n > 1 GROUP BY x.g, x.pos)""")
            out.append(f"""{b} AS (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM (
  SELECT g, pos // {FANOUT} AS pos, sha256(string_agg(h, '' ORDER BY pos)) AS h FROM {a} WHERE n > 1 GROUP BY g, pos // {FANOUT}
  UNION ALL SELECT g, pos, h FROM {a} WHERE n = 1))""")
        return ",\n".join(out)

    def climb(rows: str, name: str, place: str, group: str) -> str:
        """``rows`` with h and proof carried through the levels of a tree."""
        for k in range(levels):
            rows = (f"(SELECT q.* REPLACE (CASE WHEN s.l IS NULL THEN q.h ELSE sha256(s.l || q.h || s.r) END AS h, "
                    f"q.proof || coalesce(s.l || s.r, '') AS proof) FROM {rows} q LEFT JOIN {name}s{k} s "
                    f"ON s.g = q.{group} AND s.pos = q.{place} // {FANOUT ** k})")
        return rows
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = crc_sql("CAST(doc_id AS VARCHAR)")
    return f"""WITH RECURSIVE {CRC_CTES},
docs AS (SELECT doc_id, coalesce('1' || source, '0') AS g, {leaf_sql("text")} AS leaf,
                CASE WHEN doc_id IS NOT NULL AND {crc} % 5 = 0 THEN {leaf_sql(lower)} END AS changed FROM documents, crc_table),
placed AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs),
{tree("a", "SELECT g, pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM placed")},
subs AS (SELECT g AS grp, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS spos, '' AS top FROM a{levels}),
{tree("b", "SELECT top AS g, spos AS pos, subroot AS h, count(*) OVER () AS n FROM subs")},
climbing AS (SELECT r.doc_id, r.g, r.pos, r.leaf, s.subroot, s.spos, s.top, coalesce(r.changed, r.leaf) AS h, '' AS proof
          FROM placed r JOIN subs s ON s.grp = r.g)
SELECT q.doc_id, q.leaf, q.subroot, t.h AS root, sha256(q.proof) AS proof_sha256, q.h AS folded_root, q.h = t.h AS verified
FROM {climb(climb("climbing", "a", "pos", "g"), "b", "spos", "top")} q, b{levels} t"""
