"""Merkle manifest against a tree built in full."""

import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from conftest import DOCS, SF001
from songemo.llm import merkle, queries
from songemo.llm.base import table


def H(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    out = []
    for v in values:
        out.append("-" if v is None else f"{len(str(v).encode())}:{v}")
    return H(out)


def tree(nodes):
    """(root, path of each node): a path lists (position in its run, run)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i:i + 16] for i in range(0, len(nodes), 16)]
        for p, i in zip(paths, range(len(paths))):
            p.append((at[i] % 16, runs[at[i] // 16]))
            at[i] //= 16
        nodes = [H(r) for r in runs]
    return (nodes or [""])[0], paths


def plain(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = tree([leaf(r) for r in by[s]])
    root, top_paths = tree([trees[s][0] for s in sources])
    out = []
    for s, up in zip(sources, top_paths):
        for r, path in zip(by[s], trees[s][1]):
            own = leaf(r)
            bad = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            text = r[4]
            if bad and text is not None:
                text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
            node, sib = (leaf((*r[:4], text)) if bad else own), []
            for i, run in path + up:
                sib += run[:i] + run[i + 1:]
                node = H([*run[:i], node, *run[i + 1:]])
            out.append((r[0], own, trees[s][0], root, H(sib), node, node == root))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_whole_table(spark):
    docs = [tuple(r) for r in table(spark, SF001, "documents").select(*merkle.FIELDS).collect()]
    want = plain(docs)
    assert got(queries.op13_merkle(spark, SF001)) == want
    assert {r[-1] for r in want} == {True, False}


@pytest.mark.parametrize("sizes", [(1,), (16, 1, 17), (4096, 2), (4097, 300, 1), tuple([1] * 18), (9000,)])
def test_shapes(spark, sizes):
    """Lone leaves, full runs, last runs of one node, several stored levels, more than 16 sources."""
    rows = [(i * 3, None if s == 1 else f"src{s}é", "en", i, f"Text {i} of {s}") for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert got(merkle.manifest(df.repartition(5))) == plain(rows)


def test_nulls_ties_empty_and_clashes(spark):
    rows = [(None, None, None, None, None), (None, None, None, None, None), (5, "", "", 0, ""), (5, "", "", 0, ""), (5, "", "x", 1, "ABC"),
            (10, "b", None, -3, "Zé" * 50_000), (-7, "B", "de", None, None), (0, "b", "de", 2, "aB"), (2**40, "a:b", "-", 2, "-")]
    df = spark.createDataFrame(rows, DOCS.replace("text string, lang string, source string, n_chars long",
                                                  "source string, lang string, n_chars long, text string"))
    extra = df.withColumns({c: F.lit("x") for c in ("grp", "pos", "n", "node", "cell", "leaf", "root", "path", "_pos", "_n")})
    assert got(merkle.manifest(extra)) == plain(rows)
    assert got(merkle.manifest(df.filter("doc_id = 123"))) == []


def test_levels_between_are_made_again(spark):
    """Of a tree of 9000 leaves only the levels 0, 3 and 6 are stored."""
    nodes = spark.range(9000).select(F.lit("s").alias("grp"), F.col("id").alias("pos"), F.lit(9000).cast("long").alias("n"),
                                     F.sha2(F.col("id").cast("string"), 256).alias("node"))
    levels, tops = merkle.stored_levels(nodes)
    assert [x.count() for x in levels] == [9000, 3, 1] and tops.count() == 1
    assert tops.first()["node"] == tree([sha256(str(i).encode()).hexdigest() for i in range(9000)])[0]
