"""Secrets in texts: three patterns, and runs that a Markov model of random strings explains better.

1. Base spans: assignments, access key ids and long hex runs (``BASE``).
2. Two character Markov models of order 2 are counted over the whole corpus.
   Labelled samples come from the patterns: values of base spans (of at least
   ``MIN_RUN`` characters) are random strings, the other runs of letters, digits
   and ``+/_-`` that are shorter than that are ordinary identifiers; so no
   candidate is in the sample that it is judged by.  A model is a table of
   transition counts, at most one per triple of the alphabet's 67 symbols
   whatever the corpus, so the tasks' partial tables are summed by Spark and
   collected.
3. Every other run of at least ``MIN_RUN`` characters (``=`` may end it) is a
   candidate.  Its log-likelihood ratio, summed over the run, must exceed the
   log odds of ordinary against random runs of that length in the corpus plus
   ``MARGIN``.

Smoothing: a triple falls back on its last pair, the pair on the symbol alone, that
on the uniform distribution; a random string may use another alphabet than those seen, so its
model gives ``UNIFORM`` of its weight to the uniform distribution.

Defined cases: a null text is empty; a text without spans has empty strings and
counts of 0; a candidate that touches a base span is not added; rows with the same
``doc_id`` are scanned each for itself, a null id is kept; an empty table gives
an empty result and a corpus without base spans a model of random strings that
is uniform; only ``doc_id`` and ``text`` are read, so other columns cannot
clash.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .base import by_batch

# --- fixed values: the base patterns, in the order in which kinds are listed ---
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ASSIGN_MIN = 6
#: The whole match needs 20 and 24 characters; a run that is too short holds no longer one.
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "markov")

MIN_RUN = 16
MARGIN = math.log(1000)
UNIFORM = 0.5
BACKOFF = 4.0
_CANDIDATE = re.compile(rf"[A-Za-z0-9+/_-]{{{MIN_RUN},}}={{0,2}}")
_ALPHABET = b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-"
K = len(_ALPHABET) + 1                                     # symbol 0 ends runs
_CODE = np.zeros(256, np.int32)
_CODE[np.frombuffer(_ALPHABET, np.uint8)] = np.arange(1, K)
_CHUNK = 1 << 20                                           # bytes whose transitions are counted at once


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base patterns' matches, kind by kind."""
    out = [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= ASSIGN_MIN]
    out += [("access", m.start(), m.end()) for m in ACCESS.finditer(text)]
    return out + [("hex", m.start(), m.end()) for m in HEX.finditer(text)]


def _values(text: str, spans: list[tuple[str, int, int]]) -> list[str]:
    """The random strings that base spans hold; a string inside another one counts once."""
    at = []
    for kind, a, z in spans:
        if kind == "assign":
            a = ASSIGN.match(text, a, z).start(2)
        elif kind == "access":
            a += len("AKIA")
        if z - a >= MIN_RUN:
            at.append((a, -z))
    out, end = [], 0
    for a, z in sorted(at):
        if -z > end:
            out.append(text[max(a, end):-z])
            end = -z
    return out


def _outside(text: str, spans: list[tuple[str, int, int]]) -> str:
    """``text`` with a space for every base span."""
    cuts = sorted((a, z) for _, a, z in spans)
    out, end = [], 0
    for a, z in cuts:
        out.append(text[end:max(a, end)])
        end = max(end, z)
    return " ".join([*out, text[end:]])


def _triples(data: bytes) -> np.ndarray:
    """Cell (before last, last, next) of every run character; what lies before a run is symbol 0."""
    c = np.concatenate([np.zeros(2, np.int32), _CODE[np.frombuffer(data, np.uint8)]])
    first = np.where(c[1:-1] == 0, 0, c[:-2])
    return ((first * K + c[1:-1]) * K + c[2:])[c[2:] > 0]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(random, cell, n): transition counts of this task's texts; cell -1 counts runs of MIN_RUN characters."""
    total = np.zeros((2, K ** 3), np.int64)
    runs = [0, 0]
    held: list[list[bytes]] = [[], []]
    size = [0, 0]

    def add(label: int, text: str) -> None:
        held[label].append(text.encode("utf-8", "replace"))
        size[label] += len(held[label][-1])
        if size[label] >= _CHUNK:
            flush(label)

    def flush(label: int) -> None:
        total[label] += np.bincount(_triples(b" ".join(held[label])), minlength=K ** 3)
        held[label], size[label] = [], 0
    for b in batches:
        for t in b.column(0):
            text = t.as_py() or ""
            spans = base_spans(text)
            for v in _values(text, spans):
                runs[1] += 1
                add(1, v)
            rest = _outside(text, spans) if spans else text
            rest, n = _CANDIDATE.subn(" ", rest)
            runs[0] += n
            add(0, rest)
    for label in (0, 1):
        flush(label)
        cell = np.flatnonzero(total[label])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(cell) + 1, bool(label))), pa.array(np.append(cell, -1)),
             pa.array(np.append(total[label][cell], runs[label]))], names=["random", "cell", "n"])


@dataclass
class Model:
    ratio: np.ndarray           # float32 log-likelihood ratio of each cell
    threshold: float

    def score(self, run: str) -> float:
        """Log-likelihood ratio of the run beyond the threshold; positive for a secret."""
        return float(self.ratio[_triples(run.rstrip("=").encode())].sum(dtype=np.float64)) - self.threshold


def _probabilities(n: np.ndarray, uniform: float) -> np.ndarray:
    """P(next | before last, last) from the counts of cells."""
    n = n.reshape(K, K, K).astype(np.float64)
    pair = n.sum(axis=0)
    one = pair.sum(axis=0)
    flat = 1.0 / (K - 1)
    p = (one + BACKOFF * flat) / (one.sum() + BACKOFF)
    p = (pair + BACKOFF * p) / (pair.sum(axis=1, keepdims=True) + BACKOFF)
    p = (n + BACKOFF * p[None]) / (n.sum(axis=2, keepdims=True) + BACKOFF)
    return ((1 - uniform) * p + uniform * flat).reshape(-1)


def model_of(counts: list[tuple[bool, int, int]]) -> Model:
    """The two models and the threshold, from the summed (random, cell, n)."""
    n, runs = np.zeros((2, K ** 3)), [0, 0]
    for label, cell, k in counts:
        if cell < 0:
            runs[label] = k
        else:
            n[int(label), cell] = k
    ratio = np.log(_probabilities(n[1], UNIFORM)) - np.log(_probabilities(n[0], 0.0))
    odds = math.log((runs[0] + 1) / (runs[1] + 1))
    return Model(ratio.astype(np.float32), max(odds, 0.0) + MARGIN)


def train(docs: DataFrame) -> Model:
    """Both models from all texts of ``docs``."""
    parts = docs.select("text").mapInArrow(_counts, "random boolean, cell long, n long")
    rows = parts.groupBy("random", "cell").agg(F.sum("n").alias("n")).toArrow()        # at most 2 * (K ** 3 + 1) rows
    return model_of(list(zip(*(c.to_pylist() for c in rows.columns))))


def all_spans(text: str, model: Model) -> list[tuple[str, int, int]]:
    """Base spans and those of the models, by start, then kind as listed."""
    out = base_spans(text)
    taken = sorted((a, z) for _, a, z in out)
    for m in _CANDIDATE.finditer(text):
        a, z = m.span()
        if not any(x < z and a < y for x, y in taken) and model.score(m.group()) > 0:
            out.append(("markov", a, z))
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def scan(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, spans array<struct<kind, start, end>>) of every row; places in code points, end exclusive."""
    field = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"kind": k, "start": a, "end": z} for k, a, z in all_spans(t.as_py() or "", model)] for t in b.column(1)]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.list_(field))], names=["doc_id", "spans"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        by_batch(run), "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans) of every row, by models of the same corpus."""
    found = scan(docs, train(docs))
    s = F.col("spans")
    def of(*kinds: str) -> Column:
        return F.filter(s, lambda x: x["kind"].isin(*kinds))
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE]
    return found.select("doc_id", *counts, F.sha2(_joined(of(*BASE)), 256).alias("base_sha256"), _joined(s).alias("spans"))
