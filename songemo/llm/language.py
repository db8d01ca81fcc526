"""Language identification with a byte convolutional network, trained in numpy.

A text's UTF-8 bytes are cut into windows of 256 bytes that overlap by the
longest filter less one, so every byte sequence that a filter can see lies in
some window.  The network embeds bytes, applies filters of 2, 3 and 4 bytes,
takes ReLU and the maximum over the window, and ends in a softmax over the
learned languages.  A document's probabilities are the means over all its
windows, weighted by the bytes that each one adds.

Training uses a bounded sample: for each language at most ``PER_LANGUAGE``
rows (smallest hashes of the id) and of each at most ``WINDOWS_PER_TEXT``
windows, evenly spaced.  Prediction runs over every whole text in batches of
windows, in ``mapInArrow`` without a shuffle.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
without labelled rows every text is; with a single learned language its score
is 1; rows with a null language or ``doc_id`` are not learned from; repeated
rows are predicted each; ties go to the smaller language name; extra columns
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import by_batch, held_out, remainder4

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 12
EMBED = 8
STRIDE = WINDOW - max(WIDTHS) + 1
PER_LANGUAGE = 400
WINDOWS_PER_TEXT = 4
STEPS = 400
BATCH = 96
UNKNOWN = "und"
_LETTER = regex.compile(r"\p{L}")


def windows(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(n, WINDOW) bytes, zero-padded at the end, and the number of bytes each window adds."""
    n = max(1, -(-(len(data) - (WINDOW - STRIDE)) // STRIDE))
    raw = np.zeros((n - 1) * STRIDE + WINDOW, np.uint8)
    raw[: len(data)] = np.frombuffer(data, np.uint8)
    view = np.lib.stride_tricks.as_strided(raw, (n, WINDOW), (STRIDE, 1))
    adds = np.full(n, STRIDE, np.float64)
    adds[-1] = max(1, len(data) - (n - 1) * STRIDE)
    return view, adds


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    embed: np.ndarray           # (256, EMBED)
    kernel: np.ndarray          # (widest * EMBED, all filters); narrower filters are zero beyond their width
    bias: np.ndarray
    dense: np.ndarray           # (all filters, languages)
    dense_bias: np.ndarray

    def _filtered(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What the filters give at every place of every window, and the rows that they saw."""
        n, places, wide = len(x), STRIDE, self.kernel.shape[0]
        e = np.ascontiguousarray(self.embed[x])
        seen = np.lib.stride_tricks.as_strided(e, (n, places, wide), (e.strides[0], e.strides[1], e.strides[2]))
        out = (seen.reshape(n * places, wide) @ self.kernel).reshape(n, places, -1)
        return out, seen

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """(n, languages) for (n, WINDOW) bytes."""
        out = np.empty((len(x), len(self.languages)))
        for a in range(0, len(x), 64):
            z = np.maximum(self._filtered(x[a:a + 64])[0].max(axis=1) + self.bias, 0) @ self.dense + self.dense_bias
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[a:a + 64] = z / z.sum(axis=1, keepdims=True)
        return out


def some_windows(text: str) -> np.ndarray:
    """At most ``WINDOWS_PER_TEXT`` windows of a text, evenly spaced."""
    w, _ = windows(text.encode("utf-8", "replace"))
    return w[np.unique(np.linspace(0, len(w) - 1, min(len(w), WINDOWS_PER_TEXT)).astype(int))]


def fit(texts: list[np.ndarray], languages: list[str], steps: int = STEPS, seed: int = 7) -> Network:
    """Trains with Adam on windows of texts, one array a text; batches take every language alike."""
    names = tuple(sorted(set(languages)))
    rng = np.random.default_rng(seed)
    by: list[list[np.ndarray]] = [[] for _ in names]
    for w, lang in zip(texts, languages):
        by[names.index(lang)].append(w)
    pools = [np.concatenate(x) for x in by]
    wide, f = max(WIDTHS), FILTERS * len(WIDTHS)
    mask = np.repeat(np.stack([np.arange(wide) < w for w in WIDTHS for _ in range(FILTERS)], 1), EMBED, 0)
    par = {"embed": rng.normal(0, .5, (256, EMBED)), "kernel": rng.normal(0, .2, (wide * EMBED, f)) * mask,
           "bias": np.zeros(f), "dense": rng.normal(0, .2, (f, len(names))), "dense_bias": np.zeros(len(names))}
    par = {k: v.astype(np.float32) for k, v in par.items()}
    m, v = ({k: np.zeros_like(x) for k, x in par.items()} for _ in range(2))
    share = max(1, BATCH // max(1, len(names)))
    for step in range(1, steps + 1 if len(names) > 1 else 0):
        x = np.concatenate([p[rng.integers(0, len(p), share)] for p in pools])
        y = np.repeat(np.arange(len(names)), share)
        net = Network(names, **par)
        out, seen = net._filtered(x)
        at = out.argmax(axis=1)                                             # (n, f)
        n = len(x)
        pooled = np.maximum(np.take_along_axis(out, at[:, None], 1)[:, 0] + par["bias"], 0)
        z = pooled @ par["dense"] + par["dense_bias"]
        s = np.exp(z - z.max(axis=1, keepdims=True))
        s /= s.sum(axis=1, keepdims=True)
        s[np.arange(n), y] -= 1
        s /= n
        g = {"dense": pooled.T @ s, "dense_bias": s.sum(0)}
        d = (s @ par["dense"].T) * (pooled > 0)                             # (n, f)
        g["bias"] = d.sum(0)
        rows = seen[np.arange(n)[:, None], at]                              # (n, f, wide * EMBED)
        g["kernel"] = np.einsum("nf,nfk->kf", d, rows) * mask
        back = (d[:, :, None] * par["kernel"].T[None]).reshape(n, f, wide, EMBED)
        hit = x[np.arange(n)[:, None, None], at[:, :, None] + np.arange(wide)]
        g["embed"] = np.zeros_like(par["embed"])
        np.add.at(g["embed"], hit.reshape(-1), back.reshape(-1, EMBED))
        for k in par:
            m[k] = 0.9 * m[k] + 0.1 * g[k]
            v[k] = 0.999 * v[k] + 0.001 * g[k] ** 2
            par[k] = (par[k] - 0.01 * (m[k] / (1 - 0.9 ** step)) / (np.sqrt(v[k] / (1 - 0.999 ** step)) + 1e-8)
                      ).astype(np.float32)
    return Network(names, **par)


def predict(net: Network | None, texts: list[str | None]) -> list[tuple[str, float]]:
    """(language, score) of each text; their windows go through the network together."""
    out = [(UNKNOWN, 0.0)] * len(texts)
    known = [i for i, t in enumerate(texts) if net and t and _LETTER.search(t)]
    if not known:
        return out
    # About 8 MB of windows at a time; a longer text is one group of its own.
    group, size = [], 0
    def flush():
        cut = [windows(texts[i].encode("utf-8", "replace")) for i in group]
        p = net.probabilities(np.concatenate([w for w, _ in cut]))
        at = 0
        for i, (w, adds) in zip(group, cut):
            mean = adds @ p[at:at + len(w)] / adds.sum()
            at += len(w)
            best = int(mean.argmax())
            out[i] = (net.languages[best], float(min(1.0, mean[best])))
    for i in known:
        group.append(i)
        size += len(texts[i])
        if size >= 8_000_000:
            flush()
            group, size = [], 0
    if group:
        flush()
    return out


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """Fits on the bounded sample of rows that are not held out; None without any."""
    rows = (docs.select("doc_id", "text", "lang")
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (remainder4(F.col("doc_id")) != 2))
            .filter(F.col("text").rlike(r"\p{L}")))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    # The hash of the id picks about twice the wanted rows of each language; the window then sees only those.
    h = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    few = [(F.col("lang") == k) & (h < min(1.0, 2 * per_language / n)) for k, n in counts.items()]
    pick = few[0]
    for c in few[1:]:
        pick = pick | c

    def cut(b: pa.RecordBatch) -> pa.RecordBatch:
        data = [some_windows(t.as_py()).tobytes() for t in b.column(4)]
        return pa.RecordBatch.from_arrays([*b.columns[:4], pa.array(data, pa.binary())], names=[*b.schema.names[:4], "windows"])
    t = rows.filter(pick).select("lang", F.xxhash64("doc_id").alias("_h"), "doc_id", F.xxhash64("text").alias("_t"), "text")
    bytes_ = t.mapInArrow(by_batch(cut), f"lang string, _h long, doc_id {t.schema['doc_id'].dataType.simpleString()}, "
                                         "_t long, windows binary")
    w = Window.partitionBy("lang").orderBy("_h", "doc_id", "_t")
    sample = (bytes_.withColumn("_n", F.row_number().over(w)).filter(F.col("_n") <= per_language)
              .orderBy("lang", "_n").select("windows", "lang").collect())
    return fit([np.frombuffer(r["windows"], np.uint8).reshape(-1, WINDOW) for r in sample], [r["lang"] for r in sample])


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document."""
    shared = docs.sparkSession.sparkContext.broadcast(train(docs))

    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        lang, s = zip(*predict(shared.value, b.column(2).to_pylist()))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(lang, pa.string()),
                                           pa.array(s, pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])
    t = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return t.mapInArrow(by_batch(run), f"doc_id {t.schema['doc_id'].dataType.simpleString()}, held_out boolean, "
                                       "lang_pred string, score double")
