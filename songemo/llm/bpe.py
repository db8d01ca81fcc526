"""BPE encoding and decoding by forced-boundary splitting.

A merge can only join two symbols if the joined string is a vocabulary
token.  So where two neighbouring characters of a word stand next to each
other in no vocabulary token, no merge ever reaches across: the place is a
certain cut.  White space, which the tokenizer drops, and special-token
strings are certain cuts too.  Every fragment between cuts is encoded on its
own and the ids are concatenated; the result is that of encoding the whole.

A fragment's ids do not depend on its neighbours, so the new fragments of
about 2 MB of text are merged together (``lockstep``), and each Python worker
keeps the ids of the white-space-separated words it has seen (a bounded
table, emptied when full; it only saves time).  Documents are rows of
``mapInArrow``: no shuffle, a few MB of text in memory at a time.

Defined cases: a null text counts as empty; an empty text has no ids and
decodes to the empty string; a null ``doc_id`` is passed on; repeated rows
are encoded once per row; columns other than the two named are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from . import lockstep
from .base import by_batch, byte_chars

#: Words whose ids a worker keeps (about 200 bytes each).
KEPT_WORDS = 250_000

# Python's \s also holds U+001C..U+001F, which are no white space to the tokenizer.
_CONTROL = re.compile("[\x1c-\x1f]")
_ABOVE = re.compile("[\u0250-\U0010ffff]")
_BLANKS = re.compile("[^\\S\x1c-\x1f]+")


class ForcedBoundaryBPE:
    """Encoder and decoder for a word-level BPE file (white space dropped, words end in a suffix)."""

    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        from tokenizers import Tokenizer, models
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        steps = [s["type"] for s in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
        if (model["type"] != "BPE" or steps != ["Split", "ByteLevel"] or not model.get("end_of_word_suffix")
                or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                              "byte_fallback", "ignore_merges"))):
            raise ValueError("expected a BPE file with word ends whose pre-tokenizer drops white space")
        whole = Tokenizer.from_file(path)
        self._normalize = whole.normalizer.normalize_str if whole.normalizer else str
        self._words = whole.pre_tokenizer.pre_tokenize_str
        suffix, vocab = model["end_of_word_suffix"], model["vocab"]
        merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self._last = models.BPE(vocab=vocab, merges=merges, end_of_word_suffix=suffix)
        self._inner = models.BPE(vocab=vocab, merges=merges)
        self.joined = set()                       # neighbours inside some vocabulary token
        for token in vocab:
            t = token.removesuffix(suffix)
            self.joined.update(map("".join, zip(t, t[1:])))
        special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
        self._special = {k: v.to_bytes(4, "little") for k, v in special.items()}
        self._split_special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        names = {v: k for k, v in vocab.items()} | {v: k for k, v in special.items()}
        self._names = [names.get(i, "").encode() for i in range(max(names, default=-1) + 1)]
        self._kept, self._limit = {}, kept_words
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        if not (split["invert"] and split["behavior"] == "Removed"):
            raise ValueError("expected a pattern that names the words")
        self._pattern = regex.compile(split["pattern"]["Regex"] + r"|\n")
        self._chars = byte_chars()
        self._symbol = np.array([vocab.get(c, -1) for c in self._chars], np.int32)
        self._end_symbol = np.array([vocab.get(c + suffix, -1) for c in self._chars], np.int32)
        if self._symbol.min() < 0 or self._end_symbol.min() < 0:
            raise ValueError("expected a vocabulary with every byte")
        self._joined_bytes = np.array([[a + b in self.joined for b in self._chars] for a in self._chars])
        self._joined_bytes[10, :] = self._joined_bytes[:, 10] = False
        self._table = lockstep.MergeTable(vocab, merges)

    def fragments(self, word: str) -> list[str]:
        """``word`` (as the pre-tokenizer gives it) cut at every certain boundary."""
        cuts = [0, *(i + 1 for i, pair in enumerate(map("".join, zip(word, word[1:])))
                     if pair not in self.joined), len(word)]
        return [word[a:b] for a, b in zip(cuts, cuts[1:])]

    def _encode_slow(self, chunk: str) -> bytes:
        """Any chunk, fragment by fragment."""
        ids = []
        for word, _ in self._words(self._normalize(chunk)):
            *inner, last = self.fragments(word)
            for f in inner:
                ids += [t.id for t in self._inner.tokenize(f)]
            ids += [t.id for t in self._last.tokenize(last)]
        return b"".join(i.to_bytes(4, "little") for i in ids)

    def _encode_new(self, chunks: list[str]) -> None:
        """Fills the table of kept words; chunks of letters below U+0250 go through the merges together."""
        fast = chunks
        if _ABOVE.search(text := "\n".join(fast)):
            slow = [c for c in chunks if _ABOVE.search(c)]
            for c in slow:
                self._kept[c] = self._encode_slow(c)
            fast = list(set(chunks).difference(slow))
            text = "\n".join(fast)
        if not fast:
            return
        text = text.lower() + "\n"                    # below U+0250 there is nothing else to normalize
        words = self._pattern.findall(text)
        flat = np.frombuffer(text.encode(), np.uint8)
        lead = np.append(np.flatnonzero((flat & 0xC0) != 0x80), len(flat))      # first byte of each character
        ends = lead[np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]
        last = np.zeros(len(flat), bool)
        last[ends - 1] = True
        cut = last.copy()
        cut[:-1] |= ~self._joined_bytes[flat[:-1], flat[1:]]
        sym = np.where(last, self._end_symbol[flat], self._symbol[flat])
        newline = flat == 10
        starts = np.concatenate([[0], np.flatnonzero(cut)[:-1] + 1])
        lengths = np.diff(np.append(starts, len(flat)))
        out, long = lockstep.merge(self._table, sym, starts, lengths)
        out[newline] = -1
        for i in long.tolist():
            a, b = int(starts[i]), int(starts[i] + lengths[i])
            model = self._last if last[b - 1] else self._inner
            ids = [t.id for t in model.tokenize("".join(self._chars[x] for x in flat[a:b].tolist()))]
            out[a:b] = -1
            out[a:a + len(ids)] = ids
        left = out >= 0
        at = np.concatenate([[0], np.cumsum(left)])[np.flatnonzero(newline)] * 4
        data, a = out[left].astype("<u4").tobytes(), 0
        for c, b in zip(fast, at.tolist()):
            self._kept[c] = data[a:b]
            a = b

    def _encode_plain(self, texts: list[str]) -> list[bytes]:
        lists = [t.split() if not _CONTROL.search(t) else [c for c in _BLANKS.split(t) if c] for t in texts]
        seen = set().union(*lists)
        if new := list(seen.difference(self._kept)):
            if len(self._kept) + len(new) > self._limit:
                self._kept = {k: self._kept[k] for k in seen & self._kept.keys()}
            self._encode_new(new)
        return [b"".join(map(self._kept.__getitem__, x)) for x in lists]

    def encode(self, text: str | None) -> bytes:
        """Token ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self._split_special is None or not any(s in text for s in self._special):
            return self._encode_plain([text])[0]
        return b"".join(self._special.get(p) or self._encode_plain([p])[0] for p in self._split_special.split(text))

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The same for many texts, about 2 MB of them at a time."""
        group, size = [], 0
        for t in texts:
            group.append(t or "")
            size += len(group[-1])
            if size >= 2_000_000:
                yield from self._encode_group(group)
                group, size = [], 0
        yield from self._encode_group(group)

    def _encode_group(self, group: list[str]) -> list[bytes]:
        odd = {i for i, t in enumerate(group) if any(s in t for s in self._special)}
        plain = iter(self._encode_plain([t for i, t in enumerate(group) if i not in odd]))
        return [self.encode(t) if i in odd else next(plain) for i, t in enumerate(group)]

    def decode(self, ids: bytes) -> bytes:
        """UTF-8 text of ids: the tokens' strings with single spaces between (this kind of file has no decoder)."""
        return b" ".join(map(self._names.__getitem__, memoryview(ids).cast("I"))) if ids else b""


_encoders: dict[str, ForcedBoundaryBPE] = {}


def encoder(path: str) -> ForcedBoundaryBPE:
    """The worker's encoder for a file; its table of words is kept between batches and tasks."""
    if path not in _encoders:
        _encoders[path] = ForcedBoundaryBPE(path)
    return _encoders[path]


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    return (x.as_py() for x in batch.column(1))


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text",
           more: Sequence[str] = ()) -> DataFrame:
    """(id, n_tokens long, token_ids binary) for every row of ``docs``, and the columns ``more`` as they are."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path)
        ids = list(enc.encode_many(_texts(b)))
        return pa.RecordBatch.from_arrays(
            [b.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()), *b.columns[2:]],
            names=[id_col, "n_tokens", "token_ids", *more])
    t = docs.select(id_col, text_col, *more)
    kind = t.schema[id_col].dataType.simpleString()
    rest = "".join(f", `{c}` {t.schema[c].dataType.simpleString()}" for c in more)
    return t.mapInArrow(by_batch(run), f"`{id_col}` {kind}, n_tokens long, token_ids binary{rest}")


def decode(tokens: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "token_ids") -> DataFrame:
    """(id, decoded string) for every row; null ids decode to the empty string."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path)
        texts = [enc.decode(x.as_py() or b"").decode() for x in b.column(1)]
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[id_col, "decoded"])
    t = tokens.select(id_col, ids_col)
    kind = t.schema[id_col].dataType.simpleString()
    return t.mapInArrow(by_batch(run), f"`{id_col}` {kind}, decoded string")


def round_trip_digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode from the ids, and digest both: (doc_id, n_tokens, ids_sha256, decoded_sha256)."""
    def run(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(path)
        out = []
        for doc_id, ids in zip(b.column(0).to_pylist(), enc.encode_many(_texts(b))):
            out.append((doc_id, len(ids) // 4, hashlib.sha256(ids).hexdigest(),
                        hashlib.sha256(enc.decode(ids)).hexdigest()))
        ids_, n, a, d = zip(*out)
        return pa.RecordBatch.from_arrays(
            [pa.array(ids_, b.schema.field(0).type), pa.array(n, pa.int64()), pa.array(a), pa.array(d)],
            names=[id_col, "n_tokens", "ids_sha256", "decoded_sha256"])
    t = docs.select(id_col, text_col)
    kind = t.schema[id_col].dataType.simpleString()
    return t.mapInArrow(by_batch(run),
                        f"`{id_col}` {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
