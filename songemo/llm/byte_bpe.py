"""Byte-level BPE of whole batches: Arrow numbers the words, the tokenizers library encodes the new ones.

The byte-level pattern always cuts before a single space that stands between
two characters that are no white space.  Arrow cuts a batch of texts at its
spaces and numbers the distinct words; only those that the worker has not
seen are split by the pattern and encoded by the library's model.  Texts where a space
stands beside other white space or at an end, or that hold special-token
strings, white space other than space and newline, control characters, or
letters from U+0240 up (where Unicode versions may differ) are encoded whole
by the tokenizers library.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from .base import byte_chars

#: Words whose ids a worker keeps (about 200 bytes each).
KEPT_WORDS = 1_500_000
_SHOWN = dict(enumerate(byte_chars()))
#: The pattern of the vocabulary (fixed value), with U+001C between words.
_PIECES = regex.compile(r"\x1c|'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\x1c\p{L}\p{N}]+"
                        r"|[^\S\x1c]+(?![^\s\x1c])|[^\S\x1c]+")


class ByteBPE:
    def __init__(self, path: str, kept_words: int = KEPT_WORDS):
        from tokenizers import Tokenizer
        self._tok = Tokenizer.from_file(path)
        self._tok.no_padding()
        self._tok.no_truncation()
        spec = json.loads(self._tok.to_str())
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        if (model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space")
                or not pre.get("use_regex") or spec.get("normalizer")
                or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix",
                                              "end_of_word_suffix", "byte_fallback", "ignore_merges"))):
            raise ValueError("expected a plain byte-level BPE file")
        self._special = [a["content"] for a in spec.get("added_tokens", [])]
        self._model = self._tok.model
        self._limit = kept_words
        self._clear()

    def _clear(self) -> None:
        self._kept: dict[str, int] = {}
        self._pool, self._from, self._n = np.zeros(0, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self._tok.encode(text, add_special_tokens=False).ids, np.uint32)

    def _encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words, and how many each has."""
        text = "\x1c".join(words) + "\x1c"
        pieces = _PIECES.findall(text)
        ends = np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)))
        raw = text.encode()
        lead = np.flatnonzero((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)     # first byte of each character
        ends = np.append(lead, len(raw))[ends].tolist()
        shown, tokenize = raw.decode("latin-1").translate(_SHOWN), self._model.tokenize
        ids, n, a = [], [], 0
        for b in ends:
            if raw[a] == 0x1C:
                n.append(len(ids))
            else:
                ids += [t.id for t in tokenize(shown[a:b])]
            a = b
        return np.array(ids, np.uint32), np.diff(n, prepend=0)

    def _places(self, words: list[str]) -> np.ndarray:
        """The kept place of each of some distinct words."""
        kept = self._kept
        new = [w for w in words if w not in kept]
        if new:
            if len(kept) + len(new) > self._limit:
                self._clear()
                kept, new = self._kept, words
            ids, n = self._encode_words(new)
            kept.update(zip(new, range(len(kept), len(kept) + len(new))))
            start = len(self._pool) + np.concatenate([[0], np.cumsum(n)[:-1]])
            self._pool = np.concatenate([self._pool, ids])
            self._from, self._n = np.concatenate([self._from, start]), np.concatenate([self._n, n])
        return np.fromiter(map(kept.__getitem__, words), np.int64, len(words))

    def _odd(self, texts: pa.Array) -> np.ndarray:
        """Which texts go to the library whole: by their bytes, all at once."""
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        b = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]]
        ends = offsets[1:] - offsets[0]
        blank = (b == 32) | (b == 10)
        bad = (b >= 0xC9) | ((b < 32) & (b != 10))              # letters from U+0240 up; other white space, controls
        bad[1:] |= (b[:-1] == 0xC2) & ((b[1:] == 0x85) | (b[1:] == 0xA0))
        bad[1:] |= blank[:-1] & blank[1:] & ((b[:-1] == 32) | (b[1:] == 32))
        odd = np.zeros(len(texts), bool)
        odd[np.searchsorted(ends, np.flatnonzero(bad), side="right")] = True
        some = np.diff(offsets) > 0
        odd[some] |= (b[ends[some] - 1] == 32) | (b[offsets[:-1][some] - offsets[0]] == 32)
        for x in self._special:
            odd |= pc.match_substring(texts, x).to_numpy(zero_copy_only=False)
        return odd

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Token ids of every text; a null text is empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        odd = self._odd(texts)
        out = [self._whole(texts[i].as_py()) if x else None for i, x in enumerate(odd.tolist())]
        plain = np.flatnonzero(~odd)
        if len(plain):
            words = pc.split_pattern(texts.take(pa.array(plain)), " ")
            numbered = pc.list_flatten(words).dictionary_encode()
            first = words.offsets.to_numpy()[:-1] - words.offsets[0].as_py()
            heads = pc.take(pc.list_flatten(words), pa.array(first)).to_pylist()
            alone = dict.fromkeys(heads)
            known = [" " + w for w in numbered.dictionary.to_pylist()]
            place = self._places(list(dict.fromkeys([*known, *alone])))
            at = dict(zip(dict.fromkeys([*known, *alone]), place.tolist()))
            lookup = np.fromiter(map(at.__getitem__, known), np.int64, len(known))
            word = lookup[numbered.indices.to_numpy()]
            word[first] = np.fromiter(map(at.__getitem__, heads), np.int64, len(heads))
            n = self._n[word]
            ends = np.cumsum(n)
            ids = self._pool[np.arange(ends[-1]) + np.repeat(self._from[word] - (ends - n), n)]
            cuts = np.append(ends[first] - n[first], len(ids))
            for k, i in enumerate(plain.tolist()):
                out[i] = ids[cuts[k]:cuts[k + 1]]
        return out


_encoders: dict[str, ByteBPE] = {}


def encoder(path: str) -> ByteBPE:
    """The worker's encoder for a file; its table of words is kept between batches and tasks."""
    if path not in _encoders:
        _encoders[path] = ByteBPE(path)
    return _encoders[path]
