import hashlib
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from songemo.llm import bpe, byte_bpe, token_blocks
from songemo.llm.base import arrow_fs, qualified
from songemo.llm.queries import vocabulary

ODD = ["", None, " ", "Hello, World!!  it's 42°\n\tno", "x\x1cy \x1f z", "a<|endoftext|>b <|startoftext|> C", "é" * 300,
       "éclair   İstanbul ΣΑΣ", "日本語 テキスト 한국어", "aaaa" * 5000, "a b  c \n\n d ", "👩‍👩‍👧 ok", "'S 'll don't",
       "naïve​word", "͸\U0001f9ff"]


@cache
def library(name):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(vocabulary(name))
    t.no_padding()
    t.no_truncation()
    return t


@cache
def small_bpe():
    return bpe.ForcedBoundaryBPE(vocabulary("word_bpe_49k.json"), 50)


@cache
def small_chunks():
    return byte_bpe.ByteBPE(vocabulary("byte_bpe_50k.json"), 50)


@pytest.fixture(scope="module")
def words():
    return library("word_bpe_49k.json"), bpe.ForcedBoundaryBPE(vocabulary("word_bpe_49k.json"))


@pytest.mark.parametrize("text", ODD)
def test_bpe_equals_library(words, text):
    lib, own = words
    ids = lib.encode(text or "", add_special_tokens=False).ids
    got = own.encode(text)
    assert np.frombuffer(got, "<u4").tolist() == ids
    assert own.decode(got).decode() == lib.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_bpe_equals_library_any_text(text):
    lib, own = library("word_bpe_49k.json"), small_bpe()
    assert np.frombuffer(own.encode(text), "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_chunks_equal_library(text):
    lib, own = library("byte_bpe_50k.json"), small_chunks()
    for t in (text, f"a {text}b c's", text.replace(" ", "x")):
        assert own.encode(pa.array([t]))[0].tolist() == lib.encode(t, add_special_tokens=False).ids


def test_chunks_equal_library_odd():
    lib, own = library("byte_bpe_50k.json"), small_chunks()
    for batch in (ODD, ODD[::-1], ["one two", None, "", "two one\n\nthree\n"]):
        for t, ids in zip(batch, own.encode(pa.array(batch))):
            assert ids.tolist() == lib.encode(t or "", add_special_tokens=False).ids


def test_fragments_cut_only_where_no_token_joins(words):
    _, own = words
    pieces = own.fragments("qzxjqzzwvq")
    assert "".join(pieces) == "qzxjqzzwvq" and len(pieces) > 1
    assert all(a[-1] + b[0] not in own.joined for a, b in zip(pieces, pieces[1:]))


def test_bpe_query_shape(spark, make_docs):
    docs = make_docs([*ODD, ODD[3]], extra=("n_tokens", "token_ids"))
    lib = library("word_bpe_49k.json")
    path = vocabulary("word_bpe_49k.json")
    got = {r.doc_id: r for r in bpe.round_trip_digests(docs, path).collect()}
    for i, t in enumerate([*ODD, ODD[3]]):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    enc = bpe.encode(docs, path)
    dec = {r.doc_id: r.decoded for r in bpe.decode(enc, path).collect()}
    assert dec[3] == lib.decode(lib.encode(ODD[3], add_special_tokens=False).ids)
    assert bpe.round_trip_digests(docs.limit(0), path).count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, 5000])
@pytest.mark.parametrize("top", [1, 2, 50_000, 2**32])
@pytest.mark.parametrize("percentile", [50, 95, 100])
def test_blocks_round_trip(n, top, percentile):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, top, n, dtype=np.uint64).astype(np.uint32)
    ids[::37] = top - 1
    data, meta = token_blocks.pack(ids, percentile)
    assert len(data) == meta["bytes"].sum()
    assert token_blocks.unpack(data, meta)[:n].tolist() == ids.tolist()


def test_shards_read_back(spark, make_docs, tmp_path):
    rows = [(i * 7 % 101, t) for i, t in enumerate(ODD * 3)] + [(None, "no id"), (5, "again"), (5, "again")]
    docs = make_docs(rows, extra=("shard", "start", "path"))
    lib = library("byte_bpe_50k.json")
    man = token_blocks.write(docs, str(tmp_path / "s"), vocabulary("byte_bpe_50k.json"), shards=3)
    got = token_blocks.read_digests(man).collect()
    assert len(got) == len(rows)
    want = sorted((d is not None, d or 0, len(i := lib.encode(t or "", add_special_tokens=False).ids + [0]),
                   zlib.crc32(np.asarray(i, "<u4").tobytes())) for d, t in rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order)
    whole = {(r.start, r.token_ids) for r in token_blocks.read(man).collect()}
    assert {(r.start, r.ids_crc32) for r in got} == {(s, zlib.crc32(b)) for s, b in whole}
    empty = token_blocks.write(docs.limit(0), str(tmp_path / "e"), vocabulary("byte_bpe_50k.json"))
    assert token_blocks.read_digests(empty).count() == 0


def test_folders_are_named_as_spark_resolves_them(spark, tmp_path):
    assert qualified(spark, str(tmp_path)) == qualified(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
    assert arrow_fs(qualified(spark, str(tmp_path)))[1] == str(tmp_path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    before = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://tables/")
    conf.set("fs.viewfs.mounttable.tables.link./data", f"file://{tmp_path}")
    try:
        assert qualified(spark, "/data/x") == "viewfs://tables/data/x"
    finally:
        conf.set("fs.defaultFS", before)
