from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from functools import cache

import brute
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tessera.llm import bpe_fst, queries, token_count, token_records
from brute import SF_SMALL, doc_table, odd_texts  # noqa: F401

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


library_of = cache(token_count.tokenizer)


def _library(path, text):
    return library_of(path).encode(text or "", add_special_tokens=False).ids


def test_chunks_splice_to_the_whole(odd_texts):
    rng = random.Random(1)
    tok = library_of(BYTE)
    for t in odd_texts:
        t = (t or "") * 3
        chunk, overlap = rng.choice([20, 37, 64]), rng.choice([4, 9, 16])
        assert [i for part in token_count.chunked_ids(tok, t, chunk, overlap) for i in part] == _library(BYTE, t)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000, "x" + " " * 900 + "y z", "é" * 500 + "." * 2000, "<|endoftext|>" * 200, "\n\n a" * 600])
def test_widening_where_nothing_aligns(text):
    tok = library_of(BYTE)
    assert [i for part in token_count.chunked_ids(tok, text, 64, 8) for i in part] == _library(BYTE, text)


def test_runs_count_like_the_whole(odd_texts, monkeypatch):
    monkeypatch.setattr(token_count, "ROOM", 50)
    count = token_count.counter(library_of(BYTE))
    rng = random.Random(4)
    words = ["word", "the", "a", "x.", "don't", "é", "12", "!?", "<|endoftext|>", "日本", "\x1c", "<|", "'s", "\u200b"]
    texts = [t or "" for t in odd_texts] + ["".join(rng.choice(words) + rng.choice([" ", "\n", "", " ", " "]) for _ in range(40)).strip()
                                            for _ in range(500)]
    for at in range(0, len(texts), 37):
        some = texts[at:at + 37]
        assert count(some) == [len(_library(BYTE, t)) for t in some]


def test_counts(spark, doc_table, odd_texts):
    rows = [(i if i % 9 else None, t) for i, t in enumerate(odd_texts[:300] + odd_texts[-4:])] + [(1, "word " * 20_000)] * 2
    got = token_count.count_tokens(doc_table(rows), key="doc_id", text="text", vocabulary=BYTE, limit=10).collect()
    want = Counter((i, len((t or "").encode()), len(_library(BYTE, t)), len(_library(BYTE, t)) > 10) for i, t in rows)
    assert Counter(tuple(r) for r in got) == want
    assert token_count.count_tokens(doc_table(rows).limit(0), key="doc_id", text="text", vocabulary=BYTE, limit=1).count() == 0


def test_records_round_trip(spark, doc_table, odd_texts, tmp_path, monkeypatch):
    monkeypatch.setattr(token_records, "FILE_BYTES", 40_000)
    rows = [(i if i % 50 else None, t) for i, t in enumerate(odd_texts)] + [(3, "abc"), (3, "abc"), (3, "0 10 a0b")]
    path = str(tmp_path / "r")
    token_records.write_records(doc_table(rows), path, key="doc_id", text="text", vocabulary=WORD, end_id=1, width=2)
    index = token_records.write_index(spark, path)
    ids = [(i, [*_library(WORD, t), 1]) for i, t in rows]
    got = index.orderBy("first_token").collect()
    assert Counter((r.key, r.n_tokens, r.ids_crc32) for r in got) == Counter(
        (i, len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for i, x in ids)
    total = 0
    for r in got:
        assert r.first_token == total
        total += r.n_tokens
    keys = [-1 if r.key is None else r.key for r in got]
    assert keys == sorted(keys) and len({r.file for r in got}) > 1
    whole = token_records.read_records(spark, path).collect()
    assert Counter((r.key, tuple(r.ids)) for r in whole) == Counter((i, tuple(x)) for i, x in ids)
    some = index.where("ordinal % 7 = 0").orderBy(token_records.shuffled_keys(index, 5))
    picked = token_records.read_records(spark, path, some).collect()
    assert Counter((r.key, len(r.ids)) for r in picked) == Counter((r.key, r.n_tokens) for r in some.collect())


def test_records_of_nothing_and_damage(spark, doc_table, tmp_path):
    path = str(tmp_path / "e")
    token_records.write_records(doc_table([]), path, key="doc_id", text="text", vocabulary=WORD, end_id=1)
    assert token_records.write_index(spark, path).count() == 0
    good = token_records.frame(token_records.payload_of(7, b"\1\0\0\0", 4)) + b"\n"
    assert [token_records.parsed(p)[0] for _, p in token_records.frames(memoryview(good * 3))] == [7, 7, 7]
    for at in range(len(good)):
        broken = bytearray(good)
        broken[at] ^= 1
        with pytest.raises(ValueError):
            list(token_records.frames(memoryview(bytes(broken))))


@pytest.fixture(scope="module")
def codec():
    return bpe_fst.codec(RANKS, public_tokenizers.PATTERN)


def test_transducer_equals_the_merges(codec, odd_texts):
    ranks = bpe_fst.read_ranks(RANKS)
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for t in odd_texts:
        ids = np.frombuffer(codec.encode(t or ""), "<u4")
        assert ids.tolist() == library.encode_ordinary(t or "")
        assert "".join(codec.decode(ids)) == (t or "")
    rng = random.Random(2)
    for _ in range(1500):
        data = bytes(rng.choice(b"abcdeintshor0 =-\xc3\xa9") for _ in range(rng.randint(1, 30)))
        assert codec.transducer.encode(data) == brute.merges(ranks, data)


def test_every_token_is_its_own_encoding(codec):
    assert all(codec.transducer.encode(t) == [r] for t, r in bpe_fst.read_ranks(RANKS).items())


def test_dropped_states_and_small_windows(odd_texts, codec, monkeypatch):
    import regex
    want = [codec.encode(t or "") for t in odd_texts[:300]]
    monkeypatch.setattr(bpe_fst, "STATES", 50)
    small = bpe_fst.Codec(bpe_fst.read_ranks(RANKS), public_tokenizers.PATTERN)
    assert [small.encode(t or "") for t in odd_texts[:300]] == want
    pattern = regex.compile(public_tokenizers.PATTERN)
    for t in odd_texts[:300]:
        assert [p for part in bpe_fst.pieces(pattern, t or "", 5) for p in part] == pattern.findall(t or "")


def test_utf8_stream():
    text = "aé日👍🏽z" * 5
    data = text.encode()
    for step in (1, 2, 3, 5):
        s = bpe_fst.Utf8Stream()
        assert "".join(s.feed(data[i:i + step]) for i in range(0, len(data), step)) + s.end() == text
    s = bpe_fst.Utf8Stream()
    assert s.feed(b"a\xf0\x9f") + s.feed(b"b\xff\xc3") + s.end() == b"a\xf0\x9fb\xff\xc3".decode("utf-8", "replace")


def test_codec_tables(spark, doc_table):
    rows = [(1, "Hello, wörld's"), (None, None), (2, ""), (2, ""), (3, "x " * 100_000)]
    args = dict(vocabulary=RANKS, pattern=public_tokenizers.PATTERN)
    ids = bpe_fst.encode_table(doc_table(rows), key="doc_id", text="text", **args)
    back = bpe_fst.decode_table(ids, key="key", ids="ids", **args).collect()
    assert Counter((r.key, r.text) for r in back) == Counter((i, t or "") for i, t in rows)
    with pytest.raises(Exception, match="unknown token id"):
        bpe_fst.decode_table(spark.createDataFrame([(1, [99999])], "key long, ids array<int>"), key="key", ids="ids", **args).collect()


def test_op6_digests(spark):
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe_fst.read_ranks(RANKS), special_tokens={})
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in queries.op6_byte_bpe(spark, SF_SMALL).collect():
        ids = np.array(library.encode_ordinary(docs[r.doc_id]), "<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(docs[r.doc_id].encode()).hexdigest()


def test_op2_and_op5_queries(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries.op2_token_counts(spark, SF_SMALL).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {
        (i, len((t or "").encode()), len(_library(BYTE, t)), len(_library(BYTE, t)) > 1024) for i, t in docs.items()}
    start, want = 0, {}
    for i in sorted(docs):
        ids = [*_library(WORD, docs[i]), 1]
        want[i] = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op5_token_records(spark, SF_SMALL).collect()} == want
