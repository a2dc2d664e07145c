from __future__ import annotations

import hashlib
import random
from functools import cache

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm import queries, sentence_pieces as sp
from brute import SF_SMALL, doc_table, odd_texts  # noqa: F401

MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["a  b", "  lead", "trail  ", "▁", "▁▁ x", " ▁ ", "日本語のテキスト", "🦜🦜", "<s> </s> <unk> <0x41>", "\x00\x01", "é" * 90, "ab" * 70, "▁▁a b",
       "ﬁne ①②  ｶﾞ  x", "́ é", "K  　 x", "½  ㍿", " ", "   ", "​", "­", "ﷺ  y", "\t\n x", "Ａ１ｂ"]


@cache
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@cache
def own():
    with open(MODEL, "rb") as f:
        return sp.Codec(sp.read_model(f.read()))


def _texts(odd):
    rng = random.Random(11)
    mixed = ["".join(rng.choice(ODD) for _ in range(rng.randint(1, 6))) for _ in range(400)]
    return ODD + mixed + [t or "" for t in odd[:600]]


def _pieces(codec, text, window=sp.WINDOW, runs=True):
    found = list(codec.encode(text, window, runs))
    return [tuple(int(x) for x in row) for part in found for row in zip(*part)]


def test_ids_and_spans_equal_the_library(odd_texts):
    for t in _texts(odd_texts):
        want = [(p.id, p.begin, p.end) for p in library().encode(t, return_type="proto").pieces]
        assert _pieces(own(), t) == want, t
        assert _pieces(own(), t, window=7) == _pieces(own(), t, runs=False) == want, t
        ids = np.array([i for i, _, _ in want], np.int32)
        assert own().decode(ids) == library().decode(ids.tolist()), t


def test_any_ids_decode_like_the_library():
    rng = random.Random(5)
    some = [rng.randrange(32_000) for _ in range(60)] + list(range(0, 262)) + [28705, 29871, 275]
    for _ in range(1500):
        ids = [rng.choice(some) for _ in range(rng.randint(0, 9))]
        assert own().decode(np.array(ids, np.int32)) == library().decode(ids), ids
    for bad in ([-1], [32_000]):
        with pytest.raises(ValueError, match="unknown token id"):
            own().decode(np.array(bad))


@pytest.mark.parametrize("flags", [(d, s, e) for d in (False, True) for s in (False, True) for e in (False, True)])
def test_character_map_equals_the_library(odd_texts, flags):
    dummy, squeeze, escape = flags
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc", add_dummy_prefix=dummy, remove_extra_whitespaces=squeeze,
                                                 escape_whitespaces=escape)
    spec = dict(sp._fields(rule.serialized_model_proto()))[3]
    model = sp.Model(char_map=dict(sp._fields(spec))[2], dummy_prefix=dummy, squeeze=squeeze, escape=escape)
    normalize = sp.Normalizer(model)
    for t in _texts(odd_texts):
        want, at = rule.normalize(t, with_offsets=True)
        got = list(normalize(t, runs=False))
        assert "".join(x for x, _ in got) == "".join(x for x, _ in normalize(t)) == want, t
        for x, origins in got:  # the library's offsets count characters
            assert len(origins) == len(x.encode()) + 1
            starts = np.cumsum([0, *(len(c.encode()) for c in x)])
            assert [len(t.encode()[:origins[i]].decode()) for i in starts] == list(at), t
        assert "".join(x for x, _ in normalize(t, 5)) == want, t


def test_replaced_characters_project_to_their_source():
    rule = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    model = sp.Model(char_map=dict(sp._fields(dict(sp._fields(rule.serialized_model_proto()))[3]))[2], squeeze=True,
                     pieces=["<unk>", "▁", "f", "i", "fi", "▁x"], scores=[0, -3.0, -4.0, -4.0, -1.0, -2.0], kinds=[2, 1, 1, 1, 1, 1])
    codec = sp.Codec(model)
    # the ligature's three bytes are one piece, two spaces are one, unknown neighbours are one piece
    assert _pieces(codec, "ﬁ  xqq") == [(1, 0, 0), (4, 0, 3), (5, 3, 6), (0, 6, 8)]


def test_unfit_models_raise():
    with open(MODEL, "rb") as f:
        data = f.read()
    with pytest.raises(NotImplementedError):
        sp.read_model(data + b"\x0a\x09\x0a\x05a\xe2\x96\x81b\x18\x01")  # a piece with white space inside
    with pytest.raises(NotImplementedError):
        sp.read_model(data + b"\x0a\x07\x0a\x03abc\x18\x04")  # a user-defined piece


def test_long_texts_and_units():
    for t in ("word " * 60_000, "a" * 3000, "日本" * 2000, " " * 3000 + "x", "x" + " " * 2000):
        want = library().encode(t)
        assert [i for i, _, _ in _pieces(own(), t, 5000)] == want
    assert all(len(k) <= sp.LONG_UNIT for k in [*own().memo, *own().inner])


def test_tables(spark, doc_table):
    rows = [(1, "Hello  wörld ▁ 🦜"), (None, None), (2, ""), (2, ""), (3, "x " * 50_000)]
    ids = sp.encode_table(doc_table(rows), key="doc_id", text="text", model=MODEL)
    for r in ids.collect():
        text = next(t or "" for i, t in rows if i == r.key)
        assert r.ids == library().encode(text)
        assert b"".join(text.encode()[a:b] for a, b in zip(r.begins, r.ends)) == text.encode()
    back = sp.decode_table(ids.unionAll(ids.limit(1).select(F.lit(9).alias("key"), *[F.lit(None).alias(c) for c in ("ids", "begins", "ends")])),
                           key="key", ids="ids", model=MODEL).collect()
    assert sorted(((r.key or 0), r.text or "") for r in back) == sorted([(1, "Hello  wörld   🦜"), (0, ""), (2, ""), (2, ""), (3, "x " * 50_000), (9, "")])
    assert [r.text for r in back if r.key == 9] == [None]
    assert sp.encode_table(doc_table([]), key="doc_id", text="text", model=MODEL).count() == 0


def test_op11_digests(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    rows = queries.op11_sentence_pieces(spark, SF_SMALL).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = library().encode(docs[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library().decode(ids).encode()).hexdigest() and r.covered
