from __future__ import annotations

import zlib
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from tessera.llm import queries, shard
from brute import SF_SMALL, doc_table  # noqa: F401


@pytest.mark.parametrize("steps", [64, 3])
def test_jump_hash_is_the_published_one(spark, monkeypatch, steps):
    monkeypatch.setattr(shard, "STEPS", steps)  # with 3, many keys need the rest of the steps
    df = spark.range(500).select(F.xxhash64("id").alias("k"))
    for n in (1, 2, 24, 100, 5000 if steps == 64 else 30):
        for r in df.select("k", shard.jump_hash(F.col("k"), n).alias("s")).collect():
            assert r.s == brute.jump(r.k, n)


def _check(rows, texts_by_id=None):
    by = {}
    for r in rows:
        assert 0 <= r.shard < 24 and r.grown_shard in (r.shard, 24)
        by.setdefault(r.shard, []).append(r.slot)
    for slots in by.values():
        assert sorted(slots) == list(range(len(slots)))


def test_query(spark):
    rows = queries.op10_jump_shards(spark, SF_SMALL).collect()
    _check(rows)
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        data = docs[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 8, zlib.crc32(data), "key")


def test_nulls_repeats_blocks_and_clashing_columns(spark, doc_table, monkeypatch):
    monkeypatch.setattr(shard, "SLOT_BLOCK", 7)
    rows = [(i, "t%d" % i) for i in range(200)] + [(None, None), (None, ""), (3, "t3"), (3, "t3"), (5, "long " * 50_000)]
    out = shard.jump_shards(doc_table(rows), key="doc_id", text="text", shards=24).collect()
    _check(out)
    assert len(out) == len(rows) and len({r.shard for r in out if r.key is None}) == 1
    assert Counter(r.size for r in out)[8] == 2 and len({r.shard for r in out if r.key == 3}) == 1
    assert shard.jump_shards(doc_table(rows).limit(0), key="doc_id", text="text", shards=24).count() == 0


def test_written_shards(spark, doc_table, tmp_path):
    rows = [(i, "x") for i in range(100)]
    shard.write_shards(doc_table(rows).drop("shard"), f"{tmp_path}/s", key="doc_id", shards=4, files_per_shard=2)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == 100 and back.select("shard").distinct().count() == 4
