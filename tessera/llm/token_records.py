"""Token ids as length-delimited binary records, with a separate offset index.

A file is a run of frames in ascending key order:

    uint64 length | uint32 masked CRC of those 8 bytes | payload | uint32 masked CRC of the payload | 0x0A
    payload: int64 key | uint8 1 if the key is null | uint8 bytes per id (2 or 4) | the ids

All numbers are little-endian. A CRC is zlib's CRC-32, masked by rotation and a constant, so that
a checksum stored inside checksummed bytes doesn't weaken them. The last byte is the line end that
Spark's text writer puts after each row: files are written, committed and retried by Spark, on any
store. The index is a Parquet table of (file, ordinal, key, offset, length, n_tokens, ids_crc32,
first_token): a reader can fetch records in any order from the offsets.

Null and empty texts have only the end id. Null keys come first. Repeated keys are all written,
ordered by a hash of the text. An empty table gives no files and no rows. Frames of a bad length
or checksum raise an error.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import blocks_of
from tessera.llm.texts import releasing, slices, worker_cache
from tessera.llm.token_count import tokenizer
from tessera.llm.wordhash import WordHasher, WordTable

#: Text bytes that a file holds about: bounds what a reading task keeps in memory.
FILE_BYTES = 16 << 20
#: Words whose ids a worker keeps (some 40 bytes each).
MEMO_ROOM = 1_000_000

# Fixed value: the constant of the masked checksum.
MASK_DELTA = 0xA282EAD8
_HEAD, _KEY = struct.Struct("<QI"), struct.Struct("<qBB")
# Latin letters whose lower case is one letter each, in any context, and that no normal form changes.
_SIMPLE = re.compile("([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u012f\u0131-\u024f\u0250-\u02af]+)([.,;:!?]?)").fullmatch


def masked_crc(data: bytes | memoryview) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    """Lengths, checksums and payload of a record, without the line end."""
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked_crc(length)), payload, struct.pack("<I", masked_crc(payload))))


def frames(data: memoryview) -> Iterator[tuple[int, memoryview]]:
    """(offset, payload) of each record, all checksums verified."""
    at = 0
    while at < len(data):
        length, crc = _HEAD.unpack_from(data, at)
        if masked_crc(data[at:at + 8]) != crc or at + 17 + length > len(data):
            raise ValueError(f"bad record length at byte {at}")
        payload = data[at + 12:at + 12 + length]
        if struct.unpack_from("<I", data, at + 12 + length)[0] != masked_crc(payload) or data[at + 16 + length] != 0x0A:
            raise ValueError(f"bad record at byte {at}")
        yield at, payload
        at += 17 + length


def payload_of(key: int | None, ids: bytes, width: int) -> bytes:
    return _KEY.pack(key or 0, key is None, width) + ids


def parsed(payload: memoryview) -> tuple[int | None, np.ndarray]:
    """Key and ids (uint32) of a payload."""
    key, null, width = _KEY.unpack_from(payload, 0)
    ids = np.frombuffer(payload, {2: "<u2", 4: "<u4"}[width], offset=_KEY.size)
    return (None if null else key), ids.astype("<u4")


def word_encoder(path: str, width: int):
    """A function of texts giving their ids as little-endian bytes.

    For a tokenizer that lower-cases and drops white space, words between ASCII white space are
    encoded apart: no merge, normalisation or special string spans a space. So a worker keeps the
    ids of words it has met, in a bounded table of fingerprints, and gives only new words to the
    library: words of Latin letters, with a mark of punctuation at the end or without, lower-cased
    and parted by spaces, through a copy of the tokenizer without the normaliser and the pattern,
    which change nothing there (a token with the end-of-word suffix ends each part); all others
    one by one through the whole tokenizer.
    """
    from tokenizers import normalizers
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit
    tok = tokenizer(path)
    plain = tok.from_file(path)
    plain.normalizer = normalizers.Sequence([])
    plain.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
    ends_word = np.zeros(tok.get_vocab_size(), bool)
    ends_word[[i for t, i in tok.get_vocab().items() if t.endswith("</w>")]] = True
    kind = {2: "<u2", 4: "<u4"}[width]

    def encode(new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        sizes, parts, marked, odd = np.zeros(len(new), np.int64), [], [], []
        simple = np.zeros(len(new), bool)
        for i, w in enumerate(new):
            found = _SIMPLE(w.decode())
            if found:
                simple[i] = True
                core, mark = found.groups()
                parts.append(core.lower() + " " + mark if mark else core.lower())
                marked.append(2 if mark else 1)
            else:
                odd.append(w.decode())
        done = plain.encode_batch_fast([" ".join(parts[i:i + 1000]) for i in range(0, len(parts), 1000)], add_special_tokens=False)
        ids = np.array([x for e in done for x in e.ids], np.uint32)
        stops = np.append(0, np.flatnonzero(ends_word[ids]) + 1)[np.append(0, np.cumsum(marked, dtype=np.int64))]
        if len(parts) and stops[-1] != len(ids):
            raise AssertionError("a word without an end")
        sizes[simple] = np.diff(stops)
        others = [np.array(e.ids, np.uint32) for e in tok.encode_batch_fast(odd, add_special_tokens=False)]
        sizes[~simple] = [len(x) for x in others]
        out = np.empty(int(sizes.sum()), np.uint32)
        owner = np.repeat(simple, sizes)
        out[owner] = ids
        if others:
            out[~owner] = np.concatenate(others)
        return out.astype(kind), sizes

    hasher, table = WordHasher(), WordTable(encode, MEMO_ROOM)

    def work(texts: list[str]) -> list[bytes]:
        data = [t.encode() for t in texts]
        whole = b" ".join(data)
        hashes, starts, stops = hasher(whole)
        ids, sizes = table.over(whole, hashes, starts, stops)
        ids = ids.astype(kind, copy=False)
        # the last word that starts before a text's end closes its ids
        text_ends = np.cumsum([len(d) + 1 for d in data])
        cut = np.append(0, np.cumsum(sizes))[np.searchsorted(starts, text_ends)]
        return [ids[a:b].tobytes() for a, b in zip([0, *cut[:-1].tolist()], cut.tolist())]
    return work


def write_records(df: DataFrame, path: str, *, key: str, text: str, vocabulary: str, end_id: int, width: int = 4) -> None:
    """Encode every text, append ``end_id`` and write the files under ``path/records`` in key order.

    Rows are range-partitioned by (key, hash of the text), so one heavy key still spreads; the
    number of files follows the bytes of text.
    """
    rows = df.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long") + F.lit(32))).first()[0] or 0
    order = [F.col("key").asc_nulls_first(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(blocks_of(total, FILE_BYTES), *order).sortWithinPartitions(*order)
    end = int(end_id).to_bytes(width, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache(("words", vocabulary, width), lambda: word_encoder(vocabulary, width))
        for batch in batches:
            keys = batch.column(0).to_pylist()
            for start, texts in slices(batch, 1):
                out = [frame(payload_of(k, ids + end, width)) for k, ids in zip(keys[start:start + len(texts)], encode(texts))]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    (dealt.mapInArrow(releasing(run), "frame binary").select(F.col("frame").cast("string").alias("value"))
     .write.mode("overwrite").text(f"{path}/records"))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/records")
            .select(F.element_at(F.split("path", "/"), -1).alias("file"), "content"))


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Read the files back, verify every frame and write ``path/index``; returns the index."""
    kinds = pa.schema([("file", pa.string()), ("ordinal", pa.int64()), ("key", pa.int64()), ("offset", pa.int64()),
                       ("length", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("before", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                name, tokens, rows = batch.column(0)[i].as_py(), 0, []
                for n, (at, payload) in enumerate(frames(memoryview(batch.column(1)[i].as_buffer()))):
                    key, ids = parsed(payload)
                    rows.append((name, n, key, at, len(payload) + 17, len(ids), zlib.crc32(ids), tokens))
                    tokens += len(ids)
                columns = list(zip(*rows)) or [()] * len(kinds)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, kinds)], schema=kinds)

    raw = _files(spark, path).mapInArrow(
        run, "file string, ordinal long, key long, offset long, length long, n_tokens long, ids_crc32 long, before long")
    raw.write.mode("overwrite").parquet(f"{path}/scanned")
    scanned = spark.read.schema(raw.schema).parquet(f"{path}/scanned")
    # one row per file, in the order of the partitions
    part = F.regexp_extract("_name", r"^part-(\d+)", 1).cast("long")
    before = Window.orderBy(part, "_name").rowsBetween(Window.unboundedPreceding, -1)
    first = (scanned.groupBy(F.col("file").alias("_name")).agg(F.sum("n_tokens").alias("n"))
             .select("_name", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first")))
    index = (scanned.join(first, F.col("file") == F.col("_name"))
             .withColumn("first_token", F.col("_first") + F.col("before")).drop("_name", "_first", "before"))
    index.write.mode("overwrite").parquet(f"{path}/index")
    return spark.read.schema(index.schema).parquet(f"{path}/index")


def read_records(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """``key, ids`` of all records, or of those index rows that ``wanted`` holds (a shuffled read).

    A file's wanted offsets travel to it; records are cut out there and verified one by one.
    """
    files = _files(spark, path)
    if wanted is None:
        picked = files.withColumn("offsets", F.lit(None).cast("array<long>"))
    else:
        picked = files.join(wanted.groupBy("file").agg(F.collect_list("offset").alias("offsets")), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data, offsets = memoryview(batch.column(0)[i].as_buffer()), batch.column(1)[i].as_py()
                found = frames(data) if offsets is None else (next(frames(data[o:])) for o in offsets)
                rows = [parsed(p) for _, p in found]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([k for k, _ in rows], pa.int64()), pa.array([v.astype("i4") for _, v in rows], pa.list_(pa.int32()))],
                    ["key", "ids"])

    return picked.select("content", "offsets").mapInArrow(run, "key long, ids array<int>")


def shuffled_keys(index: DataFrame, seed: int) -> Column:
    """An order for shuffled reads: a hash of place and seed."""
    return F.xxhash64("file", "ordinal", F.lit(seed))
