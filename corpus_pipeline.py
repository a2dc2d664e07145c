"""Corpus cleaning pipeline: toxicity, near-duplicates, benchmark leaks, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its result is written as Parquet
and read again as the next stage's docs. All stages but the last return the columns of docs. Nulls,
blank texts, repeated rows, empty tables and further columns are handled as the operators' own
docstrings say; the filtering stages keep every row that they have no reason to drop.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tessera.llm import bpe_fst, decontaminate, near_dup, toxicity
from tessera.llm.common import read_table, written
from tessera.llm.queries import TOXIC, toxicity_model


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose toxicity score stays below the threshold; labelled rows of ``docs`` teach the model."""
    return toxicity.keep_below(docs, toxicity_model(spark, docs, sf_dir), text="text", limit=TOXIC)


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates (five-word shingles, similarity 0.8): the least id's.

    Documents without words are linked with nothing and stay. Rows that repeat an id and a text
    stay once.
    """
    return near_dup.keep_one(docs, doc_id="doc_id", text="text", width=5, percent=80)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold less than 0.8 of every benchmark item's five-word shingles."""
    links = decontaminate.contained_items(docs, read_table(spark, sf_dir, "benchmark"), doc_id="doc_id", text="text",
                                          item_id="item_id", item_text="text", width=5, percent=80)
    return decontaminate.drop_contaminated(docs, links, doc_id="doc_id", text="text")


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row: doc_id, token count, digests of the ids and of the decoded text, and whether it came back whole."""
    return bpe_fst.round_trip(docs, key="doc_id", text="text", vocabulary=public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              pattern=public_tokenizers.PATTERN).withColumnRenamed("key", "doc_id")


STAGES = [("toxicity", toxicity_stage), ("near_dup", near_dup_stage), ("decontaminate", decontaminate_stage), ("byte_bpe", bpe_stage)]

#: A trained score and byte-pair merges can't be written in SQL; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
