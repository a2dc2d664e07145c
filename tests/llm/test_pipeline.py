from __future__ import annotations

import brute
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline as C
from tessera.llm import queries
from tessera.llm.registry import QUERIES, SQL
from brute import SF_SMALL  # noqa: F401


def test_registered():
    assert {n.split("_")[0] for n in QUERIES} == {f"op{i}" for i in range(1, 14)}
    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and set(SQL) <= set(E.oracle_sql())
    assert [n for n, _ in C.STAGES] == ["toxicity", "near_dup", "decontaminate", "byte_bpe"]


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, duck, name):
    got = QUERIES[name](spark, SF_SMALL)
    rel = duck.sql(SQL[name])
    assert sorted(rel.columns) == sorted(got.columns)
    assert sorted(map(tuple, got.select(rel.columns).collect())) == sorted(rel.fetchall())


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    items = [brute.shingle_set(r.text, 5, short=False) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    toxic = {r.doc_id for r in queries.op9_toxicity(spark, SF_SMALL).where("predicted = 1").collect()}
    left = sorted(i for i in docs if i not in toxic)
    groups, _ = brute.near_groups([docs[i] for i in left], 5, 80)
    left = [left[k] for k in range(len(left)) if groups[k] == k]
    sets = {i: brute.shingle_set(docs[i], 5, short=False) for i in left}
    left = [i for i in left if not any(s and 100 * len(s & sets[i]) >= 80 * len(s) for s in items)]
    got = C.run(spark, SF_SMALL).collect()
    assert sorted(r.doc_id for r in got) == left and all(r.same for r in got)


def test_stages_keep_columns_and_odd_rows(spark):
    rows = [(1, None, "x", 1.0), (2, "", "x", 1.0), (None, "a kind word or two", "x", 1.0), (3, "a kind word or two more than that", None, None),
            (3, "a kind word or two more than that", None, None), (4, "word " * 50_000, "y", 2.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string, _keep double")
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, docs, SF_SMALL)
        assert out.columns == docs.columns
        want = 5 if name == "near_dup" else 6
        assert out.count() == want, name
        assert stage(spark, docs.limit(0), SF_SMALL).count() == 0
    last = C.STAGES[-1][1](spark, docs, SF_SMALL)
    assert last.count() == 6 and last.where(~F.col("same")).count() == 0
