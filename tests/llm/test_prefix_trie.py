from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import prefix_trie, queries
from tessera.llm.registry import SQL
from brute import SPACES


def _rebuilt(rows):
    """conv -> list of (role, text), as the contract rebuilds them; ties of a turn by the MD5 of role and text."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rest = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = own.get(rest, [])[:h] + own[c][h:]
    return out


def _trie(convs):
    members, ends = {}, {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    rows = []
    for p, inside in members.items():
        below = [q for q in members if q[:len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = sum(not any(len(r) == len(q) + 1 and r[:len(q)] == q for r in below) for q in below)
        saved = sum((len(members[q]) - 1) * len([w for w in SPACES.split(q[-1][1]) if w]) for q in below if q)
        ids = ",".join(map(str, sorted(ends.get(p, []))))
        rows.append((min(inside), len(p), min(members[p[:-1]]) if p else None, len(inside), len(kids), leaves, saved,
                     hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(rows, key=str)


SCHEMA = "conv_id long, turn int, role string, text string, depth int, n1 string"


def _run(spark, rows):
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], SCHEMA).repartition(3)
    got = prefix_trie.conversation_trie(df, conv_id="conv_id", turn="turn", role="role", text="text", family=20,
                                        heads=queries.id_crc("conv") % 4, most=3)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in got.collect()), key=str)


def _rows(rng, convs, longest, texts=("a b", "a", "", None, "c  d\te")):
    return [(c, t if rng.random() < 0.95 else None, rng.choice(["u", "v", None]), rng.choice(texts))
            for c in convs for t in range(rng.randint(1, longest))]


@pytest.mark.parametrize("size", [None, 7])
def test_against_brute_force(spark, monkeypatch, size):
    rng = random.Random(size or 1)
    if size:  # many small groups, salted children, chains in several blocks, no group that ranks the rest
        for name, value in (("RANGE_ROWS", 60), ("GROUP", 20), ("CHAIN", 3), ("CHILDREN", 2), ("LAST", 5), ("ID_BITS", 2)):
            monkeypatch.setattr(prefix_trie, name, value)
    rows = _rows(rng, [*range(0, 70), *range(-23, -15), 1 << 60], 6) + [(None, 0, "u", "x"), (75, 1, "u", "a"), (75, 1, "u", "a"), (75, 1, "v", "b")]
    rows += [(20, t, "u", f"t{t}") for t in range(40)] + [(c, 0, "u", f"only {c}") for c in range(200, 240)]
    rows += [(c, t, "u", "copy of it") for c in range(300, 330) for t in range(5)]
    assert _run(spark, rows) == _trie(_rebuilt(rows))


def test_small_and_empty_tables(spark):
    assert _run(spark, []) == [] == _run(spark, [(None, 1, "u", "x")])
    for rows in ([(3, 0, "u", "a")], [(0, None, None, None)], [(1, 0, "u", "a b"), (0, 0, "u", "a b")],
                 [(0, 0, "u", "word " * 20_000), (40, 0, "u", "word " * 20_000)]):
        assert _run(spark, rows) == _trie(_rebuilt(rows))


def test_one_long_conversation(spark, monkeypatch):
    for name, value in (("RANGE_ROWS", 100), ("GROUP", 50), ("CHAIN", 16), ("LAST", 10)):
        monkeypatch.setattr(prefix_trie, name, value)
    rows = [(7, t, "u", f"t {t % 3}") for t in range(700)] + [(27, t, "u", f"t {t % 3}") for t in range(0, 400)]
    assert _run(spark, rows) == _trie(_rebuilt(rows))


def test_pointer_jumping_ranks_any_list(spark):
    rng = random.Random(2)
    order = list(range(60))
    rng.shuffle(order)
    weights = [rng.randint(0, 5) for _ in order]
    rows, before = [], 0
    for i, c in enumerate(order):
        nxt = order[i + 1] if i + 1 < len(order) else None
        rows.append((c, 0, 0, nxt or 0, 0, -1 if nxt is None else 0, weights[i], 2 * weights[i], before))
        before += weights[i]
    df = spark.createDataFrame(rows, "c long, d long, x long, sc long, sd long, sx long, leaves long, saved long, want long")
    got = {r.c: (r.base_leaves, r.base_saved) for r in prefix_trie._jumped(df).collect()}
    assert got == {r[0]: (r[-1], 2 * r[-1]) for r in rows}


def test_stretches():
    after = np.array([2, -1, 1, 0, -1])  # 3 0 2 1 and 4
    head, sums = prefix_trie._segments(after, np.array([[1, 10], [2, 20], [3, 30], [4, 40], [5, 50]]))
    assert head.tolist() == [3, 3, 3, 3, 4] and sums[:, 0].tolist() == [4, 8, 5, 0, 0]


def test_sql_on_odd_rows(spark, duck, tmp_path):
    rows = _rows(random.Random(3), [*range(0, 45), -3], 6) + [(75, 1, "u", "a"), (75, 1, "u", "a"), (None, 0, "u", "é")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    con = duck.cursor()
    con.execute(f"create or replace temp view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    rel = con.sql(SQL["op13_prefix_trie"])
    got = queries.op13_prefix_trie(spark, str(tmp_path))
    assert sorted(map(str, rel.fetchall())) == sorted(str(tuple(r)) for r in got.select(rel.columns).collect())
    assert got.where(F.col("depth") == 0).count() == 1
