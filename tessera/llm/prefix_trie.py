"""Prefix trie of conversations by the Euler-tour technique.

1. Turns are numbered inside their conversation: rows are range-partitioned by (conversation, turn),
   numbered as they stream by, and what a partition carries over from the one before (at most one
   conversation) is added. Prefixes get names the same way: a prefix's name is the XOR of 128-bit
   hashes of (position, turn), so it, too, is a running sum with one carry per partition.
2. Rows of one name are a node. A node is called (c, d): its smallest member and its depth. The nodes
   of one c are a chain; where it begins it hangs from a node of another chain. So parents, siblings
   and ends are tables of at most a row per conversation, whatever the turns are. Children of one
   node are ordered: its own chain's first, the others by c, in salted groups where they are many.
3. Every node has an enter and an exit arc; the successor of each follows from the tables above.
   The list of arcs is ranked by contraction: groups of bounded size, first by chain, then by the
   chain that runs hang from, replace each stretch of consecutive arcs by one element with its
   weights; when few are left one bounded group ranks them, and lists that don't shrink that way
   are ranked by pointer jumping. Ranks go back through the rounds.
4. Weights of an enter arc: 1 for a leaf, and what the node saves. The difference of the prefix sums
   at a node's exit and enter arcs is its subtree's sum.

Turns are ordered by turn, null first; equal turns by the MD5 of role and text. Null role or text is
empty; a null and an empty text are equal. Repeated rows are turns of their own. Rows without a
conversation id take no part. A conversation without turns ends at the root. An empty table has no
nodes. Other columns are not read. Turns and prefixes are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tessera.llm.common import blocks_of, written
from tessera.llm.texts import releasing

#: Rows of a range partition, nodes or elements of a group, depths of a chain that stay together, children of a salted
#: group, elements that one group may rank, and rows up to which a side is broadcast.
RANGE_ROWS, GROUP, CHAIN, CHILDREN, LAST, BROADCAST_ROWS = 1_000_000, 40_000, 4096, 200, 20_000, 300_000
#: Low bits of an id: members whose ids share the others are one block when ids are digested.
ID_BITS = 16


def _checked(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _ranges(spark: SparkSession, rows: int) -> int:
    return max(spark.sparkContext.defaultParallelism, blocks_of(rows, RANGE_ROWS))


def _starts(key: np.ndarray, held) -> np.ndarray:
    """Per row the first row of its run of equal keys in the batch; -1 for the run that the batch before began."""
    new = np.concatenate(([held is None or key[0] != held], key[1:] != key[:-1]))
    return np.maximum.accumulate(np.where(new, np.arange(len(key)), -1))


def _rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of sorted conversations with their place in the conversation, as far as this partition knows."""
    held, count = None, 0
    for batch in batches:
        if batch.num_rows:
            conv = batch.column(0).to_numpy()
            start = _starts(conv, held)
            rank = np.arange(len(conv)) - np.where(start < 0, -count, start)
            held, count = conv[-1], int(rank[-1]) + 1
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rank), *batch.columns[1:]], ["conv", "rank", "key", "words"])


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted rows with the XOR of their conversation's hashes up to them, as far as this partition knows."""
    held, sums = None, [np.int64(0), np.int64(0)]
    for batch in batches:
        if batch.num_rows:
            conv = batch.column(0).to_numpy()
            start, out = _starts(conv, held), []
            for i in (0, 1):
                own = batch.column(3 + i).to_numpy()
                run = np.bitwise_xor.accumulate(own)
                out.append(run ^ np.where(start < 0, sums[i], run[start] ^ own[start]))
            held, sums = conv[-1], [x[-1] for x in out]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out[0]), pa.array(out[1])],
                                             ["conv", "depth", "words", "x1", "x2", "n1", "n2"])


def numbered(df: DataFrame, *, conv_id: str, turn: str, role: str, text: str) -> tuple[DataFrame, DataFrame]:
    """``conv, rank, key, words`` of every turn (rank from 0), and ``conv, turns`` of every conversation, both written."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role), F.lit(""))
    key = F.unhex(F.md5(F.concat(F.octet_length(by).cast("string"), F.lit(":"), by, said).cast("binary")))
    rows = df.where(F.col(conv_id).isNotNull()).select(F.col(conv_id).cast("long").alias("conv"), F.col(turn).alias("turn"), key.alias("key"),
                                                       F.regexp_count(said, F.lit("[^\\x20\\x09-\\x0D]+")).cast("long").alias("words"))
    order = ["conv", F.asc_nulls_first("turn"), "key"]
    runs = (rows.repartitionByRange(_ranges(df.sparkSession, df.count()), *order).sortWithinPartitions(*order)
            .select("conv", "key", "words").mapInArrow(releasing(_rank), "conv long, rank long, key binary, words long"))
    runs = written(runs.withColumn("part", F.spark_partition_id()), "turns")
    parts = written(runs.groupBy("conv", "part").agg(F.count("*").alias("n")), "turn-parts")
    before = F.sum("n").over(Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    carried = parts.withColumn("before", before).where("before > 0").select("conv", "part", "before")  # one row a partition at most
    ranked = (runs.join(F.broadcast(carried), ["conv", "part"], "left")
              .select("conv", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("rank"), "key", "words"))
    return ranked, written(parts.groupBy("conv").agg(F.sum("n").alias("turns")), "conversations")


def grafted(turns: DataFrame, convs: DataFrame, *, family: int, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations rebuilt: the first ``heads`` turns of conversation c - c % family, then c's own after its first ``heads``.

    ``heads`` is an expression of ``conv``, from 0 to ``most``. Gives ``conv, depth, key, words`` (depth
    from 1) and ``conv, turns`` as they are afterwards.
    """
    base = F.col("conv") - F.col("conv") % family
    plan = convs.withColumns({"base": base, "h": F.when(base == F.col("conv"), 0).otherwise(heads).cast("long")})
    has = convs.where(F.col("conv") % family == 0).select(F.col("conv").alias("base"), F.least("turns", F.lit(most)).alias("has"))
    plan = written(plan.join(has, "base", "left").withColumn("m", F.least("h", F.coalesce("has", F.lit(0))))
                   .select("conv", "base", "h", "m", (F.col("m") + F.greatest(F.col("turns") - F.col("h"), F.lit(0))).alias("turns")), "plan")
    lead = turns.where((F.col("conv") % family == 0) & (F.col("rank") < most)).select(F.col("conv").alias("base"), "rank", "key", "words")
    copies = (plan.where("m > 0").select("conv", "base", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("rank"))
              .join(lead, ["base", "rank"]).select("conv", (F.col("rank") + 1).alias("depth"), "key", "words"))
    skipped = F.when(base == F.col("conv"), 0).otherwise(heads)
    moved = _checked(plan.where("m < h").select("conv", (F.col("m") - F.col("h")).alias("shift")))
    own = (turns.where(F.col("rank") >= skipped).join(moved, "conv", "left")
           .select("conv", (F.col("rank") + 1 + F.coalesce("shift", F.lit(0))).alias("depth"), "key", "words"))
    return copies.unionAll(own), plan.select("conv", "turns")


def named(rows: DataFrame) -> DataFrame:
    """``conv, depth, words, n1, n2, p1, p2``: the names of the prefix that ends with each turn, and of its parent."""
    hashed = rows.select("conv", "depth", "words", F.xxhash64("depth", "key").alias("x1"), F.xxhash64("key", F.lit(1), "depth").alias("x2"))
    hashed = written(hashed, "rebuilt")
    runs = (hashed.repartitionByRange(_ranges(rows.sparkSession, hashed.count()), "conv", "depth").sortWithinPartitions("conv", "depth")
            .mapInArrow(releasing(_running), "conv long, depth long, words long, x1 long, x2 long, n1 long, n2 long"))
    runs = written(runs.withColumn("part", F.spark_partition_id()), "prefixes")
    earlier = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = (runs.groupBy("conv", "part").agg(F.bit_xor("x1").alias("s1"), F.bit_xor("x2").alias("s2"))
               .select("conv", "part", F.bit_xor("s1").over(earlier).alias("c1"), F.bit_xor("s2").over(earlier).alias("c2"))
               .where("c1 IS NOT NULL"))  # one row a partition at most
    name = lambda i: F.col(f"n{i}").bitwiseXOR(F.coalesce(f"c{i}", F.lit(0)))
    return (runs.join(F.broadcast(carried), ["conv", "part"], "left")
            .select("conv", "depth", "words", "x1", "x2", name(1).alias("n1"), name(2).alias("n2"))
            .select("conv", "depth", "words", "n1", "n2", F.col("n1").bitwiseXOR(F.col("x1")).alias("p1"), F.col("n2").bitwiseXOR(F.col("x2")).alias("p2")))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each name's blocks of ids, which come in order."""
    held, state = None, None
    out: list[tuple] = []
    for batch in batches:
        for depth, n1, n2, ids in zip(*(c.to_pylist() for c in (batch.column(i) for i in (0, 1, 2, 4)))):
            if (depth, n1, n2) != held:
                if held is not None:
                    out.append((*held, state.hexdigest()))
                held, state = (depth, n1, n2), hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if len(out) > 10_000:
            yield _digest_batch(out)
            out = []
    if held is not None:
        out.append((*held, state.hexdigest()))
    yield _digest_batch(out)


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())], ["depth", "n1", "n2", "sha"])


def ends(prefixes: DataFrame, convs: DataFrame) -> DataFrame:
    """``depth, n1, n2, sha``: per name the digest of the ids of the conversations that end there."""
    last = (prefixes.select("conv", F.struct("depth", "n1", "n2").alias("at")).groupBy("conv").agg(F.max("at").alias("at"))
            .select("conv", "at.depth", "at.n1", "at.n2"))
    none = convs.where("turns = 0").select("conv", *[F.lit(0).cast("long").alias(c) for c in ("depth", "n1", "n2")])
    name = ["depth", "n1", "n2"]
    # members of a name in blocks of ids, of which each is one row from here on
    blocks = (last.unionAll(none).groupBy(*name, F.shiftright("conv", ID_BITS).alias("block"))
              .agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv")), lambda c: c.cast("string")), ",").alias("ids")))
    return blocks.repartition(*name).sortWithinPartitions(*name, "block").mapInArrow(releasing(_digests), "depth long, n1 long, n2 long, sha string")


def _segments(after: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The head of each element's stretch and the weights before it; ``after`` is a place or -1."""
    n = len(after)
    at = np.arange(n)
    has = after >= 0
    before = at.copy()
    before[after[has]] = at[has]
    sums = np.where((before != at)[:, None], weights[before], 0)
    while True:
        further = before[before]
        if (further == before).all():
            return before, sums
        sums = sums + sums[before]
        before = further


class _Places:
    """Finds arcs (c, d, x) among a group's own."""

    def __init__(self, c: np.ndarray, d: np.ndarray, x: np.ndarray):
        self.chains, at = np.unique(c, return_inverse=True)
        self.width = 2 * (int(d.max()) + 2)
        codes = at * self.width + 2 * d + x
        self.order = np.argsort(codes)
        self.codes = codes[self.order]

    def __call__(self, c: np.ndarray, d: np.ndarray, x: np.ndarray, some: np.ndarray) -> np.ndarray:
        """Places of the arcs, -1 where there is none."""
        at = np.minimum(np.searchsorted(self.chains, c), len(self.chains) - 1)
        codes = at * self.width + 2 * d + x
        to = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
        found = some & (self.chains[at] == c) & (2 * d + x < self.width) & (self.codes[to] == codes)
        return np.where(found, self.order[to], -1)


#: Columns of an element: its first arc, what follows its last arc, its last arc, weights, and where its chain hangs.
_ELEMENT = ["c", "d", "x", "sc", "sd", "sx", "tc", "td", "tx", "leaves", "saved", "pc", "salt"]


def _table(columns: dict[str, np.ndarray], masks: dict[str, np.ndarray]) -> pa.Table:
    return pa.table({n: pa.array(v, pa.int64(), mask=masks.get(n)) if v.dtype != object else pa.array(v, pa.string())
                     for n, v in columns.items()})


def _contracted(e: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray]:
    """Elements of a group as fewer, and for each the place of its head and the weights before it. Successor -1: none."""
    places = _Places(e["c"], e["d"], e["x"])
    after = places(e["sc"], e["sd"], e["sx"], e["sx"] >= 0)
    head, sums = _segments(after, np.stack((e["leaves"], e["saved"]), 1))
    last = np.flatnonzero(after < 0)
    first = head[last]
    out = {n: e[n][first] for n in ("c", "d", "x", "pc", "salt")} | {n: e[n][last] for n in ("sc", "sd", "sx", "tc", "td", "tx")}
    out |= {"leaves": sums[last, 0] + e["leaves"][last], "saved": sums[last, 1] + e["saved"][last]}
    return out, head, sums


_MEMBER = ["hc", "hd", "hx", "before_leaves", "before_saved"]


def _round(table: pa.Table) -> pa.Table:
    """A contraction: rows of the old elements (``member``) and of the new ones."""
    e = {n: table[n].to_numpy() for n in _ELEMENT}
    new, head, sums = _contracted(e)
    n, m = len(e["c"]), len(new["c"])
    out = {"member": np.concatenate((np.ones(n, np.int64), np.zeros(m, np.int64)))}
    for name in _ELEMENT:
        out[name] = np.concatenate((e[name], new[name]))
    for name, values in zip(_MEMBER, (e["c"][head], e["d"][head], e["x"][head], sums[:, 0], sums[:, 1])):
        out[name] = np.concatenate((values, np.zeros(m, np.int64)))
    return _table(out, {})


_ROUND = ", ".join(f"{n} long" for n in ["member", *_ELEMENT, *_MEMBER])

#: What a group of chains is built from: nodes, branches (a node's other children), chain heads, ends and lengths.
NODE, BRANCH, HEAD, END, LENGTH = range(5)
_PART = "kind int, c long, d long, a long, b long, e long, f long, sha string"
_NODE_OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "leaf", "own"]


def _chains(table: pa.Table) -> pa.Table:
    """A group's nodes with their arcs, contracted once: rows of nodes (``member``) and of elements."""
    kinds = table["kind"].to_numpy()
    part = [table.filter(pa.array(kinds == k)).sort_by([("c", "ascending"), ("d", "ascending")]) for k in range(5)]
    get = lambda k, n: part[k][n].to_numpy(zero_copy_only=False)
    c, d, n_convs, own = (get(NODE, n) for n in ("c", "d", "a", "b"))
    n = len(c)
    if not n:
        return _table({k: np.empty(0, np.int64 if k != "sha" else object) for k in _CHAIN_NAMES}, {})

    def at(kind: int, chain: np.ndarray, depth: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Whether a row of a kind is there for a chain (and depth), and its place."""
        rows = part[kind].num_rows
        if not rows:
            return np.zeros(len(chain), bool), np.zeros(len(chain), np.int64)
        if depth is None:
            keys = get(kind, "c")
            to = np.minimum(np.searchsorted(keys, chain), rows - 1)
            return keys[to] == chain, to
        places = _Places(get(kind, "c"), get(kind, "d"), np.zeros(rows, np.int64))
        to = places(chain, depth, np.zeros(len(chain), np.int64), depth >= 0)
        return to >= 0, np.maximum(to, 0)

    def pick(kind: int, name: str, found: np.ndarray, to: np.ndarray, other) -> np.ndarray:
        values = get(kind, name).astype(np.int64) if part[kind].num_rows else np.zeros(1, np.int64)
        return np.where(found, values[to], other)

    length = get(LENGTH, "a")[at(LENGTH, c, None)[1]]
    deeper = length > d
    branch, to = at(BRANCH, c, np.maximum(d, 0))
    first, others = pick(BRANCH, "a", branch, to, 0), pick(BRANCH, "b", branch, to, 0)
    above, to_above = at(BRANCH, c, d - 1)
    first_above = pick(BRANCH, "a", above, to_above, 0)
    is_head, to_head = at(HEAD, c, d)
    parent = pick(HEAD, "a", is_head, to_head, c)
    has_next = is_head & (pick(HEAD, "e", is_head, to_head, 0) == 1)
    next_ = pick(HEAD, "b", has_next, to_head, 0)
    known, to_chain = at(HEAD, c, None)
    pc, salt = pick(HEAD, "a", known, to_chain, c), pick(HEAD, "f", known, to_chain, -1)
    leaf = (~deeper & ~branch).astype(np.int64)
    ended, to_end = at(END, c, d)
    sha = np.full(n, None, object)
    if part[END].num_rows:
        sha[ended] = get(END, "sha")[to_end[ended]]

    arc = lambda a, b: np.concatenate((a, b))
    zero, one = np.zeros(n, np.int64), np.ones(n, np.int64)
    # enter: the own chain's next node, else the first other child, else the exit
    down = deeper | branch
    enter = np.where(deeper, c, np.where(branch, first, c)), np.where(down, d + 1, d), np.where(down, 0, 1)
    # exit: the next sibling, else the parent's exit; none behind the root's
    aside = np.where(is_head, has_next, above)
    leave = np.where(is_head, np.where(has_next, next_, parent), np.where(above, first_above, c)), np.where(aside, d, d - 1), np.where(aside, 0, 1)
    e = {"c": arc(c, c), "d": arc(d, d), "x": arc(zero, one), "sc": arc(enter[0], leave[0]), "sd": arc(enter[1], leave[1]),
         "sx": np.where(arc(d, d) + arc(one, zero) == 0, -1, arc(enter[2], leave[2])), "leaves": arc(leaf, zero), "saved": arc(own, zero),
         "pc": arc(pc, pc), "salt": arc(salt, salt)}
    e |= {"tc": e["c"], "td": e["d"], "tx": e["x"]}
    new, head, sums = _contracted(e)
    m = len(new["c"])
    columns: dict[str, np.ndarray] = {"member": np.concatenate((one, np.zeros(m, np.int64)))}
    nodes = {"conv_id": c, "depth": d, "parent_conv_id": parent, "n_convs": n_convs, "n_children": deeper + others, "leaf": leaf, "own": own}
    for side, of in (("enter", slice(0, n)), ("exit", slice(n, 2 * n))):
        h = head[of]
        nodes |= {f"{side}_c": e["c"][h], f"{side}_d": e["d"][h], f"{side}_x": e["x"][h],
                  f"{side}_leaves": sums[of, 0], f"{side}_saved": sums[of, 1]}
    for name, values in nodes.items():
        columns[name] = np.concatenate((values, np.zeros(m, np.int64)))
    columns["sha"] = np.concatenate((sha, np.full(m, None, object)))
    for name in _ELEMENT:
        columns[name] = np.concatenate((zero, new[name]))
    return _table({k: columns[k] for k in _CHAIN_NAMES}, {"parent_conv_id": columns["depth"] + columns["member"] == 1})


_SIDES = [f"{s}_{n}" for s in ("enter", "exit") for n in ("c", "d", "x", "leaves", "saved")]
_CHAIN_NAMES = ["member", *_NODE_OUT, *_SIDES, "sha", *_ELEMENT]
_CHAIN_OUT = ", ".join(f"{n} {'string' if n == 'sha' else 'long'}" for n in _CHAIN_NAMES)


def _jumped(elements: DataFrame) -> DataFrame:
    """``c, d, x, base_leaves, base_saved``: weights before each element, by pointer jumping (for lists that stay long)."""
    arc = ["c", "d", "x"]
    now = written(elements.select(*arc, "sc", "sd", "sx", "leaves", "saved"), "jump")
    total = now.agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s")).first()
    while now.where("sx >= 0").limit(1).count():
        ahead = now.select(F.col("c").alias("sc"), F.col("d").alias("sd"), F.col("x").alias("sx"), F.col("sc").alias("ac"), F.col("sd").alias("ad"),
                           F.col("sx").alias("ax"), F.col("leaves").alias("al"), F.col("saved").alias("as_"))
        # sums go from each element to the end of the list
        now = written(now.join(ahead, ["sc", "sd", "sx"], "left").select(
            *arc, F.coalesce("ac", F.lit(0)).alias("sc"), F.coalesce("ad", F.lit(0)).alias("sd"), F.coalesce("ax", F.lit(-1)).alias("sx"),
            (F.col("leaves") + F.coalesce("al", F.lit(0))).alias("leaves"), (F.col("saved") + F.coalesce("as_", F.lit(0))).alias("saved")), "jump")
    return now.select(*arc, (F.lit(total["l"]) - F.col("leaves")).alias("base_leaves"), (F.lit(total["s"]) - F.col("saved")).alias("base_saved"))


def ranked(elements: DataFrame) -> DataFrame:
    """``c, d, x, base_leaves, base_saved``: the weights before each element of the list."""
    arc, levels, count, before = ["c", "d", "x"], [], elements.count(), None
    while count > 1 and (before is None or count <= LAST or count < 0.9 * before):
        # a run that begins with a chain's first arc and ends with an exit of that depth goes where its chain hangs
        whole = (F.col("x") == 0) & (F.col("tx") == 1) & (F.col("d") == F.col("td")) & (F.col("salt") >= 0)
        key = F.when(whole, F.xxhash64("pc", "salt")).otherwise(F.xxhash64("c", F.lit(0).cast("long")))
        if count > LAST:
            group = F.pmod(key, F.lit(blocks_of(count, GROUP)))
        else:
            group = F.lit(0).cast("long")
        done = written(elements.withColumn("_group", group).groupBy("_group").applyInArrow(_round, _ROUND), "contracted")
        levels.append(done.where("member = 1"))
        elements, before = done.where("member = 0").select(*_ELEMENT), count
        count = elements.count()
    base = _jumped(elements)
    for level in reversed(levels):
        top = _checked(base.select(F.col("c").alias("hc"), F.col("d").alias("hd"), F.col("x").alias("hx"), "base_leaves", "base_saved"))
        base = written(level.join(top, ["hc", "hd", "hx"]).select(
            *arc, (F.col("base_leaves") + F.col("before_leaves")).alias("base_leaves"),
            (F.col("base_saved") + F.col("before_saved")).alias("base_saved")), "ranks")
    return base


def prefix_trie(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of ``conv, depth, key, words`` (depths 1, 2, ... of each conversation) and ``conv, turns`` of all conversations.

    One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.
    """
    prefixes = named(rows)
    whole = convs.agg(F.min("conv").alias("c"), F.count("*").alias("n")).where("n > 0")
    zero = F.lit(0).cast("long")
    root = whole.select(zero.alias("depth"), zero.alias("n1"), zero.alias("n2"), "c", "n", zero.alias("words"), zero.alias("p1"), zero.alias("p2"))
    nodes = prefixes.groupBy("depth", "n1", "n2").agg(F.min("conv").alias("c"), F.count("*").alias("n"), F.max("words").alias("words"),
                                                       F.max("p1").alias("p1"), F.max("p2").alias("p2"))
    nodes = written(nodes.unionAll(root), "nodes")
    n_nodes = nodes.count()
    top = nodes.where("depth = 0").select(F.col("c").alias("pc"))

    # where chains begin, and where conversations end: both looked up among the nodes by name
    heads = nodes.groupBy("c").agg(F.min(F.struct("depth", "p1", "p2")).alias("at")).select("c", "at.depth", "at.p1", "at.p2")
    none = lambda t: F.lit(None).cast(t)
    wanted = (heads.where("depth > 1").select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("n1"), F.col("p2").alias("n2"), "c", none("string").alias("sha"))
              .unionAll(ends(prefixes, convs).select("depth", "n1", "n2", none("long").alias("c"), "sha")))
    found = written(wanted.join(nodes.select("depth", "n1", "n2", F.col("c").alias("pc")), ["depth", "n1", "n2"])
                    .select("c", (F.col("depth") + 1).alias("depth"), "pc", "sha"), "found")
    first = heads.where("depth = 1").select("c", "depth").crossJoin(F.broadcast(top)).select("c", "depth", "pc")  # the root is one row
    hung = written(found.where("c IS NOT NULL").select("c", "depth", "pc").unionAll(first), "heads")

    # siblings in order; a node with many children has them in salted groups
    kids = hung.groupBy("pc", "depth").agg(F.count("*").alias("others"))
    many = written(kids.where(F.col("others") > CHILDREN).select("pc", "depth", F.ceil(F.col("others") / CHILDREN).alias("salts")), "many")
    dealt = (hung.join(_checked(many), ["pc", "depth"], "left")
             .withColumn("salt", F.coalesce(F.pmod(F.xxhash64("c"), F.col("salts")), F.lit(0)).cast("long")))
    group = Window.partitionBy("pc", "depth", "salt").orderBy("c")
    dealt = written(dealt.withColumns({"next": F.lead("c").over(group), "at": F.row_number().over(group)}), "siblings")
    leads = dealt.where("at = 1 AND salts IS NOT NULL").withColumn("hop", F.lead("c").over(Window.partitionBy("pc", "depth").orderBy("salt")))
    leads = _checked(written(leads.where("hop IS NOT NULL").select("pc", "depth", "salt", "hop"), "hops"))
    linked = dealt.join(leads, ["pc", "depth", "salt"], "left").withColumn("next", F.coalesce("next", "hop"))
    branches = (dealt.where("at = 1").groupBy("pc", "depth").agg(F.min(F.struct("salt", "c")).alias("first"))
                .join(kids, ["pc", "depth"]).select(F.col("pc").alias("c"), (F.col("depth") - 1).alias("d"), F.col("first.c").alias("a"), "others"))

    block = lambda d: F.floor(d / CHAIN)
    pad = lambda *names: [none("long").alias(x) for x in names]
    parts = (
        nodes.select(F.lit(NODE).alias("kind"), "c", F.col("depth").alias("d"), F.col("n").alias("a"), ((F.col("n") - 1) * F.col("words")).alias("b"),
                     *pad("e", "f"), none("string").alias("sha"), block(F.col("depth")).alias("blk"))
        # a branch is needed by its node and by the own chain's next
        .unionAll(branches.select(F.lit(BRANCH), "c", "d", "a", F.col("others"), *pad("e", "f"), none("string"),
                                  F.explode(F.array_distinct(F.array(block(F.col("d")), block(F.col("d") + 1))))))
        .unionAll(linked.select(F.lit(HEAD), "c", "depth", "pc", F.coalesce("next", zero), F.col("next").isNotNull().cast("long"), "salt",
                                none("string"), block(F.col("depth"))))
        .unionAll(found.where("c IS NULL").select(F.lit(END), "pc", F.col("depth") - 1, *pad("a", "b", "e", "f"), "sha", block(F.col("depth") - 1)))
        .unionAll(convs.select(F.lit(LENGTH), "conv", zero, "turns", *pad("b", "e", "f"), none("string"),
                               F.explode(F.sequence(zero, block(F.col("turns")))))))
    bucket = F.pmod(F.xxhash64("c", "blk"), F.lit(blocks_of(n_nodes, GROUP)))
    chains = written(parts.groupBy(bucket.alias("bucket")).applyInArrow(_chains, _CHAIN_OUT), "chains")

    own = chains.where("member = 1")
    together = (F.col("enter_c") == F.col("exit_c")) & (F.col("enter_d") == F.col("exit_d")) & (F.col("enter_x") == F.col("exit_x"))
    base = _checked(ranked(chains.where("member = 0").select(*_ELEMENT)))
    side = lambda s: base.select(*[F.col(x).alias(f"{s}_{x}") for x in ("c", "d", "x")], F.col("base_leaves").alias(f"{s}_bl"),
                                 F.col("base_saved").alias(f"{s}_bs"))
    apart = (own.where(~together).join(side("enter"), ["enter_c", "enter_d", "enter_x"]).join(side("exit"), ["exit_c", "exit_d", "exit_x"])
             .withColumns({"base_l": F.col("exit_bl") - F.col("enter_bl"), "base_s": F.col("exit_bs") - F.col("enter_bs")}))
    same = own.where(together).withColumns({"base_l": zero, "base_s": zero})
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
               (F.col("base_l") + F.col("exit_leaves") - F.col("enter_leaves")).alias("n_leaves"),
               (F.col("base_s") + F.col("exit_saved") - F.col("enter_saved")).alias("saved_tokens"),
               F.coalesce("sha", F.sha2(F.lit(b""), 256)).alias("ends_sha256")]
    return same.select(*columns).unionAll(apart.select(*columns))


def conversation_trie(df: DataFrame, *, conv_id: str, turn: str, role: str, text: str, family: int | None = None,
                      heads: Column | None = None, most: int = 0) -> DataFrame:
    """The trie of a table of turns; with ``family``, of the conversations that ``grafted`` rebuilds first."""
    turns, convs = numbered(df, conv_id=conv_id, turn=turn, role=role, text=text)
    if family is None:
        rows = turns.select("conv", (F.col("rank") + 1).alias("depth"), "key", "words")
    else:
        rows, convs = grafted(turns, convs, family=family, heads=heads, most=most)
    return prefix_trie(rows, convs)
