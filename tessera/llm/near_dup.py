"""Near-duplicates: SuperMinHash signatures, banding, exact verification, union-find groups.

Documents are linked where the Jaccard similarity of their word-shingle sets reaches ``percent``;
a group is a connected component. Steps:

1. Every text becomes a signature, band hashes and a 64-bit name of its shingle set. Texts of one
   set are one node from here on, so a group of copies costs one row per task.
2. Nodes that share a band form a bucket. The bucket's hub, the member with the most company in
   its other bands (an unchanged original rather than a much changed copy), is compared with every
   other member: as many pairs as members. Pairs pass a bound on the set sizes and on the estimate
   before the exact check on full sets.
3. Links give components. Buckets of three and more members that still hold several components are
   looked at again: a node of which too few signature slots are found in other components, fewer
   than any link's, is out; what is left is compared in blocks of bounded size, exactly, and reports
   only links that join.

So no link is lost beyond what banding misses (25 bands of 4: 1e-8 of pairs at 0.85, 2e-6 at 0.8)
and pairs of a group are never listed.

Words are runs of bytes other than ASCII white space, A-Z lower-cased. Fewer words than a shingle
make one shingle of all; null and blank texts have an empty set and are linked with nothing.
Repeated rows are copies. Null ids take part by their text; a group's id is its least non-null id,
or null. Ids from 2^62 on are not supported. An empty table gives no rows. Other columns are not
read. Sets and nodes are compared by 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm import superminhash as smh
from tessera.llm.common import written
from tessera.llm.components import UnionFind, components
from tessera.llm.texts import map_texts, releasing
from tessera.session import scratch_scope

BANDS, ROWS = 25, 4
#: Members of a block in the exhaustive step.
BLOCK = 512
#: Rows up to which a side is broadcast; beyond it both are shuffled.
BROADCAST_ROWS = 300_000
#: Stands for a null id in minima.
NO_ID = 1 << 62


def text_key(doc_id: str, text: str) -> Column:
    """A name of the row's id and text."""
    return F.xxhash64(F.col(doc_id), F.lit(0), F.col(text))


def sketches(docs: DataFrame, *, doc_id: str, text: str, width: int) -> DataFrame:
    """Written table ``doc_id, text_key, node, n_shingles, bands, sig``, one row per document."""
    def make():
        shingler = smh.Shingler(width)

        def work(texts: list[str]) -> dict[str, list]:
            out: dict[str, list] = {"node": [], "n_shingles": [], "bands": [], "sig": []}
            for elements in shingler(texts):
                sig = smh.signature(elements, BANDS * ROWS)
                out["node"].append(smh.set_key(elements))
                out["n_shingles"].append(len(elements))
                out["bands"].append(smh.band_hashes(sig, BANDS) if len(elements) else [])
                out["sig"].append(smh.short(sig).tobytes())
            return out
        return work
    keyed = docs.select(F.struct(F.col(doc_id).cast("long").alias("doc_id"), text_key(doc_id, text).alias("text_key")).alias("k"),
                        F.col(text).alias("t"))
    out = map_texts(keyed, "k", "t", make, [("node", "long", pa.int64()), ("n_shingles", "long", pa.int64()),
                                            ("bands", "array<long>", pa.list_(pa.int64())), ("sig", "binary", pa.binary())])
    return written(out.select("key.doc_id", "key.text_key", "node", "n_shingles", "bands", "sig"), "sketches")


def set_nodes(sketch: DataFrame) -> DataFrame:
    """Written table, one row per distinct non-empty set: its least id, one of its texts, size and sketch."""
    return written(
        sketch.where("n_shingles > 0").groupBy("node").agg(
            F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_key")).alias("one"),
            F.first("n_shingles").alias("n"), F.first("bands").alias("bands"), F.first("sig").alias("sig"),
            F.count("*").alias("copies"))
        .select("node", F.col("one.id").alias("id"), F.col("one.text_key").alias("text_key"), "n", "bands", "sig", "copies"),
        "nodes")


def buckets(nodes: DataFrame) -> DataFrame:
    """Written table ``bucket, node, company`` of the buckets with several members."""
    rows = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = rows.groupBy(F.col("bucket").alias("_b")).agg(F.count("*").alias("company")).where("company > 1")
    return written(rows.join(shared, F.col("bucket") == F.col("_b")).select("bucket", "node", "company"), "buckets")


def _checked(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _texts_of(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """``node, t``: one text for each of the wanted nodes."""
    need = written(wanted.join(nodes.select("node", "text_key"), "node").select("node", "text_key"), "wanted")
    one = docs.select(text_key(doc_id, text).alias("text_key"), F.col(text).alias("t"))
    return one.join(_checked(need, need.count()), "text_key").select("node", "t")


def shingle_sets(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, *, doc_id: str, text: str, width: int) -> DataFrame:
    """Written table ``node, shingles`` (sorted 64-bit fingerprints as bytes) of the wanted nodes."""
    found = _texts_of(docs, nodes, wanted, doc_id=doc_id, text=text)

    def make():
        shingler = smh.Shingler(width)
        return lambda texts: {"shingles": [s.tobytes() for s in shingler(texts)]}
    sets = map_texts(found, "node", "t", make, [("shingles", "binary", pa.binary())])
    # repeated rows (same id, same text) give the same node twice
    return written(sets.withColumnRenamed("key", "node").dropDuplicates(["node"]), "sets")


def _similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def hub_pairs(members: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Written table of pairs (a, b): each bucket's hub and its other members, as far as bounds allow."""
    weight = members.groupBy(F.col("node").alias("_n")).agg(F.sum("company").alias("w"))
    hubs = (members.join(weight, F.col("node") == F.col("_n"))
            .groupBy(F.col("bucket").alias("_b")).agg(F.max_by("node", F.struct("w", "node")).alias("hub")))
    hubs = written(hubs, "hubs")  # so that the join below can be split where a bucket is large
    pairs = (members.join(hubs, F.col("bucket") == F.col("_b")).where("node <> hub")
             .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct())
    side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"), F.col("sig").alias(f"sig_{s}"))
    sized = (pairs.join(side("a"), "a").join(side("b"), "b")
             .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent))
    # an estimate six standard deviations below the threshold settles the pair
    slots, least = BANDS * ROWS, least_equal(percent)

    def estimate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = [np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, slots) for i in (2, 3)]
            near = (sig[0] == sig[1]).sum(1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near))

    return written(sized.select("a", "b", "sig_a", "sig_b").mapInArrow(releasing(estimate), "a long, b long"), "pairs")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Written table of the pairs whose full sets reach the threshold."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_similar(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                  for x, y in zip(batch.column(2), batch.column(3))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))

    side = lambda s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"s_{s}"))
    return written(pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "s_a", "s_b")
                   .mapInArrow(releasing(check), "a long, b long"), "links")


def _several(members: DataFrame) -> DataFrame:
    """Members (bucket, node, root, company) of buckets that hold more than one component."""
    mixed = (members.groupBy(F.col("bucket").alias("_b")).agg(F.min("root").alias("x"), F.max("root").alias("y"), F.count("*").alias("company"))
             .where("x <> y").drop("x", "y"))
    return members.select("bucket", "node", "root").join(mixed, F.col("bucket") == F.col("_b")).drop("_b")


def least_equal(percent: int) -> int:
    """Equal slots that a pair at the threshold has, but for six standard deviations."""
    j, slots = percent / 100, BANDS * ROWS
    return int(slots * (j - 6 * (j * (1 - j) / slots) ** 0.5))


def signatures(docs: DataFrame, nodes: DataFrame, wanted: DataFrame, *, doc_id: str, text: str, width: int) -> DataFrame:
    """``node, slots`` (whole signatures as 64-bit values) of the wanted nodes."""
    def make():
        shingler = smh.Shingler(width)
        return lambda texts: {"slots": [smh.signature(s, BANDS * ROWS).view(np.int64) for s in shingler(texts)]}
    found = map_texts(_texts_of(docs, nodes, wanted, doc_id=doc_id, text=text), "node", "t", make, [("slots", "array<long>", pa.list_(pa.int64()))])
    return found.withColumnRenamed("key", "node")


def linkable(open_: DataFrame, signs: DataFrame, percent: int) -> DataFrame:
    """The members that may have a link to another component.

    u of a node's slots have a value that occurs in another component too. No partner outside the
    node's own component has more slots in common with it, so the estimate that settles pairs
    settles all of the node's at once if u is below its bound. Work is linear in the members, and
    the same for every length of text.
    """
    owners = open_.select("node", "root").distinct()
    # repeated rows (same id, same text) give the same node twice
    parts = (signs.join(owners, "node").select("node", "root", F.posexplode("slots").alias("slot", "value")).distinct())
    shared = (parts.groupBy(F.col("slot").alias("_s"), F.col("value").alias("_v")).agg(F.min("root").alias("x"), F.max("root").alias("y"))
              .where("x <> y").select("_s", "_v"))
    enough = (parts.join(shared, (F.col("slot") == F.col("_s")) & (F.col("value") == F.col("_v"))).groupBy("node").agg(F.count("*").alias("u"))
              .where(F.col("u") >= least_equal(percent)).select(F.col("node").alias("_n")))
    return open_.join(enough, F.col("node") == F.col("_n"), "left_semi")


def _block_links(percent: int):
    def search(table: pa.Table) -> pa.Table:
        roots = table["root"].to_numpy()
        side = table["side"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["shingles"]]
        sizes = np.array([len(s) for s in sets])
        # postings of all members' shingles: one look-up per member counts what it shares with every other
        flat, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), sizes)
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], owner[order]
        joined, out = UnionFind(), []
        for i, own in enumerate(sets):
            low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
            n = high - low
            at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
            both = np.bincount(owner[at], minlength=len(sets))
            near = (100 * both >= percent * (sizes + sizes[i] - both)) & (roots != roots[i])
            if side.max() > 0:
                near &= side != side[i]
            for j in np.flatnonzero(near).tolist():
                if joined.join(int(roots[i]), int(roots[j])):
                    out.append((int(roots[i]), int(roots[j])))
        a, b = zip(*out) if out else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return search


def block_links(open_: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between components, from exhaustive comparison of what is left in each bucket.

    A bucket's members are dealt into blocks; a task compares one block with itself or another.
    """
    dealt = (open_.withColumn("_g", F.ceil(F.col("company") / BLOCK).cast("int"))
             .withColumn("_x", F.pmod(F.xxhash64("node"), F.col("_g")).cast("int"))
             .select("bucket", "node", "root", "_x", F.explode(F.sequence(F.lit(0), F.col("_g") - 1)).alias("_y"))
             .select("bucket", "node", "root", F.least("_x", "_y").alias("p"), F.greatest("_x", "_y").alias("q"),
                     (F.col("_x") > F.col("_y")).cast("int").alias("side")))
    return (dealt.join(sets, "node").select("bucket", "p", "q", "node", "root", "side", "shingles")
            .groupBy("bucket", "p", "q").applyInArrow(_block_links(percent), "a long, b long"))


def groups(docs: DataFrame, *, doc_id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Sketches, nodes, and ``node, root`` of the nodes that are linked with others."""
    with scratch_scope(docs.sparkSession, keep=["llm-sketches", "llm-nodes", "llm-groups"]):
        return _groups(docs, doc_id=doc_id, text=text, width=width, percent=percent)


def _groups(docs: DataFrame, *, doc_id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    sketch = sketches(docs, doc_id=doc_id, text=text, width=width)
    nodes = set_nodes(sketch)
    members = buckets(nodes)
    pairs = hub_pairs(members, nodes, percent)
    args = dict(doc_id=doc_id, text=text, width=width)
    ends = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    roots = written(components(verified(pairs, shingle_sets(docs, nodes, ends, **args), percent)), "roots")

    placed = members.select("bucket", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    # two members have been compared: one of them is the hub
    open_ = written(_several(placed).where("company > 2"), "open")
    signs = signatures(docs, nodes, open_.select("node").distinct(), **args)
    rest = written(_several(linkable(open_, signs, percent)), "rest")
    sets = shingle_sets(docs, nodes, rest.select("node").distinct(), **args)
    bridges = written(components(written(block_links(rest, sets, percent), "bridges")), "bridged")
    renamed = bridges.select(F.col("node").alias("root"), F.col("root").alias("to"))
    final = (roots.join(renamed, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
             .unionAll(bridges.join(roots.select("node"), "node", "left_anti").select("node", "root")))
    return sketch, nodes, written(final, "groups")


def grouped(docs: DataFrame, *, doc_id: str, text: str, width: int, percent: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, root, least``: each document's group and the group's least id.

    Null root: a document alone in its group.
    """
    sketch, nodes, roots = groups(docs, doc_id=doc_id, text=text, width=width, percent=percent)
    named = nodes.select("node", "id", "copies").join(roots, "node", "left")
    least = named.where("root IS NOT NULL").groupBy(F.col("root").alias("_r")).agg(F.min("id").alias("least"))
    # only sets that several documents have or that are linked: the others are their own group
    several = (named.where("root IS NOT NULL OR copies > 1").join(least, F.col("root") == F.col("_r"), "left")
               .select("node", F.coalesce("root", "node").alias("root"), F.coalesce("least", "id").alias("least")))
    return sketch.select("doc_id", "text_key", "node", "n_shingles").join(several, "node", "left").drop("node")


def near_duplicates(docs: DataFrame, *, doc_id: str, text: str, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_key, n_shingles, component_id, kept`` for every document."""
    component = F.when(F.col("root").isNull(), F.col("doc_id")).when(F.col("least") < NO_ID, F.col("least"))
    return grouped(docs, doc_id=doc_id, text=text, width=width, percent=percent).select(
        "doc_id", "text_key", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def keep_one(docs: DataFrame, *, doc_id: str, text: str, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, one row of each group: the least id's (null ids last).

    Documents without words are in no group and stay. Where the least id has several texts in the
    group, or a row repeats, one of them stays.
    """
    found = written(grouped(docs, doc_id=doc_id, text=text, width=width, percent=percent), "found")
    chosen = (found.where("root IS NOT NULL").groupBy("root")
              .agg(F.min(F.struct(F.coalesce("doc_id", F.lit(NO_ID)).alias("id"), "text_key")).alias("one"))
              .select(F.col("one.text_key").alias("_keep")))
    dropped = (found.where("root IS NOT NULL").select("text_key").distinct()
               .join(chosen, F.col("text_key") == F.col("_keep"), "left_anti").select(F.col("text_key").alias("_drop")))
    dropped = written(dropped, "dropped")
    key = text_key(doc_id, text)
    rest = docs.join(_checked(dropped, dropped.count()), key == F.col("_drop"), "left_anti")
    # the chosen row itself may repeat (same id, same text)
    again = found.where("root IS NOT NULL").groupBy(F.col("text_key").alias("_again")).count().where("count > 1").select("_again")
    again = written(again, "repeated")
    n = again.count()
    if not n:
        return rest
    once = rest.join(_checked(again, n), key == F.col("_again")).dropDuplicates(["_again"]).select(*docs.columns)
    return rest.join(_checked(again, n), key == F.col("_again"), "left_anti").unionAll(once)
