"""Benchmark decontamination by size-partitioned MinHash containment search. SQL expressions only.

Which documents contain a test item's word shingles to ``percent`` or more? Items are short and
documents long, so the Jaccard similarity of the two sets is tiny and a symmetric MinHash would
need thousands of values. Containment is one-sided: the smallest shingle of the item under a hash
order lies in the document with a probability equal to the containment. Items are partitioned by
set size into powers of two; an item's sketch is its k smallest shingles under the hash order,
where k follows the upper size of its partition: one more than the shingles that a document may
lack. So by the pigeonhole principle a document that reaches the threshold holds at least one
sketched shingle: no link is lost. Documents smaller than the threshold allows are pruned by
size. Candidates are confirmed by exact containment of the shingle strings.

Items with fewer words than a shingle match nothing, as in the query's SQL; ``contained_items``
warns of how many there are, and ``short_items`` names them. Null and empty texts match nothing. Rows with a null item id are no items; documents with a null id are reported under null.
Repeated rows give one link. Empty tables give no rows. Only the named columns are read. A text
is worked on as a whole in one row; it needs some ten times its size in memory.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import words, written

#: Rows up to which sketches and candidates are broadcast; beyond it they are shuffled.
BROADCAST_ROWS = 500_000


def let(value: Column, body) -> Column:
    """``body`` of a value that is computed once: a lambda's variable, which the optimizer doesn't inline."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _runs(items: Column, width: int, make) -> Column:
    """``make(start)`` for every run of ``width`` items."""
    n = F.size(items)
    at = F.when(n >= width, F.sequence(F.lit(0), n - F.lit(width))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, make)


def shingle_hashes(word_list: Column, width: int) -> Column:
    """One 64-bit hash per word shingle, in order."""
    return let(F.transform(word_list, lambda w: F.xxhash64(w)), lambda h: _runs(
        h, width, lambda i: F.xxhash64(*[F.get(h, i + F.lit(k)) for k in range(width)])))


def shingle_strings(word_list: Column, width: int) -> Column:
    """The distinct shingles themselves."""
    return F.array_distinct(let(word_list, lambda w: _runs(
        w, width, lambda i: F.concat_ws(" ", F.slice(w, i + F.lit(1), width)))))


def short_items(items: DataFrame, *, item_id: str, text: str, width: int = 5) -> DataFrame:
    """``item_id, n_words`` of the items that have words, but fewer than a shingle: no document is compared with them."""
    return (items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), F.size(words(F.col(text))).alias("n_words"))
            .where(F.col("n_words").between(1, width - 1)).distinct())


def item_sketches(items: DataFrame, *, item_id: str, text: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Items (``item_id, item_shingles, n_item``) and sketches (``probe, item_id, least``), both written."""
    own = (items.where(F.col(item_id).isNotNull()).select(F.col(item_id).alias("item_id"), words(F.col(text)).alias("_w"))
           .withColumn("item_shingles", shingle_strings(F.col("_w"), width)).withColumn("n_item", F.size("item_shingles"))
           .where("n_item > 0").dropDuplicates(["item_id", "item_shingles"]))
    own = written(own, "items")
    # the partition of sizes (u/2, u]: its sketch has what a document may lack of u shingles, and one more
    upper = F.pow(F.lit(2), F.ceil(F.log2(F.col("n_item")))).cast("long")
    hashed = own.select(
        "item_id", "n_item", F.array_distinct(shingle_hashes(F.col("_w"), width)).alias("_s"), F.floor(upper * F.lit(100 - percent) / 100 + 1).cast("int").alias("k"))
    smallest = F.slice(F.array_sort(F.transform("_s", lambda s: F.struct(F.xxhash64(s, F.lit(1)).alias("o"), s.alias("s")))),
                       1, F.col("k"))
    probes = hashed.select("item_id", F.ceil(F.col("n_item") * F.lit(percent) / 100).cast("int").alias("least"),
                           F.explode(smallest).alias("p")).select(F.col("p.s").alias("probe"), "item_id", "least")
    return own.select("item_id", "item_shingles", "n_item"), written(probes, "item-sketches")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """A broadcast side only up to a checked number of rows."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def contained_items(docs: DataFrame, items: DataFrame, *, doc_id: str, text: str, item_id: str, item_text: str,
                    width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, text_key, item_id, n_item, n_found, containment`` for every link, one row each.

    ``text_key`` hashes id and text: it names the row also where ids are null or repeat.
    """
    n_short = short_items(items, item_id=item_id, text=item_text, width=width).count()
    if n_short:
        warnings.warn(f"{n_short} items have fewer than {width} words and are compared with no document", stacklevel=2)
    own, probes = item_sketches(items, item_id=item_id, text=item_text, width=width, percent=percent)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"), text_key(doc_id, text).alias("text_key"))
    # every shingle of a document carries the document's size, which prunes the items that are too large for it
    probed = (rows.select("text_key", shingle_hashes(words(F.col("_text")), width).alias("_s"))
              .select("text_key", F.explode(let(F.col("_s"), lambda s: F.transform(
                  s, lambda x: F.struct(x.alias("probe"), F.size(s).alias("n"))))).alias("_p"))
              .select("text_key", F.col("_p.probe").alias("probe"), F.col("_p.n").alias("_n")))
    n_probes = probes.count()
    hits = (probed.join(_small(probes, n_probes), "probe").where(F.col("_n") >= F.col("least"))
            .groupBy("text_key").agg(F.collect_set("item_id").alias("_items")))
    hits = written(hits, "candidates")
    n_hits = hits.count()
    candidates = rows.join(_small(hits, n_hits), "text_key").dropDuplicates(["text_key"])
    found = (candidates.select("doc_id", "text_key", shingle_strings(words(F.col("_text")), width).alias("_s"),
                               F.explode("_items").alias("item_id"))
             .join(_small(own, n_probes), "item_id")
             .withColumn("n_found", F.size(F.array_intersect("_s", "item_shingles"))))
    return (found.where(F.col("n_found") * 100 >= F.col("n_item") * percent)
            .select("doc_id", "text_key", "item_id", "n_item", "n_found",
                    (F.col("n_found") / F.col("n_item")).alias("containment")).dropDuplicates(["text_key", "item_id"]))


def text_key(doc_id: str, text: str) -> Column:
    return F.xxhash64(F.col(doc_id), F.lit(0), F.col(text))


def drop_contaminated(docs: DataFrame, links: DataFrame, *, doc_id: str, text: str) -> DataFrame:
    """``docs`` with all its columns, without the rows that ``links`` names."""
    named = written(links.select(F.col("text_key").alias("_leak")).distinct(), "leaks")
    return docs.join(_small(named, named.count()), text_key(doc_id, text) == F.col("_leak"), "left_anti")
