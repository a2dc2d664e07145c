"""Registered queries of the operators: thin, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from tessera.llm import bpe_fst, decontaminate, hard_negatives, near_dup, ngram_lm, prefix_trie, sentence_pieces, shard, token_count, token_records, topk, toxicity, url_filter
from tessera.llm.common import read_table
from tessera.llm.registry import query
from tessera.session import scratch_path

URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


#: DuckDB: the lower-cased words of a text, as ``w``.
WORDS_SQL = r"""list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w"""


@query("op1_near_dup", sql=f"""
WITH RECURSIVE d AS (SELECT doc_id, {WORDS_SQL} FROM documents),
s AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' '))
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.a, r.c FROM r JOIN e ON r.doc_id = e.b),
m AS (SELECT doc_id, min(c) AS c FROM r GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.c, d.doc_id) AS component_id, d.doc_id = coalesce(m.c, d.doc_id) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)""")
def op1_near_dup(spark, sf_dir):
    return near_dup.near_duplicates(read_table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", width=3,
                                    percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@query("op2_token_counts")
def op2_token_counts(spark, sf_dir):
    return (token_count.count_tokens(read_table(spark, sf_dir, "documents"), key="doc_id", text="text",
                                     vocabulary=public_tokenizers.path("byte_bpe_50k.json"), limit=1024)
            .withColumnRenamed("key", "doc_id"))


@query("op3_decontaminate", sql=f"""
WITH d AS (SELECT DISTINCT doc_id, {WORDS_SQL} FROM documents),
i AS (SELECT DISTINCT item_id, {WORDS_SQL} FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS p FROM d)),
its AS (SELECT DISTINCT item_id, array_to_string(w[p:p + 4], ' ') AS s FROM (SELECT item_id, w, unnest(range(1, len(w) - 3)) AS p FROM i)),
n AS (SELECT item_id, CAST(count(*) AS INTEGER) AS n_item FROM its GROUP BY 1),
f AS (SELECT doc_id, item_id, CAST(count(*) AS INTEGER) AS n_found FROM ds JOIN its USING (s) GROUP BY ALL)
SELECT doc_id, item_id, n_item, n_found, n_found / n_item AS containment FROM f JOIN n USING (item_id) WHERE n_found * 100 >= n_item * 80""")
def op3_decontaminate(spark, sf_dir):
    return decontaminate.contained_items(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), doc_id="doc_id", text="text",
        item_id="item_id", item_text="text").select("doc_id", "item_id", "n_item", "n_found", "containment")


@query("op4_ngram_lm")
def op4_ngram_lm(spark, sf_dir):
    scored = ngram_lm.score_documents(read_table(spark, sf_dir, "documents"), doc_id="doc_id", text="text", learn=id_crc() % 10 != 0)
    return scored.select("doc_id", (~F.col("learned")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op5_token_records")
def op5_token_records(spark, sf_dir):
    path = scratch_path(spark, "token-records")
    token_records.write_records(read_table(spark, sf_dir, "documents"), path, key="doc_id", text="text",
                                vocabulary=public_tokenizers.path("word_bpe_49k.json"), end_id=1, width=2)
    return token_records.write_index(spark, path).select(
        F.col("key").alias("doc_id"), F.col("first_token").alias("start"), "n_tokens", "ids_crc32", "file", "offset", "length")


@query("op6_byte_bpe")
def op6_byte_bpe(spark, sf_dir):
    return bpe_fst.round_trip(read_table(spark, sf_dir, "documents"), key="doc_id", text="text",
                              vocabulary=public_tokenizers.path("byte_bpe_50k.tiktoken"),
                              pattern=public_tokenizers.PATTERN).withColumnRenamed("key", "doc_id")


@query("op7_exact_topk", sql="""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(sum(q.x * c.x) AS BIGINT) AS score
      FROM c q JOIN c ON q.d = c.d AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
             vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""")
def op7_exact_topk(spark, sf_dir):
    return topk.top_k(read_table(spark, sf_dir, "embeddings"), row_id="vec_id", vector="embedding",
                      is_query=F.col("vec_id") % 50 == 0, k=5)


#: DuckDB: prior weight of a level, from the rows (n, k, prior) of that level.
_WEIGHT_SQL = """SELECT coalesce(least(greatest(CASE WHEN b > 0 THEN q / b - 1 ELSE 1000 END, 2), 1000), 1000) AS m FROM (
  SELECT sum(n * (pow(k / n - prior, 2) - prior * (1 - prior) / n)) AS b, sum(n * prior * (1 - prior)) AS q FROM {0})"""


@query("op8_url_filter", sql=f"""
WITH u AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
x AS (SELECT *, array_to_string(string_split(host, '.')[-2:], '.') AS two, string_split(host, '.')[-1] AS one,
             array_to_string(string_split(host, '.')[-3:], '.') AS three FROM u),
v AS (SELECT page_id, host, path, CASE WHEN two IN {url_filter.SUFFIXES} THEN three ELSE two END AS domain,
             CASE WHEN two IN {url_filter.SUFFIXES} THEN two ELSE one END AS suffix FROM x),
h AS (SELECT host, domain, suffix, count(*) AS n, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS k
      FROM v JOIN labels l ON l.doc_id = v.page_id GROUP BY ALL),
g AS (SELECT domain, suffix, sum(n) AS n, sum(k) AS k FROM h GROUP BY ALL),
t AS (SELECT suffix, sum(n) AS n, sum(k) AS k FROM g GROUP BY ALL),
o AS (SELECT coalesce(sum(k), 0) + 0.2 AS a, coalesce(sum(n) - sum(k), 0) + 1.8 AS b FROM t),
t1 AS (SELECT suffix, n, k, a / (a + b) AS prior FROM t, o), t2 AS ({_WEIGHT_SQL.format("t1")}),
t3 AS (SELECT suffix, k + prior * m AS a, n - k + (1 - prior) * m AS b FROM t1, t2),
g1 AS (SELECT domain, g.n, g.k, a / (a + b) AS prior FROM g JOIN t3 USING (suffix)), g2 AS ({_WEIGHT_SQL.format("g1")}),
g3 AS (SELECT domain, k + prior * m AS a, n - k + (1 - prior) * m AS b FROM g1, g2),
h1 AS (SELECT host, h.n, h.k, a / (a + b) AS prior FROM h JOIN g3 USING (domain)), h2 AS ({_WEIGHT_SQL.format("h1")}),
h3 AS (SELECT host, k + prior * m AS a, n - k + (1 - prior) * m AS b FROM h1, h2),
z AS (SELECT v.*, coalesce(h3.a, g3.a, t3.a, o.a) AS a, coalesce(h3.b, g3.b, t3.b, o.b) AS b,
             CASE WHEN h3.a IS NOT NULL THEN 'host' WHEN g3.a IS NOT NULL THEN 'domain' WHEN t3.a IS NOT NULL THEN 'suffix'
                  ELSE 'overall' END AS level,
             CASE WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND prefix(path, '/en/') THEN 'example.net/en/'
                  WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND prefix(path, '/de/') THEN 'example.com/de/'
                  WHEN (host = 'org' OR suffix(host, '.org')) AND prefix(path, '/fr/') THEN 'org/fr/'
                  WHEN (host = 'net' OR suffix(host, '.net')) AND prefix(path, '/') THEN 'net/' END AS rule
      FROM v LEFT JOIN h3 USING (host) LEFT JOIN g3 USING (domain) LEFT JOIN t3 USING (suffix), o),
y AS (SELECT *, a / (a + b) AS rate, greatest(a / (a + b) - 1.645 * sqrt(a / (a + b) * (1 - a / (a + b)) / (a + b + 1)), 0) AS bound FROM z)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN bound > 0.5 THEN 'block' ELSE 'allow' END AS verdict, round(rate, 6) AS bad_rate, round(bound, 6) AS bad_bound, level FROM y""")
def op8_url_filter(spark, sf_dir):
    pages, labels = read_table(spark, sf_dir, "pages"), read_table(spark, sf_dir, "labels")
    # the outcome of a page: bad where its label says toxic or low quality
    outcomes = pages.select("page_id", "url").join(
        labels.select(F.col("doc_id").alias("page_id"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int").alias("bad")),
        "page_id")
    judged = url_filter.filter_urls(pages, outcomes, page_id="page_id", url="url", rules=URL_RULES)
    return judged.withColumns({c: F.round(c, 6) for c in ("bad_rate", "bad_bound")})


#: Score from which a text counts as toxic.
TOXIC = 0.3


def id_crc(doc_id="doc_id"):
    """Unsigned CRC-32 of the id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary"))


def toxicity_model(spark, docs, sf_dir):
    return toxicity.fit_labels(docs, read_table(spark, sf_dir, "labels"), key="doc_id", text="text", label="toxic",
                               learn=id_crc() % 4 != 2)


@query("op9_toxicity")
def op9_toxicity(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    scores = toxicity.score_table(docs, toxicity_model(spark, docs, sf_dir), key="doc_id", text="text")
    return scores.select(F.col("key").alias("doc_id"), F.coalesce(id_crc("key") % 4 == 2, F.lit(False)).alias("held_out"),
                         "score", (F.col("score") >= TOXIC).cast("int").alias("predicted"))


@query("op10_jump_shards")
def op10_jump_shards(spark, sf_dir):
    return (shard.jump_shards(read_table(spark, sf_dir, "documents"), key="doc_id", text="text", shards=24)
            .withColumnRenamed("key", "doc_id"))


@query("op11_sentence_pieces")
def op11_sentence_pieces(spark, sf_dir):
    return sentence_pieces.round_trip(read_table(spark, sf_dir, "documents"), key="doc_id", text="text",
                                      model=public_tokenizers.path("piece_bpe_32k.model")).withColumnRenamed("key", "doc_id")


@query("op12_hard_negatives", sql="""
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, label, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(sum(a.x * c.x) AS BIGINT) AS score
      FROM c a JOIN c ON a.d = c.d AND a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0 GROUP BY ALL),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score,
             CAST(row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) AS INTEGER) AS positive_rank
      FROM s WHERE same QUALIFY positive_rank <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score, positive_rank
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""")
def op12_hard_negatives(spark, sf_dir):
    # a seventh of the labels is wrong on purpose
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read_table(spark, sf_dir, "embeddings"), row_id="vec_id", vector="embedding", label=label,
                                         is_anchor=F.col("vec_id") % 100 == 0, positives=5, negatives=10, low=30, high=90)


#: DuckDB: unsigned CRC-32 of the conversation's number as text, bit by bit (-1 stands for a shift).
_CRC_SQL = """xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''),
             lambda ch: [CAST(ascii(ch) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])),
             lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END, CAST(4294967295 AS BIGINT)), 4294967295)"""


@query("op13_prefix_trie", sql=f"""
WITH t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(octet_length(encode(coalesce(role, '')))
                  || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS r, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, {_CRC_SQL} % 4 AS h FROM t),
u AS (SELECT c.conv_id, 0 AS part, r, role, text FROM c JOIN t ON t.conv_id = c.base AND r < h
      UNION ALL SELECT c.conv_id, 1, r, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND r >= h),
w AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY part, r) AS d, role, text FROM u),
p AS (SELECT conv_id, d, text, string_agg(md5(octet_length(encode(role)) || ':' || role || text), '' ORDER BY d)
             OVER (PARTITION BY conv_id ORDER BY d ROWS UNBOUNDED PRECEDING) AS path FROM w),
n AS (SELECT path, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(len(list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'),
             lambda x: x <> ''))) AS w FROM p GROUP BY ALL
      UNION ALL SELECT '', 0, min(conv_id), count(*), 0 FROM c HAVING count(*) > 0),
e AS (SELECT coalesce(path, '') AS path, string_agg(conv_id, ',' ORDER BY conv_id) AS ids
      FROM c LEFT JOIN (SELECT conv_id, max_by(path, d) AS path FROM p GROUP BY 1) USING (conv_id) GROUP BY 1),
k AS (SELECT left(path, len(path) - 32) AS path, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf FROM n LEFT JOIN k USING (path)),
a AS (SELECT left(path, 32 * unnest(range(0, d + 1))) AS path, leaf, (n_convs - 1) * w AS own FROM f),
s AS (SELECT path, sum(leaf) AS n_leaves, sum(own) AS saved_tokens FROM a GROUP BY 1)
SELECT f.conv_id, f.d AS depth, g.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM f JOIN s USING (path) LEFT JOIN e USING (path) LEFT JOIN n g ON f.d > 0 AND g.path = left(f.path, len(f.path) - 32)""")
def op13_prefix_trie(spark, sf_dir):
    # conversations of one family of 20 begin with the same turns
    return prefix_trie.conversation_trie(read_table(spark, sf_dir, "conversations"), conv_id="conv_id", turn="turn", role="role", text="text",
                                         family=20, heads=id_crc("conv") % 4, most=3)
