from __future__ import annotations

import math
import random
import tracemalloc
import zlib
from collections import Counter, defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.llm import components, decontaminate, near_dup, ngram_lm, queries, superminhash, toxicity, wordhash
from brute import SF_SMALL, doc_table, odd_texts  # noqa: F401

VOCABULARY = ["w%d" % i for i in range(400)]


def _documents(spark, sf=SF_SMALL):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


# word fingerprints and signatures

def test_word_fingerprints(odd_texts, monkeypatch):
    monkeypatch.setattr(wordhash, "WINDOW", 16)
    hasher, names = wordhash.WordHasher(), {}
    for t in odd_texts:
        data = (t or "").encode()
        found, starts, ends = hasher(data)
        own = data.lower().split()
        assert [data[a:b].lower() for a, b in zip(starts, ends)] == own
        for w, h in zip(own, found.tolist()):
            assert names.setdefault(w, h) == h
    assert len(set(names.values())) == len(names)


@pytest.mark.parametrize("n", [1, 3, 30, 300, 3000])
def test_signature_estimates_similarity(n):
    rng = np.random.default_rng(n)
    found, slots = [], near_dup.BANDS * near_dup.ROWS
    m = max(1, n // 10)
    for _ in range(40):
        a = rng.integers(0, 2**63, n).astype(np.uint64)
        b = np.concatenate((a[m:], rng.integers(0, 2**63, m).astype(np.uint64)))
        found.append((superminhash.signature(a, slots) == superminhash.signature(b, slots)).mean())
    assert abs(np.mean(found) - (n - m) / (n + m)) < 0.04


def test_components(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(150)] + [(2000, 2000 + i) for i in range(1, 200)]
    want = brute.Sets({x for e in edges for x in e})
    for a, b in edges:
        want.join(a, b)
    got = components.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()
    assert {r.node: r.root for r in got} == {x: want.find(x) for a, b in edges if a != b for x in (a, b)}
    assert len(got) == len({r.node for r in got})
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# near-duplicates

def _family(rng, base, n, most):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, most)):
            w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("width,percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, doc_table, monkeypatch, width, percent):
    monkeypatch.setattr(near_dup, "BLOCK", 8)
    rng = random.Random(width)
    texts = []
    for _ in range(6):
        base = [rng.choice(VOCABULARY) for _ in range(rng.choice([60, 150, 300]))]
        texts += _family(rng, base, 40, 8)
        chain = list(base)  # copies of copies: the ends are no near copies of each other
        for _ in range(25):
            chain[rng.randrange(len(chain))] = rng.choice(VOCABULARY)
            texts.append(" ".join(chain))
    texts += [texts[0]] * 30 + [texts[1].upper(), "one", "One", "one two", "one  two\n", "", " ", None, "Éa b c", "éa b c"]
    rng.shuffle(texts)
    groups, sets = brute.near_groups(texts, width, percent)
    got = near_dup.near_duplicates(doc_table(list(enumerate(texts))), doc_id="doc_id", text="text", width=width, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in got} == {
        i: (len(sets[i]), groups[i], groups[i] == i) for i in range(len(texts))}
    docs = doc_table(list(enumerate(texts)))
    kept = near_dup.keep_one(docs, doc_id="doc_id", text="text", width=width, percent=percent)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(texts)) if groups[i] == i]


def test_near_duplicates_of_nulls_repeats_and_nothing(spark, doc_table):
    long = " ".join(VOCABULARY)
    rows = [(None, long), (None, long), (7, long), (7, long), (None, "other words here are"), (None, "other words here are"),
            (8, None), (8, None), (9, ""), (None, None), (7, "another text under an id that repeats")]
    docs = doc_table(rows)
    got = near_dup.near_duplicates(docs, doc_id="doc_id", text="text", width=3, percent=85).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.n_shingles > 300} == {7}
    kept = Counter((r.doc_id, r.text) for r in near_dup.keep_one(docs, doc_id="doc_id", text="text", width=3, percent=85).collect())
    assert kept == Counter([(7, long), (None, "other words here are"), (8, None), (8, None), (9, ""), (None, None),
                            (7, "another text under an id that repeats")])
    assert near_dup.keep_one(docs.limit(0), doc_id="doc_id", text="text").count() == 0
    assert near_dup.near_duplicates(docs.limit(0), doc_id="doc_id", text="text").count() == 0


def test_op1(spark):
    docs = sorted(_documents(spark))
    groups, sets = brute.near_groups([t for _, t in docs], 3, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op1_near_dup(spark, SF_SMALL).collect()}
    assert got == {i: (len(sets[k]), docs[groups[k]][0]) for k, (i, _) in enumerate(docs)}


# decontamination

def test_contained_items(spark, doc_table, monkeypatch):
    rng = random.Random(9)
    items = [(i, " ".join(rng.choice(VOCABULARY) for _ in range(rng.choice([3, 5, 6, 12, 40, 90])))) for i in range(60)]
    items += [(60, None), (61, ""), (None, "a b c d e f"), (62, items[5][1]), (5, items[5][1])]
    rows = []
    for d in range(150):
        w = [rng.choice(VOCABULARY) for _ in range(rng.choice([0, 4, 50, 600]))]
        own = (rng.choice(items)[1] or "").split()
        for _ in range(rng.randint(0, max(1, len(own) // 12))):
            if own:
                own[rng.randrange(len(own))] = "changed"
        at = rng.randint(0, len(w))
        rows.append((d, "\n ".join([*w[:at], *own, *w[at:]]).title()))
    rows += [(3, rows[3][1]), (None, rows[4][1]), (200, None), (201, ""), (202, (items[4][1] + " ") * 3000)]
    item_table = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, probe string, n_item int")
    want = set()
    sets = {(i, t): brute.shingle_set(t, 5, short=False) for i, t in items if i is not None}
    for d, t in rows:
        own = brute.shingle_set(t, 5, short=False)
        for (i, _), s in sets.items():
            if s and 100 * len(s & own) >= 80 * len(s):
                want.add((d, i, len(s), len(s & own)))
    args = dict(doc_id="doc_id", text="text", item_id="item_id", item_text="text")
    links = decontaminate.contained_items(doc_table(rows), item_table, **args)
    assert {(r.doc_id, r.item_id, r.n_item, r.n_found) for r in links.collect()} == want and len(want) > 30
    left = decontaminate.drop_contaminated(doc_table(rows), links, doc_id="doc_id", text="text")
    bad = {d for d, *_ in want}
    assert Counter(r.doc_id for r in left.collect()) == Counter(d for d, _ in rows if d not in bad)
    assert decontaminate.contained_items(doc_table([]), item_table, **args).count() == 0
    assert decontaminate.contained_items(doc_table(rows), item_table.limit(0), **args).count() == 0


def test_items_shorter_than_a_shingle_are_reported(spark, doc_table):
    items = spark.createDataFrame([(1, "one Two three four"), (2, "a b c d e"), (3, ""), (None, "x y"), (4, "yes"), (4, "yes"), (5, None)],
                                  "item_id long, text string")
    docs = doc_table([(1, "yes one two three four"), (2, "so a b c d e")])
    with pytest.warns(UserWarning, match="^2 items have fewer than 5 words"):
        links = decontaminate.contained_items(docs, items, doc_id="doc_id", text="text", item_id="item_id", item_text="text")
    assert [(r.doc_id, r.item_id) for r in links.collect()] == [(2, 2)]
    short = decontaminate.short_items(items, item_id="item_id", text="text")
    assert {(r.item_id, r.n_words) for r in short.collect()} == {(1, 4), (4, 1)}


# language model

def _kneser_ney(docs):
    """Scores of (words, learn) documents by the definition."""
    big, uni = Counter(), Counter()
    for w, learn in docs:
        if learn:
            uni.update(w)
            big.update(zip(["<s>", *w[:-1]], w))

    def discounts(c):
        n = [sum(v == k for v in c.values()) for k in (1, 2, 3, 4)]
        if not n[0] or not n[1]:
            return [0, 0.5, 0.5, 0.5]
        y, d = n[0] / (n[0] + 2 * n[1]), [0.0]
        for k in (1, 2, 3):
            d.append(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) if n[k - 1] else d[-1])
        return d
    a = Counter(w for _, w in big)
    d, e, types, size, total = discounts(big), discounts(a), sum(a.values()), len(uni), sum(uni.values())
    about = defaultdict(lambda: [0, 0, 0, 0])
    for (v, _), c in big.items():
        about[v][0] += c
        about[v][min(c, 3)] += 1
    kinds = Counter(min(x, 3) for x in a.values())
    rest = sum(e[k] * kinds[k] for k in (1, 2, 3)) / types if types else 1.0

    def word(w):
        return (max(a[w] - e[min(a[w], 3)], 0) / types if types else 0) + rest / (size + 1)

    def after(v, w):
        if v not in about:
            return word(w)
        x, c = about[v], big[v, w]
        return max(c - d[min(c, 3)], 0) / x[0] + sum(d[k] * x[k] for k in (1, 2, 3)) / x[0] * word(w)
    for v in ["<s>", *list(uni)[:5]]:
        assert abs(sum(after(v, w) for w in uni) + after(v, None) - 1) < 1e-9
    return [(len(w), sum(uni[x] > 0 for x in w), total, sum(math.log10((uni[x] + 0.1) / (total + 0.1 * (size + 1))) for x in w),
             sum(math.log10(after(v, x)) for v, x in zip(["<s>", *w[:-1]], w))) for w, _ in docs]


def _level(counts):
    """Discounts of a level, and per context its total and its followers seen once, twice, more often."""
    n = [sum(v == k for v in counts.values()) for k in (1, 2, 3, 4)]
    d = [0, 0.5, 0.5, 0.5]
    if n[0] and n[1]:
        y, d = n[0] / (n[0] + 2 * n[1]), [0.0]
        for k in (1, 2, 3):
            d.append(min(max(k - (k + 1) * y * n[k] / n[k - 1], 0), k) if n[k - 1] else d[-1])
    about = defaultdict(lambda: [0, 0, 0, 0])
    for gram, c in counts.items():
        about[gram[:-1]][0] += c
        about[gram[:-1]][min(c, 3)] += 1
    return d, about


def _kneser_ney_3(docs):
    """As _kneser_ney, with order 3 and the recursion written out over levels of counts."""
    three = Counter()
    for w, learned in docs:
        if learned:
            padded = ["<s>", "<s>", *w]
            three.update(zip(padded, padded[1:], padded[2:]))
    uni = Counter(x for w, learned in docs if learned for x in w)
    levels = [three]
    while len(next(iter(levels[-1]))) > 1:
        levels.append(Counter(gram[1:] for gram in levels[-1]))
    levels = [(c, *_level(c)) for c in levels]

    def p(gram):
        counts, d, about = levels[3 - len(gram)]
        x = about.get(gram[:-1], [0, 0, 0, 0])
        lower = p(gram[1:]) if len(gram) > 1 else 1 / (len(uni) + 1)
        if not x[0]:
            return lower
        c = counts[gram]
        return (max(c - d[min(c, 3)], 0) + sum(d[k] * x[k] for k in (1, 2, 3)) * lower) / x[0]
    words = [*uni, None]
    for context in [g[:2] for g in list(three)[:4]] + [("no", "such")]:
        assert abs(sum(p((*context, w)) for w in words) - 1) < 1e-9
    total = sum(uni.values())
    return [(len(w), sum(uni[x] > 0 for x in w), total, sum(math.log10((uni[x] + 0.1) / (total + 0.1 * (len(uni) + 1))) for x in w),
             sum(math.log10(p(g)) for g in zip(["<s>", "<s>", *w], ["<s>", *w], w))) for w, _ in docs]


@pytest.mark.parametrize("hot", [400, 10**6])
def test_order_3_equals_the_definition(spark, doc_table, monkeypatch, hot):
    for name, value in (("BLOCK_TOKENS", 700), ("SHARD_BYTES", 3000), ("HOT_TOKENS", hot)):
        monkeypatch.setattr(ngram_lm, name, value)
    rng = random.Random(hot)
    rows = [(i, " ".join(VOCABULARY[int(rng.expovariate(0.2)) % 60] for _ in range(rng.randint(0, 60)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "Never Seen\tbefore"), (203, "w1 W1 w1"), (203, "w1 W1 w1"), (204, "w2 " * 2000)]
    got = ngram_lm.score_documents(doc_table(rows).repartition(3), doc_id="doc_id", text="text", learn=F.col("doc_id") % 10 < 7, order=3).collect()
    want = _kneser_ney_3([([*brute.words(t), "</s>"], i % 10 < 7) for i, t in rows])
    by = {(i, w[0], w[1]): w for (i, _), w in zip(rows, want)}
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    for r in got:
        _, _, total, base, score = by[r.doc_id, r.n_tokens, r.n_known]
        assert r.train_tokens == total and r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    none = ngram_lm.score_documents(doc_table(rows[:9]), doc_id="doc_id", text="text", learn=F.lit(False), order=3).collect()
    assert all(r.score == r.base_score == r.n_known == r.train_tokens == 0 for r in none) and len(none) == 9
    assert ngram_lm.score_documents(doc_table([]), doc_id="doc_id", text="text", learn=F.lit(True), order=3).count() == 0
    with pytest.raises(ValueError, match="order"):
        ngram_lm.score_documents(doc_table(rows), doc_id="doc_id", text="text", learn=F.lit(True), order=4)


@pytest.mark.parametrize("order,hot", [(2, 10**6), (2, 300), (3, 300)])
def test_a_stored_model_scores_other_documents(spark, doc_table, monkeypatch, tmp_path, order, hot):
    for name, value in (("BLOCK_TOKENS", 700), ("SHARD_BYTES", 3000), ("HOT_TOKENS", hot)):
        monkeypatch.setattr(ngram_lm, name, value)
    rng = random.Random(order)
    text = lambda: " ".join(VOCABULARY[int(rng.expovariate(0.2)) % 60] for _ in range(rng.randint(0, 60)))
    rows = [(i, text()) for i in range(100)] + [(1, "w3 " * 900)]
    new = [(1000 + i, text()) for i in range(30)] + [(1100, None), (1101, "Never seen"), (1102, "w3 w3"), (1102, "w3 w3")]
    path = f"file://{tmp_path}/model"
    both = ngram_lm.score_documents(doc_table(rows + new).repartition(3), doc_id="doc_id", text="text", learn=F.col("doc_id") < 1000, order=order,
                                    model_path=path).where("doc_id >= 1000").collect()
    got = ngram_lm.score_with(doc_table(new), path, doc_id="doc_id", text="text").collect()
    key = lambda r: (r.doc_id, r.learned, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6))
    assert sorted(map(key, got)) == sorted(map(key, both)) and len(got) == len(new)
    assert ngram_lm.score_with(doc_table([]), path, doc_id="doc_id", text="text").count() == 0


@pytest.mark.parametrize("learned", [0, 3, 10])
def test_scores_equal_the_definition(spark, doc_table, monkeypatch, learned):
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", 700)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 3000)
    rng = random.Random(learned)
    rows = [(i, " ".join(VOCABULARY[int(rng.expovariate(0.05)) % 400] for _ in range(rng.randint(0, 60)))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, "Never Seen\tbefore"), (203, "w1 W1 w1"), (203, "w1 W1 w1"), (204, "w2 " * 3000)]
    learn = F.col("doc_id") % 10 < learned
    got = ngram_lm.score_documents(doc_table(rows).repartition(3), doc_id="doc_id", text="text", learn=learn).collect()
    want = _kneser_ney([([*brute.words(t), "</s>"], i % 10 < learned) for i, t in rows]) if learned else None
    assert sorted(r.doc_id for r in got) == sorted(i for i, _ in rows)
    if not learned:
        assert all(r.score == r.base_score == r.n_known == r.train_tokens == 0 for r in got)
        return
    by = {(i, w[0], w[1]): w for (i, _), w in zip(rows, want)}
    for r in got:
        _, _, total, base, score = by[r.doc_id, r.n_tokens, r.n_known]
        assert r.train_tokens == total and r.base_score == pytest.approx(base) and r.score == pytest.approx(score)


def test_a_hot_context_is_dealt_over_shards(spark, doc_table, monkeypatch, tmp_path):
    """One word before most others, and documents of one word: no shard gets all that follows, scores stay the definition's."""
    monkeypatch.setattr(ngram_lm, "BLOCK_TOKENS", 1500)
    monkeypatch.setattr(ngram_lm, "SHARD_BYTES", 3000)
    monkeypatch.setattr(ngram_lm, "HOT_TOKENS", 400, raising=False)
    whole, folder = ngram_lm._bigram_shard, str(tmp_path)

    def counted(*args):
        run = whole(*args)

        def shard(table):
            n = sum(len(ngram_lm.unpacked(x.as_buffer())[4]) for x in table["data"])
            with open(f"{folder}/{table['shard'][0].as_py()}", "w") as f:
                f.write(str(n))
            return run(table)
        return shard
    monkeypatch.setattr(ngram_lm, "_bigram_shard", counted)
    rng = random.Random(5)
    rows = [(i, " ".join(f"| w{rng.randrange(3000)}" for _ in range(rng.randint(0, 60)))) for i in range(200)]
    rows += [(1000 + i, f"w{rng.randrange(3000)}") for i in range(1500)]
    got = ngram_lm.score_documents(doc_table(rows).repartition(3), doc_id="doc_id", text="text", learn=F.col("doc_id") % 10 < 7).collect()
    want = _kneser_ney([([*brute.words(t), "</s>"], i % 10 < 7) for i, t in rows])
    by = {i: w for (i, _), w in zip(rows, want)}
    assert len(got) == len(rows)
    for r in got:
        n, known, total, base, score = by[r.doc_id]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (n, known, total)
        assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score)
    sizes = [int(p.read_text()) for p in tmp_path.iterdir()]
    assert max(sizes) < 1600 < sum(sizes) / 5


def test_counts_over_all_blocks_pass_32_bits():
    words, n = np.array([7], np.uint64), np.array([1], np.uint32)
    one = ngram_lm.packed(words, n, *ngram_lm.six_bytes(ngram_lm.follower(words)), np.array([3_000_000_000], np.uint32))
    run = ngram_lm._bigram_shard(1, ngram_lm.Hot(np.zeros(0, np.uint64), np.zeros(0, np.int64)))
    told = run(pa.Table.from_batches([ngram_lm._batch([("ask", 0, block, one) for block in (1, 2)])]))
    answers = [ngram_lm.unpacked(d.as_buffer()) for k, d in zip(told["kind"].to_pylist(), told["data"]) if k == "bigrams"]
    assert [[int(x[0]) for x in a] for a in answers] == 2 * [[6_000_000_000, 6_000_000_000, 0, 0, 1]]
    part = ngram_lm.packed(*ngram_lm.six_bytes(ngram_lm.follower(words)), np.array([3_000_000_000], np.uint32))
    ask = ngram_lm.packed(*ngram_lm.six_bytes(ngram_lm.follower(words)))
    told = ngram_lm._word_shard()(pa.Table.from_batches([ngram_lm._batch([("part", 0, 0, part), ("part", 0, 0, part), ("ask", 0, 1, ask)])]))
    answers = [ngram_lm.unpacked(d.as_buffer()) for k, d in zip(told["kind"].to_pylist(), told["data"]) if k == "words"]
    assert int(answers[0][0][0]) == 6_000_000_000


def test_op4_beats_word_frequencies_on_held_out_rows(spark):
    got = queries.op4_ngram_lm(spark, SF_SMALL).collect()
    assert len(got) == len(_documents(spark))
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 10 == 0)
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_scores_of_nothing(spark, doc_table):
    assert ngram_lm.score_documents(doc_table([]), doc_id="doc_id", text="text", learn=F.lit(True)).count() == 0


# toxicity

def test_pairs_are_learned(spark):
    """Neither word alone tells: only the pair does."""
    rng = np.random.default_rng(1)
    x = rng.integers(0, 2, (3000, 2))
    label = (x[:, 0] & x[:, 1]).astype(float)
    lengths = x.sum(1)
    terms = np.concatenate([np.flatnonzero(r) for r in x])
    bias, w, v = toxicity.fit_arrays(label, lengths, terms, 2, toxicity.Settings())
    z = lambda a, b: bias + a * w[0] + b * w[1] + a * b * float(v[0] @ v[1])
    assert z(1, 1) > 0 > max(z(0, 0), z(1, 0), z(0, 1)) and float(v[0] @ v[1]) > 0


def test_op9_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = queries.op9_toxicity(spark, sf).collect()
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    hits = sum(a and b for a, b in held)
    assert hits / sum(a for a, _ in held) > 0.85 and hits / sum(b for _, b in held) > 0.9  # some labels are noise
    assert all(0 <= r.score <= 1 and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)


def test_training_rows_are_bounded(spark, doc_table):
    rows = [(i, "text %d" % i) for i in range(3000)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(3000)], "doc_id long, toxic int")
    got = toxicity.training_rows(doc_table(rows), labels, key="doc_id", text="text", label="toxic", learn=F.col("doc_id") % 3 > 0,
                                 settings=toxicity.Settings(), sample=500)
    assert 400 < got.count() <= 500
    few = toxicity.training_rows(doc_table(rows), labels.limit(100), key="doc_id", text="text", label="toxic",
                                 learn=F.lit(True), settings=toxicity.Settings(), sample=500)
    assert few.count() == 100


def test_odd_rows_and_labels(spark, doc_table):
    rows = [(i, "you idiot clown" if i % 2 else "a kind word") for i in range(200)] + [(None, "idiot"), (300, None), (301, ""), (302, "!? 12"), (302, "!? 12")]
    label_rows = [(i, i % 2) for i in range(200)] + [(5, 0), (None, 1), (6, None), (999, 1)]
    labels = spark.createDataFrame([(i, y, "x") for i, y in label_rows], "doc_id long, toxic int, text string")
    fit = lambda some: toxicity.fit_labels(doc_table(rows), some, key="doc_id", text="text", label="toxic", learn=F.lit(True))
    got = {(r.key, i): r.score for i, r in enumerate(toxicity.score_table(doc_table(rows), fit(labels), key="doc_id", text="text").collect())}
    assert len(got) == len(rows) and min(s for (k, _), s in got.items() if k is not None and k < 200 and k % 2) > 0.5
    assert max(s for (k, _), s in got.items() if k is not None and (k < 200 and not k % 2)) < 0.3
    base = toxicity.score_table(doc_table(rows), fit(labels.limit(0)), key="doc_id", text="text").collect()
    assert len({r.score for r in base}) == 1 and 0 < base[0].score < 0.3
    model = fit(labels.where("toxic = 1"))
    assert toxicity.score_table(doc_table([]), model, key="doc_id", text="text").count() == 0


def test_scores_equal_a_double_loop_over_pairs(spark):
    """Bias, weights of the terms that occur, and every pair of them: the definition, term by term."""
    rng = np.random.default_rng(3)
    settings = toxicity.Settings()
    texts = ["you are bad", "Bad BAD bad people", "", None, "people of the word " * 50, "nothing known here", "x" * 100_000 + " bad"]
    words = ["you", "bad", "people", "word", "the"]
    terms = np.unique([t for w in words for t in toxicity.terms_of(next(iter(toxicity.word_set(w))), settings.buckets, settings.prefixes)])
    model = toxicity.Model(-1.5, settings.buckets, settings.prefixes, terms.astype(np.int64), rng.normal(size=len(terms)),
                           rng.normal(size=(len(terms), settings.factors)) / 3)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.key: r.score for r in toxicity.score_table(df, model, key="doc_id", text="text").collect()}
    place = {int(t): i for i, t in enumerate(model.terms)}
    for n, text in enumerate(texts):
        own = sorted({place[t] for w in toxicity.word_set(text or "") for t in toxicity.terms_of(w, settings.buckets, settings.prefixes) if t in place})
        z = model.bias + sum(float(model.weights[i]) for i in own)
        for a in range(len(own)):
            for b in range(a + 1, len(own)):
                z += sum(float(x) * float(y) for x, y in zip(model.factors[own[a]], model.factors[own[b]]))
        assert got[n] == pytest.approx(1 / (1 + math.exp(-max(-30, min(30, z)))))


def test_a_word_longer_than_a_window(monkeypatch):
    rng = np.random.default_rng(1)
    long = bytes(rng.integers(97, 123, 5000, dtype=np.uint8))
    data = b"ab " + long + b" cd " + long + long + b"\n" + long.upper()
    whole = wordhash.WordHasher()(data)
    monkeypatch.setattr(wordhash, "WINDOW", 700)
    got = wordhash.WordHasher()(data)
    for one, two in zip(whole, got):
        assert one.tolist() == two.tolist()
    assert got[0][1] == got[0][4] != got[0][3]


def test_a_huge_word_takes_bounded_memory():
    import tracemalloc
    data = b"x" * 50_000_000 + b" y"
    tracemalloc.start()
    hashes, starts, ends = wordhash.WordHasher()(data)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ends.tolist() == [50_000_000, 50_000_002] and len(set(hashes.tolist())) == 2
    assert peak < 4 * len(data)  # marks of a byte each and their list, no number per byte


def test_tables_and_memos_keep_no_long_words():
    from tessera.llm.texts import Memo
    memo = Memo(len, 10**6)
    assert sum(memo["x" * n] for n in range(10_000)) == sum(range(10_000)) and max(map(len, memo)) <= 64
    calls = []

    def compute(found):
        calls.append(found)
        return np.concatenate([np.frombuffer(w[:3], np.uint8).astype(np.uint16) for w in found]), np.array([min(3, len(w)) for w in found])
    table, hasher = wordhash.WordTable(compute, 1000), wordhash.WordHasher(fold=False)
    for _ in range(2):
        data = b"abc " + b"z" * 10_000 + b" de " + b"y" * 65 + b" abc fgh"
        values, sizes = table.over(data, *hasher(data))
        assert bytes(values.astype(np.uint8).tolist()) == b"abczzzdeyyyabcfgh" and sizes.tolist() == [3, 3, 2, 3, 3, 3]
    assert sorted(calls[1]) == sorted([b"z" * 10_000, b"y" * 65]) and len(table.pool) == 8


def test_batches_of_long_texts_are_small(spark, doc_table):
    from tessera.llm import texts
    name = "spark.sql.execution.arrow.maxBytesPerBatch"

    def sizes(batches):
        for b in batches:
            yield b.from_arrays([[b.nbytes]], ["n"])
    docs = doc_table([(i, "word " * 10_000) for i in range(400)]).coalesce(1)
    try:
        spark.conf.unset(name)
        toxicity.score_table(docs, toxicity.Model(0.0, 16, ()), key="doc_id", text="text")
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) <= 2 * texts.BATCH_BYTES
        spark.conf.set(name, "1000000")  # a session's own limit stays
        texts.small_batches(spark)
        assert spark.conf.get(name) == "1000000"
    finally:
        spark.conf.unset(name)


def test_language_model_tasks_hold_few_arrays():
    """Bytes that a shard and a block hold at most, an n-gram (tracemalloc counts NumPy's arrays)."""
    hot, rng, asked, lengths = ngram_lm.Hot(np.zeros(0, np.uint64), np.zeros(0, np.int64)), np.random.default_rng(3), [], [1000] * 150
    words = np.append(np.unique(wordhash.mixed(np.arange(20_000, dtype=np.uint64))), ngram_lm.END)
    words.sort()
    for block in range(4):
        seq = (rng.zipf(1.3, 150_000) % 20_000).astype(np.uint32)
        row = {"block": block, "lengths": lengths, "learns": [True] * 150, "vocabulary": ngram_lm.packed(words), "tokens": ngram_lm.packed(seq)}
        asked += ngram_lm._ask(2, hot, 2, 2)(iter([pa.RecordBatch.from_pylist([row])]))
    asked = pa.Table.from_batches(asked)
    shard = asked.filter(pa.array([s == 0 for s in asked["shard"].to_pylist()]))
    n = sum(len(ngram_lm.unpacked(x.as_buffer())[4]) for x in shard["data"])

    def held(run):
        run()
        tracemalloc.start()
        run()
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most
    assert held(lambda: ngram_lm._bigram_shard(2, hot)(shard)) < 85 * n
    n = len(np.unique(ngram_lm.Block(words, seq, np.array(lengths), 2, hot).back))
    about, where = rng.integers(1, 9, (4, 20_000)), rng.integers(0, 20_000, n)
    assert held(lambda: ngram_lm._interpolated(np.ones(n, np.int64), where, about, np.full(4, 0.5), np.ones(n))) < 55 * n
    keys = rng.integers(0, 1000, 100_000).astype(np.uint64)
    for some in (keys, keys[:0]):
        for got, want in zip(ngram_lm.distinct(some), np.unique(some, return_inverse=True)):
            assert (got == want).all() and got.dtype == want.dtype


def test_language_model_reads_texts_in_small_batches(spark, doc_table):
    from tessera.llm import texts
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    try:
        spark.conf.unset(name)
        got = ngram_lm.score_documents(doc_table([(1, "a b"), (2, None)]), doc_id="doc_id", text="text", learn=F.lit(True))
        assert spark.conf.get(name) == str(texts.BATCH_BYTES) and got.count() == 2
    finally:
        spark.conf.unset(name)
