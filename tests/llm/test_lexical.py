"""Operator 12 against scoring every document, and the search's own bookkeeping."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, top=10):
    rows = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    count, total = len(rows), sum(sum(c.values()) for _, c in rows)
    df = Counter(t for _, c in rows for t in c)
    out = []
    for item, text in items:
        found = []
        for doc, c in rows:
            n, score = sum(c.values()), 0
            m = 100 - 75 + (75 * n * count) // total
            for t in terms(text):
                if t in c:
                    w = math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                    score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc or 0, doc))
        found.sort(key=lambda x: x[:3])
        out += [(item, k + 1, d, -s) for k, (s, _, _, d) in enumerate(found[:top])]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=str)


def corpus(n=400):
    rng = random.Random(4)
    words = [f"w{int(rng.paretovariate(0.6)) % 500}" for _ in range(3000)] + ["É", "é", "日本", "AbC", "a1"]
    texts = [" ".join(rng.choices(words, k=rng.choice([3, 10, 40, 200]))) for _ in range(n)]
    texts += [None, "", " !?", "rare", "rare", texts[0], texts[0].upper(), "w1 " * 20_000, "É-é_Abc,abc\x00a1"]
    items = [" ".join(rng.choices(words, k=k)) for k in (1, 2, 5, 30, 30, 30)]
    items += [None, "", "...", "rare", "nowhere", "w1 w1 w1 w2", "rare", "ABC é É 日本", "w1 " * 3000]
    return texts, items


@pytest.fixture(scope="module")
def case(spark):
    texts, items = corpus()
    docs = [((i * 37) % 1000 if i % 50 else None, t) for i, t in enumerate(texts)]
    docs += [docs[7], docs[7], (docs[8][0], texts[9])]  # a row repeated, and an id with two texts
    asked = [(k, t) for k, t in enumerate(items)] + [(3, items[4]), (None, items[3])]
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, score int, `text_id` string").repartition(3)
    q = spark.createDataFrame([(i, t, 5) for i, t in asked], "item_id long, text string, rank int")
    return docs, asked, d, q


@pytest.mark.parametrize("options", [{}, {"shard": 500}, {"block_bytes": 100}, {"shard": 1, "block_bytes": 20_000}, {"top": 3}, {"top": 1000}],
                         ids=["as registered", "small shards", "many blocks", "a shard a batch", "three", "all"])
def test_equals_scoring_every_document(case, options):
    docs, asked, d, q = case
    assert rows_of(lexical.ranked_search(d, q, **options)) == brute(docs, asked, options.get("top", 10))


def test_empty_tables(case):
    _, _, d, q = case
    assert lexical.ranked_search(d.limit(0), q).count() == 0
    assert lexical.ranked_search(d, q.limit(0)).count() == 0
    assert lexical.ranked_search(d.where("text is null"), q).columns == ["item_id", "rank", "doc_id", "score"]


def random_shard(rng, n_docs, n_terms):
    rows = np.repeat(np.arange(n_docs), n_terms)
    terms_ = np.tile(np.arange(n_terms), n_docs)
    keep = rng.random(len(rows)) < 0.3
    impacts = rng.integers(1, 40, len(rows))  # few values: many ties
    return lexical.Shard(np.arange(n_docs) * 3, rows[keep], terms_[keep], impacts[keep], n_terms), rows[keep], terms_[keep], impacts[keep]


def test_search_of_one_shard_is_exact_with_ties():
    rng = np.random.default_rng(1)
    for _ in range(60):
        shard, rows, terms_, impacts = random_shard(rng, int(rng.integers(1, 400)), int(rng.integers(1, 9)))
        asked = np.arange(shard.weight.size)[rng.random(shard.weight.size) < 0.6]
        repeats = rng.integers(1, 3, len(asked))
        weight = np.zeros(shard.weight.size, "int64")
        weight[asked] = repeats
        scores = np.bincount(rows, weights=weight[terms_] * impacts, minlength=len(shard.docs)).astype(int)
        want = sorted((-s, d) for s, d in zip(scores.tolist(), shard.docs.tolist()) if s > 0)[:10]
        best = lexical.Best(10)
        shard.search(asked, repeats, best)
        assert list(zip((-best.scores).tolist(), best.docs.tolist())) == want
        assert not shard.seen.any() and not shard.scored.any() and not shard.weight.any()


def test_search_stops_early():
    """A few documents with high impacts on both lists: the search must not score them all."""
    n = 20_000
    rng = np.random.default_rng(2)
    impacts = np.sort(rng.integers(1, 10**6, n))[::-1]
    rows, terms_ = np.repeat(np.arange(n), 2), np.tile([0, 1], n)
    shard = lexical.Shard(np.arange(n), rows, terms_, np.repeat(impacts, 2), 2)
    best = lexical.Best(10)
    assert shard.search(np.array([0, 1]), np.array([1, 1]), best) < 100
    assert best.docs.tolist() == list(range(10))


def test_lengths_beyond_64_bits_in_the_product():
    n = np.array([10**6, 5], "int64")
    got = lexical.impacts_of(n, np.array([3, 3]), np.array([7, 7]), 10**13, 10**16)
    want = [7 * ((3 * 10**9) // (3000 + 8 * (25 + 75 * int(x) * 10**13 // 10**16))) for x in n]
    assert got.tolist() == want
