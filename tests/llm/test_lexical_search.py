"""Ranked search against brute force over all documents."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

from tracklake.llm import lexical_search as ls

TERM = re.compile(ls.TERM)
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, top):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    big_n, big_l = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for name, text in items:
        found = []
        for i, c, n in held:
            m = 100 - 50 + (50 * n * big_n) // big_l
            score = 0
            for t in set(terms(text)) & set(c):
                w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[t] + 1)))
                score += w * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(name, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:top], 1)]
    return sorted(out, key=repr)


def corpus(seed, n):
    rnd = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["Älter", "ÉCOLE", "x9", "the", "the", "The"] * 20
    return [(i, rnd.choice([" ", ", ", "\n", "_"]).join(rnd.choices(words, k=int(rnd.paretovariate(1) * 8) % 400))) for i in range(n)]


def found(spark, docs, items, **options):
    d = spark.createDataFrame([(*r, 1, "n", "q") for r in docs], "doc_id long, text string, score int, terms string, query string").repartition(3)
    b = spark.createDataFrame([(*r, 0) for r in items], "item_id long, text string, rank int")
    return sorted((tuple(r) for r in ls.ranked_search(d, b, **options).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


def test_search_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ls, "SHARD", 100)
    monkeypatch.setattr(ls, "BLOCK", 8)
    docs = corpus(1, 500)
    docs += [(600 + k, docs[7][1]) for k in range(30)] + [(900, docs[7][1])] * 5  # ties and repeated rows
    docs += [(None, docs[7][1]), (700, None), (701, ""), (702, " .,;\t"), (703, "w1 the " * 50_000)]
    items = [(k, t[:300]) for k, (_, t) in enumerate(corpus(2, 12))] + [(50, None), (51, ""), (52, "unseen"), (53, docs[7][1]), (53, "THE école"), (None, "w5 w6")]
    want = brute(docs, items, 10)
    assert found(spark, docs, items, top=10) == want
    assert found(spark, docs, items, top=10, query_terms=40) == want  # several passes


def test_empty_tables(spark):
    assert found(spark, [], [(1, "a b")]) == found(spark, [(1, "a b")], []) == found(spark, [(1, None)], [(1, "a")]) == []


def test_bounds_hold_and_blocks_are_skipped():
    rng = np.random.default_rng(3)
    width, rows = 200, []
    for k in range(1500):  # documents of ten kinds
        base = rng.integers(0, width, 5) // 20 * 20 // 10 + (k % 10) * 20
        rows.append(np.unique(np.concatenate([base % width, (k % 10) * 20 + rng.integers(0, 20, 6)])))
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    held = np.concatenate(rows)
    asks = [np.unique(rng.integers(0, width, 12)) for _ in range(40)]
    queries = ls.term_queries([(k, [f"t{t:03}" for t in ask]) for k, ask in enumerate(asks)])
    held = rng.permutation(len(queries.hashes))[held % len(queries.hashes)]
    held = np.concatenate([np.unique(held[a:b]) for a, b in zip(offsets, offsets[1:])])
    offsets = np.concatenate([[0], np.cumsum([len(np.unique(r % len(queries.hashes))) for r in rows])])
    width = len(queries.hashes)
    impacts = rng.integers(1, 1000, len(held))
    shard = ls.Shard(offsets, held, impacts, queries, block=16)
    assert sorted(zip(held.tolist(), np.repeat(np.arange(1500), np.diff(offsets)).tolist())) == sorted(
        (t, int(d)) for t in range(width) for d in shard.members[shard.blocks[shard.lists[t]] : shard.blocks[shard.lists[t + 1]]])
    assert np.diff(shard.blocks).max() <= 16
    dense = np.zeros((1500, width), np.int64)
    dense[np.repeat(np.arange(1500), np.diff(offsets)), held] = impacts
    skipped = 0
    for q, query in enumerate(queries.terms):
        weights = rng.integers(0, 5000, len(query))
        every = dense[:, query] @ weights
        blocks, bound = shard.bounds(q, weights)
        for b, most in zip(blocks, bound):
            assert most >= every[shard.members[shard.blocks[b] : shard.blocks[b + 1]]].max()
        docs, scores, left = shard.best(q, weights, 10, 0)
        skipped += left
        least = np.sort(every)[-10]
        assert dict(zip(docs.tolist(), scores.tolist())) == {int(d): int(every[d]) for d in np.flatnonzero(every >= max(1, least))}
    assert skipped > 500
