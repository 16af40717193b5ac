"""Voters against plain counting, the label model on votes of known origin, and the scores on held-out labels."""

import random
import re
import zlib

import numpy as np
import pyarrow as pa

from tracklake.llm import toxicity as tox

SCHEMA = "doc_id long, text string, lang string, score double, c0 string, label int"
LABELS = "doc_id long, quality int, toxic int"


def corpus(seed, n=600):
    rnd = random.Random(seed)
    words = ["and", "river", "über", "señal", "house", "walks", "green", "token", "lowland", "stone"]
    docs, labels = [], []
    for i in range(n):
        text = rnd.choices(words, k=rnd.randrange(5, 60))
        toxic = i % 7 == 0
        if toxic:
            for _ in range(rnd.randrange(2, 6)):
                text.insert(rnd.randrange(len(text)), rnd.choice(["idiot", "zorb" + rnd.choice(["a", "ing", "ly", "ed", "ment"]), "gräul" + rnd.choice(["t", "en"])]))
        docs.append((i, " ".join(text)))
        labels.append((i, 1, int(toxic)))
    return docs, labels


def scored(spark, docs, labels, **options):
    d = spark.createDataFrame([(*r, "en", 0.5, "c", 9) for r in docs], SCHEMA).repartition(3)
    return [tuple(r) for r in tox.score_toxicity(d, spark.createDataFrame(labels, LABELS), **options).collect()]


def test_held_out_labels_and_odd_rows(spark):
    docs, labels = corpus(1)
    odd = [(None, "idiot zorbed"), (9000, None), (9001, ""), (9002, " \n"), (9003, "river " * 100_000 + "zorbs zorbs gräuls idiot"), (5, docs[5][1])]
    rows = scored(spark, docs + odd, labels + [(None, 1, 1), (7000, 1, 1), (3, 1, None), (8, 1, 0), (8, 1, 0)])
    assert len(rows) == len(docs) + len(odd)
    toxic = {i: t for i, _, t in labels}
    wrong = 0
    for i, held, score, predicted in rows:
        assert 0 <= score <= 1 and predicted == (score >= 0.3)
        assert held == (i is not None and zlib.crc32(str(i).encode()) % 4 == 2)
        if held and i in toxic:
            wrong += predicted != toxic[i]
    assert wrong == 0
    by_id = {r[0]: r for r in rows}
    assert by_id[None][3] == 1  # scored without an id
    assert by_id[9000][2] == by_id[9001][2] == by_id[9002][2] < 0.3
    assert len({r[2] for r in rows if r[0] == 5}) == 1


def test_labels_of_held_out_rows_change_nothing(spark):
    docs, labels = corpus(2, 300)
    turned = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, q, t in labels]
    assert sorted(scored(spark, docs, labels)) == sorted(scored(spark, docs, turned))


def test_no_labels_no_documents_one_class(spark):
    docs, labels = corpus(3, 60)
    assert {(r[2], r[3]) for r in scored(spark, docs, [])} == {(0.0, 0)}
    assert scored(spark, [], labels) == []
    assert all(r[3] == 0 for r in scored(spark, docs, [(i, 1, 0) for i, _ in docs]))
    d = spark.createDataFrame([(*r, "en", 0.5, "c", 9) for r in docs], SCHEMA)
    out = tox.score_toxicity(d, spark.createDataFrame(labels, LABELS), carry=["c0"])
    assert out.columns == ["doc_id", "held_out", "score", "predicted", "c0"] and out.where("c0 = 'c'").count() == 60


def test_found_units_are_those_of_plain_counting(spark):
    docs, labels = corpus(4, 400)
    sample = spark.createDataFrame([(i, t, x) for (i, x), (_, _, t) in zip(docs, labels)], "id long, label int, text string")
    units = tox.mine_units(sample, 5)
    seen = {}
    for (_, text), (_, _, toxic) in zip(docs, labels):
        found = set()
        for w in re.findall(r"\w+", text):
            b = w.encode()
            found |= {("word", b)} | ({("start", b[:4]), ("end", b[-4:])} if len(b) > 4 else set()) | ({("start", b[:5])} if len(b) > 5 else set())
        for u in found:
            seen.setdefault(u, [0, 0])[1 - toxic] += 1
    toxic = sum(t for _, _, t in labels)
    clean = len(labels) - toxic

    def gain(a, b):
        p = (a + b) / len(labels)
        return sum(x * np.log(x / (n * q)) for x, n, q in ((a, toxic, p), (toxic - a, toxic, 1 - p), (b, clean, p), (clean - b, clean, 1 - p)) if x)

    ranked = sorted((-gain(*c) for c in seen.values() if c[0] >= tox.SUPPORT and c[0] / toxic > 4 * c[1] / clean))
    assert len(units) == min(5, sum(g < -8 for g in ranked))
    part = next(tox.chunks(pa.array([t for _, t in docs])))
    counts, _ = tox.unit_counts(part, np.sort(units))
    flags = np.array([t for _, _, t in labels])
    gains = sorted(-gain(int((counts[flags == 1, k] > 0).sum()), int((counts[flags == 0, k] > 0).sum())) for k in range(len(units)))
    assert np.allclose(gains, ranked[: len(gains)])


def test_label_model_finds_accuracies_and_correlations():
    rng = np.random.default_rng(5)
    n = 6000
    truth = rng.random(n) < 0.3
    hit, miss = np.array([0.9, 0.7, 0.6, 0.5, 0.8]), np.array([0.05, 0.1, 0.02, 0.3, 0.1])
    votes = (rng.random((n, 5)) < np.where(truth[:, None], hit, miss)).astype(np.int64)
    copies = np.where(rng.random((n, 3)) < 0.95, votes[:, [3]], rng.random((n, 3)) < 0.4).astype(np.int64)  # repeat the weakest voter
    votes = np.hstack([votes, copies])
    given = np.where(rng.random(n) < 0.9, truth, ~truth)
    model, posterior = tox.fit_label_model(votes, given.astype(float))
    assert abs(model.prior - 0.3) < 0.03
    free = [k for k in range(5) if model.parent[k] < 0]
    assert np.allclose(model.table[free, 1, 0], hit[free], atol=0.05) and np.allclose(model.table[free, 0, 0], miss[free], atol=0.05)
    group = {3, 5, 6, 7}
    assert all(model.parent[k] in group for k in group if model.parent[k] >= 0) and sum(model.parent[k] >= 0 for k in group) == 3
    alone, _ = tox.fit_label_model(votes, given.astype(float), least=9)  # as if voters were independent
    right = ((posterior > 0.5) == truth).mean()
    assert right > 0.93 and right >= ((alone.posterior(votes) > 0.5) == truth).mean()


def test_patterns():
    texts = ["SHOUTING ALL DAY", "so what!!! oh no!!!", "you s***t", "nooooo way", "hi", "1234567 89", "plain words follow here " * 8, ""]
    part = next(tox.chunks(pa.array(texts)))
    got = tox.units_of(part).patterns
    assert [tuple(np.flatnonzero(r)) for r in got] == [(0, 4), (1, 4), (2, 4), (3, 4), (4,), (4, 5), (), (4,)]
