"""Every stage of the pipeline on null ids, repeated rows and ids with several texts, against plain Python."""

from collections import Counter

import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.test_operators import lower, prose, shingles
from tracklake.llm.lsa_quality import counts, fit_quality
from tracklake.llm.mixing import mix_sources
from tracklake.llm.queries import PIECE_MODEL

SCHEMA = "doc_id long, text string, source string"


def rows():
    near = prose(50, 100).split()
    texts = [(i, prose(i, 40)) for i in range(1, 25)]
    texts += [(30, prose(3, 40).upper().replace("W", "w")), (31, " ".join(near)), (32, " ".join([*near[:-1], "other"]))]
    texts += [(40, prose(40, 40))] * 3  # repeated rows
    texts += [(41, prose(41, 40)), (41, prose(2, 40)), (41, "BUY!! " * 80)]  # one id, several texts
    texts += [(None, prose(60, 40)), (None, prose(60, 40)), (None, prose(4, 40)), (None, "BUY!! " * 90), (None, None), (42, None), (43, "")]
    texts += [(100 + i, "BUY!! " * 80 + str(i)) for i in range(20)]
    return [(i, t, [None, "a", "b"][k % 3]) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame(rows(), SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], int("BUY" not in (r[1] or ""))) for r in rows() if r[0] is not None and r[0] != 41]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    return path


def counted(frame):
    return Counter(map(tuple, frame.collect()))


def good(spark, folder, docs):
    """Rows whose text the classifier accepts; a score depends on the text only."""
    model = fit_quality(*(spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels")))
    scores = [s for m in counts(pa.array([r[1] for r in docs], pa.string())) for s in model.score(m, 15)]
    return [r for r, s in zip(docs, scores) if s >= 0.3]


def unique(docs):
    best = {}
    for i, t, _ in docs:
        best[lower(t)] = max((x for x in (best.get(lower(t)), i) if x is not None), default=None)
    return [r for r in docs if r[0] == best[lower(r[1])]]


def apart(docs):
    sets = [(r, shingles(r[1], 5)) for r in docs]
    part = {r[0]: r[0] for r in docs if r[0] is not None}
    of_set = {}
    for r, s in sets:
        if r[0] is not None and s:
            of_set[frozenset(s)] = min(of_set.get(frozenset(s), r[0]), r[0])
    for _ in docs:
        for s, i in of_set.items():
            for z, j in of_set.items():
                if 100 * len(s & z) >= 80 * len(s | z):
                    part[i] = part[j] = min(part[i], part[j])
    return [r for r, s in sets if r[0] is None or not s or r[0] == part[of_set[frozenset(s)]]]


def mixed(spark, docs):
    taken = {(r.doc_id, r.source): r.copies for r in mix_sources(spark.createDataFrame(docs, SCHEMA)).collect()}
    return [r for r in docs for _ in range(taken[r[0], r[2]])]


def encoded(docs):
    from sentencepiece import SentencePieceProcessor

    library = SentencePieceProcessor(model_file=PIECE_MODEL)
    ids = [(r[0], library.encode(r[1] or "")) for r in docs]
    return Counter((i, len(p), tuple(p)) for i, p in ids)


def test_stages(spark, folder):
    stages = dict(corpus_pipeline.STAGES)
    docs, frame = rows(), spark.read.parquet(f"{folder}/documents.parquet")
    steps = {"quality": lambda d: good(spark, folder, d), "exact_dedup": unique, "near_dedup": apart, "mix": lambda d: mixed(spark, d)}
    for name, plain in steps.items():
        got = stages[name](spark, frame, folder)
        assert got.columns == frame.columns
        assert counted(got) == Counter(plain(docs)), name
    kept = [r for r in docs if r[0] is None]
    assert kept and all(r in apart(docs) for r in kept)
    assert any(n > 1 for n in Counter(mixed(spark, docs)).values())


def test_run(spark, folder):
    want = encoded(mixed(spark, apart(unique(good(spark, folder, rows())))))
    got = Counter((r.doc_id, r.n_pieces, tuple(r.ids)) for r in corpus_pipeline.run(spark, folder).collect())
    assert got == want and any(i is None for i, _, _ in want) and max(want.values()) > 1
