"""Operators for training data against brute force, on small tables with nulls, empty texts, ties and extra columns."""

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tracklake.llm.grace_dedup import exact_dedup, grace
from tracklake.llm.lsa_quality import fit_quality, score_quality
from tracklake.llm.mixing import mix_sources
from tracklake.llm.pieces import _WORD, SPACE, Seams, decode_ids, decode_pieces, decode_table, encode_pieces, fold_word, load_vocabulary, words_of
from tracklake.llm.queries import PIECE_MODEL, URL_RULES
from tracklake.llm.secrets import scan_secrets
from tracklake.llm.set_join import jaccard_components, set_links
from tracklake.llm.suffix_dedup import remove_repeats
from tracklake.llm.surrogates import replace_personal_data
from tracklake.llm.tile_join import vector_links
from tracklake.llm.url_templates import filter_urls

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, source string, id long, n long, low string, kept string"


def prose(seed, n):
    rng = np.random.default_rng(seed)
    return " ".join(f"w{k}" for k in rng.integers(0, 4000, n))


@pytest.fixture(scope="module")
def docs(spark):
    """Copies, near copies, a shared passage, nulls, empty texts, a repeated row and columns with clashing names."""
    base, passage = prose(1, 200), prose(2, 70)
    texts = [base, base.upper(), base.replace("w1 ", "X "), None, "", " \t\n", "one two", "one two", prose(3, 120),
             f"{prose(4, 30)} {passage} {prose(5, 10)}", f"{passage} {prose(6, 60)}", prose(7, 3000), passage]
    near = prose(8, 300).split()
    for k in range(6):
        copy = list(near)
        copy[10 * k] = f"changed{k}"
        texts.append(" ".join(copy))
    rows = [(i, t, [None, "a", "b", "c"][i % 4], 7, 8, "low", "k") for i, t in enumerate(texts)]
    return spark.createDataFrame([*rows, (None, "no id", "a", 7, 8, "low", "k")], SCHEMA).repartition(3)


def lower(text):
    return (text or "").encode().lower()


def test_exact_dedup(docs):
    rows = docs.select("doc_id", "text").collect()
    groups = defaultdict(list)
    for r in rows:
        groups[lower(r.text)].append(r.doc_id)
    want = set()
    for r in rows:
        ids = groups[lower(r.text)]
        keep = max((i for i in ids if i is not None), default=None)
        want.add((r.doc_id, keep, len(ids), r.doc_id == keep, hashlib.sha256(lower(r.text)).hexdigest()))
    assert {tuple(r) for r in exact_dedup(docs).collect()} == want
    assert {tuple(r) for r in exact_dedup(docs, limit=500).collect()} == want
    assert exact_dedup(docs.limit(0)).count() == 0


def test_grace_spills(tmp_path):
    records = [(b"%d" % (i % 500) * 50, i, 1) for i in range(2000)]
    made = []

    def folder():
        made.append(tmp_path / str(len(made)))
        made[-1].mkdir()
        return made[-1]

    got = {c: (k, n) for c, k, n in grace(iter(records), folder, 5000)}
    assert len(made) > 10 and not any(p.exists() for p in made)
    assert len(got) == 500 and all(n == 4 and k >= 1500 for k, n in got.values())


def shingles(text, size):
    w = WORD.findall(lower(text).decode())
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if len(w) >= size else ({tuple(w)} if w else set())


@pytest.mark.parametrize(("size", "percent", "options"), [(4, 85, {}), (5, 80, {"short_list": 2, "tile_block": 2}), (4, 85, {"share": 0.3})])
def test_jaccard(docs, size, percent, options):
    rows = docs.select("doc_id", "text").collect()
    sets = {r.doc_id: shingles(r.text, size) for r in rows}
    ids = [i for i in sets if i is not None]
    part = {i: i for i in ids}
    for _ in ids:
        for a in ids:
            for b in ids:
                both = len(sets[a] & sets[b])
                if both and 100 * both >= percent * len(sets[a] | sets[b]):
                    part[a] = part[b] = min(part[a], part[b])
    want = {(i, len(sets[i]), part.get(i)) for i in sets}
    assert {tuple(r) for r in jaccard_components(docs, size=size, percent=percent, **options).collect()} == want
    assert jaccard_components(docs.limit(0)).count() == 0


@pytest.mark.parametrize(("short_list", "tile_block"), [(64, 512), (3, 7)])
def test_jaccard_clusters(spark, short_list, tile_block):
    """Near copies of a few texts, so that most shingles are common, among others that share only a phrase; repeated rows."""
    rng = np.random.default_rng(5)
    phrase = " ".join(f"p{k}" for k in range(30))
    texts = []
    for base in range(4):
        words = np.array([f"b{base}w{k}" for k in range(40 + 25 * base)], object)
        for _ in range(25):
            now = words.copy()
            now[rng.integers(0, len(now), int(rng.integers(0, 3)))] = "x%d" % rng.integers(0, 1000)
            texts.append(" ".join(now[: len(now) - int(rng.integers(0, 4))]))
    texts += [phrase + " " + " ".join(f"u{i}v{k}" for k in range(int(rng.integers(0, 9)))) for i in range(40)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(0, texts[0])] * 2
    sets = {i: shingles(t, 4) for i, t in enumerate(texts)}
    part = {i: i for i in sets}
    for _ in range(6):
        for a in sets:
            for b in sets:
                if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    part[a] = part[b] = min(part[a], part[b])
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = jaccard_components(frame, short_list=short_list, tile_block=tile_block, share=0.02).collect()
    assert {tuple(r) for r in got} == {(i, len(sets[i]), part[i]) for i in sets} and len(got) == len(rows)
    assert len(set(part.values())) < len(part) / 2


def test_prefixes_start_with_rare_shingles(spark):
    """A phrase of 40 documents, too few to be common, comes after what only one document has."""
    from tracklake.llm import set_join as sj

    phrase = " ".join(f"p{k}" for k in range(30))
    rows = [(i, " ".join(f"w{i}_{k}" for k in range(30)) + " " + phrase) for i in range(40)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    known = sj.shingle_frequencies(frame, 4, 2.0)
    assert not len(known[0]) and known[2].max() >= 64 * np.log2(41) - 1
    sets = [found for _, found in sj.shingle_sets(pa.array([t for _, t in rows]), 4)]
    shared = np.intersect1d(sets[0], sets[1])
    for found in sets:
        first = sj.in_order(found, known)
        assert len(shared) == 27 and sorted(first) == found.tolist()
        assert not np.isin(first[:20], shared).any()


def test_lists_of_the_same_sets_are_put_together(spark):
    from tracklake.llm.set_join import bundled

    members = {1: range(10, 20), 2: range(11, 20), 3: range(10, 19), 7: [30, 31, 32], 8: [32, 33, 34]}
    rows = [(t, r, len(reps)) for t, reps in members.items() for r in reps]
    got = bundled(spark.createDataFrame(rows, "token long, rep long, n long"), 4).collect()
    lists = {}
    for r in got:
        lists.setdefault(r["list"], set()).add(r["rep"])
    assert sorted(map(sorted, lists.values())) == [list(range(10, 20)), [30, 31, 32], [32, 33, 34]]
    assert all(r["n"] == len(lists[r["list"]]) for r in got) and len(got) == 16


def test_derived_answers_equal_direct_ones():
    rng = np.random.default_rng(0)
    base = np.unique(rng.integers(0, 1 << 60, 100).astype(np.uint64))
    sets = [np.unique(np.r_[base[rng.random(len(base)) > 0.06], rng.integers(0, 1 << 60, 4).astype(np.uint64)]) for _ in range(30)]
    got = {(i, j) for i, js in set_links(sets, 85) for j in js.tolist()}
    want = {(i, j) for i in range(30) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))}
    assert got == want and want


@pytest.mark.parametrize("options", [{}, {"group": 0}])
def test_substrings(docs, options):
    window = 50
    rows = {r.doc_id: WORD.findall(r.text or "") for r in docs.select("doc_id", "text").collect()}
    first = {}
    for i in sorted(k for k in rows if k is not None):
        for p in range(len(rows[i]) - window + 1):
            first.setdefault(tuple(rows[i][p : p + window]), i)
    want = set()
    for i, w in rows.items():
        gone = set()
        for p in range(len(w) - window + 1):
            if i is not None and first[tuple(w[p : p + window])] < i:
                gone.update(range(p, p + window))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want.add((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert any(r[2] for r in want)
    assert {tuple(r) for r in remove_repeats(docs, **options).collect()} == want
    assert remove_repeats(docs.limit(0)).count() == 0


def test_vectors(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 16))
    x[20:40] = x[0] + rng.normal(size=(20, 16)) * 0.1
    rows = [(i, [float(v) for v in r], "l", 1) for i, r in enumerate(x)]
    rows += [(100, rows[0][1], "l", 1), (101, None, "l", 1), (102, [0.0] * 16, "l", 1), (103, [float("nan")] * 16, "l", 1), (104, [1.0, None], "l", 1)]
    vectors = spark.createDataFrame([*rows, (None, rows[0][1], "l", 1)], "vec_id long, embedding array<double>, label string, rep long")
    good = {r[0]: np.array(r[1]) / np.linalg.norm(r[1]) for r in rows if r[0] < 101}
    part, degree = {i: i for i in good}, dict.fromkeys(good, 0)
    for a in good:
        degree[a] = sum(a != b and float(good[a] @ good[b]) >= 0.95 for b in good)
    for _ in good:
        for a in good:
            for b in good:
                if float(good[a] @ good[b]) >= 0.95:
                    part[a] = part[b] = min(part[a], part[b])
    want = {(i, degree[i], part[i], part[i] == i) for i in good} | {(i, 0, i, True) for i in range(101, 105)} | {(None, 0, None, False)}
    for block in (4096, 7):
        assert {tuple(r) for r in vector_links(vectors, block=block).collect()} == want
    assert vector_links(vectors.limit(0)).count() == 0


def test_mix(docs):
    rows = mix_sources(docs).collect()
    assert len(rows) == docs.count() and {r.source for r in rows} == {None, "a", "b", "c"}
    total = sum(r["size"] for r in rows)
    targets = {r.source: r.target for r in rows}
    assert sum(targets.values()) == pytest.approx(1.5 * total)
    assert all(r.target <= 2 * r.source_size + 1e-9 and r.taken <= 2 * r["size"] for r in rows)
    for s, target in targets.items():
        own = [r for r in rows if r.source == s]
        assert abs(sum(r.taken for r in own) - target) <= max(r["size"] for r in own)
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, mix_sources(docs).collect()), key=repr)
    assert mix_sources(docs.limit(0)).count() == 0


def test_secrets(spark):
    key = "Zx9" + "Qw7Rt2Lp" * 4
    text = f"é password: 'hunter2x' API_KEY=abc token=token=abcdef AKIA{'A1' * 8} {'0af' * 9} {key} plain words"
    rows = spark.createDataFrame([(1, text, 5), (2, None, 5), (3, "", 5), (None, "ok", 5)], "doc_id long, text string, n_hex long")
    got = {r.doc_id: r for r in scan_secrets(rows).collect()}
    spans = [s.split(":") for s in got[1].spans.split(",")]
    assert [(k, text[int(a) : int(b)]) for k, a, b in spans] == [
        ("assign", "password: 'hunter2x"), ("assign", "token=token=abcdef"), ("access", "AKIA" + "A1" * 8), ("hex", "0af" * 9), ("token", key)]
    assert got[1].base_sha256 == hashlib.sha256(",".join(":".join(s) for s in spans[:4]).encode()).hexdigest()
    assert all(got[k].spans == "" and got[k].base_sha256 == hashlib.sha256(b"").hexdigest() for k in (2, 3, None))


def test_urls(spark):
    urls = ["https://A.example.org/es/7?x", "http://example.org/en/12", "http://x.org/en/1", "https://b.com/fr/1", "c.com/de/1",
            "https://b.com/de/3#y", "http://d.net/de/9", "http://d.net/fr/9", None, "://", "http://e.org"]
    pages = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate(urls * 3)], "page_id long, url string, host string, verdict string")
    got = {r.page_id: r for r in filter_urls(pages, URL_RULES).collect()}
    assert [(got[i].host, got[i].path, got[i].rule) for i in range(11)] == [
        ("a.example.org", "/es/7", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"), ("x.org", "/en/1", "org/"),
        ("b.com", "/fr/1", "com/fr/"), ("", "", None), ("b.com", "/de/3", "com/de/"), ("d.net", "/de/9", None), ("d.net", "/fr/9", None),
        ("", "", None), ("", "", None), ("e.org", "", None)]
    assert [got[i].verdict for i in (0, 1, 2, 3, 5)] == ["block", "block", "allow", "allow", "block"]
    assert len(got) == 33 and all(r.verdict in ("allow", "block") for r in got.values())
    assert filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_quality(spark):
    good = [(i, prose(i, 150)) for i in range(60)]
    junk = [(100 + i, "BUY!! " * 80 + str(i)) for i in range(40)]
    rows = spark.createDataFrame([*good, *junk, (200, None), (201, ""), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 100), None) for i, _ in good + junk] + [(5, None, 1), (None, 1, 1)], "doc_id long, quality int, score int")
    got = {r.doc_id: r for r in score_quality(rows, labels).collect()}
    assert len(got) == 103 and all(0 <= r.score <= 1 for r in got.values())
    held = [r for r in got.values() if r.held_out and r.doc_id < 200]
    assert held and all(r.predicted == int(r.doc_id < 100) for r in held)
    assert score_quality(rows, labels.limit(0)).where("score = 0.5").count() == 103


def test_surrogates(spark):
    text = "Mail Bo.Li1@x.example.com, BO.LI1@X.example.com; +1 (366) 555-9807 or +1-366-555-9807. Frau Müller 10.2.3.4 4387 5130 3523 7269"
    rows = spark.createDataFrame([(1, text, "k"), (2, None, "k"), (3, "", "k"), (None, "bo.li1@x.example.com", "k"), (1, text, "k")], "doc_id long, text string, kind string")
    got = replace_personal_data(rows, "key").collect()
    ours = [r for r in got if r.doc_id == 1]
    assert len(got) == 5 and ours[0] == ours[1] and ours[0].n_entities == 7
    new = ours[0].text
    assert not any(x in new for x in ("Bo.Li1", "555-9807", "Müller", "10.2.3.4", "4387 5130"))
    mails = re.findall(r"\S+@[\w.]+", new)
    assert mails[0].lower().rstrip(".,;") == mails[1].lower().rstrip(".,;") == next(r.text for r in got if r.doc_id is None)
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4} or \+1-\d{3}-\d{3}-\d{4}\. Frau \p{L}".replace(r"\p{L}", r"\w"), new)
    card = [int(c) for c in re.search(r"(?:\d{4} ){3}\d{4}", new)[0] if c != " "]
    assert sum(d if k % 2 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(card)) % 10 == 0


def test_pieces(spark):
    from sentencepiece import SentencePieceProcessor

    vocabulary, library = load_vocabulary(PIECE_MODEL), SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = ["Hello  world", "  a\nb\t c ", "", None, " ", "élan 漢字 　x 😀", "x" * 200, "thingheron of whst, (the)"]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    for r in decode_pieces(encode_pieces(rows, vocabulary, chunk_chars=40), vocabulary).collect():
        assert r.ids == library.encode(texts[r.doc_id] or "") and r.decoded == (texts[r.doc_id] or "")
    assert fold_word("▁thinghe", vocabulary) == library.encode("thinghe")
    assert encode_pieces(rows.limit(0), vocabulary).count() == 0


def test_pieces_of_repeated_and_long_rows(spark):
    """Rows without an id, repeated rows, a long text, columns with clashing names; blocks of one text and of many."""
    from sentencepiece import SentencePieceProcessor

    vocabulary, library = load_vocabulary(PIECE_MODEL), SentencePieceProcessor(model_file=PIECE_MODEL)
    long = prose(95, 60_000) + "y" * 3000
    rows = [(1, "same text"), (1, "same text"), (None, "same text"), (None, None), (None, ""), (2, long), (3, "of, the\n\nend "), (1, "other")]
    df = spark.createDataFrame([(*r, 7, 8, b"b", [1]) for r in rows], "doc_id long, text string, block long, bucket int, blob binary, ids array<int>")
    want = Counter((i, tuple(library.encode(t or ""))) for i, t in rows)
    for chars in (10_000, 10**9):
        got = encode_pieces(df.repartition(2), vocabulary, chunk_chars=chars).collect()
        assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    assert decode_ids([library.piece_to_id("▁the"), -1, 10**7], decode_table(vocabulary)) == "the"


def test_pieces_move_no_texts(spark):
    """Blocks of texts are read where they lie: only words and answers are exchanged."""
    rows = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    plan = encode_pieces(rows, load_vocabulary(PIECE_MODEL))._jdf.queryExecution().executedPlan().toString()
    assert "doc_ids" in plan and not re.search(r"Exchange hashpartitioning\(block[^\n]*\n[^\n]*doc_ids", plan)
    assert plan.count("Exchange hashpartitioning(block") == 1


def test_pieces_shuffle_words_once(spark):
    vocabulary = load_vocabulary(PIECE_MODEL)
    encoded = encode_pieces(spark.createDataFrame([(1, "one two"), (2, None), (3, "two three")], "doc_id long, text string"), vocabulary)
    assert len(encoded.collect()) == 3
    assert "ReusedExchange" in encoded._jdf.queryExecution().executedPlan().toString()


def test_decoded_pieces_equal_plain_ones():
    from tracklake.llm import pieces

    table = decode_table(load_vocabulary(PIECE_MODEL))
    as_bytes = [b"" if p is None else bytes([p]) if isinstance(p, int) else p.encode() for p in table] + [b""]
    rng = np.random.default_rng(3)
    rows = [None if i % 7 == 0 else rng.integers(-3, 300 if i % 2 else len(table) + 3, int(rng.integers(0, 40))).tolist() for i in range(50)]
    got = list(pieces.decoded(pa.array([[1], *rows], pa.list_(pa.int32())).slice(1), as_bytes))
    assert got == [None if row is None else decode_ids(row, table) for row in rows]


def test_words_and_parts():
    vocabulary = load_vocabulary(PIECE_MODEL)
    texts = ["a\nb", "\na", "a\n\n b\n", "a  b", " a", "a ", "\0a\n", "\r\n x", "no. 12345 漢字x", "\n", " "]
    for text in texts:
        assert words_of(text) == _WORD.findall(SPACE + text.replace(" ", SPACE))
    words = [w for t in texts for w in words_of(t)]
    parts = Seams(vocabulary).split(words)
    assert ["".join(p) for p in parts] == words and any(len(p) > 1 for p in parts)
    assert all([i for p in ps for i in fold_word(p, vocabulary)] == fold_word(w, vocabulary) for w, ps in zip(words, parts))
    assert Seams(vocabulary).split([]) == []


def test_surrogates_of_many_short_entities(spark):
    """More single names, and more short addresses and numbers, than there are surrogates of their first lengths."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    names = [f"Mr {a.upper()}{b}{c}x" for a in letters for b in letters for c in letters[:8]]
    mails = [f"{a}@{b}.de" for a in letters for b in letters]
    phones = [f"+1 {k:04d}" for k in range(1000, 10000)]
    rows = [(k, "; ".join(part)) for every in (names, mails, phones) for k, part in enumerate(every[i : i + 100] for i in range(0, len(every), 100))]
    want = Counter(t.count(";") + 1 for _, t in rows)
    got = replace_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()
    assert Counter(r.n_entities for r in got) == want
    new = [w for r in got for w in r.text.split("; ")]
    assert len(new) == len(set(new)) == len(names) + len(mails) + len(phones) and len(names) > 5000
    assert not set(new) & {*names, *mails, *phones}


def test_substrings_of_one_id_with_several_texts(spark):
    """Places found in one row of an id do not reach into the next document."""
    shared, clean = prose(90, 80), prose(91, 100)
    rows = [(1, shared), (2, f"{prose(92, 30)} {shared}"), (2, prose(93, 20)), (3, clean), (2, None), (4, clean + " end"), (2, "")]
    got = remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), with_text=True).collect()
    kept = Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got)
    assert kept == Counter([(1, 80, 0, shared), (2, 110, 80, prose(92, 30)), (2, 20, 0, prose(93, 20)), (3, 100, 0, clean), (2, 0, 0, ""), (2, 0, 0, ""), (4, 101, 100, "end")])
    # As last rows of their chunk.
    last = spark.createDataFrame([(1, shared), (2, shared), (2, "short"), (2, None)], "doc_id long, text string").coalesce(1)
    assert Counter((r.n_words, r.n_removed) for r in remove_repeats(last).collect()) == Counter([(80, 0), (80, 80), (1, 1), (0, 0)])


def url_templates(shapes, share=0.02, least=5):
    """Templates of one host's shapes with counts, level by level to the last segment."""
    now = {s: "" for s in shapes}
    for level in range(max(s.count("/") + 1 for s in shapes)):
        value = {s: s.split("/")[level] for s in shapes if s.count("/") >= level}
        below = Counter()
        for s, v in value.items():
            below[now[s], v] += shapes[s]
            below[now[s], None] += shapes[s]
        now |= {s: now[s] + ("/" + v if below[now[s], v] >= max(least, share * below[now[s], None]) else "/*") for s, v in value.items()}
    return now


def test_deep_urls(spark):
    """Segments after the fourth keep branches apart."""
    paths = [f"a/b/c/d/{kind}/page" for kind in ("good", "bad") for _ in range(20)] + ["a/b/c/d/good/other/x/y"] * 6 + ["a/b/c/d/bad/one/z"] * 2
    paths += [f"q/{c}/r/s/t/u" for c in "abcdef"] * 2 + ["q/a/r/s/t/u/v/w/x"] * 7 + ["lone/1/2/3/4/5".replace("1", "x")] * 3 + ["p"] * 9
    rows = [(k, f"http://h.org/{p}") for k, p in enumerate(paths)] + [(1000, "http://k.org/only/one/two/three/four/five")]
    rules = [("allow", "h.org/a/b/c/d/good/page"), ("block", "h.org/a/b/c/d/bad/page")]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    digits = lambda p: re.sub("[0-9]+", "<n>", p)
    want = url_templates(Counter(map(digits, paths)))
    assert {r.page_id: r.template for r in got} == {k: want[digits(p)] for k, p in enumerate(paths)} | {1000: "/*" * 6}
    purity = {p: {r.purity for r in got if r.path == f"/a/b/c/d/{p}/page"} for p in ("good", "bad")}
    assert min(purity["good"]) > 0.7 and max(purity["bad"]) < 0.3


def test_quality_takes_one_row_of_an_id(spark):
    rows = [(i, prose(i, 40)) for i in range(30)] + [(7, prose(100 + k, 40)) for k in range(40)] + [(8, None)] * 5
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id long, quality int")
    model = fit_quality(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), labels, training_rows=20)
    every = fit_quality(spark.createDataFrame(rows, "doc_id long, text string"), labels)
    assert len(model.labels) == 20 and 20 < len(every.labels) < 30 and (abs(every.vectors).sum(axis=1) > 0).all()


def test_secrets_of_letters_only(spark):
    """Random keys of one case or of letters and separators are found, names made of words are not."""
    keys = ["xqzvkjwpfhbtrmcg", "XKQZJVWPYHBFTRMC", "AbQdXyQzKwVrTpLmNs==", "qJxZvKpW/LmRtBzQhYdNc", "wqkz-xvbn-jpfh-zqtr"]
    names = ["internationalization", "INTERNATIONALIZATION", "getResponseHeaderValue", "some_long_variable_name", "path/to/some/folder", "a/b/c/d/e/f/g/h/i/j"]
    got = scan_secrets(spark.createDataFrame([(1, " ".join(keys)), (2, " ".join(names))], "doc_id long, text string")).collect()
    spans = {r.doc_id: [s.split(":") for s in r.spans.split(",") if s] for r in got}
    assert [" ".join(keys)[int(a) : int(b)] for _, a, b in spans[1]] == keys and not spans[2]


def test_plain_phone_numbers(spark):
    """Numbers without country code and brackets; dates, amounts, cards and other numbers keep their kind or their text."""
    phones = ["366-555-9807", "366.555.9807", "366 555 9807", "0171 5559807", "0171/5559807", "030-12345678", "01 23 45 67 89", "089 12 34 56 78"]
    others = ["01.02.2024", "2024-01-02", "3.366.555.98071", "12 345 678", "366-5559-807", "1,366 555 9807"]
    rows = [(1, "; ".join(phones)), (2, "; ".join(others)), (3, "10.2.3.4; 123-45-6789; 4387 5130 3523 7269; 0387 5130 3523 7269"), (4, "Call 366-555-9807.")]
    got = {r.doc_id: r for r in replace_personal_data(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    shape = lambda t: re.sub("[0-9]", "9", t)
    assert got[1].n_entities == len(phones) and not set(got[1].text.split("; ")) & set(phones) and shape(got[1].text) == shape(rows[0][1])
    assert (got[2].text, got[2].n_entities, got[3].n_entities) == (rows[1][1], 0, 4)
    assert got[4].text == f"Call {got[1].text.split('; ')[0]}."
    assert [len(re.sub(r"\D", "", x)) for x in got[3].text.split("; ")[1:]] == [9, 16, 16]


def test_url_templates_and_purities(spark):
    """Templates and purities of several hosts by plain Python."""
    rng = np.random.default_rng(5)
    names = ["news", "item", "tag", "x9", "abcdef0123"]
    rows = [(k, f"http://h{rng.integers(4)}.org/" + "/".join(names[j] for j in rng.integers(0, 5, rng.integers(1, 6)))) for k in range(600)]
    rules = [("allow", "h0.org/news"), ("block", "h0.org/tag"), ("block", "h1.org/item/news"), ("allow", "h1.org/x"), ("allow", "h2.org/news/tag")]
    got = filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    paths, labels = defaultdict(Counter), defaultdict(Counter)
    for _, url in rows:
        host, path = url[7:].split("/", 1)
        paths[host][path.replace("x9", "x<n>").replace("abcdef0123", "<h>")] += 1
        fits = [(len(r), v) for v, r in rules if f"{host}/{path}".startswith(r)]
        labels[host, path.replace("x9", "x<n>").replace("abcdef0123", "<h>")][max(fits)[1] if fits else None] += 1
    template = {(h, p): t for h, c in paths.items() for p, t in url_templates(c).items()}
    leaf, branch, pooled, by_name = (defaultdict(lambda: np.zeros(2)) for _ in range(4))
    for (h, p), seen in labels.items():
        t = template[h, p]
        for into, key in ((leaf, (h, t)), (branch, (h, t.split("/")[1])), (by_name, t)):
            into[key] += (seen["allow"], seen["block"])
    base = (sum(v[0] for v in leaf.values()) + 1) / (sum(v.sum() for v in leaf.values()) + 2)
    merged = {}
    for (h, t), (a, b) in leaf.items():
        top = branch[h, t.split("/")[1]]
        share, n = (top[0] + 1) / (top.sum() + 2), a + b
        own = n > 0 and abs(a / n - share) >= 2 * (share * (1 - share) / n) ** 0.5
        merged[h, t] = (h, t.split("/")[1], t if own else "*")
        pooled[merged[h, t]] += (a, b)
    assert len({r.template for r in got}) > 50 and len(got) == len(rows)
    for r in got:
        shape = r.path[1:].replace("x9", "x<n>").replace("abcdef0123", "<h>")
        t = template[r.host, shape]
        prior = (by_name[t][0] + 5 * base) / (by_name[t].sum() + 5)
        a, b = pooled[merged[r.host, t]]
        assert r.template == t and r.purity == pytest.approx((a + 5 * prior) / (a + b + 5))
        assert r.rule is not None or r.verdict == ("allow" if r.purity >= 0.5 else "block")
