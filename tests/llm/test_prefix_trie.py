"""The prefix trie against brute force over sets of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from tracklake.llm import prefix_trie as pt

SCHEMA = "conv_id long, turn long, role string, text string, key string, part int, node string, n long"


def brute(rows, family=5):
    """Nodes by listing every prefix of every rebuilt conversation."""
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            name = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16] + len(text.encode()).to_bytes(4, "big")
            convs[conv].append(((turn is not None, turn or 0), name, (role, text)))
    turns = {c: [t for _, _, t in sorted(v)] for c, v in convs.items()}
    built = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(turns.get(c - c % family, [])[:h] + own[h:])
    members, ends, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c in sorted(built):
        seq = built[c]
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            if d:
                kids[seq[: d - 1]].add(seq[:d])
        ends[seq].append(c)
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not kids[p]
            saved[p[:d]] += (len(m) - 1) * len(p[-1][1].encode()) if p else 0
    return sorted(
        (m[0], len(p), members[p[:-1]][0] if p else None, len(m), len(kids[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest()) for p, m in members.items())


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(spark, rows, **options):
    df = spark.createDataFrame([(*r, "key", 1, "node", 2) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r[c] for c in COLUMNS) for r in pt.prefix_trie(df, **options).collect())


def sample(seed, n=60):
    rnd = random.Random(seed)
    rows = []
    for c in rnd.sample(range(-20, 200), n):
        for t in range(rnd.choice([1, 2, 3, 9, 12, 30])):
            rows.append((c, t, rnd.choice(["user", "assistant", None]), rnd.choice(["a", "b", "é", "", None])))
    return rows


@pytest.mark.parametrize("range_bytes", [1 << 20, 60])
def test_trie_equals_brute_force(spark, range_bytes):
    rows = sample(1)
    rows += [(300, None, "user", "x"), (300, None, None, None), (300, 0, "user", "y"), (300, 0, "user", "y"), (None, 0, "user", "lost")]
    rows += [(301 + k, t, "user", f"same {t}") for k in range(40) for t in range(12)]  # a large group of copies
    rows += [(400, t, "user", "long " * 20_000) for t in range(10)] + [(405, t, "user", "deep") for t in range(700)]
    assert trie(spark, rows, range_bytes=range_bytes) == brute(rows)


def test_large_groups_go_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(pt, "CHUNK", 3)
    rows = sample(2, 30) + [(1000 + k, t, "user", "s") for k in range(50) for t in range(2)]
    assert trie(spark, rows, range_bytes=300) == brute(rows)


def test_empty_and_turnless(spark):
    assert trie(spark, []) == []
    # 12345's opening is absent, and its own turns are fewer than it skips.
    lone = next(c for c in range(1, 999) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(lone, 0, "user", "gone"), (lone, 1, "user", "gone")]
    assert trie(spark, rows) == brute(rows) == [(lone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(lone).encode()).hexdigest())]


def test_node_layouts_grow():
    tree = pt.RadixTree()
    rnd = random.Random(3)
    keys = {bytes([rnd.randrange(256) for _ in range(rnd.choice([2, 4, 6]))]) for _ in range(5000)} | {b"", b"\0\0" * 40}
    for k in keys:
        tree.insert(k, k)
    rooms, seen, stack = set(), set(), [(tree.root, b"")]
    while stack:
        node, above = stack.pop()
        here = above + node.path
        rooms.add(node.room)
        edges = list(node.edges())
        assert [b for b, _ in edges] == sorted(b for b, _ in edges) and node.room >= len(edges)
        assert all(node.get(b) is kid for b, kid in edges)
        assert node.value is not None or len(edges) > 1 or node is tree.root  # paths are compressed
        if node.value is not None:
            assert node.value == here
            seen.add(here)
        stack += [(kid, here + bytes([b])) for b, kid in edges]
    assert seen == keys and rooms == {4, 16, 48, 256}


def test_ranges_add_up():
    """Trees of two ranges, joined at the border, give the tree of the whole."""
    ids = [bytes([k]) * 16 + (k + 1).to_bytes(4, "big") for k in range(4)]
    rnd = random.Random(5)
    keys = sorted({b"".join(rnd.choices(ids, k=rnd.randrange(6))) for _ in range(120)})
    entries = [(k, i % 3 + 1, i, str(i)) for i, k in enumerate(keys)]
    want = {(r[2], r[3]): r[5:9] for r in pt.trie_rows(entries)}
    for cut in range(1, len(keys)):
        depth = pt.shared_bytes(keys[cut - 1], keys[cut]) // pt.WIDTH
        rows = pt.trie_rows(entries[:cut], -1, depth) + pt.trie_rows(entries[cut:], depth, -1)
        got = {(r[2], r[3]): r[5:9] for r in rows if r[0] is None}
        for name in {r[0] for r in rows if r[0]}:
            same = [r for r in rows if r[0] == name]
            got[min(r[2] for r in same), same[0][3]] = [sum(r[i] for r in same) for i in range(5, 9)]
        assert got == want
