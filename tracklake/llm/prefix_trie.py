"""Conversation prefix trie: adaptive radix trees over fixed-width turn ids, one tree per range of sorted conversations.

A turn's id has 20 bytes: 16 of a digest of its role and text, then the byte length of the text, big-endian. A
conversation is the row of its turns' ids, so a prefix of turns is a prefix of bytes. Conversations are sorted and cut
into ranges of bounded size; a task builds one radix tree for each of its ranges and reads off the nodes at turn-aligned
depths. Only prefixes that reach over a range's border are in several trees. Every figure of a node is a sum (or least
value) over trees, because a tree counts a node's text and its place among its parent's children only if the
node starts in its range. So the few nodes at borders are added up in the end and nothing else is shuffled again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklake.llm.common import groups_of
from tracklake.session import stage

DIGEST = 16
WIDTH = DIGEST + 4
FAMILY = 5  # conversations that share the opening of the first of them
RANGE_BYTES = 8 << 20  # ids of the conversations of one tree
CHUNK = 4096  # members whose ids are written together
BROADCAST_ROWS = 100_000
EMPTY = hashlib.sha256(b"").hexdigest()


class Node:
    """A radix tree node: a compressed path, what ends here, and children in a layout that grows 4, 16, 48, 256.

    The two small layouts keep sorted key bytes beside the children; the third keeps a place per byte; the
    fourth has a child per byte.
    """

    __slots__ = ("path", "value", "room", "keys", "kids")

    def __init__(self, path: bytes, value=None):
        self.path, self.value = path, value
        self.clear()

    def clear(self) -> None:
        self.room, self.keys, self.kids = 4, bytearray(), []

    def get(self, byte: int) -> Node | None:
        if self.room == 256:
            return self.kids[byte]
        if self.room == 48:
            at = self.keys[byte]
            return self.kids[at - 1] if at else None
        at = self.keys.find(byte)
        return self.kids[at] if at >= 0 else None

    def add(self, byte: int, kid: Node) -> None:
        if self.room < 256 and len(self.kids) == self.room:
            self.grow()
        if self.room == 256:
            self.kids[byte] = kid
        elif self.room == 48:
            self.kids.append(kid)
            self.keys[byte] = len(self.kids)
        else:
            at = next((i for i, k in enumerate(self.keys) if k > byte), len(self.keys))
            self.keys.insert(at, byte)
            self.kids.insert(at, kid)

    def grow(self) -> None:
        if self.room == 4:
            self.room = 16
        elif self.room == 16:
            places = bytearray(256)
            for i, byte in enumerate(self.keys):
                places[byte] = i + 1
            self.room, self.keys = 48, places
        else:
            self.kids = [self.kids[at - 1] if at else None for at in self.keys]
            self.room, self.keys = 256, bytearray()

    def edges(self) -> Iterator[tuple[int, Node]]:
        if self.room == 256:
            yield from ((b, kid) for b, kid in enumerate(self.kids) if kid is not None)
        elif self.room == 48:
            yield from ((b, self.kids[at - 1]) for b, at in enumerate(self.keys) if at)
        else:
            yield from zip(self.keys, self.kids)


def shared_bytes(a: bytes, b: bytes) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class RadixTree:
    def __init__(self):
        self.root: Node | None = None

    def insert(self, key: bytes, value) -> None:
        """Keys come once each; `value` is what ends at the key and is not None."""
        if self.root is None:
            self.root = Node(key, value)
            return
        node, at = self.root, 0
        while True:
            path = node.path
            n = len(path) if key.startswith(path, at) else shared_bytes(path, key[at : at + len(path)])
            if n < len(path):
                lower = Node(path[n + 1 :], node.value)
                lower.room, lower.keys, lower.kids = node.room, node.keys, node.kids
                node.path, node.value = path[:n], None
                node.clear()
                node.add(path[n], lower)
            at += n
            if at == len(key):
                node.value = value
                return
            kid = node.get(key[at])
            if kid is None:
                node.add(key[at], Node(key[at + 1 :], value))
                return
            node, at = kid, at + 1


def _prefix_digests(key: bytes, depth: int) -> list[bytes]:
    """Digest of the first 0, 1, ... `depth` turns."""
    h, out = hashlib.sha256(), []
    for d in range(depth + 1):
        h.update(key[(d - 1) * WIDTH : d * WIDTH] if d else b"")
        out.append(h.copy().digest())
    return out


class _Sums:
    """What a subtree brings to the nodes above it."""

    __slots__ = ("n", "low", "texts", "owned", "leaves", "open", "waiting", "key")

    def __init__(self):
        self.n = self.texts = self.owned = self.leaves = self.open = 0
        self.low, self.waiting, self.key = None, [], b""

    def take(self, other: _Sums) -> None:
        self.n += other.n
        self.low = other.low if self.low is None else min(self.low, other.low)
        self.texts += other.texts
        self.owned += other.owned
        self.leaves += other.leaves
        self.open += other.open
        if len(self.waiting) < len(other.waiting):
            self.waiting, other.waiting = other.waiting, self.waiting
        self.waiting += other.waiting
        self.key = other.key


def trie_rows(entries: list[tuple[bytes, int, int, str]], before: int = -1, after: int = -1) -> list[list]:
    """Nodes of one range of distinct sorted keys, given as (key, members, smallest member, digest of the members).

    `before` and `after` say how many leading turns the first and the last key share with the neighbouring range
    (-1: there is none). Rows: digest of the prefix and of the parent's prefix, null inside the range; smallest
    member, depth, parent's smallest member (null if the parent reaches over the border), members, children, leaves, saved bytes, ends.
    """
    tree = RadixTree()
    for entry in entries:
        tree.insert(entry[0], entry)
    first, last = entries[0][0], entries[-1][0]
    ids = {True: _prefix_digests(first, before), False: _prefix_digests(last, after)}

    # Pre-order, so that going backwards meets children before parents without recursion.
    order: list[tuple[Node, int, int, int, bool, bool]] = []  # node, parent, bytes above, bytes with it, on the first, on the last key
    stack = [(tree.root, -1, 0, len(tree.root.path), True, True)]
    while stack:
        item = stack.pop()
        at = len(order)
        order.append(item)
        node, _, _, end, on_first, on_last = item
        for byte, kid in node.edges():
            stack.append((kid, at, end, end + 1 + len(kid.path), on_first and len(first) > end and first[end] == byte,
                          on_last and len(last) > end and last[end] == byte))

    rows: list[list] = []
    sums = [_Sums() for _ in order]
    for at in range(len(order) - 1, -1, -1):
        node, parent, start, end, on_first, on_last = order[at]
        own = sums[at]
        if node.value is not None:
            key, n, low, _ = node.value
            own.n += n
            own.low = low if own.low is None else min(own.low, low)
            own.key = key
        lowest = start // WIDTH + 1 if parent >= 0 else 0
        for depth in range(end // WIDTH, lowest - 1, -1):
            left, right = on_first and depth <= before, on_last and depth <= after
            size = int.from_bytes(own.key[depth * WIDTH - 4 : depth * WIDTH], "big") if depth else 0
            own.leaves += depth * WIDTH == end and not node.kids and not right
            own.texts += own.n * size
            own.owned += 0 if left else size
            ends = node.value[3] if node.value is not None and depth * WIDTH == end else None
            name = ids[left][depth] if left or right else None
            for child in own.waiting:
                rows[child][1 if name else 4] = name or own.low
            rows.append([name, None, own.low, depth, None, own.n, own.open, own.leaves, own.texts - own.owned, ends])
            own.waiting = [len(rows) - 1]
            own.open = 0 if left else 1
        if parent >= 0:
            sums[parent].take(own)
        sums[at] = None
    return rows


NODE = "node binary, parent binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_NODE_TYPES = [pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.string()]


def conversation_keys(turns: DataFrame, family: int = FAMILY) -> DataFrame:
    """(conv_id, key): the ids of each rebuilt conversation's turns, one after the other."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    named = F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    turn_id = F.concat(F.substring(named, 1, 2 * DIGEST), F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    conv = F.col("`conv_id`").cast("long")
    listed = turns.select(
        conv.alias("conv"), (conv - F.pmod(conv, F.lit(family))).alias("head"), F.col("`turn`").cast("long").alias("turn"), F.unhex(turn_id).alias("id")
    ).where("conv IS NOT NULL").repartition("head")
    # All that follows is dealt by `head` already: one shuffle. Turns that share a number are ordered by their ids.
    place = F.row_number().over(Window.partitionBy("head", "conv").orderBy(F.col("turn").asc_nulls_first(), "id"))
    own = F.pmod(F.crc32(F.col("conv").cast("string").cast("binary")), F.lit(9)).cast("int")
    placed = listed.withColumn("place", place)
    kept = F.struct(F.col("conv"), F.lit(1).alias("mine"), "place", F.when(F.col("place") > own, F.col("id")).alias("id"))
    member = F.transform(F.sequence(F.lit(0), F.lit(family - 1)), lambda k: F.col("head") + k)
    lent = F.transform(
        F.filter(member, lambda c: F.pmod(F.crc32(c.cast("string").cast("binary")), F.lit(9)) >= F.col("place")),
        lambda c: F.struct(c.alias("conv"), F.lit(0).alias("mine"), F.col("place"), F.col("id")))
    opening = F.when((F.col("conv") == F.col("head")) & (F.col("place") <= 8), lent).otherwise(F.array().cast("array<struct<conv:bigint,mine:int,place:int,id:binary>>"))
    dealt = placed.select("head", F.explode(F.concat(F.array(kept), opening)).alias("t")).select("head", "t.*")
    whole = dealt.groupBy("head", "conv").agg(
        F.max("mine").alias("mine"), F.sort_array(F.collect_list(F.when(F.col("id").isNotNull(), F.struct("mine", "place", "id")))).alias("ids"))
    key = F.unhex(F.array_join(F.transform("ids", lambda t: F.hex(t["id"])), ""))
    return whole.where("mine = 1").select(F.col("conv").alias("conv_id"), key.alias("key"))


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members per key of a sorted range. The first and the last key and long runs leave as chunks of members, since
    more of them may be in the next range; other keys leave with the digest of their members."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()
    schema = pa.schema([("part", pa.int32()), ("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("ids", pa.string()), ("sha", pa.string())])
    out: list[tuple] = []
    key, ids, open_run = None, [], True

    def close(as_chunk: bool) -> None:
        text = ",".join(map(str, ids))
        out.append((part, key, ids[0], len(ids), *((text, None) if as_chunk else (None, hashlib.sha256(text.encode()).hexdigest()))))

    for batch in batches:
        for k, c in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
            if k != key:
                if key is not None:
                    close(open_run)
                    open_run = False
                key, ids = k, []
            elif len(ids) == CHUNK:
                close(True)
                open_run, ids = True, []
            ids.append(c)
        if len(out) >= CHUNK:
            yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)
            out = []
    if key is not None:
        close(True)
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(zip(*out), schema)], schema=schema)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key from its chunks, which come in order; the digest runs over them, so none is held."""
    schema = pa.schema([("part", pa.int32()), ("key", pa.binary()), ("first", pa.int64()), ("n", pa.int64()), ("sha", pa.string())])
    state = None

    def line() -> pa.RecordBatch:
        part, key, low, n, digest = state
        return pa.RecordBatch.from_pylist([{"part": part, "key": key, "first": low, "n": n, "sha": digest.hexdigest()}], schema=schema)

    for batch in batches:
        for row in batch.to_pylist():
            if state is None or state[1] != row["key"]:
                if state is not None:
                    yield line()
                state = [row["part"], row["key"], row["first"], 0, hashlib.sha256()]
            if state[3]:
                state[4].update(b",")
            state[3] += row["n"]
            state[4].update(row["ids"].encode())
    if state is not None:
        yield line()


def _border_depths(keys: DataFrame) -> dict[int, tuple[int, int]]:
    """Per range, how many turns its ends share with the neighbours. The driver holds two numbers per range."""
    ends = keys.groupBy("part").agg(F.min("key").alias("low"), F.max("key").alias("high")).orderBy("part")
    found: dict[int, list[int]] = {}
    last = None
    for row in ends.toLocalIterator():
        found[row["part"]] = [-1, -1]
        if last is not None:
            found[row["part"]][0] = found[last[0]][1] = shared_bytes(last[1], bytes(row["low"])) // WIDTH
        last = (row["part"], bytes(row["high"]))
    return {part: (a, b) for part, (a, b) in found.items()}


def prefix_trie(turns: DataFrame, family: int = FAMILY, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per distinct prefix of turns of the rebuilt conversations; columns as in `NODE` without the digests.

    Input columns: conv_id, turn, role, text; others are ignored. Turns are ordered by number, null first; turns of
    one number by their ids, and repeated rows are repeated turns. Null roles and texts count as empty.
    Rows without conv_id are in no conversation. A conversation opens with the first h turns of the first one of its family
    of `family` (ids that are equal when divided and rounded down; h: crc32 of its id modulo 9), then goes on with its own turns after its first h; one without turns is a
    member of the root only. An empty table has no nodes, not even a root. Texts of any length are read whole, and
    only their ids are shuffled.

    A range's tree holds about `range_bytes` of ids. A conversation stays in one piece, which takes 20 bytes a turn. Equal
    conversations are counted before the trees are built, and the members of a frequent one are spread over ranges; only
    their digest runs through one task, in chunks of ids.
    """
    keys = stage(conversation_keys(turns, family))
    size = keys.agg(F.sum(F.octet_length("key") + 16)).first()[0] or 0
    ranges = max(keys.sparkSession.sparkContext.defaultParallelism, -(-size // range_bytes))
    runs = stage(keys.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _runs, "part int, key binary, first long, n long, ids string, sha string"))
    chunks = runs.where("ids IS NOT NULL").drop("sha").repartition("key").sortWithinPartitions("key", "first")
    names = ("part", "key", "first", "n", "sha")
    whole = runs.where("ids IS NULL").select(*names).unionByName(
        chunks.mapInArrow(_joined, "part int, key binary, first long, n long, sha string"))
    whole = stage(whole)
    borders = keys.sparkSession.sparkContext.broadcast(_border_depths(whole))

    def grown(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_of(batches, "part"):
            entries = list(zip(*(group.column(c).to_pylist() for c in ("key", "n", "first", "sha"))))
            rows = trie_rows(entries, *borders.value[group.column("part")[0].as_py()])
            for a in range(0, len(rows), 10_000):
                columns = zip(*rows[a : a + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, _NODE_TYPES)], names=[f.split()[0] for f in NODE.split(", ")])

    nodes = stage(whole.repartition(ranges, "part").sortWithinPartitions("part", "key").mapInArrow(grown, NODE))
    # A node at a border is in several trees; its figures add up.
    at_border = stage(nodes.where("node IS NOT NULL").groupBy("node").agg(
        F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")), F.max("ends_sha256").alias("ends_sha256")))
    inside = nodes.where("node IS NULL")
    every = inside.unionByName(at_border)
    tops = at_border.select(F.col("node").alias("parent"), F.col("conv_id").alias("top"))
    tops = F.broadcast(tops) if tops.count() <= BROADCAST_ROWS else tops
    known = every.where("parent IS NULL")
    looked_up = every.where("parent IS NOT NULL").join(tops, "parent").withColumn("parent_conv_id", F.col("top")).drop("top")
    return known.unionByName(looked_up).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
