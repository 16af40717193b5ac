"""Exact dedup by Grace hashing: spill partitions, then open-addressing tables that compare whole contents."""

from __future__ import annotations

import hashlib
import shutil
import struct
import tempfile
from collections.abc import Callable, Iterator, Sequence
from functools import partial
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructType

TABLE_BYTES = 48 << 20  # contents that one table may hold
FAN_OUT = 16
_HEAD = "<qqi"  # id, number of texts, bytes of content
_GROUP = "digest binary, content binary, keep_id long, group_size long"


class ContentTable:
    """Open addressing with linear probing. Equal hashes are not enough: contents are compared in full."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = np.full(slots, -1, np.int64)
        self.contents: list[bytes] = []
        self.hashes: list[int] = []
        self.keep: list[int] = []
        self.size: list[int] = []
        self.held = 0

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        for i, h in enumerate(self.hashes):
            at = h & (len(self.slots) - 1)
            while self.slots[at] >= 0:
                at = (at + 1) & (len(self.slots) - 1)
            self.slots[at] = i

    def add(self, hashed: int, content: bytes, keep: int, size: int) -> None:
        at = hashed & (len(self.slots) - 1)
        while (i := self.slots[at]) >= 0:
            if self.hashes[i] == hashed and self.contents[i] == content:
                self.keep[i] = max(self.keep[i], keep)
                self.size[i] += size
                return
            at = (at + 1) & (len(self.slots) - 1)
        self.slots[at] = len(self.contents)
        self.contents.append(content)
        self.hashes.append(hashed)
        self.keep.append(keep)
        self.size.append(size)
        self.held += len(content) + 100
        if 3 * len(self.contents) > 2 * len(self.slots):
            self._grow()


def _level_hash(content: bytes, level: int) -> int:
    return int.from_bytes(hashlib.blake2b(content, digest_size=8, salt=level.to_bytes(4, "little")).digest(), "little")


Record = tuple[bytes, int, int]  # content, id to keep, number of texts


def grace(records: Iterator[Record], folder: Callable[[], Path], limit: int, level: int = 0) -> Iterator[Record]:
    """One record per distinct content, in bounded memory.

    A table takes records until `limit` bytes of contents are held. From then on, contents that the table knows
    are still counted there and all others go to one of FAN_OUT spill files by a hash of this level. Each file
    is treated the same way, with the hash of the next level.
    """
    table, files, root = ContentTable(), [], None
    for content, keep, size in records:
        hashed = _level_hash(content, level)
        if not files and table.held + len(content) > limit and table.contents:
            root = folder()
            files = [(root / f"{level}-{i}").open("wb") for i in range(FAN_OUT)]
        if files and not _known(table, hashed, content):
            out = files[(hashed >> 40) % FAN_OUT]
            out.write(struct.pack(_HEAD, keep, size, len(content)))
            out.write(content)
        else:
            table.add(hashed, content, keep, size)
    yield from zip(table.contents, table.keep, table.size)
    del table
    for out in files:
        out.close()
    for out in files:
        yield from grace(_spilled(Path(out.name)), folder, limit, level + 1)
    if root is not None:
        shutil.rmtree(root, ignore_errors=True)


def _known(table: ContentTable, hashed: int, content: bytes) -> bool:
    at = hashed & (len(table.slots) - 1)
    while (i := table.slots[at]) >= 0:
        if table.hashes[i] == hashed and table.contents[i] == content:
            return True
        at = (at + 1) & (len(table.slots) - 1)
    return False


def _spilled(path: Path) -> Iterator[Record]:
    with path.open("rb") as file:
        while head := file.read(struct.calcsize(_HEAD)):
            keep, size, n = struct.unpack(_HEAD, head)
            yield file.read(n), keep, size
    path.unlink()


def _contents(batches: Iterator[pa.RecordBatch], text: str) -> Iterator[tuple[int | None, bytes]]:
    """Ids and normalised contents: bytes.lower() changes A-Z only. A null text is an empty one."""
    for batch in batches:
        binary = batch.column(text).cast(pa.binary())
        for key, value in zip(batch.column("id").to_pylist(), binary):
            yield key, (value.as_py() or b"").lower()


_NO_ID = -(1 << 63)


def _collapse(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Before the shuffle: one record per text of the task, so a text's copies cross as one row a task at most."""
    records = ((c, _NO_ID if k is None else k, 1) for k, c in _contents(batches, "content"))
    table = ContentTable()
    for content, keep, size in records:
        if table.held + len(content) > limit and table.contents:
            yield from _rows(zip(table.contents, table.keep, table.size))
            table = ContentTable()
        table.add(_level_hash(content, 0), content, keep, size)
    yield from _rows(zip(table.contents, table.keep, table.size))


def _rows(records: Iterator[Record]) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    size = 0
    for content, keep, count in records:
        held.append((hashlib.sha256(content).digest(), content, keep, count))
        size += len(content)
        if size > 4 << 20 or len(held) >= 5000:
            yield _batch(held)
            held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    types = (pa.binary(), pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names=["digest", "content", "keep_id", "group_size"]
    )


def _join_partition(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    def records() -> Iterator[Record]:
        for batch in batches:
            columns = (batch.column(n) for n in ("content", "keep_id", "group_size"))
            for content, keep, size in zip(*columns):
                yield content.as_py(), keep.as_py(), size.as_py()

    def folder() -> Path:
        return Path(tempfile.mkdtemp(prefix="grace-"))

    held: list[tuple] = []
    for content, keep, size in grace(records(), folder, limit):
        held.append((hashlib.sha256(content).digest(), b"", keep, size))
        if len(held) >= 20000:
            yield _batch(held)
            held = []
    if held:
        yield _batch(held)


def _digests(batches: Iterator[pa.RecordBatch], carry: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [hashlib.sha256(c).digest() for _, c in _contents([batch], "content")]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(rows, pa.binary()), *(batch.column(c) for c in carry)], names=["id", "digest", *carry])


def _texts(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("content"), *(F.col(f"`{c}`") for c in carry))


def text_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_BYTES) -> DataFrame:
    """Distinct texts (A-Z lower-cased, null as empty): `digest` (SHA-256), `keep_id` (largest id), `group_size`.

    Copies are collapsed before the shuffle. Texts are then hash partitioned and each partition is deduplicated by
    `grace`, which spills to the task's own temporary folder and removes it. A null id loses against any other;
    if a text has none but null ids, keep_id is null.
    """
    texts = _texts(docs, id_col, text_col)
    single = texts.mapInArrow(partial(_collapse, limit=limit), _GROUP)
    dealt = single.repartition("digest")
    groups = dealt.mapInArrow(partial(_join_partition, limit=limit), _GROUP)
    keep = F.when(F.col("keep_id") != _NO_ID, F.col("keep_id"))
    return groups.select("digest", keep.alias("keep_id"), "group_size")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE_BYTES, carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are so after lower-casing A-Z. Null texts count as empty, and empty texts are equal to each
    other. The row with the largest id of a group is kept; of rows that share this id all are kept. A row without an id
    is kept only if its text has no row with an id. An empty table gives an empty result; further columns
    are not read, but those named in `carry` are added to their rows. Texts of any length work if one fits in a task's memory.
    """
    groups = text_groups(docs, id_col, text_col, limit)
    schema = StructType().add("id", LongType()).add("digest", BinaryType())
    for c in carry:
        schema.add(c, docs.schema[c].dataType)
    members = _texts(docs, id_col, text_col, carry).mapInArrow(partial(_digests, carry=carry), schema)
    joined = members.join(groups, "digest")
    kept = F.col("id").eqNullSafe(F.col("keep_id"))
    return joined.select(
        F.col("id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"), *carry
    )
