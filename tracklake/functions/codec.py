"""zlib for message bodies. Spark has no zlib function, so the bytes pass through Arrow batches.

A batch of 10,000 short bodies can hold a hundred megabytes of text, so that results leave Python in pieces: a worker holds
the batch that came in and one piece, whatever the number of messages.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

PIECE_ROWS = 256  # bodies that leave Python together


def inflate_one(body: bytes) -> str | None:
    try:
        return zlib.decompress(body).decode("utf-8")
    except (zlib.error, UnicodeDecodeError):
        return None


def _deflate_one(text: str) -> bytes:
    return zlib.compress(text.encode("utf-8"))


def _in_pieces(batches: Iterator[pa.Array], one: Callable, kind: pa.DataType) -> Iterator[pa.Array]:
    for batch in batches:
        for at in range(0, len(batch), PIECE_ROWS):
            piece = batch.slice(at, PIECE_ROWS)
            yield pa.array([None if v is None else one(v) for v in piece.to_pylist()], kind)


@F.arrow_udf(BinaryType())
def deflate(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    return _in_pieces(texts, _deflate_one, pa.binary())


@F.arrow_udf(StringType())
def inflate(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
    """Text of a compressed body, null where the bytes are damaged."""
    return _in_pieces(bodies, inflate_one, pa.string())


# Spark copies a deterministic function into the filters on its result and would inflate each body in a second worker for them.
inflate = inflate.asNondeterministic()


def encode_body(text: Column, codec: str = "zlib") -> Column:
    return deflate(text) if codec == "zlib" else F.encode(text, "UTF-8")


def decode_body(value: Column, codec: str = "zlib") -> Column:
    return inflate(value) if codec == "zlib" else F.decode(value, "UTF-8")
