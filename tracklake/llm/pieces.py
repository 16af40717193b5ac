"""SentencePiece encoding as a relational lattice, and decoding.

Pieces never reach over the start of a word, so each distinct word is encoded once. Nor do they join two characters that are
neighbours in no piece, so a word falls into parts there. A part's substrings of bounded length are joined to the piece
table; the matches are the edges of its lattice. A fold over them gives the best path: for unigram models the Viterbi
recursion, for BPE models the merges in order of their scores, each of which is an edge. Texts are
kept as blocks of word numbers, and the encoded words return to the blocks.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklake.llm.common import groups_of
from tracklake.session import fresh_path

CHUNK_CHARS = 20_000_000
BUCKET_CHARS = 4_000_000  # text for each bucket of words, so that a task sorts few lattices
LEAST_BUCKETS = 64
HELD_WORDS = 500_000  # distinct words after which a block ends
SLICE_WORDS = 200_000
PIECE_ROWS = 256  # texts that leave a worker together
LATTICE_CHARS = 48  # longer parts are folded in Python, with the same rule
SPACE = "▁"
_WORD = re.compile(f"{SPACE}*[^{SPACE}\n]+|{SPACE}+|\n")


@dataclass
class Vocabulary:
    """A model's normal pieces with ids and scores, its byte pieces, and the longest piece."""

    pieces: dict[str, tuple[int, float]]
    bytes_: list[int]
    unknown: int
    bpe: bool
    longest: int


def load_vocabulary(path: str) -> Vocabulary:
    """Read a model file on the driver. Models whose pieces cross the start of a word or a line are refused."""
    from sentencepiece import SentencePieceProcessor
    from sentencepiece import sentencepiece_model_pb2 as model

    proto = model.ModelProto()
    with open(path, "rb") as file:
        proto.ParseFromString(file.read())
    norm = proto.normalizer_spec
    if norm.name != "identity" or norm.remove_extra_whitespaces or not norm.add_dummy_prefix:
        raise ValueError("only models without normalisation and with a dummy prefix are supported")
    plain, special = SentencePieceProcessor(model_file=path), {}
    pieces = {}
    for i, p in enumerate(proto.pieces):
        if plain.is_byte(i):
            special[int(p.piece[3:5], 16)] = i
        elif not (plain.is_control(i) or plain.is_unknown(i) or plain.is_unused(i)):
            pieces[p.piece] = (i, p.score)
    for p in pieces:
        if SPACE in p.lstrip(SPACE) or (len(p) > 1 and "\n" in p):
            raise ValueError(f"piece {p!r} crosses the start of a word")
    table = [special.get(b, plain.unk_id()) for b in range(256)]
    return Vocabulary(pieces, table, plain.unk_id(), proto.trainer_spec.model_type == 2, max(map(len, pieces)))


def words_of(text: str) -> list[str]:
    """Words with the spaces before them; the first one gets the dummy prefix."""
    if not text:
        return []
    text = SPACE + text.replace(" ", SPACE)
    if SPACE * 2 in text or "\0" in text:
        return _WORD.findall(text)
    if "\n" not in text:
        return text.replace(SPACE, "\n" + SPACE)[1:].split("\n")
    marked = text.replace("\n", "\n\0\n").replace(SPACE, "\n" + SPACE).split("\n")
    return ["\n" if w == "\0" else w for w in marked if w]


class Seams:
    """Where words fall apart: between characters that are neighbours in no piece."""

    def __init__(self, vocabulary: Vocabulary):
        pairs = {p[k : k + 2] for p in vocabulary.pieces for k in range(len(p) - 1)}
        chars = sorted({ord(c) for pair in pairs for c in pair})
        self.chars = np.array(chars, np.uint32)
        self.joined = np.zeros((len(chars) + 1,) * 2, bool)  # the last line is for all other characters
        for pair in pairs:
            self.joined[tuple(np.searchsorted(self.chars, [ord(c) for c in pair]))] = True

    def split(self, words: list[str]) -> list[list[str]]:
        """The parts of each word. A word is free of line feeds, unless it is one."""
        codes = np.frombuffer("\n".join("\t" if w == "\n" else w for w in words).encode("utf-32-le"), np.uint32)
        if not len(codes) or not len(self.chars):
            return [list(w) for w in words]
        at = np.minimum(np.searchsorted(self.chars, codes), len(self.chars) - 1)
        at = np.where(self.chars[at] == codes, at, len(self.chars))
        # A line feed joins nothing: it gets one on either side, so that three part two words and one parts two parts.
        seams = np.flatnonzero(~self.joined[at[:-1], at[1:]]) + 1
        text = np.insert(codes, seams, np.uint32(10)).tobytes().decode("utf-32-le")
        parts = [w.split("\n") for w in text.split("\n\n\n")]
        return [["\n"] if w == "\n" else p for w, p in zip(words, parts, strict=True)]


def lattice(words: DataFrame, pieces: DataFrame, bucket: str, least: int = 2) -> DataFrame:
    """Edges of each word's lattice, best first, each a number: piece order * 2**36 + i * 2**30 + l * 2**24 + piece id.

    An edge covers characters i to i + l, so words have 62 characters at most. Edges shorter than `least` are left out. Only
    substrings of lengths that pieces with the same three first characters have are looked up. Words are grouped by a
    hash first, on which sorts compare quickly.
    """
    size, key = F.length("word"), F.xxhash64("word").alias("key")
    first = pieces.where("length(piece) >= 3").groupBy(F.substring("piece", 1, 3).alias("first")).agg(
        F.collect_set(F.length("piece")).alias("lengths"))
    short = F.array(*[F.lit(n) for n in (1, 2) if n >= least])
    starts = words.where(size >= least).select(bucket, key, "word", F.explode(F.sequence(F.lit(0), size - least)).alias("i"))
    near = starts.join(F.broadcast(first), F.substring("word", F.col("i") + 1, F.lit(3)) == F.col("first"), "left")  # a fixed table
    spans = near.select(bucket, "key", "word", "i", F.explode(F.concat(short, F.coalesce("lengths", F.array().cast("array<int>")))).alias("l"))
    spans = spans.where(F.col("i") + F.col("l") <= size)
    texts = spans.select(bucket, "key", "word", "i", "l", F.substring("word", F.col("i") + 1, F.col("l")).alias("piece"))
    edges = texts.join(F.broadcast(pieces), "piece")  # the vocabulary, a fixed table
    edge = F.col("order") * (1 << 36) + F.col("i").cast("long") * (1 << 30) + F.col("l").cast("long") * (1 << 24) + F.col("id")
    return edges.groupBy("key", bucket, "word").agg(F.sort_array(F.collect_list(edge)).alias("edges")).drop("key")


def _field(edge: Column, shift: int, bits: int) -> Column:
    return F.shiftright(edge, shift).bitwiseAND(F.lit((1 << bits) - 1)).cast("int")


def _places(edge: Column) -> tuple[Column, Column]:
    """As bits of a number: the two ends of an edge, and the places between them."""
    bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place)
    low = bit(_field(edge, 30, 6))
    high = bit(_field(edge, 30, 6) + _field(edge, 24, 6))
    return low.bitwiseOR(high), high - low * 2


def merge_fold(word: Column, edges: Column) -> Column:
    """BPE: cut places (as bits) after merging the best-scored mergeable pair, leftmost first, until none is left.

    An edge is mergeable when both its ends are cuts and just one cut lies between them. The ends and inner places of
    the edges are worked out once and go along in the fold's state; a set sign bit says that nothing is left to merge.
    """
    size = F.length(word)
    every = F.call_function("shiftleft", F.lit(1).cast("long"), size + 1) - 1
    sign = F.lit(-(1 << 63)).cast("long")

    def masks(edge: Column) -> Column:
        ends, inner = _places(edge)
        return F.struct(ends.alias("ends"), inner.alias("inner"))

    def state(cuts: Column, pairs: Column) -> Column:
        return F.struct(cuts.alias("cuts"), pairs.alias("pairs"))

    def step(now: Column, _: Column) -> Column:
        cuts = now["cuts"]
        mergeable = lambda e: (F.bit_count(cuts.bitwiseAND(e["inner"])) == 1) & (cuts.bitwiseAND(e["ends"]) == e["ends"])
        best = F.get(F.filter(now["pairs"], mergeable), F.lit(0))
        merged = F.coalesce(cuts.bitwiseAND(F.bitwise_not(best["inner"])), cuts.bitwiseOR(sign))
        return F.when(cuts < 0, now).otherwise(state(merged, now["pairs"]))

    pairs = F.transform(F.filter(edges, lambda e: _field(e, 24, 6) > 1), masks)
    steps = F.when(size > 1, F.sequence(F.lit(2), size)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, state(every, pairs), step, lambda end: end["cuts"].bitwiseAND(F.lit((1 << 63) - 1)))


def viterbi_fold(word: Column, edges: Column, scores: Column, missing: float = -1e6) -> Column:
    """Unigram: cut places (as bits) of the path with the largest sum of scores; a character without a piece costs `missing`.

    scores: map from piece id to score for the word's pieces.
    """
    start = F.array(F.struct(F.lit(0.0).alias("total"), F.lit(1).cast("long").alias("cuts")))
    bit = lambda place: F.call_function("shiftleft", F.lit(1).cast("long"), place)

    def step(best: Column, end: Column) -> Column:
        def path(length: Column, score: Column) -> Column:
            before = F.get(best, end - length)
            return F.struct((before["total"] + score).alias("total"), (before["cuts"] + bit(end)).alias("cuts"))

        into = F.filter(edges, lambda e: _field(e, 30, 6) + _field(e, 24, 6) == end)
        paths = F.transform(into, lambda e: path(_field(e, 24, 6), F.element_at(scores, _field(e, 0, 24))))
        single = F.exists(into, lambda e: _field(e, 24, 6) == 1)
        every = F.when(single, paths).otherwise(F.concat(paths, F.array(path(F.lit(1), F.lit(missing)))))
        return F.concat(best, F.array(F.array_max(every)))

    return F.element_at(F.aggregate(F.sequence(F.lit(1), F.length(word)), start, step), -1)["cuts"]


def _ids(word: str, places: list[int], vocabulary: Vocabulary) -> list[int]:
    """Ids of the pieces between neighbouring cut places; characters without a piece become bytes."""
    out: list[int] = []
    for a, b in zip(places, places[1:]):
        hit = vocabulary.pieces.get(word[a:b])
        out += [hit[0]] if hit else [vocabulary.bytes_[x] for x in word[a:b].encode()]
    return out


def path_ids(word: str, cuts: int, vocabulary: Vocabulary) -> list[int]:
    return _ids(word, [k for k in range(len(word) + 1) if cuts >> k & 1], vocabulary)


def fold_word(word: str, vocabulary: Vocabulary) -> list[int]:
    """The same path for one long word: merges from a heap, or the Viterbi recursion."""
    import heapq

    n, pieces = len(word), vocabulary.pieces
    if vocabulary.bpe:
        end, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            if a >= 0 and end[a] < n:
                hit = pieces.get(word[a : end[end[a]]])
                if hit:
                    heapq.heappush(heap, (-hit[1], a, end[end[a]]))

        for a in range(n):
            offer(a)
        while heap:
            _, a, b = heapq.heappop(heap)
            if alive[a] and end[a] < n and end[end[a]] == b and end[a] != b:
                alive[end[a]] = False
                end[a] = b
                if b < n:
                    before[b] = a
                offer(a)
                offer(before[a])
        places = [0]
        while places[-1] < n:
            places.append(end[places[-1]])
    else:
        best = [(0.0, 0)] + [(float("-inf"), 0)] * n
        for b in range(1, n + 1):
            for a in range(max(0, b - vocabulary.longest), b):
                hit = pieces.get(word[a:b])
                score = best[a][0] + (hit[1] if hit else -1e6)
                if (hit or b - a == 1) and score > best[b][0]:
                    best[b] = (score, a)
        places = [n]
        while places[-1]:
            places.append(best[places[-1]][1])
        places.reverse()
    return _ids(word, places, vocabulary)


def _packed(*arrays: np.ndarray) -> bytes:
    """Arrays of 32-bit numbers one after the other, compressed with all lowest bytes first, as the high ones are mostly zero."""
    numbers = np.concatenate(arrays).astype("<i4")
    return zstandard.ZstdCompressor(level=3).compress(numbers.view(np.uint8).reshape(-1, 4).T.tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def _listed(words: list[str]) -> bytes:
    """Words as one compressed text. They hold no line feed, except that one itself, which is written as an empty line."""
    return zstandard.ZstdCompressor(level=3).compress("\n".join("" if w == "\n" else w for w in words).encode())


def _unlisted(blob: bytes) -> list[str]:
    return [w or "\n" for w in zstandard.ZstdDecompressor().decompress(blob).decode().split("\n")]


class _Numbers(dict):
    """Numbers for words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


BLOCK_SCHEMA = "kind int, block long, bucket int, doc_ids array<long>, blob binary"


def _block(block: int, ids: list[int | None], counts: list[int], runs: list[np.ndarray], numbers: _Numbers, buckets: int) -> pa.RecordBatch:
    dealt: dict[int, list[str]] = {}
    for w in sorted(numbers):
        dealt.setdefault(zlib.crc32(w.encode()) % buckets, []).append(w)
    place = np.zeros(len(numbers), np.int32)
    place[np.fromiter((numbers[w] for k in sorted(dealt) for w in dealt[k]), np.int64, len(numbers))] = np.arange(len(numbers))
    texts = _packed(np.array(counts, np.int32), place, *runs)
    n = len(dealt)
    columns = ([0] + [1] * n, [block] * (n + 1), [-1, *dealt], [ids] + [None] * n, [texts, *map(_listed, dealt.values())])
    types = (pa.int32(), pa.int64(), pa.int32(), pa.list_(pa.int64()), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["kind", "block", "bucket", "doc_ids", "blob"])


def _blocks(batches: Iterator[pa.RecordBatch], buckets: int, chars: int) -> Iterator[pa.RecordBatch]:
    """Neighbouring texts of a task as blocks. Of each, one row with its texts as word numbers, and one row for each bucket
    with the sorted distinct words that fall into it. Places order a block's words by bucket, then by themselves."""
    block = TaskContext.get().partitionId() << 32
    ids, counts, runs, numbers, held = [], [], [], _Numbers(), 0
    for batch in batches:
        for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            text = value.as_py() or ""
            words = words_of(text)
            ids.append(doc_id)
            counts.append(len(words))
            runs.append(np.fromiter(map(numbers.__getitem__, words), np.int32, len(words)))
            held += len(text) + 1
            if held >= chars or len(numbers) >= HELD_WORDS:
                yield _block(block, ids, counts, runs, numbers, buckets)
                block += 1
                ids, counts, runs, numbers, held = [], [], [], _Numbers(), 0
    if ids:
        yield _block(block, ids, counts, runs, numbers, buckets)
    del ids, counts, runs, numbers
    pa.default_memory_pool().release_unused()  # the worker is kept for the next stages


def _parts(batches: Iterator[pa.RecordBatch], seams) -> Iterator[pa.RecordBatch]:
    """Distinct parts of each bucket's words; rows come sorted by bucket."""
    for group in groups_of(batches, "bucket"):
        words: set[str] = set()
        for blob in group.column("blob"):
            words.update(_unlisted(blob.as_py()))
        parts = sorted({p for w in seams.value.split(list(words)) for p in w})
        yield pa.RecordBatch.from_arrays([group.column("bucket")[:1].combine_chunks(), pa.array([parts], pa.list_(pa.string()))], names=["bucket", "parts"])


def _answer(key, asked: pa.Table, parts: pa.Table, vocabulary, seams) -> pa.Table:
    """For one bucket: the number of words, numbers of ids, then the ids, of every block's words in the order of its list.

    Parts that are too long for a lattice, or have no edge in it, are folded here.
    """
    model = vocabulary.value
    known = {
        w: np.array(path_ids(w, cuts, model), "<i4").tobytes()
        for w, cuts in zip(parts.column("word").to_pylist(), parts.column("cuts").to_pylist())
    }
    of_word: dict[str, bytes] = {}
    blobs = []
    for blob in asked.column("blob"):
        words = _unlisted(blob.as_py())
        fresh = [w for w in words if w not in of_word]
        for w, split in zip(fresh, seams.value.split(fresh), strict=True):
            for p in split:
                if p not in known:
                    known[p] = np.array(fold_word(p, model), "<i4").tobytes()
            of_word[w] = b"".join([known[p] for p in split])
        found = [of_word[w] for w in words]
        blobs.append(_packed(np.array([len(found), *(len(f) // 4 for f in found)]), np.frombuffer(b"".join(found), "<i4")))
    return pa.table([asked.column("block"), pa.array([key[0].as_py()] * len(blobs), pa.int32()), pa.array(blobs, pa.binary())], names=["block", "bucket", "answers"])


def _encode_block(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Ids of a block's texts: its words' places lead to the answers, which are put together in the order of the buckets."""
    sizes, flat = [np.zeros(0, np.int32)], [np.zeros(0, np.int32)]
    for blob in answers.sort_by("bucket").column("answers"):
        numbers = _unpacked(blob.as_py())
        sizes.append(numbers[1 : 1 + numbers[0]])
        flat.append(numbers[1 + numbers[0] :])
    size, every = np.concatenate(sizes), np.concatenate(flat)
    start = np.cumsum(size, dtype=np.int64) - size
    doc_ids, numbers = texts.column("doc_ids").combine_chunks().flatten(), _unpacked(texts.column("blob")[0].as_py())
    counts = numbers[: len(doc_ids)]
    place, runs = numbers[len(doc_ids) : len(doc_ids) + len(size)], numbers[len(doc_ids) + len(size) :]
    ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
    before = np.zeros(len(runs) + 1, np.int64)
    for a in range(0, len(runs), SLICE_WORDS):
        before[a + 1 : a + 1 + SLICE_WORDS] = before[a] + np.cumsum(size[place[runs[a : a + SLICE_WORDS]]], dtype=np.int64)
    out = np.empty(before[-1], np.int32)
    for a in range(0, len(runs), SLICE_WORDS):
        at = place[runs[a : a + SLICE_WORDS]]
        low, high = before[a], before[a + len(at)]
        out[low:high] = every[np.repeat(start[at] - before[a : a + len(at)] + low, size[at]) + np.arange(high - low)]
    return pa.table([doc_ids, pa.LargeListArray.from_arrays(pa.array(before[ends]), pa.array(out)).cast(pa.list_(pa.int32()))], names=["doc_id", "ids"])


def _piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    rows = pd.DataFrame([(p, i, float(s)) for p, (i, s) in vocabulary.pieces.items()], columns=["piece", "id", "score"])
    rows["order"] = (-rows["score"]).rank(method="dense").astype("int64")
    return spark.createDataFrame(rows, "piece string, id int, score double, order long")


def encode_pieces(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
                  chunk_chars: int = CHUNK_CHARS, lattice_chars: int = LATTICE_CHARS) -> DataFrame:
    """One row per input row: id, ids (array of piece ids, as the model's own library gives them).

    Null and empty texts have no pieces. Rows without an id and repeated rows are encoded like any other, and further
    columns are not read. The character U+2581 is the model's own sign for a space and reads as one. Very long words are
    folded in Python. An empty table gives an empty result. A task holds one block of texts, which is `chunk_chars`
    characters and a text at most, or one bucket of words.

    Texts are never shuffled. One pass writes them as blocks of word numbers, in a table bucketed by block, and each block's
    distinct words by bucket, so both are linear in the data. A bucket's words of all blocks meet once for their lattices;
    the answers go back to the blocks where these lie. The table is external, in the shared folder, and stays
    in the session's catalog.
    """
    spark = docs.sparkSession
    every = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    total = every.agg(F.sum(F.length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-total // min(BUCKET_CHARS, chunk_chars)))
    lanes = max(LEAST_BUCKETS, -(-total // chunk_chars))
    path = fresh_path(spark, "piece_blocks")
    name = re.sub(r"\W", "_", path.rsplit("/", 1)[1])
    blocks = every.mapInArrow(partial(_blocks, buckets=buckets, chars=chunk_chars), BLOCK_SCHEMA)
    # The blobs are compressed already, and Parquet's codecs would hold whole pages of them outside the heap.
    blocks.write.option("compression", "uncompressed").partitionBy("kind").bucketBy(lanes, "block").option("path", path).saveAsTable(name, format="parquet")
    texts = spark.table(name).where("kind = 0").select("block", "doc_ids", "blob")
    # Read by its path: of the catalog's table each use would be shuffled anew.
    listed = spark.read.schema("block long, bucket int, blob binary, kind int").parquet(path).where("kind = 1")
    asked = listed.select("block", "bucket", "blob").repartition(buckets, "bucket")
    shared, seams = spark.sparkContext.broadcast(vocabulary), spark.sparkContext.broadcast(Seams(vocabulary))
    parts = asked.sortWithinPartitions("bucket").mapInArrow(partial(_parts, seams=seams), "bucket int, parts array<string>")
    words = parts.select("bucket", F.explode("parts").alias("word")).where(F.length("word") <= lattice_chars)
    words = words.repartition(buckets, "bucket")
    table = _piece_table(spark, vocabulary)
    if vocabulary.bpe:
        paths = lattice(words, table, "bucket")
        paths = paths.withColumn("cuts", merge_fold(F.col("word"), F.col("edges")))
    else:
        paths = lattice(words, table, "bucket", least=1)
        every = table.agg(F.map_from_entries(F.collect_list(F.struct("id", "score"))).alias("scores"))
        wanted = F.transform("edges", lambda e: _field(e, 0, 24))
        own = F.map_filter("scores", lambda k, _: F.array_contains(wanted, k))
        paths = paths.join(F.broadcast(every)).withColumn("scores", own)  # one row, the fixed vocabulary
        paths = paths.withColumn("cuts", viterbi_fold(F.col("word"), F.col("edges"), F.col("scores")))
    encoded = paths.select(F.col("bucket").alias("of_bucket"), "word", "cuts")
    answers = asked.groupBy("bucket").cogroup(encoded.groupBy("of_bucket")).applyInArrow(
        partial(_answer, vocabulary=shared, seams=seams), "block long, bucket int, answers binary")
    out = texts.groupBy("block").cogroup(answers.repartition(lanes, "block").groupBy("block")).applyInArrow(_encode_block, "doc_id long, ids array<int>")
    return out.withColumnRenamed("doc_id", id_col)


def decode_ids(ids: list[int], table: list[str | int | None]) -> str:
    """Text of piece ids. `table` has a piece's text, a byte's number, or None for pieces that stand for nothing, as do ids outside it."""
    out = bytearray()
    for i in ids:
        piece = table[i] if 0 <= i < len(table) else None
        if isinstance(piece, int):
            out.append(piece)
        elif piece is not None:
            out += piece.encode()
    text = out.decode("utf-8", "replace").replace(SPACE, " ")
    return text[1:] if text.startswith(" ") else text


def decode_table(vocabulary: Vocabulary) -> list[str | int | None]:
    size = 1 + max([i for i, _ in vocabulary.pieces.values()] + vocabulary.bytes_)
    table: list[str | int | None] = [None] * size
    for p, (i, _) in vocabulary.pieces.items():
        table[i] = p
    for b, i in enumerate(vocabulary.bytes_):
        if i != vocabulary.unknown:
            table[i] = b
    return table


def decoded(ids: pa.Array, table: list[bytes]) -> Iterator[str | None]:
    """Text of each row of ids, as `decode_ids` gives it. `table` has the bytes of every piece, and an empty last line for ids outside it."""
    flat = ids.values.to_numpy(zero_copy_only=False)
    for valid, a, b in zip(ids.is_valid().to_pylist(), ids.offsets[:-1].to_pylist(), ids.offsets[1:].to_pylist()):
        if not valid:
            yield None
            continue
        own = flat[a:b]
        if len(own) and (own.min() < 0 or own.max() >= len(table)):
            own = np.where((own < 0) | (own >= len(table)), len(table) - 1, own)
        text = b"".join(map(table.__getitem__, own.tolist())).decode("utf-8", "replace").replace(SPACE, " ")
        yield text[1:] if text.startswith(" ") else text


def decode_pieces(encoded: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of the ids. Null ids give a null text. Texts leave a worker in pieces, so that it holds the batch of ids and one piece."""
    pieces = [b"" if p is None else bytes([p]) if isinstance(p, int) else p.encode() for p in decode_table(vocabulary)]
    shared = encoded.sparkSession.sparkContext.broadcast([*pieces, b""])

    @F.arrow_udf("string")
    def text_of(ids: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in ids:
            for at in range(0, len(batch), PIECE_ROWS):
                yield pa.array(decoded(batch.slice(at, PIECE_ROWS), shared.value), pa.string())

    return encoded.withColumn(text_col, text_of(F.col(f"`{ids_col}`")))
