"""Exact Jaccard join of documents on word shingles, with skipping in index lists and derived answers.

1. Every document becomes a set of shingle hashes; equal sets are reduced to one representative.
2. Index: sets that reach the threshold share a shingle of their prefixes. The order that makes prefixes puts rare
   shingles first, by counts in a table of fixed size, so phrases that a few dozen or more share hardly index anything.
3. Short lists give candidate pairs: a list is sorted by set size, blocks of too small sets are skipped, and a
   pair is skipped whose places in the two sets leave too few shingles to share. Long lists are put together where
   they hold the same sets, and cut into tiles of two blocks of sets, so no list is enumerated in one task and
   no pairs are written.
4. Groups of candidates fetch their texts once and are joined exactly. Overlaps of a set with all others of the
   group are derived from those of the most similar set done before, from the few shingles in which both differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructType

from tracklake.llm.common import components, groups_of
from tracklake.llm.tile_join import Forest
from tracklake.llm.words import _WORD_BASE, grams, polynomial, split_words, text_column
from tracklake.session import stage

SHORT_LIST = 64
TILE_BLOCK = 512
COMMON_SHARE = 0.001
SKETCH_BITS = 21
SKETCH_PART = 1 << 16  # counts that are added up together
_COMMON_LEVEL = 1 << 15  # levels of common shingles lie above those of all others
_FLUSH = 4 << 20


def shingle_sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """Place and sorted set of shingle hashes of each text; shorter texts have their whole sequence as one shingle."""
    for part in split_words(column, lower=True):
        hashes = part.hashes()
        every = grams(hashes, size)
        for k in range(part.last - part.first):
            a, b = int(part.bounds[k]), int(part.bounds[k + 1])
            if b - a >= size:
                yield part.first + k, np.unique(every[a : b - size + 1])
            elif b > a:
                yield part.first + k, polynomial(hashes[a:b], np.array([0]), np.array([b - a]), _WORD_BASE)
            else:
                yield part.first + k, np.zeros(0, np.uint64)


def needed(n: int, percent: int) -> int:
    """Least overlap that a set of n needs with any set it links to."""
    return -(-percent * n // 100)


def levels_of(counts: np.ndarray) -> np.ndarray:
    """Counts in steps of one percent."""
    return np.rint(64 * np.log2(1.0 + counts)).astype(np.uint16)


# Common shingles, sorted, with their counts, and for all others a level for the top bits of their hash.
Frequencies = tuple[np.ndarray, np.ndarray, np.ndarray]


def in_order(found: np.ndarray, frequencies: Frequencies) -> np.ndarray:
    """A sorted set in index order: the rarest shingles first, by their level and then by hash."""
    common, counts, levels = frequencies
    level = levels[found >> np.uint64(64 - SKETCH_BITS)]
    if len(common):
        at = np.minimum(np.searchsorted(common, found), len(common) - 1)
        level = np.where(common[at] == found, _COMMON_LEVEL + levels_of(counts[at]), level)
    return found[np.argsort(level, kind="stable")]


def _count(batches: Iterator[pa.RecordBatch], size: int, share: float) -> Iterator[pa.RecordBatch]:
    """Shingles that a fair share of a run of documents has, and a task's counts by the top bits of the hash, in parts."""
    held: list[np.ndarray] = []
    sketch = np.zeros(1 << SKETCH_BITS, np.uint32)

    def flush() -> pa.RecordBatch:
        every = np.concatenate(held)
        sketch[:] += np.bincount((every >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=len(sketch)).astype(np.uint32)
        values, counts = np.unique(every, return_counts=True)
        keep = counts >= max(3, share * len(held))
        return _counted(shingle=values[keep].view(np.int64), n=counts[keep].astype(np.int64))

    total = 0
    for batch in batches:
        for _, found in shingle_sets(text_column(batch, "text"), size):
            held.append(found)
            total += len(found)
            if total >= _FLUSH:
                yield flush()
                held, total = [], 0
    if held:
        yield flush()
    if sketch.any():
        yield _counted(part=list(range(len(sketch) // SKETCH_PART)), blob=[_planes(p) for p in sketch.reshape(-1, SKETCH_PART)])


_COUNTED = {"shingle": pa.int64(), "n": pa.int64(), "part": pa.int32(), "blob": pa.binary()}


def _counted(**columns) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    arrays = [pa.array(columns[c], t) if c in columns else pa.nulls(rows, t) for c, t in _COUNTED.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(_COUNTED))


def _planes(counts: np.ndarray) -> bytes:
    """Counts compressed with all lowest bytes first, as the high ones are mostly zero."""
    return zstandard.ZstdCompressor(level=1).compress(counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sum of each part's counts as levels. Rows come sorted by part."""
    part, total = None, np.zeros(SKETCH_PART, np.int64)

    def done() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([levels_of(total).tobytes()])], names=["part", "levels"])

    for batch in batches:
        for p, blob in zip(batch.column("part").to_pylist(), batch.column("blob")):
            if part is not None and p != part:
                yield done()
                total[:] = 0
            part = p
            planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob.as_py()), np.uint8).reshape(4, -1)
            total += np.ascontiguousarray(planes.T).view("<u4").ravel()
    if part is not None:
        yield done()


def shingle_frequencies(texts: DataFrame, size: int, share: float) -> Frequencies:
    """How often shingles occur. It decides only the order of the index, never a result.

    At most 2 / share times the mean set size of common shingles come back, and 2 ** SKETCH_BITS levels, however many documents
    there are. Shingles with the same top bits share a level. What a shingle of a few dozen documents adds stands
    out from that: prefixes take the rarest 15 % or so, and it falls far less often among these than one that occurs once.
    """
    # Both parts of the counts leave one pass over the texts.
    seen = stage(texts.mapInArrow(partial(_count, size=size, share=share), "shingle long, n long, part int, blob binary"))
    total = texts.count()
    rows = seen.where("part IS NULL").groupBy("shingle").agg(F.sum("n").alias("n")).where(F.col("n") >= total * share / 2).toPandas()
    tokens = rows["shingle"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(tokens)
    parts = seen.where("part IS NOT NULL").select("part", "blob").repartition("part").sortWithinPartitions("part")
    levels = np.zeros(1 << SKETCH_BITS, np.uint16).reshape(-1, SKETCH_PART)
    for row in parts.mapInArrow(_add_up, "part int, levels binary").collect():
        levels[row["part"]] = np.frombuffer(row["levels"], np.uint16)
    return tokens[order], rows["n"].to_numpy(np.int64)[order], levels.ravel()


def _index(batches: Iterator[pa.RecordBatch], size: int, percent: int, shared, carry: Sequence[str] = ()) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [batch.column(c) for c in ("doc_id", *carry)]
        held: list[tuple] = []
        for place, found in shingle_sets(text_column(batch, "text"), size):
            n = len(found)
            first = in_order(found, shared.value)[: n - needed(n, percent) + 1] if n else found
            sign = hashlib.blake2b(found.tobytes(), digest_size=16).digest() if n else None
            held.append((place, n, sign, first.view(np.int64)))
            if len(held) >= 2000:
                yield _index_rows(ids, held, carry)
                held = []
        if held:
            yield _index_rows(ids, held, carry)


def _index_rows(ids: list[pa.Array], held: list[tuple], carry: Sequence[str]) -> pa.RecordBatch:
    places, sizes, signs, prefixes = zip(*held)
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in prefixes])]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(prefixes)))
    first, *more = (c.take(pa.array(places)) for c in ids)
    return pa.RecordBatch.from_arrays(
        [first, pa.array(sizes, pa.int64()), pa.array(signs, pa.binary()), lists, *more],
        names=["doc_id", "n_shingles", "sign", "prefix", *carry])


def _list_pairs(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Pairs of sets in a list whose sizes allow a link, with the overlap that their places in the list leave possible."""
    for batch in batches:
        column = batch.column("entries")
        flat = column.flatten()
        rep = flat.field("rep").to_numpy()
        meta = flat.field("meta").to_numpy()
        size, place = meta >> 32, meta & 0xFFFFFFFF
        offsets = column.offsets.to_numpy()
        offsets = offsets - offsets[0]
        a_out, b_out, gaps = [], [], []
        for lo, hi in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            order = lo + np.argsort(size[lo:hi], kind="stable")
            n, left, ids = size[order], size[order] - place[order] - 1, rep[order]
            starts = np.searchsorted(n, -(-percent * n // 100))  # smaller sets before are one skipped block
            for k in range(1, hi - lo):
                j = np.arange(starts[k], k)
                # What is missing: by place after this shingle, and in shared prefix shingles over all lists.
                least = -(-percent * (n[k] + n[j]) // (100 + percent))
                a_out.append(np.full(len(j), ids[k]))
                b_out.append(ids[j])
                # The set whose prefix ends first in the order adds at most what follows its prefix.
                rest = np.maximum(-(-percent * n[k] // 100), -(-percent * n[j] // 100)) - 1
                gaps.append(np.stack([1 + np.minimum(left[k], left[j]) - least, least - rest], 1))
        a, b = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (a_out, b_out))
        gap = np.concatenate(gaps) if gaps else np.zeros((0, 2), np.int64)
        columns = (np.minimum(a, b), np.maximum(a, b), gap[:, 0], gap[:, 1])
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["x", "y", "slack", "shared"])


def set_links(sets: list[np.ndarray], percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each set its place and the places of all sets done before that it links to."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) <= 4:
        for i in range(1, len(sets)):
            both = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for j in range(i)])
            yield i, np.flatnonzero((sizes[:i] > 0) & (100 * both >= percent * (sizes[i] + sizes[:i] - both)))
        return
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    codes = [code[a:b] for a, b in zip(bounds, bounds[1:])]
    owner = np.repeat(np.arange(len(sets)), sizes)[np.argsort(code, kind="stable")]
    starts = np.concatenate([[0], np.cumsum(np.bincount(code))])

    def overlaps(tokens: np.ndarray) -> np.ndarray:
        if not len(tokens):
            return np.zeros(len(sets), np.int64)
        return np.bincount(np.concatenate([owner[starts[t] : starts[t + 1]] for t in tokens]), minlength=len(sets))

    answers = np.zeros((len(sets), len(sets)), np.int32)
    best, parent = np.zeros(len(sets), np.int64), np.full(len(sets), -1)
    for i in range(len(sets)):
        p = parent[i]
        if p >= 0 and sizes[i] + sizes[p] - 2 * best[i] < sizes[i]:
            more = np.setdiff1d(codes[i], codes[p], assume_unique=True)
            less = np.setdiff1d(codes[p], codes[i], assume_unique=True)
            both = answers[p] + overlaps(more) - overlaps(less)
        else:
            both = overlaps(codes[i])
        answers[i] = both
        closer = both > best
        best[closer], parent[closer] = both[closer], i
        done = both[:i]
        yield i, np.flatnonzero((done > 0) & (100 * done >= percent * (sizes[i] + sizes[:i] - done)))


def _join_groups(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    a_out: list[int] = []
    b_out: list[int] = []
    for group in groups_of(batches, "grp"):
        ids = group.column("member").to_pylist()
        sets = [s for _, s in shingle_sets(group.column("text").combine_chunks(), size)]
        forest = Forest(len(ids))
        for i, linked in set_links(sets, percent):
            for j in linked.tolist():
                forest.add(i, j)
        a_out += [ids[i] for i, _ in forest.links]
        b_out += [ids[j] for _, j in forest.links]
        if len(a_out) > 10000:
            yield pa.RecordBatch.from_arrays([pa.array(a_out), pa.array(b_out)], names=["a", "b"])
            a_out, b_out = [], []
    yield pa.RecordBatch.from_arrays([pa.array(a_out, pa.int64()), pa.array(b_out, pa.int64())], names=["a", "b"])


def bundled(long: DataFrame, block: int) -> DataFrame:
    """Long lists (token, rep, n) with those put together that mostly hold the same sets: list, rep, n (sets of that list).

    Near copies share dozens of long lists, each of which would fetch their texts again. Lists that are connected by
    their sets become one list of all these sets where its tiles fetch fewer texts than theirs do. Any two sets
    that share a list still do.
    """
    fetches = lambda n: F.ceil(F.col(n) / F.lit(block))
    least = long.groupBy("token").agg(F.min("rep").alias("least"))
    parts = components(long.join(least, "token"), "rep", "least")  # the smallest vertex of a component is not among them
    named = stage(long.join(parts, F.col("rep") == F.col("vertex"), "left").select("token", "rep", "n", F.coalesce("component", "rep").alias("component")))
    sets = named.groupBy("component", "rep").agg(F.sum(fetches("n")).alias("apart"))
    sizes = sets.groupBy("component").agg(F.sum("apart").alias("apart"), F.count("*").alias("m"))
    whole = sizes.where(F.col("m") * fetches("m") < F.col("apart")).select("component", "m")
    together = sets.join(whole, "component").select(F.concat(F.lit("c"), "component").alias("list"), "rep", F.col("m").alias("n"))
    return together.unionByName(named.join(whole, "component", "left_anti").select(F.concat(F.lit("t"), "token").alias("list"), "rep", "n"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 4, percent: int = 85,
                       short_list: int = SHORT_LIST, tile_block: int = TILE_BLOCK, share: float = COMMON_SHARE, carry: Sequence[str] = ()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (smallest id reachable by links, itself included).

    A document's set: distinct shingles of `size` words of the text with A-Z lower-cased; with fewer words, the whole
    sequence as one. Documents link when 100 * intersection >= percent * union. Null and empty texts have no set and
    link with nothing. Rows without an id have a null component. Rows with one id are one vertex. An empty table
    gives an empty result. Shingles are compared by 64-bit hashes. All links between different sets are found; a
    list of common shingles is cut into tiles of 2 * tile_block sets, whose number grows with the list's square.
    Columns named in `carry` are added to their rows.
    """
    spark = docs.sparkSession
    everything = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                             *(F.col(f"`{c}`") for c in carry))
    texts = everything.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "text")
    shared = spark.sparkContext.broadcast(shingle_frequencies(texts, size, share))
    schema = StructType().add("doc_id", LongType()).add("n_shingles", LongType()).add("sign", BinaryType()).add("prefix", ArrayType(LongType()))
    for c in carry:
        schema.add(c, docs.schema[c].dataType)
    index = stage(everything.mapInArrow(partial(_index, size=size, percent=percent, shared=shared, carry=carry), schema))
    usable = index.where("doc_id IS NOT NULL AND sign IS NOT NULL")
    reps = usable.groupBy("sign").agg(F.min("doc_id").alias("rep"))
    single = usable.select(F.col("doc_id").alias("rep"), "sign", "n_shingles", "prefix").join(reps, ["rep", "sign"])
    meta = F.shiftleft("n_shingles", 32) + F.col("place").cast("long")
    postings = single.select("rep", "n_shingles", F.posexplode("prefix").alias("place", "token")).select("token", "rep", meta.alias("meta"))
    lengths = postings.groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    lists = stage(postings.join(lengths, "token"))
    short = lists.where(F.col("n") <= short_list).groupBy("token").agg(F.collect_list(F.struct("rep", "meta")).alias("entries"))
    seen = short.select("entries").mapInArrow(partial(_list_pairs, percent=percent), "x long, y long, slack long, shared long")
    # A pair must pass the place test at its first shared shingle, and share enough prefix shingles. Pairs that also
    # meet in long lists share more than is counted here, but their tiles find them.
    met = seen.where("x <> y").groupBy("x", "y").agg(F.count("*").alias("c"), F.max("slack").alias("slack"), F.max("shared").alias("shared"))
    pairs = stage(met.where("slack >= 0 AND c >= shared").select("x", "y"))
    blocks = F.ceil(F.col("n") / F.lit(tile_block)).cast("int")
    long = bundled(lists.where(F.col("n") > short_list).select("token", "rep", "n"), tile_block)
    dealt = long.select(
        "list", "rep", blocks.alias("blocks"), F.pmod(F.xxhash64("rep"), blocks).cast("int").alias("block"))
    dealt = dealt.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    tile = F.concat_ws("/", "list", F.least("block", "other"), F.greatest("block", "other"))
    asked = (
        pairs.select(F.concat(F.lit("p"), "x").alias("grp"), F.col("y").alias("member"))
        .unionByName(pairs.select(F.concat(F.lit("p"), "x").alias("grp"), F.col("x").alias("member")).distinct())
        .unionByName(dealt.select(tile.alias("grp"), F.col("rep").alias("member")))
    )
    fetched = asked.join(texts.withColumnRenamed("doc_id", "member"), "member")
    grouped = fetched.repartition("grp").sortWithinPartitions("grp")
    links = stage(grouped.mapInArrow(partial(_join_groups, size=size, percent=percent), "a long, b long"))
    parts = components(links)
    named = reps.join(parts, F.col("rep") == F.col("vertex"), "left").select(
        "sign", F.coalesce("component", "rep").alias("least"))
    out = index.select("doc_id", "n_shingles", "sign", *carry).join(named, "sign", "left")
    return out.select(F.col("doc_id").alias(id_col), "n_shingles", F.coalesce("least", "doc_id").alias("component_id"), *carry)
