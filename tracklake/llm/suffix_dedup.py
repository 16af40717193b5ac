"""Substring dedup: suffixes in groups by variable-length prefixes, and the deep nodes of each group's suffix tree.

The suffixes that matter start at windows whose words occur in another document too. To find them without shuffling
every suffix, each window picks one sequence of `anchor` words inside it, the one with the smallest hash; equal
windows pick equal ones. An anchor that occurs in one document only rules out all its windows.

Suffixes then meet by prefix. The prefix of a group is as long as its size demands: mostly the anchor alone, and
where that is too common, the whole window. A group under an anchor is a suffix tree, built from the top by edges of
some words: a node splits by the words of its next edge, and leaves are dropped as soon as they stand alone. Nodes
of window depth that are left are repeats, and the smallest document below a node keeps its copy. What each tree finds
is extended to the left and right by the neighbouring windows of the document, whose union is the maximal repeat.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklake.llm.words import Words, grams, mix, split_words, text_column
from tracklake.session import stage

ANCHOR = 25
EDGE = 10  # words of one edge of a tree
GROUP = 2000  # contexts that one tree may hold
_NONE = (1 << 63) - 1


def picks(part: Words, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: text, first and last window (word numbers), place and hash of the anchor."""
    hashes = part.hashes()
    every = grams(hashes, anchor)
    none = np.zeros(0, np.int64)
    span = window - anchor + 1
    if len(every) < span:
        return none, none, none, none, none.astype(np.uint64)
    # Leftmost smallest hash of each window, by ranges of doubling length.
    least, at, reach = every, np.arange(len(every)), 1
    while 2 * reach <= span:
        less = least[reach:] < least[:-reach]
        least, at = np.where(less, least[reach:], least[:-reach]), np.where(less, at[reach:], at[:-reach])
        reach *= 2
    if reach < span:
        shift = span - reach
        less = least[shift:] < least[:-shift]
        least, at = np.where(less, least[shift:], least[:-shift]), np.where(less, at[shift:], at[:-shift])
    counts = np.diff(part.bounds)
    owner = np.repeat(np.arange(len(counts)), counts)[: len(at)]
    whole = np.arange(len(at)) + window <= part.bounds[owner + 1]
    start = np.flatnonzero(whole)
    if not len(start):
        return none, none, none, none, none.astype(np.uint64)
    at, owner = at[start], owner[start]
    new = np.r_[True, (at[1:] != at[:-1]) | (owner[1:] != owner[:-1])]
    first = np.flatnonzero(new)
    last = np.r_[first[1:], len(start)] - 1
    return owner[first], start[first], start[last], at[first], every[at[first]]


def _ids(batch: pa.RecordBatch, name: str = "doc_id") -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _anchors(batches: Iterator[pa.RecordBatch], window: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = _ids(batch)
        for part in split_words(text_column(batch, "text")):
            owner, _, _, _, code = picks(part, window, anchor)
            yield pa.RecordBatch.from_arrays(
                [pa.array(code.view(np.int64)), pa.array(ids[part.first + owner])], names=["code", "doc_id"])


def _hits(batch: pa.RecordBatch, part: Words, window: int, anchor: int):
    """Anchors of texts that are in the row's list of shared ones."""
    owner, first, last, at, code = picks(part, window, anchor)
    lists = batch.column("codes").slice(part.first, part.last - part.first)
    lengths = np.array([len(v) if v.is_valid else 0 for v in lists])
    known = np.repeat(np.arange(len(lengths)), lengths)
    shared = np.concatenate([v.values.to_numpy().view(np.uint64) for v in lists if v.is_valid] or [np.zeros(0, np.uint64)])
    salt = lambda o, c: c ^ mix(o.astype(np.uint64))
    keep = np.isin(salt(owner, code), salt(known, shared))
    return owner[keep], first[keep], last[keep], at[keep], code[keep]


def _contexts(batches: Iterator[pa.RecordBatch], window: int, anchor: int, texts: bool) -> Iterator[pa.RecordBatch]:
    """Occurrences of shared anchors. With `texts` the words around them, one row for equal ones in a task's batch."""
    for batch in batches:
        ids = _ids(batch)
        for part in split_words(text_column(batch, "text")):
            rows: dict[bytes, list] = {}
            owner, first, last, at, code = _hits(batch, part, window, anchor)
            keys, docs, starts = [], [], []
            # Words are joined by one space so that equal word sequences are equal bytes.
            for o, a, b, p, c in zip(owner.tolist(), first.tolist(), last.tolist(), at.tolist(), code.view(np.int64).tolist()):
                lo, hi = part.starts[a], part.ends[b + window - 1]
                words = b" ".join(part.data[lo:hi].tobytes().split())
                key = hashlib.blake2b(words, digest_size=16, key=(p - a).to_bytes(4, "little")).digest()
                doc = int(ids[part.first + o])
                if texts:
                    known = rows.get(key)
                    if known is None:
                        rows[key] = [c, p - a, words, doc, False]
                    else:
                        known[3:] = min(known[3], doc), known[4] or known[3] != doc
                else:
                    keys.append(key)
                    docs.append(doc)
                    starts.append(a - int(part.bounds[o]))
            if texts:
                columns = [pa.array(list(rows), pa.binary())]
                columns += [pa.array([r[k] for r in rows.values()], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.bool_()))]
                yield pa.RecordBatch.from_arrays(columns, names=["context", "code", "lead", "words", "doc_id", "many"])
            else:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.binary()), pa.array(docs, pa.int64()), pa.array(starts, pa.int64())],
                    names=["context", "doc_id", "start"])


def tree_firsts(prefix: np.ndarray, first: np.ndarray, docs: np.ndarray, many: np.ndarray, hashes: np.ndarray, window: int) -> np.ndarray:
    """Smallest document of each suffix's node of depth `window`; _NONE for suffixes that are alone before that depth.

    prefix: number of the tree a suffix belongs to; first: place of its first word in `hashes`; docs: its smallest
    document; many: whether it stands for several documents, so that it is not alone.
    """
    out = np.full(len(first), _NONE, np.int64)
    alive = np.arange(len(first))
    node = prefix.astype(np.uint64)
    for depth in range(0, window, EDGE):
        edge = grams(hashes, min(EDGE, window - depth))
        node = mix(node) ^ edge[first[alive] + depth]
        _, node_id, size = np.unique(node, return_inverse=True, return_counts=True)
        inner = (size[node_id] > 1) | many[alive]
        alive, node = alive[inner], node[inner]
    if len(alive):
        _, node_id = np.unique(node, return_inverse=True)
        least = np.full(node_id.max() + 1, _NONE, np.int64)
        np.minimum.at(least, node_id, docs[alive])
        out[alive] = least[node_id]
    return out


def _suffixes(batch: pa.RecordBatch, window: int) -> tuple[np.ndarray, ...]:
    """All window starts of a batch of contexts: row, first word, and the words' hashes. A context holds whole windows."""
    hashes, rows, firsts, base = [], [], [], 0
    for part in split_words(batch.column("words")):
        hashes.append(part.hashes())
        counts = np.diff(part.bounds) - window + 1
        row = np.repeat(np.arange(len(counts)), counts)
        firsts.append(base + part.bounds[row] + np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts))
        rows.append(row + part.first)
        base += len(hashes[-1])
    return np.concatenate(rows), np.concatenate(firsts), np.concatenate(hashes)


def _trees(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Trees of whole groups; rows come sorted by anchor, and many small groups are built at once."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        for at in range(0, batch.num_rows, 4 * GROUP):
            piece = batch.slice(at, 4 * GROUP)
            held.append(piece)
            size += piece.num_rows
            code = _ids(piece, "code")
            if size >= 4 * GROUP and code[0] != code[-1]:
                cut = int(np.flatnonzero(code != code[-1])[-1]) + 1
                held[-1] = piece.slice(0, cut)
                yield _build(held, window)
                held, size = [piece.slice(cut)], piece.num_rows - cut
    if size:
        yield _build(held, window)


def _build(held: list[pa.RecordBatch], window: int) -> pa.RecordBatch:
    batch = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    row, first, hashes = _suffixes(batch, window)
    docs = _ids(batch)[row]
    code = _ids(batch, "code").view(np.uint64)
    lead = _ids(batch, "lead")
    offset = first - np.r_[0, np.cumsum(np.bincount(row, minlength=batch.num_rows) + window - 1)[:-1]][row]
    # Suffixes of one tree start equally far before their anchor, else they cannot be equal.
    prefix = mix(code[row]) ^ (lead[row] - offset).astype(np.uint64)
    least = tree_firsts(prefix, first, docs, _ids(batch, "many")[row].astype(bool), hashes, window)
    bounds = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(bounds), pa.array(least))
    return pa.RecordBatch.from_arrays([batch.column("context"), lists], names=["context", "firsts"])


def _long_prefixes(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Suffixes under anchors that are too common for one tree: one row each, keyed by all words of the window."""
    for batch in batches:
        for at in range(0, batch.num_rows, GROUP):
            piece = batch.slice(at, GROUP)
            contexts, docs = piece.column("context").to_pylist(), _ids(piece)
            keys, out, place, doc = [], [], [], []
            for k, words in enumerate(piece.column("words").to_pylist()):
                split = words.split()
                for i in range(len(split) - window + 1):
                    keys.append(hashlib.blake2b(b" ".join(split[i : i + window]), digest_size=16).digest())
                    out.append(contexts[k])
                    place.append(i)
                    doc.append(int(docs[k]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(out, pa.binary()), pa.array(place, pa.int32()), pa.array(doc, pa.int64())],
                names=["suffix", "context", "place", "doc_id"])


def _kept(batches: Iterator[pa.RecordBatch], window: int, with_text: bool) -> Iterator[pa.RecordBatch]:
    """Texts without the words that some repeated window covers."""
    for batch in batches:
        ids = batch.column("doc_id")
        for part in split_words(text_column(batch, "text")):
            n = part.last - part.first
            gone = np.zeros(len(part.starts) + 1, np.int64)
            lists = batch.column("starts").slice(part.first, n)
            for k, value in enumerate(lists):
                if value.is_valid:
                    at = np.unique(value.values.to_numpy()) + part.bounds[k]
                    # Places come from any row of the id; they end with this row's words.
                    np.add.at(gone, np.minimum(at, part.bounds[k + 1]), 1)
                    np.add.at(gone, np.minimum(at + window, part.bounds[k + 1]), -1)
            stay = np.cumsum(gone)[:-1] <= 0
            words, removed, digests, texts = np.diff(part.bounds), [], [], []
            data = part.data.tobytes()
            for k in range(n):
                a, b = part.bounds[k], part.bounds[k + 1]
                here = stay[a:b]
                removed.append(int(b - a - here.sum()))
                if here.all():
                    text = b" ".join(data[part.texts[k] : part.texts[k + 1]].split())
                else:
                    text = b" ".join([data[s:e] for s, e in zip(part.starts[a:b][here].tolist(), part.ends[a:b][here].tolist())])
                digests.append(hashlib.sha256(text).hexdigest())
                texts.append(text if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(part.first, n), pa.array(words.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests),
                 pa.array(texts, pa.binary())], names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50, anchor: int = ANCHOR,
                   group: int = GROUP, with_text: bool = False) -> DataFrame:
    """Texts without passages of `window` or more words that a document with a smaller id has too.

    Returns id, n_words, n_removed, kept_sha256 (kept words joined by one space) and, if asked for, kept_text. Windows are judged
    on the input. Null and empty texts have no words. Rows without an id keep everything and cause no loss. Rows with
    one id are one document: they do not remove each other's words, and each loses the words at the places of windows found
    in any of them, as far as it has words there, so ids should be unique. An empty table gives an empty result.
    """
    everything = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    texts = everything.where("doc_id IS NOT NULL AND text IS NOT NULL")
    run = {"window": window, "anchor": anchor}
    anchors = stage(texts.mapInArrow(partial(_anchors, **run), "code long, doc_id long"))
    shared = anchors.groupBy("code").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("code")
    codes = anchors.join(shared, "code").groupBy("doc_id").agg(F.collect_set("code").alias("codes"))
    hits = stage(codes)
    marked = texts.join(hits, "doc_id")
    wide = stage(marked.mapInArrow(partial(_contexts, texts=True, **run), "context binary, code long, lead int, words binary, doc_id long, many boolean"), "zstd")
    sizes = wide.groupBy("code").agg(F.count("*").alias("n"))
    large = sizes.where(F.col("n") > group).select("code")
    small = wide.join(large, "code", "left_anti")
    trees = small.repartition("code").sortWithinPartitions("code").mapInArrow(partial(_trees, window=window), "context binary, firsts array<long>")
    by_tree = trees.select("context", F.posexplode("firsts").alias("place", "low")).where(F.col("low") < _NONE)
    suffixes = wide.join(large, "code").select("context", "words", "doc_id").mapInArrow(
        partial(_long_prefixes, window=window), "suffix binary, context binary, place int, doc_id long")
    lows = suffixes.groupBy("suffix").agg(F.min("doc_id").alias("low"))
    by_prefix = suffixes.select("suffix", "context", "place").join(lows, "suffix").select("context", "place", "low")
    repeats = stage(by_tree.unionByName(by_prefix).groupBy("context", "place").agg(F.min("low").alias("low")))
    places = marked.mapInArrow(partial(_contexts, texts=False, **run), "context binary, doc_id long, start long")
    found = places.join(repeats, "context").where(F.col("low") < F.col("doc_id"))
    starts = found.groupBy("doc_id").agg(F.collect_list(F.col("start") + F.col("place")).alias("starts"))
    cut = everything.join(starts, "doc_id", "left").mapInArrow(
        partial(_kept, window=window, with_text=with_text), "doc_id long, n_words long, n_removed long, kept_sha256 string, kept binary")
    more = [F.col("kept").cast("string").alias("kept_text")] if with_text else []
    return cut.select(F.col("doc_id").alias(id_col), "n_words", "n_removed", "kept_sha256", *more)
