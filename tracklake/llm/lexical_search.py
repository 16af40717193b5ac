"""Ranked lexical search: per-term geometric blocking with coordinatewise-maximum summaries.

Documents become sparse vectors over the terms of the queries. A shard of documents holds a posting list per term; each
list is clustered by the similarity of its documents into small blocks, and a block stores, per coordinate, the largest
impact of its documents. A query's product with that summary is at least the score of every document of the block, so a
block is skipped only if its bound is below the score that a result needs at least. All scores are whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tracklake.llm.words import split_words, text_column
from tracklake.session import stage

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_GAP = np.ones(256, bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
QUERY_TERMS = 16_384  # terms of the queries that are answered in one pass over the documents
SHARD = 2048  # documents whose lists are clustered together
BLOCK = 64  # documents of a block at most
SKETCH = 32  # dimensions in which documents are compared for clustering
WARM = 16_384  # documents, about, that give the first thresholds
TASK = 8 * SHARD  # documents that a task searches, whatever the size of the table


@dataclass
class Queries:
    """Queries of one pass: their terms as indices into the vocabulary. Held by every task; bounded by `QUERY_TERMS`."""

    names: list
    terms: list[np.ndarray]
    hashes: np.ndarray  # of the vocabulary, ascending
    sizes: np.ndarray  # byte length of each term
    asked: list[np.ndarray]  # per term, the terms of all queries that have it
    places: list[list[np.ndarray]]  # per query and term of it, where the query's terms are in `asked`


def term_queries(rows: list) -> Queries:
    """From rows of (name, distinct terms)."""
    vocabulary = sorted({t for r in rows for t in r[1]})
    parts = list(split_words(pa.array(vocabulary, pa.large_string()), space=_GAP))
    hashes = np.concatenate([p.hashes() for p in parts]) if parts else np.zeros(0, np.uint64)
    order = np.argsort(hashes, kind="stable")
    place = {vocabulary[k]: i for i, k in enumerate(order)}
    sizes = np.array([len(vocabulary[k].encode()) for k in order], np.int64)
    terms = [np.array(sorted(place[t] for t in r[1]), np.int64) for r in rows]
    having: list[list[np.ndarray]] = [[] for _ in vocabulary]
    for query in terms:
        for t in query:
            having[t].append(query)
    asked = [np.unique(np.concatenate(h)) for h in having]
    places = [[np.searchsorted(asked[t], query) for t in query] for query in terms]
    return Queries([r[0] for r in rows], terms, hashes[order], sizes, asked, places)


def term_counts(column: pa.Array, queries: Queries) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk of whole texts: terms of each text, and its counts of the queries' terms as (offsets, terms, counts)."""
    width = max(1, len(queries.hashes))
    for part in split_words(column, lower=True, space=_GAP):
        n = part.last - part.first
        total = np.diff(part.bounds)
        found, size = part.hashes(), part.ends - part.starts
        at = np.minimum(np.searchsorted(queries.hashes, found), width - 1)
        hit = (queries.hashes[at] == found) & (queries.sizes[at] == size) if len(queries.hashes) else np.zeros(len(found), bool)
        cells, counts = np.unique(np.repeat(np.arange(n), total)[hit] * width + at[hit], return_counts=True)
        yield total, np.searchsorted(cells, np.arange(n + 1) * width), cells % width, counts


class Shard:
    """Vectors of some documents and their blocked posting lists.

    A block's summary holds the coordinates that some query with the list's term asks for: no other query looks at the block.
    """

    def __init__(self, offsets: np.ndarray, terms: np.ndarray, impacts: np.ndarray, queries: Queries, block: int = BLOCK):
        self.queries = queries
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.vectors = np.zeros((len(offsets) - 1, len(queries.hashes)), np.int32)
        self.vectors[owner, terms] = impacts
        self._cluster(owner, terms, block)
        self._summarize()

    def _sketches(self) -> np.ndarray:
        """Unit vectors of a random projection, near for documents with similar vectors."""
        signs = np.random.default_rng(7).choice(np.array([-1, 1], np.float32), (self.vectors.shape[1], SKETCH))
        out = self.vectors.astype(np.float32) @ signs
        length = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return out / np.where(length > 0, length, 1)

    def _cluster(self, owner: np.ndarray, terms: np.ndarray, block: int) -> None:
        """Postings in order of term, then cluster; a block is a run of at most `block` of one cluster."""
        order = np.argsort(terms, kind="stable")
        docs = owner[order]
        bounds = np.searchsorted(terms[order], np.arange(self.vectors.shape[1] + 1))
        cluster = np.zeros(len(docs), np.int64)
        sketches = self._sketches()
        for term in np.flatnonzero(np.diff(bounds) > block):
            a, b = bounds[term], bounds[term + 1]
            mine = sketches[docs[a:b]]
            centres = mine[np.linspace(0, b - a - 1, -(-(b - a) // block)).astype(int)]
            nearest = np.argmax(mine @ centres.T, axis=1)
            inside = np.argsort(nearest, kind="stable")
            docs[a:b], cluster[a:b] = docs[a:b][inside], nearest[inside]
        term_of = np.repeat(np.arange(self.vectors.shape[1]), np.diff(bounds))
        new = np.ones(len(docs), bool)
        new[1:] = (term_of[1:] != term_of[:-1]) | (cluster[1:] != cluster[:-1])
        heads = np.flatnonzero(new)
        run = np.arange(len(docs)) - np.repeat(heads, np.diff(np.append(heads, len(docs))))
        starts = np.flatnonzero(run % block == 0)
        self.members = docs
        self.blocks = np.append(starts, len(docs))  # bounds of the blocks in `members`
        self.lists = np.searchsorted(starts, bounds)  # bounds of the terms' lists in the blocks

    def _summarize(self) -> None:
        """Per term, the largest impact per block and coordinate."""
        self.summaries: dict[int, np.ndarray] = {}
        for term in np.flatnonzero(np.diff(self.lists)):
            starts = self.blocks[self.lists[term] : self.lists[term + 1] + 1]
            rows = self.vectors[self.members[starts[0] : starts[-1]][:, None], self.queries.asked[term]]
            self.summaries[int(term)] = np.maximum.reduceat(rows, starts[:-1] - starts[0], axis=0)

    def scores(self, docs: np.ndarray, query: int, weights: np.ndarray) -> np.ndarray:
        return self.vectors[docs[:, None], self.queries.terms[query]].astype(np.int64) @ weights

    def bounds(self, query: int, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Blocks of the query's lists, and for each at least the score of every document in it."""
        blocks, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for term, places in zip(self.queries.terms[query], self.queries.places[query]):
            if (summary := self.summaries.get(int(term))) is not None:
                blocks.append(np.arange(self.lists[term], self.lists[term + 1]))
                found.append(summary[:, places].astype(np.int64) @ weights)
        return np.concatenate(blocks), np.concatenate(found)

    def members_of(self, blocks: np.ndarray) -> np.ndarray:
        sizes = self.blocks[blocks + 1] - self.blocks[blocks]
        before = np.cumsum(sizes) - sizes
        return np.unique(self.members[np.arange(sizes.sum()) + np.repeat(self.blocks[blocks] - before, sizes)])

    def best(self, query: int, weights: np.ndarray, top: int, least: int) -> tuple[np.ndarray, np.ndarray, int]:
        """All documents that can be among the `top` and score at least `least`, their scores, and the blocks skipped.

        `weights` are those of the query's terms. Documents that tie with the last one are all in it.
        """
        # Every document with a term of the query is in a block of one of its lists.
        ours, bound = self.bounds(query, weights)
        every = len(ours)
        order = np.argsort(-bound, kind="stable")
        order = order[bound[order] >= max(1, least)]
        ours, bound = ours[order], bound[order]
        sizes = np.cumsum(self.blocks[ours + 1] - self.blocks[ours])
        # The most promising blocks first; their scores raise the threshold for the others.
        first = int(np.searchsorted(sizes, 2 * top)) + 1
        docs = self.members_of(ours[:first])
        found = self.scores(docs, query, weights)
        if len(docs) >= top:
            least = max(least, int(np.partition(found, len(found) - top)[len(found) - top]))
        rest = ours[first:][bound[first:] >= least]
        more = np.setdiff1d(self.members_of(rest), docs, assume_unique=True)
        docs, found = np.concatenate([docs, more]), np.concatenate([found, self.scores(more, query, weights)])
        if len(docs) >= top:
            least = max(least, int(np.partition(found, len(found) - top)[len(found) - top]))
        good = found >= max(1, least)
        return docs[good], found[good], every - min(first, len(ours)) - len(rest)


def impact(tf: np.ndarray, n: np.ndarray, documents: int, terms: int) -> np.ndarray:
    """A term's saturated frequency in a document of `n` terms, in whole numbers."""
    norm = 100 - 50 + (50 * n * documents) // terms
    return (1_000_000_000 * tf) // (1000 * tf + 20 * norm)


def term_weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def _vectors(docs: DataFrame, queries, id_col: str, text_col: str) -> DataFrame:
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for total, offsets, terms, counts in term_counts(text_column(batch, "text"), queries.value):
                lists = (pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(x, pa.int32())) for x in (terms, counts))
                yield pa.RecordBatch.from_arrays([batch.column("id").slice(at, len(total)), pa.array(total, pa.int64()), *lists], names=["id", "n", "terms", "counts"])
                at += len(total)

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return texts.mapInArrow(counted, "id long, n long, terms array<int>, counts array<int>")


def _flat(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    offsets = column.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], column.values.to_numpy()[offsets[0] : offsets[-1]].astype(np.int64)


def _sums(vectors: DataFrame, width: int) -> tuple[int, int, np.ndarray]:
    """Documents with terms, all terms, and documents per query term. One line per term and task is shuffled."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2, np.int64)
        for batch in batches:
            n = batch.column("n").to_numpy()
            total[:width] += np.bincount(_flat(batch, "terms")[1], minlength=width)
            total[width] += (n > 0).sum()
            total[width + 1] += n.sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(total)), pa.array(total[total != 0])], names=["at", "n"])

    out = np.zeros(width + 2, np.int64)
    for at, n in vectors.select("n", "terms").mapInArrow(summed, "at long, n long").groupBy("at").agg(F.sum("n")).collect():
        out[at] = n
    return int(out[width]), int(out[width + 1]), out[:width]


def _search(vectors: DataFrame, queries, weights, least, documents: int, terms: int, top: int) -> DataFrame:
    """Per shard and query, the documents that can be among the best."""

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, SHARD):
                batch = whole.slice(a, SHARD)
                offsets, held = _flat(batch, "terms")
                n = batch.column("n").to_numpy()
                tf = _flat(batch, "counts")[1]
                shard = Shard(offsets, held, impact(tf, np.repeat(n, np.diff(offsets)), documents, terms), queries.value)
                names, docs, scores = [], [], []
                for q, query in enumerate(queries.value.terms):
                    found, score, _ = shard.best(q, weights.value[query], top, int(least.value[q]))
                    names.append(np.full(len(found), q)), docs.append(found), scores.append(score)
                places = pa.array(np.concatenate(docs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(names), pa.int32()), batch.column("id").take(places), pa.array(np.concatenate(scores))], names=["query", "id", "score"])

    found = vectors.mapInArrow(searched, "query int, id long, score long")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top)


def ranked_search(docs: DataFrame, items: DataFrame, top: int = 50, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text: str = "text", query_terms: int = QUERY_TERMS) -> DataFrame:
    """The `top` documents of each item: item_col, rank, id_col, score.

    All documents and whole texts count. Null and empty texts have no terms; they are no result and not among the counted
    documents. Rows without an id are ranked after others of their score and give a null id; repeated rows are documents of their own.
    Each row of `items` is a query of its own; one without terms, or whose terms no document has, gives no row. Empty tables
    give an empty result. Columns with other names are ignored.

    Items are answered in passes whose items hold about `query_terms` terms together (one item's terms stay together), so
    what tasks are sent is bounded. Per pass, texts are read once; vectors over the queries' terms are written to the shared folder
    and read for document frequencies, for first thresholds (about `WARM` documents; they only help to skip), and for
    the search. A shard sends on no more than its best documents and those that tie with the last of them.
    """
    spark = docs.sparkSession
    lowered = F.translate(F.col(f"`{item_text}`").cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    asked = stage(items.select(F.col(f"`{item_col}`").alias("name"), F.array_distinct(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("terms"))
                  .where("size(terms) > 0"))
    passes = max(1, -(-(asked.agg(F.sum(F.size("terms"))).first()[0] or 0) // query_terms))
    results = []
    for k in range(passes):
        rows = asked.where(F.pmod(F.xxhash64("name", "terms"), F.lit(passes)) == k).collect()
        if not rows:
            continue
        plain = term_queries([tuple(r) for r in sorted(rows, key=repr)])
        queries = spark.sparkContext.broadcast(plain)
        vectors = stage(_vectors(docs, queries, id_col, text_col))
        documents, terms, df = _sums(vectors, len(plain.hashes))
        if not documents:
            continue
        weights = spark.sparkContext.broadcast(np.array([term_weight(documents, int(n)) for n in df], np.int64))
        some = vectors.where(F.pmod(F.xxhash64("id"), F.lit(max(4, documents // WARM))) == 0)
        zero = spark.sparkContext.broadcast(np.zeros(len(rows), np.int64))
        least = np.zeros(len(rows), np.int64)
        for r in _search(some, queries, weights, zero, documents, terms, top).where(F.col("rank") == top).select("query", "score").collect():
            least[r["query"]] = r["score"]
        dealt = vectors.repartition(-(-documents // TASK))  # vectors are small beside the work they make
        found = _search(dealt, queries, weights, spark.sparkContext.broadcast(least), documents, terms, top)
        kind = items.schema[item_col].dataType
        named = spark.createDataFrame(list(enumerate(plain.names)), f"query int, `{item_col}` {kind.simpleString()}")
        results.append(found.join(F.broadcast(named), "query").select(
            F.col(f"`{item_col}`"), F.col("rank").cast("int").alias("rank"), F.col("id").alias(id_col), "score"))
    if not results:
        return items.select(F.col(f"`{item_col}`"), F.lit(0).alias("rank"), F.lit(0).cast("long").alias(id_col), F.lit(0).cast("long").alias("score")).limit(0)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
