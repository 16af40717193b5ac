"""Quality classifier: nearest-neighbour voting among labelled latent-semantic vectors."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from tracklake.llm.words import mix, split_words, text_column

BUCKETS = 1024  # hashed features: three-byte sequences, and shapes of words
TOPICS = 64
TRAINING_ROWS = 4096  # bound of the labelled sample
NEIGHBOURS = 15
COPIES = 12  # buckets of a marked kind of word
BLOCK = 256  # documents whose cosines are held at once

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _bucket(codes: np.ndarray, salt: int) -> np.ndarray:
    return (mix(codes.astype(np.uint64) + np.uint64(salt << 56)) >> np.uint64(54)).astype(np.int64)


def counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Feature counts of whole texts, some hundred rows at a time, in order."""
    for part in split_words(column):
        n, size = part.last - part.first, len(part.data)
        owner = np.repeat(np.arange(n), np.diff(part.texts))
        found = np.zeros(n * BUCKETS, np.int64)
        if size >= 3:
            wide = part.data.astype(np.uint64)
            codes = (wide[:-2] << np.uint64(16)) | (wide[1:-1] << np.uint64(8)) | wide[2:]
            inside = owner[:-2] == owner[2:]
            found += np.bincount((owner[:-2] * BUCKETS + _bucket(codes, 1))[inside], minlength=n * BUCKETS)
        if len(part.starts):
            ends = part.data[part.ends - 1].astype(np.uint64)
            shape = np.minimum(part.ends - part.starts, 15).astype(np.uint64)
            upper = ((part.data[part.starts] >= 65) & (part.data[part.starts] <= 90)).astype(np.uint64)
            codes = (ends << np.uint64(8)) | (shape << np.uint64(1)) | upper
            of_word = owner[part.starts]
            found += np.bincount(of_word * BUCKETS + _bucket(codes, 2), minlength=n * BUCKETS)
            # Words that repeat the word before, and words without letters or digits, count in several buckets each,
            # so that they weigh something beside the many byte sequences.
            hashes = part.hashes()
            again = np.zeros(len(hashes), bool)
            again[1:] = (hashes[1:] == hashes[:-1]) & (of_word[1:] == of_word[:-1])
            first = part.data[part.starts]
            bare = (part.ends - part.starts == 1) & ~_LETTER[first]
            for salt, rows in ((3, of_word[again]), (4, of_word[bare])):
                for bucket in _bucket(np.arange(COPIES), salt):
                    found += np.bincount(rows * BUCKETS + bucket, minlength=n * BUCKETS)
        matrix = found.reshape(n, BUCKETS)
        for a in range(0, n, BLOCK):
            yield matrix[a : a + BLOCK]


def _scaled(matrix: np.ndarray, idf: np.ndarray) -> np.ndarray:
    x = np.log1p(matrix) * idf
    length = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return x / np.where(length > 0, length, 1)


@dataclass
class Model:
    """What scoring needs; its size is fixed by the parameters, not by the data."""

    idf: np.ndarray
    topics: np.ndarray  # BUCKETS x TOPICS
    vectors: np.ndarray  # unit vectors of the labelled rows
    labels: np.ndarray
    prior: float

    def embed(self, matrix: np.ndarray) -> np.ndarray:
        x = _scaled(matrix, self.idf) @ self.topics
        length = np.sqrt((x * x).sum(axis=1, keepdims=True))
        return x / np.where(length > 0, length, 1)

    def score(self, matrix: np.ndarray, neighbours: int) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest labelled vectors; the prior counts like a faint one."""
        if not len(self.labels):
            return np.full(len(matrix), self.prior)
        cosine = self.embed(matrix) @ self.vectors.T
        k = min(neighbours, cosine.shape[1])
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
        weight = np.maximum(np.take_along_axis(cosine, near, 1), 0) ** 8
        faint = 1e-3
        return ((weight * self.labels[near]).sum(axis=1) + faint * self.prior) / (weight.sum(axis=1) + faint)


def fit(matrix: np.ndarray, labels: np.ndarray) -> Model:
    """Inverse document frequencies, leading right singular vectors, and the labelled rows' vectors."""
    if not len(labels):
        return Model(np.ones(BUCKETS), np.zeros((BUCKETS, 1)), np.zeros((0, 1)), labels.astype(float), 0.5)
    idf = np.log((1 + len(matrix)) / (1 + (matrix > 0).sum(axis=0))) + 1
    x = _scaled(matrix, idf)
    values, vectors = np.linalg.eigh(x.T @ x)
    topics = vectors[:, np.argsort(-values, kind="stable")[:TOPICS]]
    model = Model(idf, topics, np.zeros((0, 1)), labels.astype(float), float(labels.mean()))
    model.vectors = model.embed(matrix)
    return model


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = 0
        for matrix in counts(text_column(batch, "text")):
            rows = pa.array([r.astype(np.int32).tobytes() for r in matrix], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("label").slice(at, len(rows)), batch.column("id").slice(at, len(rows)), rows], names=["label", "id", "counts"])
            at += len(rows)


def held_out(key) -> object:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(5)) == 0


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                training_rows: int = TRAINING_ROWS) -> Model:
    """Fit on at most `training_rows` labelled rows, those with the smallest hashes of their ids, none of them held out.

    Of rows that share an id one counts: that whose text has the smallest hash, a null text only if there is no other.
    """
    key = F.col(f"`{id_col}`")
    marked = labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    chosen = marked.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(training_rows)
    texts = docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # The sample is bounded, so it may be broadcast; the texts are not shuffled.
    one = F.min(F.struct(F.isnull("text"), F.xxhash64("text"), "text"))
    sample = texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(one.alias("one")).select("id", "label", "one.text")
    rows = sample.mapInArrow(_features, "label int, id long, counts binary").collect()
    rows.sort(key=lambda r: (r["id"], bytes(r["counts"])))
    matrix = np.stack([np.frombuffer(r["counts"], np.int32) for r in rows]) if rows else np.zeros((0, BUCKETS))
    return fit(matrix, np.array([r["label"] for r in rows], dtype=float))


def score_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
                  training_rows: int = TRAINING_ROWS, neighbours: int = NEIGHBOURS, accept: float = 0.3, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= accept).

    The model is an LSA of hashed features and the unit vectors of a bounded labelled sample; it is broadcast, and
    its size depends on the parameters only. Every document's cosines with all labelled vectors are computed exactly,
    block by block, and its nearest neighbours vote with their similarity. Texts are the only input of a
    score. Null and empty texts have no features and get the share of label 1 in the sample, as do all documents when nothing
    is labelled (then 0.5). Labels that are null or have no id are not used; of repeated labels the larger counts. Rows
    without an id are scored and not held out. An empty table gives an empty result. Columns named in `carry` are added
    to their rows.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_quality(docs, labels, id_col, text_col, label_col, training_rows))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.value.score(m, neighbours) for m in counts(text_column(batch, "text"))]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores), *(batch.column(c) for c in carry)], names=["id", "score", *carry])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
                        *(F.col(f"`{c}`") for c in carry))
    schema = StructType().add("id", LongType()).add("score", DoubleType())
    for c in carry:
        schema.add(c, docs.schema[c].dataType)
    out = texts.mapInArrow(scored, schema)
    return out.select(
        F.col("id").alias(id_col), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= accept, 1).otherwise(0).alias("predicted"), *carry)
