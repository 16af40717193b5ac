"""Toxicity by weak supervision: many lexicon and pattern voters, a generative label model, and a linear classifier.

Voters look at a text and fire or not: fixed word lists, patterns of typing, and single words, word beginnings and word
ends that the labelled sample shows to go with toxic texts. The label model is a Bayesian forest: every voter depends on
the hidden label and on at most one other voter, so that it learns accuracies and correlations; the given label is
one more fallible voter. The classifier is trained on the model's posterior labels.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructType

from tracklake.llm.words import Words, mix, polynomial, split_words, text_column
from tracklake.session import stage

TRAINING_ROWS = 4096  # bound of the labelled sample
MINED = 256  # bound of the voters that are found in it
SUPPORT = 4  # toxic texts that a found voter needs
BAG = 1024  # hashed words beside the voters
_GAP = np.ones(256, bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_UPPER = np.zeros(256, bool)
_UPPER[range(0x41, 0x5B)] = True
_LOWER_CASE = np.arange(256, dtype=np.uint8)
_LOWER_CASE[0x41:0x5B] += 32

# Word lists: a text with any word of a list makes its voter fire.
LEXICONS = {
    "insult en": "idiot idiots moron morons stupid dumb fool loser losers scum trash garbage clown pathetic worthless disgusting creep jerk coward",
    "insult de": "idiot idioten dumm dummkopf trottel versager abschaum dreckig widerlich feigling wertlos",
    "insult fr": "idiot idiote stupide imbécile crétin ordure minable dégoûtant lâche nul",
    "insult es": "idiota estúpido estúpida imbécil basura asqueroso cobarde patético inútil",
    "threat": "kill die hurt destroy beat burn töten sterben tuer mourir matar morir",
    "curse": "damn hell crap shit fuck fucking bitch bastard scheiße arsch merde putain mierda puta",
    "address": "you your yours du dein dich tu ton toi vous usted tú",
    "courtesy": "please thanks thank welcome bitte danke merci gracias",
}
PATTERNS = ("shouting", "exclamation", "masked letters", "drawn-out letters", "few words", "many digits")


@dataclass
class Units:
    """Words of a chunk of texts and what voters can be made of them."""

    kinds: list[np.ndarray]  # hashes of whole words, beginnings of 4 and 5 bytes, and ends of 4; 0: none
    owner: np.ndarray  # text of each word
    words: np.ndarray  # words of each text
    patterns: np.ndarray  # texts x patterns


def units_of(part: Words) -> Units:
    n = part.last - part.first
    words = np.diff(part.bounds)
    owner = np.repeat(np.arange(n), words)
    data = _LOWER_CASE[part.data].astype(np.uint64) + np.uint64(1)
    size = part.ends - part.starts
    kinds = [polynomial(data, part.starts, part.ends)]
    for salt, low, high, long in ((1, part.starts, part.starts + 4, size > 4), (2, part.starts, part.starts + 5, size > 5), (3, part.ends - 4, part.ends, size > 4)):
        cut = np.zeros(len(size), np.uint64)
        cut[long] = mix(polynomial(data, low[long], high[long]) + np.uint64(salt))
        kinds.append(cut)
    of_byte = np.repeat(np.arange(n), np.diff(part.texts))

    def share(marks: np.ndarray) -> np.ndarray:
        return np.bincount(of_byte[: len(marks)][marks], minlength=n)

    raw = part.data
    star = raw == ord("*")
    masked = star[1:-1] & ~_GAP[raw[:-2]] & (star[2:] | ~_GAP[raw[2:]]) if len(raw) > 2 else np.zeros(0, bool)
    drawn = (raw[3:] == raw[2:-1]) & (raw[2:-1] == raw[1:-2]) & (raw[1:-2] == raw[:-3]) & ~_GAP[raw[3:]] if len(raw) > 3 else np.zeros(0, bool)
    bytes_ = np.maximum(np.diff(part.texts), 1)
    capital = share(_UPPER[raw])
    patterns = np.stack([
        capital * 3 > share(~_GAP[raw]), share(raw == ord("!")) * 200 > bytes_, share(masked) > 0, share(drawn) > 0, words < 20,
        share((raw >= 0x30) & (raw < 0x3A)) * 10 > bytes_], axis=1)
    return Units(kinds, owner, words, patterns)


def unit_counts(part: Words, units: np.ndarray) -> tuple[np.ndarray, Units]:
    """How often each of the sorted `units` occurs in each text of a chunk."""
    found = units_of(part)
    n, width = part.last - part.first, len(units)
    counts = np.zeros(n * width, np.int64)
    if width:
        for hashes in found.kinds:
            at = np.minimum(np.searchsorted(units, hashes), width - 1)
            hit = (units[at] == hashes) & (hashes != 0)
            counts += np.bincount(found.owner[hit] * width + at[hit], minlength=n * width)
    return counts.reshape(n, width), found


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes + np.uint64(9)) >> np.uint64(54)).astype(np.int64) % BAG


def chunks(column: pa.Array) -> Iterator[Words]:
    return split_words(column, space=_GAP)


def word_hashes(words: Sequence[str]) -> np.ndarray:
    parts = [units_of(p).kinds[0] for p in chunks(pa.array(list(words), pa.string()))]
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


@dataclass
class LabelModel:
    """P(label) and P(voter fires | label, its parent fires): a forest over the voters."""

    prior: float = 0.5
    parent: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))  # -1: none
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 2, 2)))  # voter, label, parent fires

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        above = np.where(self.parent >= 0, votes[:, self.parent], 0)
        voter = np.arange(votes.shape[1])
        odds = np.full(len(votes), np.log(self.prior / (1 - self.prior)))
        for y, sign in ((1, 1), (0, -1)):
            p = self.table[voter, y, above]
            odds += sign * np.where(votes == 1, np.log(p), np.log(1 - p)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Share of label 1 among the texts on which each voter fires by itself."""
        hit, miss = self.prior * self.table[:, 1, 0], (1 - self.prior) * self.table[:, 0, 0]
        return hit / (hit + miss)


def _information(votes: np.ndarray, posterior: np.ndarray) -> np.ndarray:
    """Mutual information of each two voters given the label."""
    total = np.zeros((votes.shape[1],) * 2)
    for weight in (posterior, 1 - posterior):
        n = weight.sum() + 1e-9
        v = votes.astype(float)
        both = (v * weight[:, None]).T @ v / n
        one = np.diag(both)
        for a, b, cell in ((one[:, None], one[None], both), (1 - one[:, None], one[None], one[None] - both),
                           (one[:, None], 1 - one[None], one[:, None] - both), (1 - one[:, None], 1 - one[None], 1 - one[:, None] - one[None] + both)):
            cell = np.maximum(cell, 0)
            total += n / len(votes) * np.where(cell > 1e-12, cell * np.log(np.maximum(cell, 1e-12) / np.maximum(a * b, 1e-12)), 0)
    np.fill_diagonal(total, 0)
    return total


def correlated_with(information: np.ndarray, least: float) -> np.ndarray:
    """Parent of each voter in the forest of the strongest correlations; -1 where none reaches `least`."""
    n = len(information)
    parent, done = np.full(n, -1), np.zeros(n, bool)
    best, source = np.zeros(n), np.full(n, -1)
    for _ in range(n):
        at = int(np.argmax(np.where(done, -1, best)))
        done[at] = True
        if best[at] >= least:
            parent[at] = source[at]
        closer = ~done & (information[at] > best)
        best[closer], source[closer] = information[at][closer], at
    return parent


def fit_label_model(votes: np.ndarray, start: np.ndarray, rounds: int = 20, least: float = 2e-3) -> tuple[LabelModel, np.ndarray]:
    """Expectation maximization from the posterior `start`; the correlations are found anew while it settles."""
    posterior = np.clip(start, 0.02, 0.98)
    model = LabelModel(parent=np.full(votes.shape[1], -1))
    for k in range(rounds):
        if k in (1, 5):
            model.parent = correlated_with(_information(votes, posterior), least)
        model.prior = float(np.clip(posterior.mean(), 1e-3, 1 - 1e-3))
        model.table = np.empty((votes.shape[1], 2, 2))
        above = np.where(model.parent >= 0, votes[:, model.parent], 0)
        for y, weight in ((0, 1 - posterior), (1, posterior)):
            plain = (votes * weight[:, None]).sum(axis=0) / max(weight.sum(), 1e-9)
            for fires in (0, 1):
                w = weight[:, None] * (above == fires)
                # Cells without rows lean on the voter's own rate.
                rate = ((votes * w).sum(axis=0) + 2 * plain) / (w.sum(axis=0) + 2)
                model.table[:, y, fires] = np.clip(rate, 1e-3, 1 - 1e-3)
        posterior = model.posterior(votes)
    return model, posterior


def fit_linear(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 400) -> np.ndarray:
    """Logistic regression on soft labels; the last weight is the constant."""
    x = np.hstack([x, np.ones((len(x), 1))])
    theta, speed, square = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    held = np.append(np.full(x.shape[1] - 1, penalty), 0)
    for k in range(1, rounds + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ theta, -30, 30)))
        slope = x.T @ (p - y) / len(x) + held * theta
        speed, square = 0.9 * speed + 0.1 * slope, 0.99 * square + 0.01 * slope * slope
        theta -= 0.1 * (speed / (1 - 0.9**k)) / (np.sqrt(square / (1 - 0.99**k)) + 1e-8)
    return theta


@dataclass
class Model:
    """What scoring needs; its size is fixed by the parameters."""

    units: np.ndarray  # sorted hashes
    of_voter: np.ndarray  # units x unit voters
    theta: np.ndarray | None = None
    label_model: LabelModel | None = None

    def features(self, part: Words) -> np.ndarray:
        """Votes, how dense they are, and shares of hashed words."""
        counts, found = unit_counts(part, self.units)
        hits = counts @ self.of_voter
        n = len(hits)
        size = np.maximum(found.words, 1)[:, None]
        bag = np.bincount(found.owner * BAG + _bucket(found.kinds[0]), minlength=n * BAG).reshape(n, BAG) / size
        return np.hstack([hits > 0, found.patterns, np.log1p(hits) / 4, bag]).astype(np.float32)

    @property
    def voters(self) -> int:
        return self.of_voter.shape[1] + len(PATTERNS)

    def score(self, part: Words) -> np.ndarray:
        if self.theta is None:
            return np.zeros(part.last - part.first)
        return 1 / (1 + np.exp(-np.clip(self.features(part) @ self.theta[:-1] + self.theta[-1], -30, 30)))


def held_out(key: Column) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(4)) == 2


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, training_rows: int) -> DataFrame:
    """(id, label, text) of the labelled rows with the smallest hashes of their ids, none held out, one row per id."""
    key = F.col(f"`{id_col}`").cast("long")
    marked = labels.select(key.alias("id"), F.col(f"`{label_col}`").cast("int").alias("label")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("id")))
    chosen = marked.groupBy("id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("id"), "id").limit(training_rows)
    texts = docs.select(key.alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    one = F.min(F.struct(F.isnull("text"), F.xxhash64("text"), "text"))
    return texts.join(F.broadcast(chosen), "id").groupBy("id", "label").agg(one.alias("one")).select("id", "label", "one.text")


def _distinct_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        labels, at = batch.column("label"), 0
        for part in chunks(text_column(batch, "text")):
            found = units_of(part)
            n = part.last - part.first
            owner = np.tile(found.owner, len(found.kinds))
            unit = np.concatenate(found.kinds)
            order = np.lexsort((unit, owner))
            owner, unit = owner[order], unit[order]
            new = np.ones(len(unit), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (unit[1:] != unit[:-1])
            new &= unit != 0
            yield pa.RecordBatch.from_arrays([pa.array(unit[new].view(np.int64)), labels.slice(at, n).take(pa.array(owner[new]))], names=["unit", "label"])
            at += n


def mine_units(sample: DataFrame, mined: int, support: int = SUPPORT) -> np.ndarray:
    """Hashes of the words, beginnings and ends that go with label 1 most clearly (likelihood ratio test)."""
    size = sample.groupBy("label").count().collect()
    toxic = sum(r["count"] for r in size if r["label"] == 1)
    clean = sum(r["count"] for r in size if r["label"] != 1)
    if not toxic or not clean or not mined:
        return np.zeros(0, np.uint64)
    counts = sample.mapInArrow(_distinct_units, "unit long, label int").groupBy("unit").agg(
        F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") != 1).alias("b"))
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    rate = (a + b) / (toxic + clean)

    def part(seen: Column, of: int, p: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / (of * p))).otherwise(0.0)

    gain = part(a, toxic, rate) + part(toxic - a, toxic, 1 - rate) + part(b, clean, rate) + part(clean - b, clean, 1 - rate)
    best = counts.where((F.col("a") >= support) & (a / toxic > 4 * b / clean)).select("unit", gain.alias("gain")).where("gain > 8")
    return np.array([r["unit"] for r in best.orderBy(F.desc("gain"), "unit").limit(mined).collect()], np.int64).view(np.uint64)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                 training_rows: int = TRAINING_ROWS, mined: int = MINED) -> Model:
    sample = stage(labelled_sample(docs, labels, id_col, text_col, label_col, training_rows))
    found = mine_units(sample, mined)
    lists = [word_hashes(words.split()) for words in LEXICONS.values()]
    units = np.unique(np.concatenate([found, *lists]))
    of_voter = np.zeros((len(units), len(lists) + len(found)), np.int64)
    for k, hashes in enumerate([*lists, *found[:, None]]):
        of_voter[np.searchsorted(units, hashes), k] = 1
    model = Model(units, of_voter)

    def described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for part in chunks(text_column(batch, "text")):
                rows = pa.array([r.tobytes() for r in model.features(part)], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column("label").slice(at, len(rows)), batch.column("id").slice(at, len(rows)), rows], names=["label", "id", "x"])
                at += len(rows)

    rows = sorted(sample.mapInArrow(described, "label int, id long, x binary").collect(), key=lambda r: (r["id"], r["label"]))
    if not rows:
        return model
    x = np.stack([np.frombuffer(r["x"], np.float32) for r in rows]).astype(float)
    given = np.array([r["label"] == 1 for r in rows], np.int64)
    votes = np.hstack([x[:, : model.voters].astype(np.int64), given[:, None]])
    model.label_model, posterior = fit_label_model(votes, given.astype(float))
    model.theta = fit_linear(x, posterior)
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
                   training_rows: int = TRAINING_ROWS, mined: int = MINED, accept: float = 0.3, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: id, held_out, score (0 to 1, higher: label 1 likelier), predicted (1 if score >= accept).

    Voters, label model and classifier are fitted on at most `training_rows` labelled rows, one per id, none held out; texts are
    the only input of a score, and whole texts are read. Null and empty texts are texts without words. Labels that are null or
    have no id are not used; of repeated labels the larger counts. Without usable labels every score is 0. Rows without an id
    are scored and not held out; repeated rows are scored alike. An empty table gives an empty result. Columns named in
    `carry` are added to their rows, others are ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, id_col, text_col, label_col, training_rows, mined))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.value.score(p) for p in chunks(text_column(batch, "text"))]
            scores = np.concatenate(parts).astype(float) if parts else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(scores), *(batch.column(f"c{k}") for k in range(len(carry)))],
                                             names=["id", "score", *(f"c{k}" for k in range(len(carry)))])

    carried = [F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(carry)]
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *carried)
    schema = StructType().add("id", LongType()).add("score", DoubleType())
    for k, c in enumerate(carry):
        schema.add(f"c{k}", docs.schema[c].dataType)
    return texts.mapInArrow(scored, schema).select(
        F.col("id").alias(id_col), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= accept, 1).otherwise(0).alias("predicted"), *(F.col(f"c{k}").alias(c) for k, c in enumerate(carry)))
