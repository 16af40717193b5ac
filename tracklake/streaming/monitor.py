"""Monitor of a stream of graph messages: counts, totals and rolling rates."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from ..operators.monitor import SAMPLE, newest_in_task
from ..functions.codec import PIECE_ROWS, decode_body, inflate_one
from ..operators.triples import is_typing
from ..sources.triples import LINE, good_and_bad, judged_lines, judged_messages, message_lines, parse_lines
from ..vocab import RDF_TYPE

# A line that types a node, with the class; a class is a URI or a blank node.
_TYPING = rf"(?s)^(?:<[^<>]*>|_:[^ \t<]+)[ \t]*<{re.escape(RDF_TYPE)}>[ \t]*(?:<(?P<iri>[^<>]*)>|(?P<bnode>_:[^ \t<]+?))[ \t]*\.[ \t]*(?:#.*)?\z"


def message_triples(messages: DataFrame, codec: str = "zlib", apart: bool = True) -> tuple[DataFrame, DataFrame] | DataFrame:
    """(triples with msg_id and ts, dead letters) of N-Triples messages (graph_id, timestamp, value).

    A message is a set: repeated lines are dropped while they are still one array. Each of the two frames reads the
    messages; with `apart=False` there is one frame of all lines, told apart by `valid`.
    """
    keep, named = ("graph_id", "timestamp"), {"graph_id": "msg_id", "timestamp": "ts"}
    if codec == "zlib":
        every = judged_messages(messages, keep)
        if not apart:
            return every.withColumnsRenamed(named)
        good, bad = good_and_bad(judged_messages(messages, keep, raw=False), every, keep)
    else:
        lines = message_lines(messages, codec)
        if not apart:
            return judged_lines(lines, keep=keep).withColumnsRenamed(named)
        good, bad = parse_lines(lines, keep=keep)
    return good.withColumnsRenamed(named), bad.withColumnsRenamed(named)


def count_messages(messages: DataFrame, codec: str = "zlib") -> DataFrame:
    """One row per message (graph_id, timestamp, value): `msg_id`, `ts`, triples, typed objects, instances per class, and
    lines that are no N-Triples.

    A message is counted where it is read: its text stays with the worker that inflates it and only the counts leave, so nothing is
    exploded or shuffled, and the counts run on streams and tables alike. A body that cannot be decoded has null counts.
    """
    counted = _count_bodies(F.col("value")) if codec == "zlib" else _count_texts(decode_body(F.col("value"), codec))
    rows = messages.select(F.col("graph_id").alias("msg_id"), F.col("timestamp").alias("ts"), counted.alias("_n"))
    return rows.select("msg_id", "ts", "_n.trip_count", "_n.obj_count", "_n.classes", "_n.bad_lines")


_INSTANCES = ArrayType(StructType([StructField("class", StringType()), StructField("n", LongType())]))
_COUNTS = StructType([StructField(c, _INSTANCES if c == "classes" else LongType()) for c in ("trip_count", "obj_count", "classes", "bad_lines")])
_CLASS = pa.struct([("class", pa.string()), ("n", pa.int64())])


def _count_piece(texts: list[str | None]) -> pa.StructArray:
    """Counts of a few messages. Lines are judged once however many of the messages have them."""
    lines = pc.split_pattern(pa.array(texts, pa.string()), "\n")
    of_line = pc.list_parent_indices(lines).to_numpy()
    coded = pc.utf8_trim(pc.list_flatten(lines), " \t\r").dictionary_encode()
    known = coded.dictionary
    says = pc.and_not(pc.not_equal(known, ""), pc.starts_with(known, "#"))
    valid = pc.and_(says, pc.match_substring_regex(known, LINE)).to_numpy(zero_copy_only=False)
    says = says.to_numpy(zero_copy_only=False)
    typing = np.flatnonzero(valid & pc.match_substring(known, f"<{RDF_TYPE}>").to_numpy(zero_copy_only=False))
    named = pc.extract_regex(known.take(pa.array(typing)), _TYPING)
    names = pc.fill_null(pc.binary_join_element_wise(pc.struct_field(named, "iri"), pc.struct_field(named, "bnode"), ""), "").dictionary_encode()
    class_of = np.full(len(known), -1)
    class_of[typing] = names.indices.to_numpy()

    # A message is a set of lines: the first place of each.
    code = coded.indices.to_numpy()
    at = np.sort(np.unique(of_line * max(len(known), 1) + code, return_index=True)[1])
    owner, code = of_line[at], code[at]
    per_message = lambda on: np.bincount(owner[on], minlength=len(texts))
    triples, kept = per_message(valid[code]), per_message(says[code])
    empty = pc.index(names.dictionary, "").as_py()  # lines that name the type but are no typing
    instance = (class_of[code] >= 0) & (class_of[code] != empty)
    groups, firsts, n = np.unique(owner[instance] * max(len(names.dictionary), 1) + class_of[code[instance]], return_index=True, return_counts=True)
    order = np.argsort(firsts)
    classes = names.dictionary.take(pa.array(groups[order] % max(len(names.dictionary), 1)))
    sizes = np.bincount(groups // max(len(names.dictionary), 1), minlength=len(texts))
    none = np.array([t is None for t in texts], dtype=bool)
    offsets = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32), mask=np.r_[none, False])
    counts = [pa.array(c, pa.int64(), mask=none) for c in (triples, per_message(instance), kept - triples)]
    each = pa.StructArray.from_arrays([classes, pa.array(n[order], pa.int64())], fields=list(_CLASS))
    return pa.StructArray.from_arrays(
        [counts[0], counts[1], pa.ListArray.from_arrays(offsets, each), counts[2]], names=_COUNTS.names)


@F.arrow_udf(_COUNTS)
def _count_bodies(bodies: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in bodies:
        for at in range(0, len(batch), PIECE_ROWS):
            yield _count_piece([None if b is None else inflate_one(b) for b in batch.slice(at, PIECE_ROWS).to_pylist()])


@F.arrow_udf(_COUNTS)
def _count_texts(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in texts:
        for at in range(0, len(batch), PIECE_ROWS):
            yield _count_piece(batch.slice(at, PIECE_ROWS).to_pylist())


# As with `inflate`: conditions on the counts must not count once more.
_count_bodies, _count_texts = _count_bodies.asNondeterministic(), _count_texts.asNondeterministic()


NEWEST = "name string, shard int, messages bigint, first bigint, second bigint, recent array<struct<micros:bigint,msg_id:string,first:bigint,second:bigint>>"


class NewestMessages(StatefulProcessor):
    """State per name and shard: totals, and the newest few messages by event time, whatever order they arrive in."""

    def __init__(self, sample: int):
        self.sample = sample

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "micros bigint, msg_id string, first bigint, second bigint")
        self.totals = handle.getValueState("totals", "messages bigint, first bigint, second bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        recent = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        totals = list(self.totals.get()) if self.totals.exists() else [0, 0, 0]
        for batch in rows:
            totals = [totals[0] + int(batch["messages"].sum()), totals[1] + int(batch["first"].sum()), totals[2] + int(batch["second"].sum())]
            timed = batch[batch["micros"].notna()].sort_values(["micros", "msg_id"]).tail(self.sample)
            found = zip(timed["micros"], timed["msg_id"], timed["first"], timed["second"])
            recent = sorted(recent + [(int(m), i, int(a), int(b)) for m, i, a, b in found])[-self.sample :]
        if recent:
            self.recent.put(recent)
        self.totals.update(tuple(totals))
        names = ("micros", "msg_id", "first", "second")
        yield pd.DataFrame({"name": [key[0]], "shard": [key[1]], "messages": totals[:1], "first": totals[1:2], "second": totals[2:],
                            "recent": [[dict(zip(names, r)) for r in recent]]})

    def close(self) -> None:
        pass


def _total(others: pa.Table) -> pa.Table:
    """One row per name and shard, without a time, for messages that are not among the newest."""
    sums = others.group_by(["name", "shard"]).aggregate([(c, "sum") for c in ("messages", "first", "second")])
    taken = {"name": sums["name"], "shard": sums["shard"], **{c: sums[f"{c}_sum"] for c in ("messages", "first", "second")}}
    return pa.table([taken[f.name] if f.name in taken else pa.nulls(len(sums), f.type) for f in others.schema], schema=others.schema)


def stream_monitor(counts: DataFrame, sample: int = SAMPLE, shards: int = 16) -> DataFrame:
    """State of the monitor, from the rows of `count_messages`: per trigger, one row for every name and shard that changed.

    The name is `messages` for all messages (first: triples, second: objects) and the class for those with instances of it
    (first: instances). Every message and many classes occur all the time, so a name is dealt to shards by message;
    a shard keeps its totals and its newest `sample` messages. `monitor_view` puts the shards together.
    Each task sends only its newest `sample` messages of a name and shard, and one row with the totals of its others.
    """
    whole = F.struct(F.lit("messages").alias("name"), F.col("trip_count").alias("first"), F.col("obj_count").alias("second"))
    of_class = F.transform("classes", lambda c: F.struct(c["class"].alias("name"), c["n"].alias("first"), F.lit(0).cast("bigint").alias("second")))
    rows = counts.where("trip_count IS NOT NULL").select(
        F.col("msg_id").cast("string").alias("msg_id"), F.unix_micros("ts").alias("micros"), F.explode(F.concat(F.array(whole), of_class)).alias("_e"))
    keyed = rows.select("_e.name", F.pmod(F.xxhash64("msg_id"), F.lit(shards)).cast("int").alias("shard"), "micros", "msg_id", "_e.first", "_e.second")
    keyed = keyed.withColumn("messages", F.lit(1).cast("bigint"))
    few = keyed.mapInArrow(newest_in_task(["name", "shard"], ["micros", "msg_id"], sample, _total), keyed.schema)
    return few.groupBy("name", "shard").transformWithStateInPandas(
        statefulProcessor=NewestMessages(sample), outputStructType=NEWEST, outputMode="Update", timeMode="None")


def monitor_view(updates: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Totals and rates per name from all that `stream_monitor` has sent so far.

    The newest messages of a name are the newest of its shards, so the rates are those of the batch operators' newest row;
    they are null without a time between the oldest and the newest.
    """
    state = updates.groupBy("name", "shard").agg(F.max_by(F.struct("messages", "first", "second", "recent"), "messages").alias("s"))
    # Of each shard the newest few are left: a name's rows are as many as shards times `sample`.
    merged = state.groupBy("name").agg(
        *(F.sum(f"s.{c}").alias(c) for c in ("messages", "first", "second")),
        F.slice(F.sort_array(F.flatten(F.collect_list("s.recent")), asc=False), 1, sample).alias("recent"))
    span = (F.array_max("recent.micros") - F.array_min("recent.micros")) / F.lit(1_000_000.0)
    total = lambda c: F.aggregate(f"recent.{c}", F.lit(0).cast("bigint"), lambda a, x: a + x)
    rate = lambda amount: F.when(span > 0, amount / span)
    return merged.select(
        "name", "messages", "first", "second", rate(F.size("recent")).alias("msg_rate"), rate(total("first")).alias("first_rate"),
        rate(total("second")).alias("second_rate"))


class RateWindow(StatefulProcessor):
    """State per class: its total and the times and counts of its last few messages."""

    def __init__(self, sample: int):
        self.sample = sample

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.recent = handle.getListState("recent", "micros bigint, msg_no bigint, n bigint")
        self.total = handle.getValueState("total", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        recent = [tuple(r) for r in self.recent.get()] if self.recent.exists() else []
        total = self.total.get()[0] if self.total.exists() else 0
        for batch in rows:
            total += int(batch["n"].sum())
            newest = batch.nlargest(self.sample, ["micros", "msg_no"])[["micros", "msg_no", "n"]]
            recent = sorted(recent + list(newest.itertuples(index=False, name=None)))[-self.sample :]
        self.recent.put([tuple(int(v) for v in r) for r in recent])
        self.total.update((total,))
        span = (recent[-1][0] - recent[0][0]) / 1e6
        rate = sum(r[2] for r in recent) / span if span > 0 else None
        yield pd.DataFrame({"class": [key[0]], "total": [total], "rate": [rate]}).astype({"rate": "float64"})

    def close(self) -> None:
        pass


def stream_class_rates(counts: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Per trigger, the total and the rate of every class that occurred. Input (class, micros, msg_no, n)."""
    return counts.groupBy("class").transformWithStateInPandas(
        statefulProcessor=RateWindow(sample),
        outputStructType="class string, total bigint, rate double",
        outputMode="Update",
        timeMode="None",
    )


def stream_totals(triples: DataFrame) -> DataFrame:
    """Running triple and object totals (output mode `complete`)."""
    return triples.groupBy().agg(F.count("*").alias("triples"), F.count_if(is_typing()).alias("objects"))


def stream_class_totals(triples: DataFrame) -> DataFrame:
    """Running instances per class (output mode `complete` or `update`)."""
    return triples.where(is_typing()).groupBy(F.col("o").alias("class")).agg(F.count("*").alias("total"))
