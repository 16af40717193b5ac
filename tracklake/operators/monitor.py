"""Counts and rates over a stream of graphs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import bar_label, namespace_of, option_label, short_name
from ..session import stage
from .ordered import DEFAULT_LIMIT, HotKeys, look_back
from .triples import is_typing

SAMPLE = 5
HELD_ROWS = 50_000  # newest rows of all names that a task holds before it sends them on


def message_counts(triples: DataFrame) -> DataFrame:
    """Triples and typed objects of each message. Input: distinct triples with `msg_id` and `ts`."""
    return triples.groupBy("msg_id").agg(
        F.min("ts").alias("ts"), F.count("*").alias("trip_count"), F.count_if(is_typing()).alias("obj_count")
    )


def class_counts(triples: DataFrame) -> DataFrame:
    """Instances of each class in each message."""
    return (
        triples.where(is_typing())
        .groupBy("msg_id", F.col("o").alias("class"))
        .agg(F.min("ts").alias("ts"), F.count("*").alias("n"))
    )


def totals(counts: DataFrame) -> DataFrame:
    return counts.agg(
        F.count("*").alias("messages"), F.sum("trip_count").alias("triples"), F.sum("obj_count").alias("objects")
    )


def class_totals(triples: DataFrame) -> DataFrame:
    return triples.where(is_typing()).groupBy(F.col("o").alias("class")).agg(F.count("*").alias("total"))


def _per_second(amount: Column, w: Window) -> Column:
    """Amount over the time between the first and the last row of the frame; null without such a time."""
    span = F.unix_micros("ts") - F.min(F.unix_micros("ts")).over(w)
    return F.when(span > 0, amount / (span / F.lit(1_000_000.0)))


def rolling_rates(
    counts: DataFrame, sample: int = SAMPLE, *, hot: HotKeys | None = None, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """Message, triple and object rates over the last `sample` messages."""

    def add(df: DataFrame, w: Window) -> DataFrame:
        frame = w.rowsBetween(-(sample - 1), 0)
        return df.select(
            "*",
            _per_second(F.sum("trip_count").over(frame), frame).alias("trip_rate"),
            _per_second(F.sum("obj_count").over(frame), frame).alias("obj_rate"),
            _per_second(F.count("*").over(frame), frame).alias("msg_rate"),
        )

    return look_back(counts, [], ["ts", "msg_id"], sample - 1, add, hot=hot, limit=limit)


def class_rates(
    counts: DataFrame, sample: int = SAMPLE, *, hot: HotKeys | None = None, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """Rate of each class over the last `sample` messages it occurs in. Classes are few and large, so
    big ones are cut into slices by `look_back`."""

    def add(df: DataFrame, w: Window) -> DataFrame:
        frame = w.rowsBetween(-(sample - 1), 0)
        return df.withColumn("rate", _per_second(F.sum("n").over(frame), frame))

    return look_back(counts, ["class"], ["ts", "msg_id"], sample - 1, add, hot=hot, limit=limit)


def newest_in_task(keys: list[str], order: list[str], few: int, condense: Callable[[pa.Table], pa.Table] | None = None):
    """For `mapInArrow`: of each task's rows, the last `few` of every key in `order`, nulls before all values. `condense`
    makes few rows of the others, which are dropped without it.

    What a task holds is `few` rows a key; with more than `HELD_ROWS` of them it sends them on and begins anew.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = _newest(table if held is None else pa.concat_tables([held, table]), keys, order, few, condense)
            if len(held) > HELD_ROWS:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    return run


def _newest(table: pa.Table, keys: list[str], order: list[str], few: int, condense) -> pa.Table:
    group = np.zeros(len(table), dtype=np.int64)
    for key in keys:
        codes = table[key].combine_chunks().dictionary_encode(null_encoding="encode")
        group = group * len(codes.dictionary) + codes.indices.to_numpy(zero_copy_only=False)
    numbered = table.append_column("_group", pa.array(group))
    wanted = [("_group", "ascending"), *((c, "descending") for c in order)]
    at = pc.sort_indices(numbered, sort_keys=wanted, null_placement="at_end").to_numpy()
    ordered = group[at]
    starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]][: len(at)])
    place = np.arange(len(at)) - np.repeat(starts, np.diff(np.r_[starts, len(at)]))
    last = table.take(pa.array(at[place < few]))
    if condense is None:
        return last
    return pa.concat_tables([last, condense(table.take(pa.array(at[place >= few])))]).combine_chunks()


def newest_rates(counts: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """Each class's newest rate and its total, as `latest_rates` of `class_rates`, without the rates in between.

    Only the last `sample` messages of a class in each task are shuffled, and one count per class and task. A task picks
    its last messages batch by batch and sorts no more than a batch and what it holds.
    """
    last = Window.partitionBy("class").orderBy(F.desc("ts"), F.desc("msg_id"))
    picked = counts.select("class", "ts", "msg_id", "n")
    picked = picked.mapInArrow(newest_in_task(["class"], ["ts", "msg_id"], sample), picked.schema)
    few = picked.withColumn("_rn", F.row_number().over(last)).where(F.col("_rn") <= sample)
    newest, oldest = F.max(F.when(F.col("_rn") == 1, F.unix_micros("ts"))), F.min(F.unix_micros("ts"))
    rates = few.groupBy("class").agg(F.sum("n").alias("_n"), (newest - oldest).alias("_span"))
    rates = rates.select("class", F.when(F.col("_span") > 0, F.col("_n") / (F.col("_span") / F.lit(1_000_000.0))).alias("rate"))
    return rates.join(counts.groupBy("class").agg(F.sum("n").alias("total")), "class")


def stage_counts(counts: DataFrame) -> DataFrame:
    """Per-message rows are read several times by the rate operators and are far fewer than the triples."""
    return stage(counts)


def latest_rates(rates: DataFrame) -> DataFrame:
    """Each class's newest rate and its total."""
    return rates.groupBy("class").agg(
        F.max(F.struct("ts", "msg_id", "rate"))["rate"].alias("rate"), F.sum("n").alias("total")
    )


def rate_table(latest: DataFrame, selected: list[str] | None = None) -> DataFrame:
    """The bar table: selected classes with labels, by short name."""
    if selected is not None:
        latest = latest.where(F.col("class").isin(*selected))
    name = short_name(F.col("class"))
    return latest.select(
        "class", name.alias("short_name"), bar_label(F.col("rate"), F.col("total")).alias("label"),
        namespace_of(F.col("class")).alias("namespace"), "rate",
    ).orderBy("short_name", "class")


def class_options(latest: DataFrame) -> DataFrame:
    """The option list: every class with its count, names descending."""
    return latest.select(
        "class", option_label(short_name(F.col("class")), F.col("total")).alias("label")
    ).orderBy(F.col("class").desc())
