"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklake.session import stage

WORD = r"[^\x20\x09-\x0D]+"


def narrowed(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that further columns of the caller cannot clash with its own."""
    return df.select(*(F.col(f"`{n}`") for n in names))


def groups_of(batches: Iterable[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Whole groups of rows with one key, from batches that are sorted by the key."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        column = table.column(key).combine_chunks()
        codes = column.to_pylist()
        cuts = [0, *(i for i in range(1, len(codes)) if codes[i] != codes[i - 1]), len(codes)]
        if held and held[0].column(key)[0].as_py() != codes[0]:
            yield pa.concat_tables(held)
            held = []
        for a, b in zip(cuts, cuts[1:]):
            held.append(table.slice(a, b - a))
            if b < len(codes):
                yield pa.concat_tables(held)
                held = []
    if held:
        yield pa.concat_tables(held)


def pair_up(a: Column, b: Column) -> tuple[Column, Column]:
    return F.greatest(a, b), F.least(a, b)


def components(links: DataFrame, high: str = "a", low: str = "b", rounds: int = 60) -> DataFrame:
    """Smallest vertex reachable from each linked vertex: columns `vertex` and `component`.

    Alternates two steps over the link table until nothing changes: every vertex hangs its larger neighbours
    on its smallest one, then its smaller neighbours. Each step is a minimum per vertex and a join, so no
    vertex's links meet in one task; the joins are left to Spark's skew handling. Each round is written to the
    shared folder, so lost executors restart from the last round. Null ends and loops are ignored.
    """
    a, b = F.col(high), F.col(low)
    up, down = pair_up(a, b)
    now = stage(links.where(a.isNotNull() & b.isNotNull() & (a != b)).select(up.alias("a"), down.alias("b")).distinct())
    mark = None
    for _ in range(rounds):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = (
            both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(smallest, "a")
        hung = small.where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = stage(hung.unionByName(smallest.select("a", F.col("m").alias("b"))).distinct())
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            return now.select(F.col("a").alias("vertex"), F.col("b").alias("component"))
        mark = tuple(seen)
    raise RuntimeError(f"components did not settle in {rounds} rounds")
