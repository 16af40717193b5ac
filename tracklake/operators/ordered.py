"""Ordered windows that hold when one key owns most of the rows.

`Window.partitionBy(key)` puts every row of a key in one task. For keys under a row limit that is what
we want: one shuffle and no more. Keys over the limit are cut into slices that follow the window order,
so that each task gets at most about `limit` rows:

1. `find_hot` counts rows per key (map-side combined) and keeps the keys over the limit. Without keys the whole
   table counts as one such key, so that a global order never meets in one task.
2. Only the key and order columns of those keys are range partitioned and sorted, and each range reports the
   first row and the row count of its slices. That is one small row per slice: the split points. A range holds many
   slices, so that neither the sample that Spark takes to find the ranges nor the tasks grow with the slices.
3. A row's slice is then a function of its own order columns, the same in every later scan, so nothing
   has to be materialised. Row numbers inside a slice plus the rows in earlier slices give the row
   number in the key.

Null order values come first, as in any Spark window: a split point holds two numbers per column, whether there is a
value and the value. So it makes no difference to the result whether a key is cut or not.

Frames that look back a few rows use buckets of consecutive row numbers, with the last rows of each
bucket copied into the next one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEFAULT_LIMIT = 2_000_000  # rows of one key that a single task may sort
MAX_SLICES = 20_000  # bound on hot keys and on split points kept on the driver; beyond it slices grow
RANGE_ROWS = 200_000  # narrow rows that a task sorts to find split points
WINDOW_ROWS = 500_000  # rows that a task should sort for windows on slices, if slices are smaller than that
LEAST_SLICE = 50_000  # rows under which a slice of a global order is not cut further just to use more cores


@dataclass
class HotKeys:
    """Keys over the row limit, their sizes, and the slice size to cut them into."""

    keys: list[str]
    limit: int
    sizes: list[tuple] = field(default_factory=list)  # (key values..., rows)
    rows: int = 0  # of the table, hot or not

    def __bool__(self) -> bool:
        return bool(self.sizes)

    @property
    def rows_per_slice(self) -> int:
        total = sum(row[-1] for row in self.sizes)
        return max(self.limit, -(-total // MAX_SLICES))

    def tasks(self, df: DataFrame) -> int:
        """Tasks for windows on slices. It follows the rows, so that what a task sorts does not grow with the table."""
        rows = max(self.rows, sum(row[-1] for row in self.sizes))
        return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // WINDOW_ROWS))


def find_hot(df: DataFrame, keys: list[str], limit: int = DEFAULT_LIMIT) -> HotKeys:
    """Count rows per key and keep the keys over `limit`.

    The limit grows with the table, so that at most MAX_SLICES keys reach the driver. A table within the
    limit has no such key; its total alone tells (a Parquet scan takes it from the file footers).
    """
    total = df.count()
    if total <= limit:
        return HotKeys(list(keys), limit)
    if not keys:
        return HotKeys([], limit, [(total,)], total)
    limit = max(limit, -(-total // MAX_SLICES))
    found = df.groupBy(*keys).count().where(F.col("count") > limit)
    return HotKeys(list(keys), limit, [tuple(row) for row in found.collect()], total)


def as_longs(df: DataFrame, name: str) -> tuple[Column, Column]:
    """Two numbers that sort like the column with its nulls first: whether there is a value, and the value."""
    kind = df.schema[name].dataType.typeName()
    value = F.unix_micros(F.col(name).cast("timestamp")) if kind.startswith("timestamp") else F.col(name).cast("bigint")
    return F.col(name).isNotNull().cast("bigint"), F.coalesce(value, F.lit(0))


def _order_numbers(df: DataFrame, order: list[str]) -> list[Column]:
    return [number for name in order for number in as_longs(df, name)]


def _with_hot_id(df: DataFrame, hot: HotKeys) -> DataFrame:
    """Number the hot keys; other rows get null. The joined table has `len(hot.sizes)` rows."""
    if not hot.keys:
        return df.withColumn("_hot", F.lit(0))
    schema = ", ".join(f"`_k_{k}` {df.schema[k].dataType.simpleString()}" for k in hot.keys)
    rows = [(*row[:-1], i) for i, row in enumerate(hot.sizes)]
    table = df.sparkSession.createDataFrame(rows, f"{schema}, _hot int")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in hot.keys])
    return df.join(F.broadcast(table), same, "left").drop(*[f"_k_{k}" for k in hot.keys])


def _split_points(df: DataFrame, order: list[str], hot: HotKeys) -> np.ndarray:
    """One line per slice: hot id, first order values, row offset in the key, rows in the key."""
    total = sum(row[-1] for row in hot.sizes)
    n = max(1, -(-total // max(hot.rows_per_slice, RANGE_ROWS)))
    names = [f"_o{i}" for i in range(2 * len(order))]
    narrow = _with_hot_id(df, hot).where(F.col("_hot").isNotNull())
    narrow = narrow.select(F.col("_hot").cast("bigint").alias("_hot"), *[c.alias(o) for c, o in zip(_order_numbers(df, order), names)])
    ranged = narrow.repartitionByRange(n, "_hot", *names)
    if hot.rows_per_slice >= RANGE_ROWS:  # a range is one slice, and nothing is sorted
        ranges = ranged.groupBy(F.spark_partition_id().alias("_part"), "_hot").agg(F.min(F.struct(*names)).alias("first"), F.count("*").alias("n"))
        ranges = ranges.select("_hot", *[f"first.{o}" for o in names], "n").collect()
    else:
        schema = ", ".join(f"{c} bigint" for c in ("_hot", *names, "n"))
        ranges = ranged.sortWithinPartitions("_hot", *names).mapInPandas(_slices_of(hot.rows_per_slice), schema).collect()
    ranges.sort(key=lambda row: tuple(row)[:-1])
    totals: dict[int, int] = {}
    lines = []
    for row in ranges:
        lines.append([*row[:-1], totals.get(row[0], 0)])
        totals[row[0]] = totals.get(row[0], 0) + row[-1]
    return np.array([[*line, totals[line[0]]] for line in lines], dtype=np.int64).reshape(len(lines), len(names) + 3)


def _slices_of(size: int):
    """Sorted rows of a range to one line per slice: its first row and its number of rows. A slice takes `size` rows and
    those equal to its last one, and is of one key (the first column)."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = before = names = None  # first row of the open slice, row before this batch
        held = 0
        for batch in batches:
            rows = batch.to_numpy(dtype=np.int64)
            if not len(rows):
                continue
            if first is None:
                first = before = rows[0]
                names = list(batch.columns)
            earlier = np.vstack([before[None, :], rows[:-1]])
            fresh = np.flatnonzero((rows != earlier).any(axis=1))  # rows unlike the one before: a slice may begin there
            keys = np.flatnonzero(rows[:, 0] != earlier[:, 0])  # rows of a key of their own: one must begin there
            lines, at = [], 0
            while True:
                full = np.searchsorted(fresh, at + max(size - held, 0))
                key = np.searchsorted(keys, at, side="left" if held else "right")
                ends = [int(found[i]) for found, i in ((fresh, full), (keys, key)) if i < len(found)]
                if not ends:
                    break
                lines.append([*first, held + min(ends) - at])
                at, held = min(ends), 0
                first = rows[at]
            held, before = held + len(rows) - at, rows[-1]
            if lines:
                yield pd.DataFrame(lines, columns=[*names, "n"])
        if held:
            yield pd.DataFrame([[*first, held]], columns=[*names, "n"])

    return cut


def _last_not_after(points: np.ndarray, wanted: list[np.ndarray]) -> np.ndarray:
    """Index of the last split point that is not after each wanted tuple (bisection on all rows at once)."""
    low = np.zeros(len(wanted[0]), dtype=np.int64)
    high = np.full(len(wanted[0]), len(points), dtype=np.int64)
    for _ in range(int(len(points)).bit_length() + 1):
        mid = np.minimum((low + high) // 2, len(points) - 1)
        not_after = np.ones(len(low), dtype=bool)
        for column in range(len(wanted) - 1, -1, -1):
            point = points[mid, column]
            not_after = (point < wanted[column]) | ((point == wanted[column]) & not_after)
        open_ = low < high
        low = np.where(open_ & not_after, mid + 1, low)
        high = np.where(open_ & ~not_after, mid, high)
    return low - 1


def _slice_udf(points: np.ndarray, width: int):
    @F.pandas_udf("slice int, before bigint, total bigint")
    def slice_of(hot_id: pd.Series, *order: pd.Series) -> pd.DataFrame:
        mask = hot_id.notna().to_numpy()
        out = np.zeros((len(hot_id), 3), dtype=np.int64)
        out[:, 0] = -1
        if mask.any():
            wanted = [c.to_numpy()[mask].astype(np.int64) for c in (hot_id, *order)]
            at = _last_not_after(points[:, :width], wanted)
            out[mask, 0] = at
            out[mask, 1:] = points[at, width:]
        return pd.DataFrame(
            {"slice": out[:, 0].astype(np.int32), "before": out[:, 1], "total": out[:, 2]}
        )

    return slice_of


def _order_columns(order: list[str]) -> list[Column]:
    return [F.col(c) for c in order]


def keyed_index(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    index: str = "rn",
    total: str | None = None,
    hot: HotKeys | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Number the rows of each key 1, 2, ... in `order`; optionally add the key's row count.

    `order` must be timestamps or integers, with nulls first, and unique within a key (rows that share all
    values are numbered in any order, and stay in one slice). Without keys the numbering is global. Null
    keys are a key.
    """
    hot = find_hot(df, keys, limit) if hot is None else hot
    group = [F.col(k) for k in keys] or [F.lit(0)]
    if not hot:
        w = Window.partitionBy(*group)
        out = df.withColumn(index, F.row_number().over(w.orderBy(*_order_columns(order))).cast("bigint"))
        return out.withColumn(total, F.count("*").over(w)) if total else out

    points = _split_points(df, order, hot)
    slice_of = _slice_udf(points, 1 + 2 * len(order))
    cut = _with_hot_id(df, hot).withColumn("_cut", slice_of("_hot", *_order_numbers(df, order)))
    cut = cut.withColumn("_slice", F.col("_cut.slice")).repartition(hot.tasks(df), *keys, "_slice")
    w = Window.partitionBy(*(keys + ["_slice"]))
    out = cut.withColumn(
        index, F.row_number().over(w.orderBy(*_order_columns(order))).cast("bigint") + F.col("_cut.before")
    )
    if total:
        out = out.withColumn(
            total, F.when(F.col("_slice") >= 0, F.col("_cut.total")).otherwise(F.count("*").over(w))
        )
    return out.select(*df.columns, index, *([total] if total else []))


def look_back(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    reach: int,
    add: Callable[[DataFrame, Window], DataFrame],
    *,
    hot: HotKeys | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Apply `add(df, window)`, whose frames reach at most `reach` rows back in each key."""
    hot = find_hot(df, keys, limit) if hot is None else hot
    group = [F.col(k) for k in keys] or [F.lit(0)]
    if not hot:
        return add(df, Window.partitionBy(*group).orderBy(*_order_columns(order)))

    size = max(hot.rows_per_slice, reach + 1)
    placed = keyed_index(df, keys, order, index="_i", hot=hot)
    home = F.expr(f"(_i - 1) div {size}")
    spill = F.expr(f"(_i - 1 + {reach}) div {size}")
    placed = placed.withColumn("_home", home).withColumn(
        "_bucket", F.explode(F.array_distinct(F.array(home, spill)))
    ).repartition(hot.tasks(df), *keys, "_bucket")
    w = Window.partitionBy(*keys, "_bucket").orderBy(*_order_columns(order))
    out = add(placed, w).where(F.col("_bucket") == F.col("_home"))
    return out.drop("_i", "_home", "_bucket")
