"""Operators that need a stream in event-time order: rows wait until the watermark has passed them.

State per vessel: the rows that wait, appended per Arrow batch, and what the operator itself remembers. A timer
at the oldest waiting row releases, in order, all rows that no later row can precede. So the result is that of the
batch operator if no row is more than `delay` late. A row that comes after later rows of its vessel have left is dropped.

A call of the state costs far more than a row. Tracker and tracks therefore keep their state per shard of vessels: tasks pack
their rows into one Arrow block a shard, blocks wait as they are, and a timer works on all vessels of its shard at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.geo import Zone
from ..operators.kalman import ROW_COLUMNS, STALE_SECONDS, advance, project, with_state

SHARDS = 64
_TASK_ROWS = 200_000  # rows that a task packs at once
_BLOCK_ROWS = 50_000  # rows of a block of state or output


class InOrder(StatefulProcessor):
    """`columns` of the input (the first is the time in micros), kept until they are released."""

    columns: tuple[str, ...] = ()
    waiting_schema = ""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", self.waiting_schema)
        self.done = handle.getValueState("done", "micros bigint")

    def narrowed(self, rows: pd.DataFrame) -> pd.DataFrame:
        """Rows of a batch that have to wait."""
        return rows

    def released_until(self, watermark_ms: int) -> int:
        """Rows of this time in micros and before can leave."""
        return watermark_ms * 1000

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        oldest, done = None, self.done.get()[0] if self.done.exists() else None
        for batch in rows:
            kept = self.narrowed(batch if done is None else batch[batch["micros"] > done])
            if not len(kept):
                continue
            first = int(kept["micros"].min())
            oldest = first if oldest is None else min(oldest, first)
            self.waiting.appendList([tuple(None if pd.isna(v) else v for v in r) for r in kept[list(self.columns)].itertuples(index=False, name=None)])
        if oldest is not None:
            self.wake(oldest)
        yield from ()  # a frame without rows costs as much as one with some

    def wake(self, micros: int) -> None:
        self.handle.registerTimer(self.due(micros))

    def due(self, micros: int) -> int:
        return micros // 1000 + 1

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = self.released_until(timerValues.getCurrentWatermarkInMs())
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((r for r in held if r[0] <= until), key=lambda r: tuple((v is not None, v) for v in r[:2]))
        rest = [r for r in held if r[0] > until]
        if rest:
            self.waiting.put(rest)
            self.wake(min(r[0] for r in rest))
        elif held:
            self.waiting.clear()
        if ready:
            self.done.update((until,))
        out = self.release(key, ready, until)
        if out:
            yield self.frame(key, out)

    def release(self, key, ready: list[tuple], until: int) -> list[tuple]:
        raise NotImplementedError

    def frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        raise NotImplementedError

    def close(self) -> None:
        pass


class LastSeen(InOrder):
    """Remembers a vessel's last released ping, for `idle` micros of event time if that is given."""

    columns = ("micros", "seq", "lat", "lon")
    waiting_schema = "micros bigint, seq bigint, lat double, lon double"

    def __init__(self, idle: int | None):
        self.idle = idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.last = handle.getValueState("last", self.waiting_schema)

    def release(self, key, ready: list[tuple], until: int) -> list[tuple]:
        last, out = tuple(self.last.get()) if self.last.exists() else None, []
        for ping in ready:
            if last is not None and self.idle is not None and ping[0] - last[0] > self.idle:
                last = None
            out.append((*key, *ping, *((last[0], *last[2:]) if last else (None, None, None))))
            last = ping
        if last is not None and self.idle is not None and until - last[0] > self.idle:
            self.last.clear()
            self.done.clear()
        elif last is not None:
            if ready:
                self.last.update(last)
            if self.idle is not None:
                self.wake(last[0] + self.idle)
        return out

    def frame(self, key, rows: list[tuple]) -> pd.DataFrame:
        names = ("mmsi", *self.columns, "prev_micros", "prev_lat", "prev_lon")
        whole = {n: pd.array([r[i] for r in rows], dtype="Int64") for i, n in enumerate(names) if n in ("micros", "seq", "prev_micros")}
        return pd.DataFrame({n: whole.get(n, pd.Series([r[i] for r in rows], dtype="object" if n == "mmsi" else "float64")) for i, n in enumerate(names)})


def stream_last_seen(pings: DataFrame, delay: str = "10 minutes", idle_seconds: int | None = None) -> DataFrame:
    """Each ping with time and place of the vessel's ping before it, in event-time order: `last_seen` on a stream.

    A ping leaves once the watermark, `delay` behind the newest ping, has passed it. With `idle_seconds` a vessel is
    forgotten when it has been silent that long, and its next ping has no predecessor; without it the state
    holds one ping per vessel for good. Pings without a time or vessel are not part of the stream.
    """
    marked = pings.where("ts IS NOT NULL AND mmsi IS NOT NULL").withWatermark("ts", delay)
    keyed = marked.select("mmsi", "ts", F.unix_micros("ts").alias("micros"), "seq", "lat", "lon")
    out = keyed.groupBy("mmsi").transformWithStateInPandas(
        statefulProcessor=LastSeen(None if idle_seconds is None else idle_seconds * 1_000_000),
        outputStructType="mmsi string, micros bigint, seq bigint, lat double, lon double, prev_micros bigint, prev_lat double, prev_lon double",
        outputMode="Append", timeMode="EventTime")
    at = lambda c: F.timestamp_micros(c)
    return out.select("mmsi", at("micros").alias("ts"), "seq", "lat", "lon", at("prev_micros").alias("prev_ts"), "prev_lat", "prev_lon")


def _as_block(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def _blocks(table: pa.Table, rows: int = _BLOCK_ROWS) -> Iterator[bytes]:
    for at in range(0, len(table), rows):
        yield _as_block(table.slice(at, rows))


def _of_blocks(blocks, schema: pa.Schema) -> pa.Table:
    return pa.concat_tables([schema.empty_table(), *(pa.ipc.open_stream(b).read_all() for b in blocks)])


def _pack(schema: pa.Schema, narrowed):
    """For `mapInArrow`: one row per shard for the rows a task holds, with their first and last time and the rows as a block."""

    def flush(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        table = table.take(pc.sort_indices(table["shard"]))
        shard = table["shard"].to_numpy()
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        rows = table.select(schema.names).cast(schema)
        for at, end in zip(starts, np.r_[starts[1:], len(table)]):
            part = narrowed(rows.slice(at, end - at))
            span = pc.min_max(part["micros"]).as_py()
            yield pa.record_batch({
                "shard": pa.array([shard[at]], pa.int32()), "first": pa.array([span["min"]], pa.int64()),
                "last": pa.array([span["max"]], pa.int64()), "block": pa.array([_as_block(part)], pa.binary())})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                n += batch.num_rows
            if n >= _TASK_ROWS:
                yield from flush(held)
                held, n = [], 0
        if held:
            yield from flush(held)

    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in batch.column("block"):
            yield from pa.ipc.open_stream(block.as_buffer()).read_all().to_batches()


def _coded(mmsi: list[pa.ChunkedArray]) -> tuple[np.ndarray, pa.Array]:
    """Numbers of the vessels, and the vessel of each number."""
    names = pa.chunked_array([c for column in mmsi for c in column.chunks], pa.string()).combine_chunks().dictionary_encode()
    return names.indices.to_numpy(), names.dictionary


def _in_order(table: pa.Table, codes: np.ndarray) -> np.ndarray:
    """Places of the rows by vessel, time and number, missing numbers first."""
    keys = pa.table({"code": pa.array(codes), "micros": table["micros"], "seq": table["seq"]})
    return pc.sort_indices(keys, sort_keys=[(k, "ascending") for k in keys.column_names], null_placement="at_start").to_numpy()


class ShardInOrder(StatefulProcessor):
    """Blocks of rows of a shard's vessels (mmsi, micros, seq and more), kept until the rows are released."""

    schema: pa.Schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "block binary")
        self.done = handle.getValueState("done", "micros bigint")

    def load(self, state, schema: pa.Schema) -> pa.Table:
        return _of_blocks((bytes(r[0]) for r in state.get()) if state.exists() else (), schema)

    def store(self, state, table: pa.Table) -> None:
        if len(table):
            state.put([(b,) for b in _blocks(table)])
        elif state.exists():
            state.clear()

    def narrowed(self, rows: pa.Table) -> pa.Table:
        """Rows that have to wait."""
        return rows

    def released_until(self, watermark_ms: int) -> int:
        """Rows of this time in micros and before can leave."""
        return watermark_ms * 1000

    def due(self, micros: int) -> int:
        return micros // 1000 + 1

    def wake(self, micros: int) -> None:
        self.handle.registerTimer(self.due(micros))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        oldest = None
        for batch in rows:
            first = int(batch["first"].min())
            oldest = first if oldest is None else min(oldest, first)
            self.waiting.appendList([(bytes(b),) for b in batch["block"]])
        if oldest is not None:
            self.wake(oldest)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        until = self.released_until(timerValues.getCurrentWatermarkInMs())
        done = self.done.get()[0] if self.done.exists() else None
        if done is not None and until <= done:  # another timer of the shard has released all there is
            return
        held = self.load(self.waiting, self.schema)
        if done is not None:
            held = held.filter(pc.greater(held["micros"], done))
        ready, rest = (held.filter(on(held["micros"], until)) for on in (pc.less_equal, pc.greater))
        self.store(self.waiting, rest)
        if len(rest):
            self.wake(pc.min(rest["micros"]).as_py())
        self.done.update((until,))
        for block in _blocks(self.release(ready, until)):
            yield pd.DataFrame({"block": [block]})

    def release(self, ready: pa.Table, until: int) -> pa.Table:
        raise NotImplementedError

    def close(self) -> None:
        pass


def _sharded(rows: DataFrame, processor: ShardInOrder, delay: str, shards: int, schema: str) -> DataFrame:
    """What `processor` makes of the rows (mmsi, micros and more). A block's event time is that of its last row."""
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("mmsi"), F.lit(shards)).cast("int"))
    packed = dealt.mapInArrow(_pack(processor.schema, processor.narrowed), "shard int, first bigint, last bigint, block binary")
    marked = packed.withColumn("ts", F.timestamp_micros("last")).withWatermark("ts", delay)
    out = marked.select("shard", "ts", "first", "block").groupBy("shard").transformWithStateInPandas(
        statefulProcessor=processor, outputStructType="block binary", outputMode="Append", timeMode="EventTime")
    return out.mapInArrow(_unpacked, schema)


def _arrow(**types) -> pa.Schema:
    return pa.schema(list(types.items()))


_I, _D, _S = pa.int64(), pa.float64(), pa.string()
_AXES = [f"{axis}{i}" for axis in "xy" for i in range(5)]
_LIVE = _arrow(mmsi=_S, track_id=_S, last=_I, **dict.fromkeys(_AXES, _D))
_STEP = pa.schema([(c, _I if c == "ts" else _S if c in ("track_id", "mmsi", "kind") else _D) for c in ROW_COLUMNS])


class TrackerInOrder(ShardInOrder):
    """The live tracks of a shard's vessels, fed with a vessel's newest ping of each time step once the step is complete."""

    schema = _arrow(mmsi=_S, micros=_I, seq=_I, x=_D, y=_D)

    def __init__(self, start: int, step: int):
        self.start, self.step = start, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.live = handle.getListState("live", "block binary")

    def narrowed(self, rows: pa.Table) -> pa.Table:
        # One row per step is enough, so what waits is bounded by the steps within the delay and the batches in them.
        if not len(rows):
            return rows
        codes, _ = _coded([rows["mmsi"]])
        at = _in_order(rows, codes)
        code, step = codes[at], (rows["micros"].to_numpy()[at] - self.start) // self.step
        last = np.r_[(code[1:] != code[:-1]) | (step[1:] != step[:-1]), True]
        return rows.take(pa.array(at[last]))

    def _end(self, micros: int) -> int:
        """Last micro of the step of a ping."""
        return self.start + ((micros - self.start) // self.step + 1) * self.step - 1

    def released_until(self, watermark_ms: int) -> int:
        final = watermark_ms * 1000
        return self.start + (final + 1 - self.start) // self.step * self.step - 1

    def due(self, micros: int) -> int:
        return self._end(micros) // 1000 + 1

    def release(self, ready: pa.Table, until: int) -> pa.Table:
        live: dict[str, list] = {}
        for mmsi, track_id, last, *axes in zip(*(c.to_pylist() for c in self.load(self.live, _LIVE).columns)):
            live.setdefault(mmsi, []).append((track_id, last, tuple(axes[:5]), tuple(axes[5:])))
        newest, out = self.narrowed(ready), []
        for mmsi, micros, x, y in zip(*(newest[c].to_pylist() for c in ("mmsi", "micros", "x", "y"))):
            live[mmsi], row = advance(live.get(mmsi, []), mmsi, micros, x, y)
            out.append(row)
        fresh = [(m, t[0], t[1], *t[2], *t[3]) for m, ts in live.items() for t in ts if until - t[1] <= STALE_SECONDS * 1_000_000]
        self.store(self.live, _columns(fresh, _LIVE))
        if fresh:
            self.handle.registerTimer(max(t[2] for t in fresh) // 1000 + STALE_SECONDS * 1000 + self.step // 1000)
        return _columns(out, _STEP)


def _columns(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()


def stream_tracker(
    pings: DataFrame, zone: Zone, start_micros: int = 0, seconds: int = 60, delay: str = "10 minutes", shards: int = SHARDS
) -> DataFrame:
    """The tracker from pings to filtered states, on a stream whose pings come up to `delay` late and in any order.

    Time steps are counted from `start_micros`, as in the batch operators, and a step is fed to the tracks when the
    watermark has passed its end. The states are those of `filter_tracks` over the newest ping per vessel and step.
    """
    placed = project(pings.where("ts IS NOT NULL AND mmsi IS NOT NULL AND lat IS NOT NULL AND lon IS NOT NULL"), zone)
    keyed = placed.select("mmsi", F.unix_micros("ts").alias("micros"), "seq", "x", "y")
    micros = ", ".join(f"{f.name} " + {_I: "bigint", _S: "string", _D: "double"}[f.type] for f in _STEP)
    out = _sharded(keyed, TrackerInOrder(start_micros, seconds * 1_000_000), delay, shards, micros)
    return with_state(out.withColumn("ts", F.timestamp_micros("ts")))


_PING_FIELDS = ("micros", "seq", "lat", "lon", "sog", "cog")
_COUNTER = _arrow(mmsi=_S, n=_I)
_TRACK_PING = pa.struct(list(_arrow(ts=_I, seq=_I, lat=_D, lon=_D, sog=_D, cog=_D)))
_TRACK = _arrow(mmsi=_S, track_no=_I, finished=pa.bool_(), pings=pa.list_(_TRACK_PING))


class TracksInOrder(ShardInOrder):
    """The unfinished tracks of a shard's vessels and the numbers of their next ones."""

    schema = _arrow(mmsi=_S, micros=_I, seq=_I, lat=_D, lon=_D, sog=_D, cog=_D)

    def __init__(self, size: int, idle: int | None):
        self.size, self.idle = size, idle

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.open = handle.getListState("open", "block binary")
        self.counter = handle.getListState("counter", "block binary")

    def release(self, ready: pa.Table, until: int) -> pa.Table:
        table, counter = pa.concat_tables([self.load(self.open, self.schema), ready]), self.load(self.counter, _COUNTER)
        n = len(table)
        if not n:
            return _TRACK.empty_table()
        codes, vessels = _coded([table["mmsi"], counter["mmsi"]])
        table = table.take(pa.array(order := _in_order(table, codes[:n])))
        code, micros, at = codes[order], table["micros"].to_numpy(), np.arange(n)
        # A vessel's first ping opens a run, and so does one after a silence; tracks are cut from the start of the run.
        opens = np.r_[True, code[1:] != code[:-1]]
        if self.idle is not None:
            opens[1:] |= np.diff(micros) > self.idle
        starts = np.flatnonzero((at - np.maximum.accumulate(np.where(opens, at, 0))) % self.size == 0)
        ends = np.r_[starts[1:], n]
        vessel, finished = code[starts], ends - starts == self.size
        leaves = finished | ~np.r_[vessel[1:] != vessel[:-1], True]
        if self.idle is not None:
            leaves |= until - micros[ends - 1] > self.idle
        held, left = ends[~leaves], vessel[leaves]
        if len(held) and self.idle is not None:
            self.wake(int(micros[held - 1].min()) + self.idle)
        gone = np.repeat(leaves, ends - starts)
        self.store(self.open, table.filter(pa.array(~gone)))

        numbers = np.zeros(len(vessels), dtype=np.int64)
        numbers[codes[n:]] = counter["n"].to_numpy()
        firsts = np.flatnonzero(np.r_[True, left[1:] != left[:-1]][: len(left)])
        number = numbers[left] + np.arange(len(left)) - np.repeat(firsts, np.diff(np.r_[firsts, len(left)]))
        if len(left):
            numbers += np.bincount(left, minlength=len(vessels))
            known = numbers > 0
            self.store(self.counter, pa.table([vessels.filter(pa.array(known)), numbers[known]], schema=_COUNTER))
        pings = table.filter(pa.array(gone)).combine_chunks()
        values = pa.StructArray.from_arrays([_one(pings[c]) for c in _PING_FIELDS], fields=list(_TRACK_PING))
        offsets = pa.array(np.r_[0, np.cumsum((ends - starts)[leaves])], pa.int32())
        return pa.table(
            [vessels.take(pa.array(left)), number, finished[leaves], pa.ListArray.from_arrays(offsets, values)], schema=_TRACK)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


def stream_ordered_tracks(
    pings: DataFrame, size: int = 4, delay: str = "10 minutes", idle_seconds: int | None = None, shards: int = SHARDS
) -> DataFrame:
    """Tracks of `size` pings in event-time order from pings that come up to `delay` late, in the layout of `build_tracks`
    with a column `finished`.

    With `idle_seconds`, a silence longer than that ends a track; the pings it has by then leave as a track that is not
    finished, so that none is lost with the state. Without it, an unfinished track waits for more. A vessel's
    state is its pings within the delay and fewer than `size` more; they are appended batch by batch.
    """
    keyed = pings.where("ts IS NOT NULL AND mmsi IS NOT NULL").select("mmsi", F.unix_micros("ts").alias("micros"), *_PING_FIELDS[1:])
    fields = "ts:bigint,seq:bigint,lat:double,lon:double,sog:double,cog:double"
    processor = TracksInOrder(size, None if idle_seconds is None else idle_seconds * 1_000_000)
    out = _sharded(keyed, processor, delay, shards, f"mmsi string, track_no bigint, finished boolean, pings array<struct<{fields}>>")
    stamped = F.transform("pings", lambda p: F.struct(F.timestamp_micros(p["ts"]).alias("ts"), *[p[c].alias(c) for c in _PING_FIELDS[1:]]))
    tracks = out.select("mmsi", "track_no", "finished", stamped.alias("pings"))
    return tracks.select("mmsi", "track_no", "finished", F.array_min("pings.ts").alias("min_ts"), F.array_max("pings.ts").alias("max_ts"), "pings")
