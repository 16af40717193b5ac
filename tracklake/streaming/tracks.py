"""Tracks built incrementally: a track leaves as soon as it is full."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

OUT_SCHEMA = (
    "mmsi string, track_no bigint, pings array<struct<ts:bigint,seq:bigint,lat:double,lon:double,sog:double,cog:double>>"
)
_PARTS = ["micros", "seq", "lat", "lon", "sog", "cog"]
_OPEN_SCHEMA = "micros bigint, seq bigint, lat double, lon double, sog double, cog double"


class TrackBuilder(StatefulProcessor):
    """State per vessel: the pings of the unfinished track (fewer than `size`) and the track counter."""

    def __init__(self, size: int, idle_ms: int | None = None):
        self.size = size
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getListState("open", _OPEN_SCHEMA, ttlDurationMs=self.idle_ms)
        self.counter = handle.getValueState("counter", "n bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held = [tuple(r) for r in self.open.get()] if self.open.exists() else []
        arrived = pd.concat(list(rows))[_PARTS].sort_values(["micros", "seq"])
        pings = held + list(arrived.itertuples(index=False, name=None))
        number = self.counter.get()[0] if self.counter.exists() else 0
        full = len(pings) // self.size
        tracks = [pings[i * self.size : (i + 1) * self.size] for i in range(full)]
        rest = pings[full * self.size :]
        if rest:
            self.open.put([tuple(p) for p in rest])
        else:
            self.open.clear()
        self.counter.update((number + full,))
        names = ["ts", "seq", "lat", "lon", "sog", "cog"]
        yield pd.DataFrame(
            {
                "mmsi": [key[0]] * full,
                "track_no": list(range(number, number + full)),
                "pings": [[dict(zip(names, p)) for p in t] for t in tracks],
            }
        )

    def close(self) -> None:
        pass


def stream_tracks(pings: DataFrame, size: int = 4, idle_ms: int | None = None) -> DataFrame:
    """Finished tracks of a ping stream, in the layout of the batch builder.

    Pings of a vessel must reach the stream in time order; within a trigger they are sorted. The trigger
    size (maxFilesPerTrigger, maxOffsetsPerTrigger) bounds what one vessel can bring at once.
    """
    keyed = pings.select("mmsi", F.unix_micros("ts").alias("micros"), *_PARTS[1:])
    out = keyed.groupBy("mmsi").transformWithStateInPandas(
        statefulProcessor=TrackBuilder(size, idle_ms),
        outputStructType=OUT_SCHEMA,
        outputMode="Append",
        timeMode="ProcessingTime" if idle_ms else "None",
    )
    stamped = F.transform(
        "pings",
        lambda p: F.struct(
            F.timestamp_micros(p["ts"]).alias("ts"), *[p[c].alias(c) for c in ("seq", "lat", "lon", "sog", "cog")]
        ),
    )
    tracks = out.select("mmsi", "track_no", stamped.alias("pings"))
    return tracks.select(
        "mmsi", "track_no", F.array_min("pings.ts").alias("min_ts"), F.array_max("pings.ts").alias("max_ts"), "pings"
    )
