"""The multi-target tracker on a stream of synchronised, projected detections."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.kalman import STALE_SECONDS, STEP_SCHEMA, advance, rows_frame, with_state
from ..operators.tracks import sync_to_grid

_LIVE_SCHEMA = (
    "track_id string, last bigint, "
    + ", ".join(f"{axis}{i} double" for axis in "xy" for i in range(5))
)


class Tracker(StatefulProcessor):
    """State per vessel: its live tracks. A timer drops them once the vessel has been silent too long."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.live = handle.getListState("live", _LIVE_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        live = []
        if self.live.exists():
            live = [(r[0], r[1], tuple(r[2:7]), tuple(r[7:12])) for r in self.live.get()]
        arrived = pd.concat(list(rows)).sort_values("micros")
        out = []
        for micros, x, y in zip(arrived["micros"], arrived["x"], arrived["y"]):
            live, row = advance(live, key[0], int(micros), float(x), float(y))
            out.append(row)
        self.live.put([(t[0], t[1], *t[2], *t[3]) for t in live])
        last = max(t[1] for t in live)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(last // 1000 + STALE_SECONDS * 1000)
        yield rows_frame(out)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.live.clear()
        yield rows_frame([])

    def close(self) -> None:
        pass


def stream_filter(projected: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Filtered states of a detection stream (mmsi, ts, x, y), already one per vessel and minute.

    The output of `stream_sync` has a column `step` with its watermark; a second watermark would hold back the first.
    """
    clock = "step" if "step" in projected.columns else "ts"
    marked = projected if clock == "step" else projected.withWatermark("ts", delay)
    keyed = marked.select("mmsi", clock, F.unix_micros("ts").alias("micros"), "x", "y")
    out = keyed.groupBy("mmsi").transformWithStateInPandas(
        statefulProcessor=Tracker(), outputStructType=STEP_SCHEMA, outputMode="Append", timeMode="EventTime"
    )
    return with_state(out)


def stream_sync(pings: DataFrame, delay: str = "10 minutes", seconds: int = 60) -> DataFrame:
    """Newest ping per vessel and time step, emitted when the watermark passes the step. `step` is the event time of later steps."""
    newest = F.max(F.struct("ts", "seq", "lat", "lon")).alias("newest")
    return (
        sync_to_grid(pings.withWatermark("ts", delay), seconds)
        .groupBy("mmsi", F.window("ts", f"{seconds} seconds"))
        .agg(newest)
        .select("mmsi", "newest.*", F.window_time("window").alias("step"))
    )
