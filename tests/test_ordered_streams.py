"""Streams in event-time order: what comes late within the delay changes nothing."""

import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tests.test_streaming import drain, read_files
from tracklake.functions.geo import zone_of
from tracklake.operators import kalman, tracks
from tracklake.streaming.ordered import stream_last_seen, stream_ordered_tracks, stream_tracker

SCHEMA = "mmsi string, ts timestamp, seq long, lat double, lon double, sog double, cog double"


def pings(spark, seed, n=160, vessels=4, gap=40):
    """Half of the pings belong to one vessel; some share their time."""
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        vessel = 0 if k % 2 == 0 else rnd.randrange(vessels)
        rows.append((f"v{vessel}", 1_700_000_000 + k * gap // 2 * 2, k, 50.0 + vessel + k * 1e-4, -1.0 + k * 1e-4, 5.0, 90.0))
    return spark.createDataFrame([(m, None, *r) for m, _, *r in rows], SCHEMA).withColumn(
        "ts", F.timestamp_seconds(F.lit(1_700_000_000) + F.floor(F.col("seq") / 2) * 2 * gap))


def in_order_of_arrival(df, path, late_seconds, files=5):
    """Files in which each ping is up to `late_seconds` late, then a ping that ends the stream."""
    at = F.unix_seconds("ts") + F.pmod(F.xxhash64("seq", F.lit(3)), F.lit(late_seconds))
    lo, hi = df.agg(F.min(at), F.max(at)).first()
    part = F.floor((at - lo) * files / F.lit(hi - lo + 1)).cast("int")
    for k in range(files):
        df.where(part == k).orderBy(F.xxhash64("seq")).coalesce(1).write.mode("append").parquet(path)
    end = df.limit(1).withColumns({"mmsi": F.lit("end"), "ts": F.timestamp_seconds(F.lit(hi + 10_000_000))})
    end.coalesce(1).write.mode("append").parquet(path)
    return read_files(df.sparkSession, path, df.schema)


@pytest.fixture(scope="module")
def moving(spark):
    return pings(spark, 1).cache()


def test_last_seen_in_any_order(moving, tmp_path):
    source = in_order_of_arrival(moving, str(tmp_path / "in"), 600)
    got = drain(stream_last_seen(source, "20 minutes"), tmp_path)
    want = tracks.last_seen(moving)
    names = ("mmsi", "seq", "prev_ts", "prev_lat", "prev_lon")
    assert rows_of(got, *names) == rows_of(want, *names)


def test_last_seen_forgets_silent_vessels(spark, tmp_path):
    rows = [("a", 0, 1), ("a", 50, 2), ("a", 200, 3), ("b", 10, 4), ("b", 300, 5), (None, 5, 6), ("a", None, 7)]
    df = spark.createDataFrame(rows, "mmsi string, t long, seq long").select(
        "mmsi", F.timestamp_seconds(F.col("t") + 1_700_000_000).alias("ts"), "seq", F.lit(1.0).alias("lat"), F.lit(2.0).alias("lon"))
    source = in_order_of_arrival(df.where("ts IS NOT NULL"), str(tmp_path / "in"), 10, files=3)
    got = drain(stream_last_seen(source, "1 minute", idle_seconds=100), tmp_path)
    assert {r.seq: r.prev_ts is not None for r in got.collect()} == {1: False, 2: True, 3: False, 4: False, 5: False}


def test_rows_that_come_after_later_ones_have_left_are_dropped(moving, tmp_path):
    path = str(tmp_path / "in")
    for part in ("seq BETWEEN 40 AND 99", "seq BETWEEN 100 AND 129", "seq >= 130"):
        moving.where(part).coalesce(1).write.mode("append").parquet(path)
    source = in_order_of_arrival(moving.where("seq < 40"), path, 1, files=1)
    got = drain(stream_last_seen(source, "1 minute"), tmp_path)
    want = tracks.last_seen(moving.where("seq >= 40"))
    assert rows_of(got, "seq", "prev_ts") == rows_of(want, "seq", "prev_ts")


def test_tracker_in_any_order(moving, tmp_path):
    zone, start = zone_of(50.0, -1.0), moving.agg(F.min(F.unix_micros("ts"))).first()[0]
    source = in_order_of_arrival(moving, str(tmp_path / "in"), 600)
    got = drain(stream_tracker(source, zone, start, delay="20 minutes"), tmp_path)
    newest = tracks.latest_per_vessel(tracks.sync_to_grid(moving, 60, start))
    want = kalman.filter_tracks(kalman.project(newest, zone))
    names = ("track_id", "mmsi", "ts", "kind", "x", "vx", "y", "vy", "p_xx", "q_vv")
    assert want.count() > 60 and rows_of(got, *names) == rows_of(want, *names)


def test_tracks_in_any_order(moving, tmp_path):
    source = in_order_of_arrival(moving, str(tmp_path / "in"), 600)
    got = drain(stream_ordered_tracks(source, 4, "20 minutes"), tmp_path)
    want = tracks.build_tracks(moving)
    flat = lambda d: rows_of(d.select("mmsi", "track_no", "min_ts", "max_ts", F.to_json("pings").alias("pings")))
    assert got.where("finished").count() == got.count() and flat(got) == flat(want)


def test_silence_ends_a_track_and_loses_no_ping(moving, tmp_path):
    pause = moving.withColumn("ts", F.when(F.col("seq") < 81, F.col("ts")).otherwise(F.col("ts") + F.expr("interval 5 hours")))
    source = in_order_of_arrival(pause, str(tmp_path / "in"), 600)
    got = drain(stream_ordered_tracks(source, 4, "20 minutes", idle_seconds=7200), tmp_path).cache()
    assert got.agg(F.sum(F.size("pings"))).first()[0] == 160
    assert got.where(F.col("finished") != (F.size("pings") == 4)).count() == 0 and got.where("NOT finished").count() > 4
    assert got.where(F.unix_seconds("max_ts") - F.unix_seconds("min_ts") > 7200).count() == 0
    per_vessel = got.groupBy("mmsi").agg(F.count("*").alias("n"), F.max("track_no").alias("last")).collect()
    assert all(r["n"] == r["last"] + 1 for r in per_vessel)


def test_vessels_that_wait_send_no_frame():
    import pandas as pd

    from tracklake.streaming.ordered import LastSeen

    class State(list):
        exists, appendList = (lambda self: False), list.extend

    class Handle:
        timers = []
        getListState = getValueState = lambda self, *_: State()
        registerTimer = timers.append

    seen = LastSeen(None)
    seen.init(Handle())
    rows = pd.DataFrame({"micros": [5_000], "seq": [1], "lat": [1.0], "lon": [2.0]})
    assert list(seen.handleInputRows(("a",), iter([rows]), None)) == [] and seen.waiting == [(5_000, 1, 1.0, 2.0)] and Handle.timers == [6]


def test_late_pings_come_in_time_however_many_files_hold_the_table(spark, tmp_path):
    from pathlib import Path

    from tracklake.plans.queries import _late_pings

    steady = pings(spark, 2, n=1200, gap=60).repartition(9)
    source = _late_pings(steady, str(tmp_path / "late"), 1200)
    assert [len(list(f.glob("part-*"))) for f in sorted(Path(tmp_path / "late/in").iterdir())] == [1] * 7
    got = drain(stream_ordered_tracks(source, 4, "20 minutes", idle_seconds=7200), tmp_path).where("mmsi <> 'end'")
    assert got.agg(F.sum(F.size("pings"))).first()[0] == 1200


class HeldState:
    def __init__(self):
        self.rows = []

    exists = lambda self: bool(self.rows)
    get = lambda self: list(self.rows)
    appendList = lambda self, rows: self.rows.extend(rows)
    put = lambda self, rows: setattr(self, "rows", list(rows))
    update = lambda self, row: setattr(self, "rows", list(row))
    clear = lambda self: setattr(self, "rows", [])


class FakeHandle:
    def __init__(self):
        self.timers = []

    getListState = getValueState = lambda self, *_: HeldState()
    registerTimer = lambda self, ms: self.timers.append(ms)


class FakeClock:
    getCurrentWatermarkInMs = lambda self: 2_000


def test_one_timer_works_on_all_vessels_of_a_shard():
    import pandas as pd
    import pyarrow as pa

    from tracklake.streaming import ordered

    tracks_of = ordered.TracksInOrder(2, None)
    handle = FakeHandle()
    tracks_of.init(handle)
    rows = pa.table({"mmsi": [f"v{k % 50}" for k in range(150)], "micros": [k * 20_000 for k in range(150)], "seq": range(150),
                     **{c: [1.0] * 150 for c in ("lat", "lon", "sog", "cog")}}, schema=tracks_of.schema)
    arrived = pd.DataFrame({"first": [0], "last": [2_980_000], "block": [ordered._as_block(rows)]})
    assert list(tracks_of.handleInputRows((0,), iter([arrived]), None)) == [] and handle.timers == [1]
    out = list(tracks_of.handleExpiredTimer((0,), FakeClock(), None))
    got = ordered._of_blocks(out[0]["block"], ordered._TRACK).to_pylist()
    # 101 pings until 2 s: each vessel has a whole track, and v0 one ping more, which waits with the 49 that come later.
    assert len(out) == 1 and [(t["track_no"], t["finished"], [p["seq"] for p in t["pings"]]) for t in got] == [
        (0, True, [k, k + 50]) for k in range(50)]
    assert len(tracks_of.load(tracks_of.open, tracks_of.schema)) == 1 and len(tracks_of.load(tracks_of.waiting, tracks_of.schema)) == 49
    assert list(tracks_of.handleExpiredTimer((0,), FakeClock(), None)) == []


def test_one_timer_feeds_all_trackers_of_a_shard():
    import pandas as pd
    import pyarrow as pa

    from tracklake.streaming import ordered

    tracker, handle = ordered.TrackerInOrder(0, 1_000_000), FakeHandle()
    tracker.init(handle)
    rows = pa.table({"mmsi": [f"v{k % 3}" for k in range(60)], "micros": [k * 50_000 for k in range(60)], "seq": range(60),
                     "x": [k * 0.1 for k in range(60)], "y": [2.0] * 60}, schema=tracker.schema)
    waiting = tracker.narrowed(rows)
    assert sorted(waiting["seq"].to_pylist()) == [17, 18, 19, 37, 38, 39, 57, 58, 59]  # the newest of a vessel and step
    arrived = pd.DataFrame({"first": [0], "last": [2_950_000], "block": [ordered._as_block(waiting)]})
    assert list(tracker.handleInputRows((0,), iter([arrived]), None)) == []
    out = list(tracker.handleExpiredTimer((0,), FakeClock(), None))
    got, want = ordered._of_blocks(out[0]["block"], ordered._STEP).to_pylist(), []
    for vessel, seqs in (("v2", (17, 38)), ("v0", (18, 39)), ("v1", (19, 37))):
        live = []
        for k in seqs:
            live, row = kalman.advance(live, vessel, k * 50_000, k * 0.1, 2.0)
            want.append(dict(zip(kalman.ROW_COLUMNS, row)))
    at = lambda r: (r["mmsi"], r["ts"])
    assert len(out) == 1 and sorted(got, key=at) == sorted(want, key=at)
    assert tracker.load(tracker.live, ordered._LIVE)["mmsi"].to_pylist() == ["v0", "v1", "v2"]
