"""Multi-target tracker over synchronised detections.

Each axis follows an Ornstein-Uhlenbeck velocity model and is measured on its own, so the four-state
filter is two two-state filters. Detections only compete with tracks of the same vessel, and at most one
detection per vessel and minute arrives, so the work of one vessel is bounded by the time range: vessels
are the unit of parallelism and the filter state is all a task keeps.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.geo import Zone, from_utm, to_utm
from .ordered import keyed_index

# Model and tracker settings.
DIFFUSION = 0.5  # q, per axis
DAMPING = 1e-4  # K, 1/s
NOISE = 15.0  # position variance of a detection, m^2
SPEED_PRIOR = 10.0  # velocity variance of a new track
MISSED_DISTANCE = 3.0
STALE_SECONDS = 600

STEP_SCHEMA = (
    "track_id string, mmsi string, ts timestamp, kind string, x double, vx double, y double, vy double, "
    "p_xx double, p_xv double, p_vv double, q_yy double, q_yv double, q_vv double"
)


def transition(dt: float) -> tuple[float, float, float, float, float]:
    """(position gain from velocity, velocity decay, Q position, Q cross, Q velocity) for a step of dt s."""
    k, q = DAMPING, DIFFUSION
    a = k * dt
    e1 = -math.expm1(-a)
    if a < 1e-4:
        noise = (q * (dt**3 / 3 - k * dt**4 / 4), q * (dt**2 / 2 - k * dt**3 / 2), q * (dt - k * dt**2))
    else:
        e2 = -math.expm1(-2 * a)
        noise = (
            q * (dt - 2 * e1 / k + e2 / (2 * k)) / k**2,
            q * (e1 / k - e2 / (2 * k)) / k,
            q * e2 / (2 * k),
        )
    return (e1 / k, 1.0 - e1, *noise)


def _predict(axis: tuple, step: tuple) -> tuple:
    m, v, pm, pc, pv = axis
    g, d, qm, qc, qv = step
    return (
        m + g * v,
        d * v,
        pm + 2 * g * pc + g * g * pv + qm,
        d * (pc + g * pv) + qc,
        d * d * pv + qv,
    )


def _update(axis: tuple, z: float) -> tuple:
    m, v, pm, pc, pv = axis
    s = pm + NOISE
    gain_m, gain_v, y = pm / s, pc / s, z - axis[0]
    return (m + gain_m * y, v + gain_v * y, pm - gain_m * pm, pc - gain_m * pc, pv - gain_v * pc)


def advance(live: list, mmsi: str, micros: int, x: float, y: float) -> tuple[list, tuple]:
    """Feed one detection to the live tracks of its vessel; returns the new live tracks and the output row.

    A live track is (track_id, last update in micros, x axis, y axis).
    """
    live = [t for t in live if micros - t[1] <= STALE_SECONDS * 1_000_000]
    best, best_d = None, MISSED_DISTANCE
    for place, (track_id, last, ax, ay) in enumerate(live):
        if last > micros:  # a late detection cannot continue a track that is already further
            continue
        step = transition((micros - last) / 1e6)
        px, py = _predict(ax, step), _predict(ay, step)
        d = math.sqrt((x - px[0]) ** 2 / (px[2] + NOISE) + (y - py[0]) ** 2 / (py[2] + NOISE))
        if d < best_d or (best is not None and d == best_d and track_id < live[best[0]][0]):
            best, best_d = (place, px, py), d
    if best is None:
        start = (0.0, NOISE, 0.0, SPEED_PRIOR)
        ax, ay = (x, *start), (y, *start)
        track = (f"{mmsi}-{micros}", micros, ax, ay)
        kind, live = "init", [*live, track]
    else:
        place, px, py = best
        ax, ay = _update(px, x), _update(py, y)
        track = (live[place][0], micros, ax, ay)
        kind, live = "update", [*live[:place], track, *live[place + 1 :]]
    row = (track[0], mmsi, micros, kind, ax[0], ax[1], ay[0], ay[1], *ax[2:], *ay[2:])
    return live, row


ROW_COLUMNS = [
    "track_id", "mmsi", "ts", "kind", "x", "vx", "y", "vy", "p_xx", "p_xv", "p_vv", "q_yy", "q_yv", "q_vv",
]


def rows_frame(rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=ROW_COLUMNS)
    out["ts"] = pd.to_datetime(out["ts"], unit="us")
    return out


def _track_partition(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Detections sorted by vessel and time; a vessel's live tracks carry over from batch to batch."""
    vessel, live = None, []
    for batch in batches:
        rows = []
        for mmsi, micros, x, y in zip(batch["mmsi"], batch["micros"], batch["x"], batch["y"]):
            if mmsi != vessel:
                vessel, live = mmsi, []
            live, row = advance(live, mmsi, micros, x, y)
            rows.append(row)
        yield rows_frame(rows)


def project(detections: DataFrame, zone: Zone) -> DataFrame:
    """Add UTM easting and northing as x and y."""
    x, y = to_utm(F.col("lat"), F.col("lon"), zone)
    return detections.select("*", x.alias("x"), y.alias("y"))


def unproject(steps: DataFrame, zone: Zone) -> DataFrame:
    """Add lat and lon of the filtered position."""
    lat, lon = from_utm(F.col("x"), F.col("y"), zone)
    return steps.select("*", lat.alias("lat"), lon.alias("lon"))


def track_set(steps: DataFrame) -> DataFrame:
    """The tracks that filtered states belong to: vessel, first and last time, and states, one row per track."""
    return steps.groupBy("track_id", "mmsi").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.countDistinct("ts").alias("n_states"))


def union_track_states(*parts: DataFrame) -> DataFrame:
    """States of tracks that were followed in several overlapping runs: each track keeps one state per time, the
    updated one if there is one. A track is in the union once, however many parts know it."""
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    names = [c for c in every.columns if c not in ("track_id", "ts")]
    best = F.max_by(F.struct(*names), F.struct((F.col("kind") == "update"), F.xxhash64(*[F.col(c) for c in names if c != "state"])))
    return every.groupBy("track_id", "ts").agg(best.alias("_one")).select("track_id", "ts", "_one.*").select(*every.columns)


def stream_track_set(steps: DataFrame) -> DataFrame:
    """Each track of a stream of states once, when its first state comes; the state is one row per track id."""
    return steps.select("track_id", "mmsi").dropDuplicates(["track_id"])


def filter_tracks(projected: DataFrame) -> DataFrame:
    """Filtered tracks, one row per detection, with the state as an array (x, vx, y, vy)."""
    rows = (
        projected.select("mmsi", F.unix_micros("ts").alias("micros"), "x", "y")
        .repartition("mmsi")
        .sortWithinPartitions("mmsi", "micros")
        .mapInPandas(_track_partition, STEP_SCHEMA)
    )
    return with_state(rows)


def with_state(rows: DataFrame) -> DataFrame:
    return rows.withColumn("state", F.array("x", "vx", "y", "vy"))


def track_counts(steps: DataFrame) -> DataFrame:
    """Number of tracks and of vessels. Tracks belong to one vessel, so both come from one row per track."""
    tracks = steps.groupBy("track_id", "mmsi").agg(F.count("*").alias("n"))
    vessels = tracks.groupBy("mmsi").agg(F.count("*").alias("tracks"), F.sum("n").alias("n"))
    return vessels.agg(
        F.sum("tracks").alias("tracks"), F.count("*").alias("vessels"), F.sum("n").alias("states")
    )


def fill_grid(steps: DataFrame, seconds: int = 60) -> DataFrame:
    """Predicted states at the whole steps without a detection, up to the stale limit or the next update.

    The model composes over time, so a prediction only needs the last updated state.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("track_id").orderBy("ts")
    gap = F.coalesce(
        F.unix_micros(F.lead("ts").over(w)) - F.unix_micros("ts"), F.lit(STALE_SECONDS * 1_000_000)
    ) / F.lit(1_000_000)
    ahead = steps.withColumn("gap", gap).withColumn(
        "dt", F.explode(F.expr(f"sequence({seconds}, greatest(cast(ceil(gap) as int) - 1, {seconds}), {seconds})"))
    ).where(F.col("dt") < F.col("gap"))
    e1 = -F.expm1(-DAMPING * F.col("dt"))
    moved = {
        "x": F.col("x") + e1 / DAMPING * F.col("vx"),
        "vx": F.col("vx") * (1 - e1),
        "y": F.col("y") + e1 / DAMPING * F.col("vy"),
        "vy": F.col("vy") * (1 - e1),
    }
    out = ahead.select(
        "track_id", "mmsi",
        F.timestamp_micros(F.unix_micros("ts") + F.col("dt").cast("bigint") * 1_000_000).alias("ts"),
        F.lit("predicted").alias("kind"),
        *[c.alias(n) for n, c in moved.items()],
    )
    return with_state(out)


def polylines(located: DataFrame) -> DataFrame:
    """Ordered points, last point and metadata of each track. One point per time step bounds the array."""
    point = F.struct(F.unix_micros("ts").alias("at"), "lat", "lon")
    return located.groupBy("track_id", "mmsi").agg(F.array_sort(F.collect_list(point)).alias("_all")).select(
        "track_id",
        F.create_map(F.lit("MMSI"), F.col("mmsi")).alias("metadata"),
        F.transform("_all", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("points"),
        F.element_at("_all", -1)["lat"].alias("last_lat"),
        F.element_at("_all", -1)["lon"].alias("last_lon"),
    )


def polyline_parts(located: DataFrame, length: int = 1000, **options) -> DataFrame:
    """Polylines in parts of at most `length` points and the first point of the next part, which closes the gap to it.

    For tracks of any length: no row holds more than a part, and the points of a long track are numbered in slices.
    """
    placed = keyed_index(located.select("track_id", "mmsi", "ts", "lat", "lon"), ["track_id"], ["ts"], index="_rn", **options)
    own = F.expr(f"(_rn - 1) div {length}")
    parts = F.when((F.col("_rn") % length == 1 % length) & (own > 0), F.array(own, own - 1)).otherwise(F.array(own))
    point = F.struct("_rn", "lat", "lon")
    return placed.withColumn("part", F.explode(parts)).groupBy("track_id", "mmsi", "part").agg(F.array_sort(F.collect_list(point)).alias("_all")).select(
        "track_id", "mmsi", "part", F.transform("_all", lambda p: F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"))).alias("points"))
