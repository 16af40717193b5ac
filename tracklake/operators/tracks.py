"""Pings to tracks: fixed-size batches per vessel, bounds, last-seen lookup, ends and sessions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.geo import Zone, zone_of
from .ordered import DEFAULT_LIMIT, HotKeys, find_hot, keyed_index, look_back

TRACK_SIZE = 4
PING_PARTS = ("ts", "seq", "lat", "lon", "sog", "cog")


def number_batches(
    pings: DataFrame, size: int = TRACK_SIZE, *, hot: HotKeys | None = None, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """Give each ping its track number and drop the unfinished batch at the end of each vessel.

    One exchange on mmsi: the row number and the vessel's row count come from the same partitioning.
    """
    indexed = keyed_index(pings, ["mmsi"], ["ts", "seq"], index="_rn", total="_n", hot=hot, limit=limit)
    return (
        indexed.withColumn("track_no", F.expr(f"(_rn - 1) div {size}"))
        .where(F.col("track_no") < F.expr(f"_n div {size}"))
        .drop("_rn", "_n")
    )


def track_bounds(batches: DataFrame) -> DataFrame:
    """First and last time of each track."""
    return batches.groupBy("mmsi", "track_no").agg(
        F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"), F.count("*").alias("n_pings")
    )


def build_tracks(
    pings: DataFrame, size: int = TRACK_SIZE, parts=PING_PARTS, *, hot: HotKeys | None = None, **kw
) -> DataFrame:
    """One row per finished track, with its `size` pings in time order."""
    batches = number_batches(pings.select("mmsi", *parts), size, hot=hot, **kw)
    return batches.groupBy("mmsi", "track_no").agg(
        F.min("ts").alias("min_ts"),
        F.max("ts").alias("max_ts"),
        F.array_sort(F.collect_list(F.struct(*parts))).alias("pings"),
    )


def last_seen(pings: DataFrame, parts=("ts", "lat", "lon"), **kw) -> DataFrame:
    """Previous ping of the same vessel, as `prev_*` columns."""

    def add(df: DataFrame, w: Window) -> DataFrame:
        return df.select("*", *[F.lag(c).over(w).alias(f"prev_{c}") for c in parts])

    return look_back(pings, ["mmsi"], ["ts", "seq"], 1, add, **kw)


def first_pings(pings: DataFrame, n: int) -> DataFrame:
    """The `n` earliest pings (top-n, no full sort)."""
    return pings.orderBy("ts", "seq").limit(n)


def in_time_order(pings: DataFrame) -> DataFrame:
    return pings.orderBy("ts", "seq")


def last_points(batches: DataFrame) -> DataFrame:
    """Final position of each track."""
    last = F.max(F.struct("ts", "seq", "lat", "lon"))
    return (
        batches.groupBy("mmsi", "track_no")
        .agg(last.alias("_last"))
        .select("mmsi", "track_no", F.col("_last.ts").alias("ts"), "_last.lat", "_last.lon")
    )


def sync_to_grid(pings: DataFrame, seconds: int = 60, start_micros: int = 0) -> DataFrame:
    """Number the time step each ping falls in."""
    step = F.floor((F.unix_micros("ts") - F.lit(start_micros)) / F.lit(seconds * 1_000_000)).cast("bigint")
    return pings.withColumn("step", step)


def latest_per_vessel(synced: DataFrame, parts=("lat", "lon")) -> DataFrame:
    """Newest ping of each vessel in each time step. Combined before the shuffle, so a busy vessel
    sends at most one row per step and task."""
    newest = F.max(F.struct("ts", "seq", *parts)).alias("_newest")
    return synced.groupBy("mmsi", "step").agg(newest).select("mmsi", "step", "_newest.*")


def step_counts(synced: DataFrame) -> DataFrame:
    """Pings per vessel and time step."""
    return synced.groupBy("mmsi", "step").agg(F.count("*").alias("n_pings"))


def first_zone(pings: DataFrame) -> Zone:
    """UTM zone of the earliest detection: one row reaches the driver."""
    row = pings.agg(F.min(F.struct("ts", "seq", "lat", "lon")).alias("f")).first()
    return zone_of(row.f.lat, row.f.lon)


def first_micros(pings: DataFrame) -> int:
    return pings.agg(F.min(F.unix_micros("ts"))).first()[0]


def sessions(
    pings: DataFrame, gap_seconds: int = 600, *, hot: HotKeys | None = None, limit: int = DEFAULT_LIMIT
) -> DataFrame:
    """Runs of pings of one vessel with no silence longer than `gap_seconds`.

    Only rows that open a session, and the last row of each vessel, leave the first window; ends and
    counts follow from the next such row. Pings without a time are in no session.
    """
    # `seq` only breaks ties here; a number in place of null keeps its order when it is turned round.
    pings = pings.where("ts IS NOT NULL").select("mmsi", "ts", F.coalesce("seq", F.lit(-(2**62))).alias("seq"))
    hot = find_hot(pings, ["mmsi"], limit) if hot is None else hot

    def flag(df: DataFrame, w: Window) -> DataFrame:
        gap = F.unix_micros("ts") - F.unix_micros("_before")
        return df.withColumn("_before", F.lag("ts").over(w)).withColumn(
            "_opens", F.col("_before").isNull() | (gap > gap_seconds * 1_000_000)
        )

    indexed = keyed_index(pings, ["mmsi"], ["ts", "seq"], index="_rn", total="_n", hot=hot)
    edges = look_back(indexed, ["mmsi"], ["ts", "seq"], 1, flag, hot=hot)
    edges = edges.where(F.col("_opens") | (F.col("_rn") == F.col("_n")))
    # Newest first, so that the next edge is one row back.
    edges = edges.withColumn("_back", -F.unix_micros("ts")).withColumn("_back_seq", -F.col("seq"))
    edge_hot = find_hot(edges, ["mmsi"], limit) if hot else hot

    def close(df: DataFrame, w: Window) -> DataFrame:
        nxt = F.lag(F.struct("ts", "_rn", "_before", "_opens")).over(w)
        return df.withColumn("_next", nxt)

    closed = look_back(edges, ["mmsi"], ["_back", "_back_seq"], 1, close, hot=edge_hot).where("_opens")
    following = F.col("_next")
    end = (
        F.when(following.isNull(), F.col("ts"))
        .when(following["_opens"], following["_before"])
        .otherwise(following["ts"])
    )
    count = (
        F.when(following.isNull(), F.lit(1))
        .when(following["_opens"], following["_rn"] - F.col("_rn"))
        .otherwise(following["_rn"] - F.col("_rn") + 1)
    )
    opened = closed.select(
        "mmsi", "seq", F.col("ts").alias("start_ts"), end.alias("end_ts"), count.cast("bigint").alias("n_pings")
    )
    numbered = keyed_index(opened, ["mmsi"], ["start_ts", "seq"], index="session_no", hot=edge_hot)
    return numbered.drop("seq")
