"""Driver tables read as vessel data.

`events` stands in for a position table: a user is a vessel, an event a ping. All arithmetic is on
integers with one final division, so the text of every number is the same in any engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare
from .pings import canonical

EPOCH_2024 = 1_704_067_200_000_000
TIME_DIVISOR = 200


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events_as_pings(events: DataFrame, compressed: bool = False) -> DataFrame:
    """`compressed` divides time by 200, which turns hours between pings into minutes."""
    ts = F.col("ts").cast("timestamp")
    if compressed:
        micros = F.unix_micros(ts)
        ts = F.timestamp_micros(F.lit(EPOCH_2024) + F.floor((micros - F.lit(EPOCH_2024)) / F.lit(TIME_DIVISOR)))
    k = F.get_json_object("props", "$.k").cast("int")
    user, event = F.col("user_id"), F.col("event_id")
    lat_e5 = F.lit(5_050_000) + (user % 50) * 1000 + k + F.when(event % 41 == 0, 5000).otherwise(0)
    lon_e5 = F.lit(-150_000) + (user % 37) * 1000 + (event % 97)
    code = F.expr("CASE event_type WHEN 'click' THEN '1001' WHEN 'view' THEN '1004' WHEN 'purchase' THEN '1011' ELSE '9999' END")
    picks = {
        "mmsi": (F.lit(200_000_000) + user).cast("string"),
        "ts": ts,
        "lat": lat_e5 / F.lit(100000.0),
        "lon": lon_e5 / F.lit(100000.0),
        "sog": F.col("value"),
        "cog": k * F.lit(3.0),
        "heading": k * F.lit(1.0),
        "vessel_name": F.when(user % 3 == 0, "").otherwise(F.concat(F.lit("VESSEL "), user.cast("string"))),
        "imo": F.when(user % 4 == 0, "").otherwise((F.lit(9_000_000) + user).cast("string")),
        "call_sign": F.when(user % 5 == 0, "").otherwise(F.concat(F.lit("CS"), user.cast("string"))),
        "vessel_type": code,
        "status": F.col("event_type"),
        "length": (user % 200) + F.lit(20.0),
        "width": (user % 30) + F.lit(5.0),
        "draft": (user % 10) + F.lit(1.5),
        "cargo": F.lit(None),
    }
    return canonical(events, picks, event)


def pings(spark: SparkSession, sf_dir: str, compressed: bool = False) -> DataFrame:
    return events_as_pings(table(spark, sf_dir, "events"), compressed)
