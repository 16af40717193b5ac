"""Readers of position tables, all projected to the canonical ping layout."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.text import parse_number, parse_time


def canonical(raw: DataFrame, picks: dict[str, Column], seq: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Project to the ping layout, after the `keep` columns; fields that `picks` leaves out become null."""
    columns = [picks.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.PING if f.name != "seq"]
    return raw.select(*keep, *columns, seq.cast("bigint").alias("seq"))


def ais_picks(text: dict[str, Column]) -> dict[str, Column]:
    """Canonical columns from the 16 text fields."""
    return {
        "mmsi": text["MMSI"],
        "ts": parse_time(text["BaseDateTime"]),
        "lat": parse_number(text["LAT"]),
        "lon": parse_number(text["LON"]),
        "sog": parse_number(text["SOG"]),
        "cog": parse_number(text["COG"]),
        "heading": parse_number(text["Heading"]),
        "vessel_name": text["VesselName"],
        "imo": text["IMO"],
        "call_sign": text["CallSign"],
        "vessel_type": text["VesselType"],
        "status": text["Status"],
        "length": parse_number(text["Length"]),
        "width": parse_number(text["Width"]),
        "draft": parse_number(text["Draft"]),
        "cargo": text["Cargo"],
    }


def oz_picks(text: dict[str, Column]) -> dict[str, Column]:
    """Canonical columns from the craft layout, which carries no IMO, name or call sign."""
    return {
        "mmsi": text["CRAFT_ID"],
        "lon": parse_number(text["LON"]),
        "lat": parse_number(text["LAT"]),
        "cog": parse_number(text["COURSE"]),
        "sog": parse_number(text["SPEED"]),
        "vessel_type": text["TYPE"],
        "length": parse_number(text["LENGTH"]),
        "width": parse_number(text["BEAM"]),
        "draft": parse_number(text["DRAUGHT"]),
        "ts": parse_time(text["TIMESTAMP"]),
        "imo": F.lit(""),
        "vessel_name": F.lit(""),
        "call_sign": F.lit(""),
    }


def content_seq(columns: list[str]) -> Column:
    """Tie-break for files without a row id: a hash of the row, the same on every read."""
    return F.xxhash64(*columns)


def read_ais_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schema.AIS_TEXT).option("header", True).csv(path)
    return canonical(raw, ais_picks({c: F.col(c) for c in schema.AIS_COLUMNS}), content_seq(schema.AIS_COLUMNS))


def read_oz_csv(spark: SparkSession, path: str) -> DataFrame:
    raw = spark.read.schema(schema.OZ_TEXT).option("header", True).csv(path)
    return canonical(raw, oz_picks({c: F.col(c) for c in schema.OZ_COLUMNS}), content_seq(schema.OZ_COLUMNS))


def read_ping_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schema.PING).parquet(path)


def read_position_table(
    spark: SparkSession, url: str, table: str = "position", *, bounds: tuple[int, int], splits: int, **options
) -> DataFrame:
    """A `position` table behind JDBC, read in `splits` ranges of the numeric MMSI."""
    raw = (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn="MMSI", **options)
        .options(lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(splits))
        .load()
    )
    text = {c: F.col(c).cast("string") for c in schema.AIS_COLUMNS}
    return canonical(raw, ais_picks(text), content_seq(schema.AIS_COLUMNS))


def minimal_pings(rows: DataFrame) -> DataFrame:
    """Rows of (mmsi, ts text, lat, lon)."""
    picks = {"mmsi": F.col("mmsi"), "ts": parse_time(F.col("ts")), "lat": F.col("lat"), "lon": F.col("lon")}
    return canonical(rows, picks, content_seq(["mmsi", "ts", "lat", "lon"]))


def detections(raw: DataFrame, lon: str, lat: str, time: str) -> DataFrame:
    """Detections with named roles; every other column goes into the `metadata` map."""
    rest = [c for c in raw.columns if c not in (lon, lat, time)]
    pairs = [x for c in rest for x in (F.lit(c), F.col(c).cast("string"))]
    metadata = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
    return raw.select(
        parse_time(F.col(time).cast("string")).alias("ts"),
        F.col(lat).cast("double").alias("lat"),
        F.col(lon).cast("double").alias("lon"),
        metadata.alias("metadata"),
    )


def read_detection_csv(spark: SparkSession, path: str, lon: str, lat: str, time: str) -> DataFrame:
    return detections(spark.read.option("header", True).csv(path), lon, lat, time)


def detections_as_pings(found: DataFrame, vessel_key: str = "MMSI") -> DataFrame:
    """Canonical pings from detections, the vessel taken from the metadata."""
    picks = {
        "mmsi": F.col("metadata")[vessel_key],
        "ts": F.col("ts"),
        "lat": F.col("lat"),
        "lon": F.col("lon"),
    }
    return canonical(found, picks, F.xxhash64("ts", "lat", "lon", F.col("metadata")[vessel_key]))


def split_bad_pings(pings: DataFrame, raw: str | None = None, keep: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Usable pings, and the rest with a reason (for the error sink) after the `keep` columns."""
    off = ~F.col("lat").between(-90.0, 90.0) | ~F.col("lon").between(-180.0, 180.0)
    reason = (
        F.when(F.coalesce(F.col("mmsi"), F.lit("")) == "", "no vessel id")
        .when(F.col("ts").isNull(), "bad timestamp")
        .when(F.col("lat").isNull() | F.col("lon").isNull() | off, "bad position")
    )
    marked = pings.withColumn("error", reason)
    text = F.col(raw) if raw else F.to_json(F.struct(*[c for c in pings.columns]))
    good = marked.where(F.col("error").isNull()).drop("error")
    return good, marked.where(F.col("error").isNotNull()).select(*keep, "error", text.alias("raw"))
