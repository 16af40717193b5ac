"""Message sources: frames with Kafka column names to rows, with a dead-letter side output."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schema
from ..functions.codec import decode_body
from .pings import ais_picks, canonical, oz_picks


def read_topic(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """A Kafka topic as a stream (needs the Kafka connector on the class path)."""
    return (
        spark.readStream.format("kafka")
        .options(**{"kafka.bootstrap.servers": servers, "subscribe": topic, **options})
        .load()
    )


def message_id(topic: str = "topic", partition: str = "partition", offset: str = "offset") -> Column:
    """Identity of a message: each message is a graph of its own."""
    return F.concat_ws(":", F.col(topic), F.col(partition).cast("string"), F.col(offset).cast("string"))


def ping_number(place: Column) -> Column:
    """`seq` of a ping from a message: no two rows of a topic share it, and it grows with offset and place.

    Offset, partition and place stand next to each other in one number. Where one is too large for its digits or the
    offset is not a number, a negative hash of all three takes its place.
    """
    offset, partition = F.col("offset").try_cast("bigint"), F.col("partition").cast("bigint")
    fits = offset.between(0, (1 << 40) - 1) & (place < 1 << 12) & partition.between(0, (1 << 10) - 1)
    packed = (offset * F.lit(1 << 10) + partition) * F.lit(1 << 12) + place
    mixed = F.xxhash64(F.col("topic"), F.col("partition"), F.col("offset"), place)
    return F.when(fits, packed).otherwise(mixed.bitwiseOR(F.lit(-(1 << 63))))


def read_rows(
    messages: DataFrame, codec: str = "none", shape: str = "row", layout: str = "ais", raw: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """(pings, dead letters) from JSON messages holding one row (`row`) or an array of rows (`batch`).

    `graph_id` is the message, `place` the row's place in it, and `seq` numbers the rows of all messages. `raw` names
    a further column for the text of the row. A null row has no fields at all.
    """
    return split_rows(parsed_rows(messages, codec, shape), shape, layout, raw)


def parsed_rows(messages: DataFrame, codec: str = "none", shape: str = "row") -> DataFrame:
    """Messages with their body as text and as JSON rows; null where there is none. Decoding happens here, once."""
    text = decode_body(F.col("value"), codec)
    kind = "array<string>" if shape == "row" else "array<array<string>>"
    return messages.select("topic", "partition", "offset", message_id().alias("graph_id"), "value", text.alias("_text")).withColumn(
        "_rows", F.from_json("_text", kind)
    )


def split_rows(parsed: DataFrame, shape: str = "row", layout: str = "ais", raw: str | None = None) -> tuple[DataFrame, DataFrame]:
    """`read_rows` of messages that are parsed already."""
    good = F.col("_text").isNotNull() & F.col("_rows").isNotNull()
    reason = F.when(F.col("_text").isNull(), "body cannot be decoded").otherwise("not a JSON array")
    dead = parsed.where(~good).select("graph_id", reason.alias("error"), F.col("value").alias("raw"))
    place = F.lit(0) if shape == "row" else F.col("_at")
    rows = parsed.where(good).select(
        "graph_id", "topic", "partition", "offset",
        *([F.lit(0).alias("_at"), F.col("_rows").alias("_row")] if shape == "row" else [F.posexplode("_rows").alias("_at", "_row")]),
    ).select("graph_id", F.col("_at").alias("place"), ping_number(place.cast("bigint")).alias("_seq"), "_row",
             *([F.coalesce(F.to_json("_row"), F.lit("null")).alias(raw)] if raw else []))
    names = schema.AIS_COLUMNS if layout == "ais" else schema.OZ_COLUMNS
    picks = (ais_picks if layout == "ais" else oz_picks)(
        {name: F.get("_row", F.lit(i)) for i, name in enumerate(names)}
    )
    return canonical(rows, picks, F.col("_seq"), keep=("graph_id", "place", *([raw] if raw else []))), dead


def read_track_messages(messages: DataFrame, codec: str = "none") -> tuple[DataFrame, DataFrame]:
    """(one row per track state, dead letters) from nested track JSON."""
    text = decode_body(F.col("value"), codec)
    parsed = messages.select(message_id().alias("graph_id"), "value", text.alias("_text")).withColumn(
        "_track", F.from_json("_text", schema.TRACK_MESSAGE)
    )
    good = F.col("_track.states").isNotNull()
    dead = parsed.where(~good).select(
        "graph_id", F.lit("not a track message").alias("error"), F.col("value").alias("raw")
    )
    states = parsed.where(good).select(
        "graph_id", F.col("_track.metadata").alias("metadata"), F.posexplode("_track.states").alias("step", "_state")
    )
    return (
        states.select(
            "graph_id",
            "metadata",
            "step",
            F.col("_state.timestamp").try_cast("timestamp").alias("ts"),
            F.col("_state.coordinates").cast("array<double>").alias("coordinates"),
            F.col("_state.epsgCode").alias("epsg"),
            F.col("_state.velocityVector").cast("array<double>").alias("velocity"),
        ),
        dead,
    )
