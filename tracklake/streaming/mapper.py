"""Continuous mapping: ping messages in, one graph message out per ping."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.emitters import vessel_state_graphs, vessel_state_texts
from ..operators.mapping import ClassPolicy, UriPolicy, map_pings, vessel_class_map
from ..operators.packing import as_messages
from ..sources.messages import parsed_rows, split_rows
from ..sources.pings import split_bad_pings
from ..vocab import DATA


def map_messages(
    messages: DataFrame, *, codec: str = "zlib", shape: str = "batch", layout: str = "ais",
    uri: UriPolicy | None = None, classes: ClassPolicy | None = None, data_uri: str = DATA, tasks: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(triples, dead letters) of ping messages. Stateless, so it runs on streams and tables alike.

    With `tasks`, rows are dealt to so many tasks by graph before they become triples: what groups the triples by
    graph then shuffles none of them.

    Each row is a graph of its own: message id and place in the message. Bodies that cannot be decoded or parsed are
    dead letters (graph_id, error, raw: the bytes), and so is every row without a vessel, a time or a position, with the row's
    text and its message; the other rows of its message are mapped.
    """
    mapped, dead = _mapped(parsed_rows(messages, codec, shape), shape, layout, uri, classes)
    if tasks is not None:
        mapped = mapped.repartition(tasks, "graph_id")
    return vessel_state_graphs(mapped, data_uri), dead


def map_to_texts(
    messages: DataFrame, *, codec: str = "zlib", shape: str = "batch", layout: str = "ais",
    uri: UriPolicy | None = None, classes: ClassPolicy | None = None, data_uri: str = DATA,
) -> tuple[DataFrame, DataFrame]:
    """`map_messages` with each graph as one N-Triples text. Nothing is shuffled on the way."""
    mapped, dead = _mapped(parsed_rows(messages, codec, shape), shape, layout, uri, classes)
    return vessel_state_texts(mapped, data_uri), dead


def _mapped(parsed: DataFrame, shape: str, layout: str, uri, classes) -> tuple[DataFrame, DataFrame]:
    rows, dead = split_rows(parsed, shape, layout, raw="_raw")
    pings, bad = split_bad_pings(rows, raw="_raw", keep=("graph_id",))
    graph = F.concat_ws(":", F.col("graph_id"), F.col("place").cast("string"))
    mapped = map_pings(pings.drop("_raw"), vessel_class_map(parsed.sparkSession), uri, classes, graph_id=graph)
    return mapped, dead.unionByName(bad.withColumn("raw", F.encode("raw", "UTF-8")))


Sink = Callable[[DataFrame], None]


def folder_sink(path: str) -> Sink:
    """Writes each batch to a partition of its own. A batch that is run again replaces its partition, so that the table
    holds every row once."""

    def write(rows: DataFrame) -> None:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    return write


def run_mapper(
    messages: DataFrame,
    checkpoint: str,
    send: Sink,
    send_dead: Sink | None = None,
    *,
    topic: str = "triples",
    out_codec: str = "zlib",
    trigger: dict | None = None,
    codec: str = "zlib",
    shape: str = "batch",
    layout: str = "ais",
    uri: UriPolicy | None = None,
    classes: ClassPolicy | None = None,
    data_uri: str = DATA,
) -> StreamingQuery:
    """Consume, map and produce. `send` writes a frame with Kafka columns, e.g. `write_topic`, and `send_dead` the dead letters
    (graph_id, error, raw). Both frames also carry the `batch_id`.

    Spark runs a batch again after a failure between sink and checkpoint. Names of graphs and nodes are then the same, and
    a sink that keeps one place per batch id, such as `folder_sink`, adds nothing. A message topic cannot take a
    batch back; its reader drops repeats by the message key, which is the graph. A batch is decoded and parsed once
    for both sinks.
    """

    def one_batch(batch: DataFrame, batch_id: int) -> None:
        parsed = parsed_rows(batch, codec, shape).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            mapped, dead = _mapped(parsed, shape, layout, uri, classes)
            sent = as_messages(vessel_state_texts(mapped, data_uri), topic=topic, key="graph_id", codec=out_codec)
            send(sent.withColumn("batch_id", F.lit(batch_id)))
            if send_dead is not None:
                send_dead(dead.withColumn("batch_id", F.lit(batch_id)))
        finally:
            parsed.unpersist()

    return (
        messages.writeStream.foreachBatch(one_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
