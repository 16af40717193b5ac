"""Rows and graphs to messages, and text sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codec import encode_body
from ..functions.text import epsg_or_default, iso_text, node_text, ntriples_line, quad_line, short_name, term
from ..vocab import PREFIXES, RDF_TYPE
from .ordered import DEFAULT_LIMIT, HotKeys, keyed_index

BATCH_ROWS = 8

# Order of the craft layout in feeder messages (fixed values); None is an empty field.
OZ_MESSAGE = [
    "mmsi", "lon", "lat", "cog", "sog", "vessel_type", None, "length", "width", "draft", "ts", "vessel_name",
    "imo", "call_sign",
]


def number_messages(
    pings: DataFrame, size: int = BATCH_ROWS, *, compat_tail: bool = False, hot: HotKeys | None = None,
    limit: int = DEFAULT_LIMIT,
) -> DataFrame:
    """Cut the pings, in time order, into messages of `size` rows: `batch_id` and `place` in the batch.

    `compat_tail` keeps round(rows / size) messages, half to even, so a short tail can be lost.
    """
    out = keyed_index(pings, [], ["ts", "seq"], index="_rn", total="_n", hot=hot, limit=limit)
    out = out.withColumn("batch_id", F.expr(f"(_rn - 1) div {size}")).withColumn(
        "place", ((F.col("_rn") - 1) % size).cast("int")
    )
    if compat_tail:
        out = out.where(F.col("batch_id") < F.bround(F.col("_n") / F.lit(float(size)), 0))
    return out.drop("_rn", "_n")


def ais_row(ts_text: Column | None = None) -> Column:
    """One ping as an array of variants: text stays text and numbers stay numbers in JSON."""
    fields = [
        "mmsi", None, "lat", "lon", "sog", "cog", "heading", "vessel_name", "imo", "call_sign", "vessel_type",
        "status", "length", "width", "draft", "cargo",
    ]
    ts_text = iso_text(F.col("ts")) if ts_text is None else ts_text
    return F.array(*[(F.col(f) if f else ts_text).cast("variant") for f in fields])


def oz_row() -> Column:
    columns = []
    for i, name in enumerate(OZ_MESSAGE):
        value = F.lit("") if name is None else iso_text(F.col("ts")) if name == "ts" else F.col(name).cast("string")
        columns.append(F.coalesce(value, F.lit("")).alias(f"_{i}"))
    return F.struct(*columns)


def oz_projection(pings: DataFrame) -> DataFrame:
    """Pings in the craft layout of feeder messages."""
    columns = [F.lit(None).cast("string").alias("subtype") if c is None else F.col(c) for c in OZ_MESSAGE]
    return pings.select(*columns, "seq")


def pack_json(numbered: DataFrame) -> DataFrame:
    """One JSON array of row arrays per message. A message gathers `size` rows, never more.

    Rows are spread by message first: a short table is numbered in one task, and the grouping would stay
    there. On a long one this is the exchange the grouping needs anyway.
    """
    rows = numbered.repartition("batch_id").select("batch_id", "place", F.to_json(ais_row()).alias("_row"))
    joined = F.array_join(F.transform(F.array_sort("_rows"), lambda r: r["_row"]), ",")
    return (
        rows.groupBy("batch_id")
        .agg(F.collect_list(F.struct("place", "_row")).alias("_rows"))
        .select("batch_id", F.size("_rows").alias("n_rows"), F.concat(F.lit("["), joined, F.lit("]")).alias("text"))
    )


def pack_oz_csv(numbered: DataFrame) -> DataFrame:
    """One CSV text per message, craft layout, CRLF line ends."""
    line = F.to_csv(oz_row(), {"emptyValue": "", "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"})
    rows = numbered.repartition("batch_id").select("batch_id", "place", line.alias("_row"))
    joined = F.array_join(F.transform(F.array_sort("_rows"), lambda r: F.concat(r["_row"], F.lit("\r\n"))), "")
    return (
        rows.groupBy("batch_id")
        .agg(F.collect_list(F.struct("place", "_row")).alias("_rows"))
        .select("batch_id", F.size("_rows").alias("n_rows"), joined.alias("text"))
    )


def as_messages(
    texts: DataFrame, *, topic: str | Column, key: str, text: str = "text", codec: str = "zlib",
    timestamp: Column | None = None,
) -> DataFrame:
    """Frame with Kafka column names, ready for `write.format("kafka")` or a file sink."""
    topic = F.lit(topic) if isinstance(topic, str) else topic
    stamp = F.lit(None).cast("timestamp") if timestamp is None else timestamp
    return texts.select(
        F.encode(F.col(key).cast("string"), "UTF-8").alias("key"),
        encode_body(F.col(text), codec).alias("value"),
        topic.alias("topic"),
        F.lit(0).alias("partition"),
        F.col(key).alias("offset"),
        stamp.alias("timestamp"),
    )


def write_topic(messages: DataFrame, servers: str, **options):
    """Send to Kafka (needs the connector); a `topic` column picks the topic of each message."""
    messages.select("topic", "key", "value").write.format("kafka").options(
        **{"kafka.bootstrap.servers": servers, **options}
    ).save()


def ntriples_messages(triples: DataFrame, max_lines: int | None = None) -> DataFrame:
    """One N-Triples text per graph, lines sorted.

    With `max_lines` a graph becomes several messages of at most that many lines; use it where a graph is
    not bounded by construction. Lines carry whole triples, so the parts can be parsed on their own.
    """
    lines = triples.select("graph_id", ntriples_line().alias("line"))
    if max_lines is None:
        return lines.groupBy("graph_id").agg(
            F.count("*").alias("n_triples"), F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("text")
        )
    hashed = lines.withColumn("_h", F.xxhash64("line")).withColumn("_h2", F.hash("line").cast("bigint"))
    numbered = keyed_index(hashed, ["graph_id"], ["_h", "_h2"], index="_rn")
    return (
        numbered.withColumn("part", F.expr(f"(_rn - 1) div {max_lines}"))
        .groupBy("graph_id", "part")
        .agg(F.count("*").alias("n_triples"), F.array_join(F.sort_array(F.collect_list("line")), "\n").alias("text"))
    )


def turtle_blocks(triples: DataFrame, prefixes: dict[str, str] = PREFIXES) -> DataFrame:
    """One Turtle block per subject, predicates sorted with the type first."""
    brief = lambda uri: F.when(
        short_name(uri, prefixes).rlike(r"^[a-z0-9]+:[A-Za-z0-9_][A-Za-z0-9_:-]*$"), short_name(uri, prefixes)
    ).otherwise(node_text(uri))
    verb = F.when(F.col("p") == RDF_TYPE, "a").otherwise(brief(F.col("p")))
    kind, dtype = F.col("o_kind"), F.col("o_dtype")
    obj = (
        F.when(kind == "iri", brief(F.col("o")))
        .when(dtype.startswith("http"), F.concat(term(F.col("o"), kind, F.lit(None)), F.lit("^^"), brief(dtype)))
        .otherwise(term(F.col("o"), kind, dtype))
    )
    pairs = triples.select(
        "graph_id", brief(F.col("s")).alias("subject"),
        F.concat(verb, F.lit(" "), obj).alias("pair"), (verb != "a").alias("later"),
    )
    body = F.array_join(F.transform(F.array_sort("_pairs"), lambda p: p["pair"]), " ;\n    ")
    return (
        pairs.groupBy("graph_id", "subject")
        .agg(F.collect_list(F.struct("later", "pair")).alias("_pairs"))
        .select("graph_id", "subject", F.concat_ws(" ", "subject", F.concat(body, F.lit(" ."))).alias("block"))
    )


def turtle_documents(triples: DataFrame, prefixes: dict[str, str] = PREFIXES) -> DataFrame:
    """One Turtle document per graph; for graphs of bounded size, such as fixed-size tracks."""
    head = "".join(f"@prefix {p}: <{ns}> .\n" for p, ns in sorted(prefixes.items())) + "\n"
    return (
        turtle_blocks(triples, prefixes)
        .groupBy("graph_id")
        .agg(
            F.count("*").alias("n_subjects"),
            F.concat(F.lit(head), F.array_join(F.array_sort(F.collect_list("block")), "\n\n"), F.lit("\n")).alias("text"),
        )
    )


def save_graph_files(triples: DataFrame, path: str):
    """N-Triples files, one folder per graph. Rows are sorted by graph so a task has one file open."""
    (
        triples.select("graph_id", ntriples_line().alias("value"))
        .sortWithinPartitions("graph_id")
        .write.partitionBy("graph_id")
        .text(path)
    )


def save_graph_buckets(triples: DataFrame, path: str, buckets: int = 64, splits: int = 4) -> None:
    """Graphs as N-Quads text in `buckets` folders by the hash of their id, and a manifest of (graph_id, bucket, n_triples).

    There are at most `buckets * splits` files however many graphs or tasks there are; a bucket is dealt to `splits`
    tasks by line, so that no graph has to fit in one. `read_graph_buckets` reads graphs back by their ids. Quads repeat their
    graph and their names, so the files are compressed.
    """
    lines = triples.select("graph_id", _bucket_of("graph_id", buckets).alias("bucket"), quad_line().alias("value")).where("value IS NOT NULL")
    dealt = lines.withColumn("_split", F.pmod(F.xxhash64("value"), F.lit(splits))).repartition(buckets * splits, "bucket", "_split")
    dealt.sortWithinPartitions("bucket", "graph_id").select("bucket", "value").write.partitionBy("bucket").text(f"{path}/graphs", compression="gzip")
    counts = lines.groupBy("graph_id", "bucket").agg(F.count("*").alias("n_triples"))
    counts.repartition(buckets, "bucket").sortWithinPartitions("graph_id").write.parquet(f"{path}/manifest")


def _bucket_of(graph_id: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(graph_id), F.lit(buckets)).cast("int")


def encoded_state(
    ts: Column, state: Column, xy=(0, 2), z: int | None = None, v_xy=None, v_z: int | None = None,
    epsg: Column | None = None, default_epsg: str = "4326",
) -> Column:
    """One state of a track message; the third coordinate and the velocity are optional."""
    pick = lambda indices: F.array(*[F.get(state, F.lit(i)) for i in indices])
    epsg = F.lit(None).cast("string") if epsg is None else epsg
    fields = [
        iso_text(ts).alias("timestamp"),
        pick([*xy, *([] if z is None else [z])]).alias("coordinates"),
        epsg_or_default(epsg, default_epsg).alias("epsgCode"),
    ]
    if v_xy is not None:
        fields.append(pick([*v_xy, *([] if v_z is None else [v_z])]).alias("velocityVector"))
    return F.struct(*fields)


def pack_tracks(steps: DataFrame, key: str = "track_id", mmsi: str = "mmsi", **state_options) -> DataFrame:
    """One JSON message per track, states in time order. A track holds at most one state per time step."""
    state = encoded_state(F.col("ts"), F.col("state"), **state_options)
    return (
        steps.select(key, mmsi, F.struct(F.unix_micros("ts").alias("at"), state.alias("state")).alias("_one"))
        .groupBy(key, mmsi)
        .agg(F.array_sort(F.collect_list("_one")).alias("_all"))
        .select(
            key,
            F.size("_all").alias("n_states"),
            F.to_json(
                F.struct(
                    F.create_map(F.lit("mmsi"), F.col(mmsi)).alias("metadata"),
                    F.transform("_all", lambda x: x["state"]).alias("states"),
                )
            ).alias("text"),
        )
    )

