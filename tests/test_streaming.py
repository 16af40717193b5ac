"""Streams give the rows of the batch operators, however the input is cut into triggers."""

import uuid

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tracklake.operators import emitters, kalman, mapping, monitor, packing, tracks
from tracklake.operators import triples as tr
from tracklake.schema import MESSAGE
from tracklake.sources import driver
from tracklake.streaming import monitor as smonitor
from tracklake.streaming.mapper import run_mapper
from tracklake.streaming.tracker import stream_filter, stream_sync
from tracklake.streaming.tracks import stream_tracks


def drain(df, tmp_path, mode="append"):
    """Run a stream over all available input into a memory table."""
    name = "q" + uuid.uuid4().hex
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    finished = query.awaitTermination(90)
    query.stop()
    assert finished, "the stream did not come to an end"
    return df.sparkSession.table(name)


def in_files(df, path, files, order):
    """Write `df` as files that follow each other in time."""
    slice_no = F.floor(F.percent_rank().over(_all_by(order)) * (files - 1e-9)).cast("int")
    numbered = df.withColumn("_f", slice_no).cache()
    for i in range(files):
        numbered.where(F.col("_f") == i).drop("_f").coalesce(1).write.mode("append").parquet(path)
    return path


def _all_by(order):
    from pyspark.sql import Window

    return Window.partitionBy(F.lit(0)).orderBy(*order)


def read_files(spark, path, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


@pytest.mark.parametrize("files", [1, 5])
def test_tracks(spark, sf_dir, tmp_path, files):
    p = driver.pings(spark, sf_dir)
    source = read_files(spark, in_files(p, str(tmp_path / "in"), files, ["ts", "seq"]), p.schema)
    got = drain(stream_tracks(source), tmp_path)
    want = tracks.build_tracks(p)
    flat = lambda d: rows_of(
        d.select("mmsi", "track_no", "min_ts", "max_ts", F.to_json("pings").alias("pings"))
    )
    assert flat(got) == flat(want)


def test_tracks_with_idle_limit(spark, sf_dir, tmp_path):
    """With a state lifetime Spark goes on with empty triggers, so they are switched off to come to an end."""
    p = driver.pings(spark, sf_dir)
    source = read_files(spark, in_files(p, str(tmp_path / "in"), 1, ["ts", "seq"]), p.schema)
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        got = drain(stream_tracks(source, idle_ms=3_600_000), tmp_path).count()
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")
    assert got == tracks.build_tracks(p).count()


@pytest.mark.parametrize("files", [1, 4])
def test_tracker(spark, sf_dir, tmp_path, files):
    p = driver.pings(spark, sf_dir, compressed=True)
    newest = tracks.latest_per_vessel(tracks.sync_to_grid(p, 60, 0))
    detections = kalman.project(newest, tracks.first_zone(p)).select("mmsi", "ts", "x", "y")
    source = read_files(spark, in_files(detections, str(tmp_path / "in"), files, ["ts", "mmsi"]), detections.schema)
    got = drain(stream_filter(source), tmp_path)
    assert rows_of(got, "track_id", "ts", "kind", "x", "vx", "p_xx") == rows_of(
        kalman.filter_tracks(detections), "track_id", "ts", "kind", "x", "vx", "p_xx"
    )


def test_tracker_from_pings(spark, sf_dir, tmp_path):
    p = driver.pings(spark, sf_dir, compressed=True)
    source = read_files(spark, in_files(p, str(tmp_path / "in"), 4, ["ts", "seq"]), p.schema)
    zone = tracks.first_zone(p)
    got = drain(stream_filter(kalman.project(stream_sync(source), zone)), tmp_path)
    want = kalman.filter_tracks(kalman.project(tracks.latest_per_vessel(tracks.sync_to_grid(p, 60, 0)), zone))
    missing = want.select("track_id", "ts").exceptAll(got.select("track_id", "ts")).count()
    assert got.count() > 0 and got.select("track_id", "ts").exceptAll(want.select("track_id", "ts")).count() == 0
    assert missing < 80  # steps the final watermark has not passed


def test_late_detection_starts_its_own_track():
    live, _ = kalman.advance([], "v", 600_000_000, 0.0, 0.0)
    live, row = kalman.advance(live, "v", 300_000_000, 0.0, 0.0)
    assert row[3] == "init" and len(live) == 2


def test_sync_drops_late_rows_only(spark, sf_dir, tmp_path):
    p = driver.pings(spark, sf_dir, compressed=True)
    source = read_files(spark, in_files(p, str(tmp_path / "in"), 3, ["ts", "seq"]), p.schema)
    got = drain(stream_sync(source, "1 minute"), tmp_path).select("mmsi", "seq")
    want = tracks.latest_per_vessel(tracks.sync_to_grid(p, 60, 0)).select("mmsi", "seq")
    assert got.exceptAll(want).count() == 0
    assert want.count() - got.count() < 50  # steps the final watermark has not passed


def _graph_messages(spark, sf_dir):
    p = driver.pings(spark, sf_dir).where("seq < 200")
    t = emitters.vessel_state_graphs(mapping.map_pings(p, mapping.vessel_class_map(spark)), keep=("seq", "ts"))
    stamps = p.select(F.concat(F.lit("msg-"), F.col("seq").cast("string")).alias("graph_id"), "ts", "seq")
    texts = packing.ntriples_messages(t).join(stamps, "graph_id")
    sent = packing.as_messages(texts, topic="triples", key="graph_id", timestamp=F.col("ts"))
    return t, sent.withColumn("graph_id", F.decode("key", "UTF-8"))


def test_monitor(spark, sf_dir, tmp_path):
    t, sent = _graph_messages(spark, sf_dir)
    source = read_files(spark, in_files(sent, str(tmp_path / "in"), 3, ["timestamp"]), sent.schema)
    triples, dead = smonitor.message_triples(source)
    got = drain(smonitor.stream_class_totals(triples), tmp_path, "complete")
    want = monitor.class_totals(t)
    assert rows_of(got, "class", "total") == rows_of(want, "class", "total")
    total = drain(smonitor.stream_totals(triples), tmp_path, "complete").first()
    assert total.triples == t.count() and total.objects == t.where(tr.is_typing()).count()
    assert drain(dead, tmp_path).count() == 0


@pytest.mark.parametrize("files", [1, 4])
def test_class_rates(spark, sf_dir, tmp_path, files):
    events = driver.table(spark, sf_dir, "events")
    counts = events.select(
        F.col("event_type").alias("class"), F.col("ts").cast("timestamp").alias("ts"),
        F.col("event_id").alias("msg_id"), (F.col("event_id") % 5).alias("n"),
    )
    narrow = counts.select("class", F.unix_micros("ts").alias("micros"), F.col("msg_id").alias("msg_no"), "n")
    source = read_files(spark, in_files(narrow, str(tmp_path / "in"), files, ["micros"]), narrow.schema)
    updates = drain(smonitor.stream_class_rates(source), tmp_path, "update")
    last = updates.groupBy("class").agg(F.max_by(F.struct("total", "rate"), "total").alias("r"))
    got = {r["class"]: (r.r.total, round(r.r.rate, 9)) for r in last.collect()}
    want = {r["class"]: (r.total, round(r.rate, 9)) for r in monitor.latest_rates(monitor.class_rates(counts)).collect()}
    assert got == want


def test_mapper(spark, sf_dir, tmp_path):
    p = driver.pings(spark, sf_dir).where("seq < 80")
    sent = packing.as_messages(packing.pack_json(packing.number_messages(p)), topic="pings", key="batch_id")
    broken = spark.createDataFrame([(None, bytearray(b"junk"), "pings", 0, 99, None)], MESSAGE)
    path = in_files(sent.unionByName(broken), str(tmp_path / "in"), 2, ["offset"])
    source = read_files(spark, path, sent.schema)
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    query = run_mapper(
        source, str(tmp_path / "state"),
        lambda df: df.write.mode("append").parquet(out), lambda df: df.write.mode("append").parquet(dead),
    )
    assert query.awaitTermination(90)
    assert spark.read.parquet(dead).count() == 1
    seen, bad = smonitor.message_triples(spark.read.parquet(out).withColumn("graph_id", F.decode("key", "UTF-8")))
    direct = emitters.vessel_state_graphs(mapping.map_pings(p, mapping.vessel_class_map(spark)))
    assert bad.count() == 0 and seen.count() == direct.count()
    assert seen.select("msg_id").distinct().count() == 80


def test_stream_set(spark, tmp_path):
    rows = [("g", "s", "p", "o", "iri", None, i) for i in (0, 1, 2)] + [("g", "s2", "p", "o", "iri", None, 3)]
    df = spark.createDataFrame(
        rows, "graph_id string, s string, p string, o string, o_kind string, o_dtype string, sec int"
    ).withColumn("ts", F.timestamp_seconds("sec"))
    df.coalesce(1).write.parquet(str(tmp_path / "in"))
    source = read_files(spark, str(tmp_path / "in"), df.schema)
    assert drain(tr.as_set_stream(source, "ts", "1 hour"), tmp_path).count() == 2


def test_mapper_sorts_out_bad_rows_and_a_replay_adds_nothing(spark, sf_dir, tmp_path):
    from tracklake.streaming.mapper import folder_sink

    p = driver.pings(spark, sf_dir).where("seq < 60")
    seq = F.col("seq")
    bad = packing.number_messages(p).withColumns({
        "mmsi": F.when(seq % 10 != 1, F.col("mmsi")), "ts": F.when(seq % 10 != 2, F.col("ts")),
        "lat": F.when(seq % 10 == 3, "north").otherwise(F.col("lat").cast("string")), "lon": F.when(seq % 10 == 4, 181.0).otherwise(F.col("lon"))})
    sent = packing.as_messages(packing.pack_json(bad), topic="pings", key="batch_id")
    path = in_files(sent, str(tmp_path / "in"), 3, ["offset"])
    out, dead = str(tmp_path / "out"), str(tmp_path / "dead")
    seen = []
    for attempt in range(2):  # the second one has lost its checkpoint and sends every batch again
        query = run_mapper(read_files(spark, path, sent.schema), str(tmp_path / f"state{attempt}"), folder_sink(out), folder_sink(dead))
        assert query.awaitTermination(120)
        letters = spark.read.parquet(dead)
        triples, refused = smonitor.message_triples(spark.read.parquet(out).withColumn("graph_id", F.decode("key", "UTF-8")))
        assert refused.count() == 0
        seen.append((rows_of(letters, "graph_id", "error", "raw"), triples.count(), triples.select("msg_id").distinct().count(), spark.read.parquet(out).count()))
    assert seen[0] == seen[1]
    reasons = letters.groupBy("error").count().collect()
    assert {r["error"]: r["count"] for r in reasons} == {"no vessel id": 6, "bad timestamp": 6, "bad position": 12}
    assert seen[0][2] == seen[0][3] == 36
    assert letters.where(F.decode("raw", "UTF-8").contains("north")).count() == 6  # the row as it came


def test_counts_in_the_row_and_rates_in_any_order(spark, sf_dir, tmp_path):
    t, sent = _graph_messages(spark, sf_dir)
    broken = spark.createDataFrame([(None, bytearray(b"junk"), "triples", 0, 999, None)], MESSAGE).withColumn("offset", F.lit("msg-x")).withColumn("graph_id", F.lit("msg-x"))
    odd = packing.as_messages(spark.createDataFrame([("msg-odd", "# note\n\n<a><b><c>.\n<a> <b> <c> .\n<a><b><c>.\nno triple")], "graph_id string, text string"),
                              topic="triples", key="graph_id").withColumn("graph_id", F.lit("msg-odd"))
    both = sent.unionByName(broken).unionByName(odd)
    counts = smonitor.count_messages(both).cache()
    want = monitor.message_counts(t.withColumnRenamed("seq", "msg_id")).select(F.concat(F.lit("msg-"), F.col("msg_id").cast("string")).alias("msg_id"), "trip_count", "obj_count")
    plain = counts.where("msg_id NOT IN ('msg-x', 'msg-odd')")
    assert rows_of(plain, "msg_id", "trip_count", "obj_count") == rows_of(want, "msg_id", "trip_count", "obj_count")
    assert [tuple(r) for r in counts.where("msg_id = 'msg-odd'").select("trip_count", "obj_count", "bad_lines").collect()] == [(2, 0, 1)]
    assert [tuple(r) for r in counts.where("msg_id = 'msg-x'").select("trip_count", "obj_count", "bad_lines").collect()] == [(None, None, None)]

    shuffled = in_files(plain.withColumn("_r", F.xxhash64("msg_id")), str(tmp_path / "in"), 4, ["_r"])
    source = read_files(spark, shuffled, plain.schema)
    updates = drain(smonitor.stream_monitor(source, shards=3), tmp_path, "update")
    view = {r["name"]: r for r in smonitor.monitor_view(updates).collect()}
    newest = monitor.rolling_rates(plain.select("msg_id", "ts", "trip_count", "obj_count")).orderBy(F.desc("ts"), F.desc("msg_id")).first()
    whole = view.pop("messages")
    assert whole["messages"] == 200 and whole["first"] == t.count() and whole["second"] == t.where(tr.is_typing()).count()
    assert (whole["first_rate"], whole["second_rate"], whole["msg_rate"]) == pytest.approx((newest.trip_rate, newest.obj_rate, newest.msg_rate))
    classes = plain.select("msg_id", "ts", F.explode("classes").alias("c")).select("msg_id", "ts", "c.class", "c.n")
    latest = {r["class"]: r for r in monitor.latest_rates(monitor.class_rates(classes)).collect()}
    assert set(view) == set(latest)
    for name, r in view.items():
        assert r["first"] == latest[name].total and r["first_rate"] == pytest.approx(latest[name].rate)
