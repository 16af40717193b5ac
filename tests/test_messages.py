import json
import zlib

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tracklake.operators import packing
from tracklake.sources import driver, messages, pings
from tracklake.streaming.mapper import map_messages


def frame(spark, bodies):
    rows = [(None, None if b is None else bytearray(b), "t", 0, i) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, partition int, offset bigint")
    return df.withColumn("timestamp", F.timestamp_seconds("offset"))


ROW = ["366952890", "2017-01-01T00:00:09", 40.64175, -74.07136, 0.0, -102.6, 511, "BOAT", "", None, "1004", "", 10, 5, 2, ""]


def test_row_messages_and_dead_letters(spark):
    bodies = [json.dumps(ROW).encode(), b"{not json", None, b'"text"']
    good, dead = messages.read_rows(frame(spark, bodies))
    row = good.first()
    assert (row.graph_id, row.mmsi, row.lat, row.lon, row.sog, row.cog) == ("t:0:0", "366952890", 40.64175, -74.07136, 0.0, -102.6)
    assert (row.vessel_name, row.imo, row.call_sign, row.vessel_type, row.seq) == ("BOAT", "", None, "1004", 0)
    assert good.count() == 1 and dead.count() == 3


def test_batch_messages(spark):
    packed = zlib.compress(json.dumps([ROW, ROW]).encode())
    good, dead = messages.read_rows(frame(spark, [packed, packed[:-5]]), codec="zlib", shape="batch")
    assert [r.seq for r in good.orderBy("seq").collect()] == [0, 1]
    assert [r.error for r in dead.collect()] == ["body cannot be decoded"]


def test_craft_layout(spark):
    row = ["503444444", "142.99254", "-42.005783", "0", "0", "30", "", "", "", "", "01/04/2020 12:00:00 AM"]
    good, _ = messages.read_rows(frame(spark, [json.dumps(row).encode()]), layout="oz")
    r = good.select("mmsi", "lat", "lon", F.col("ts").cast("string"), "imo", "vessel_name").first()
    assert list(r) == ["503444444", -42.005783, 142.99254, "2020-01-04 00:00:00", "", ""]


def test_bad_numbers_go_to_the_error_sink(spark):
    bad = [ROW[:2] + ["north"] + ROW[3:], ["", *ROW[1:]], [ROW[0], "whenever", *ROW[2:]]]
    rows, _ = messages.read_rows(frame(spark, [json.dumps(r).encode() for r in [ROW, *bad]]))
    good, rest = pings.split_bad_pings(rows)
    assert good.count() == 1
    assert {r.error for r in rest.collect()} == {"bad position", "no vessel id", "bad timestamp"}


@pytest.mark.parametrize("limit", [100, 1_000_000])
def test_packing_keeps_every_row_in_time_order(spark, sf_dir, limit):
    p = driver.pings(spark, sf_dir)
    numbered = packing.number_messages(p, 7, limit=limit)
    sizes = sorted(r["count"] for r in numbered.groupBy("batch_id").count().collect())
    assert sizes == [6] + [7] * 142
    text = packing.pack_json(numbered)
    sent = packing.as_messages(text, topic="pings", key="batch_id")
    got, dead = messages.read_rows(sent, codec="zlib", shape="batch")
    assert dead.count() == 0
    columns = ["mmsi", "ts", "lat", "lon", "sog", "cog", "heading", "vessel_name", "imo", "call_sign", "vessel_type", "length"]
    assert rows_of(got, *columns) == rows_of(p, *columns)
    order = [r.seq for r in p.orderBy("ts", "seq").collect()]
    placed = [r.seq for r in numbered.orderBy("batch_id", "place").collect()]
    assert placed == order


@pytest.mark.parametrize("rows, size, kept", [(20, 8, 2), (12, 8, 2), (28, 8, 4), (13, 8, 2), (3, 8, 0)])
def test_compat_tail_rounds_half_to_even(spark, rows, size, kept):
    df = spark.range(rows).select(F.timestamp_seconds("id").alias("ts"), F.col("id").alias("seq"))
    n = packing.number_messages(df, size, compat_tail=True).select("batch_id").distinct().count()
    assert n == round(rows / size) == kept


def test_oz_csv_message(spark, sf_dir):
    p = driver.pings(spark, sf_dir).where("seq = 0").withColumn("vessel_name", F.lit('A "B", C'))
    text = packing.pack_oz_csv(packing.number_messages(p)).first().text
    assert text.endswith("\r\n") and text.count("\r\n") == 1
    import csv
    import io

    row = next(csv.reader(io.StringIO(text)))
    assert len(row) == 14 and row[6] == "" and row[11] == 'A "B", C' and row[0] == "200000013"


def test_track_message_shapes(spark):
    df = spark.createDataFrame([("t", "9", [1.0, 2.0, 3.0, 4.0, 5.0, 6.0])], "track_id string, mmsi string, state array<double>")
    df = df.withColumn("ts", F.timestamp_seconds(F.lit(0)))
    text = packing.pack_tracks(df, z=4, v_xy=(1, 3), v_z=5).first().text
    assert json.loads(text) == {
        "metadata": {"mmsi": "9"},
        "states": [
            {"timestamp": "1970-01-01T00:00:00", "coordinates": [1.0, 3.0, 5.0], "epsgCode": "4326", "velocityVector": [2.0, 4.0, 6.0]}
        ],
    }
    assert "velocityVector" not in packing.pack_tracks(df).first().text


def test_track_message_source(spark):
    state = {"epsgCode": "4326", "timestamp": "2017-01-05T00:00:00", "coordinates": ["38.03654", "-122.12249"]}
    body = json.dumps({"metadata": {"mmsi": "367330510"}, "states": [state, state]}).encode()
    states, dead = messages.read_track_messages(frame(spark, [body, b"[]"]))
    assert states.count() == 2 and dead.count() == 1
    assert states.first().coordinates == [38.03654, -122.12249]


def test_mapper_on_tables(spark):
    triples, dead = map_messages(frame(spark, [json.dumps(ROW).encode(), b"x"]), codec="none", shape="row")
    assert dead.count() == 1
    assert {r.graph_id for r in triples.select("graph_id").distinct().collect()} == {"t:0:0:0"}
    assert triples.where("o = 'http://myOntology.org.uk/classes#FreightShip'").count() == 1


def test_csv_sources(spark, tmp_path):
    ais = tmp_path / "ais.csv"
    ais.write_text(
        "MMSI,BaseDateTime,LAT,LON,SOG,COG,Heading,VesselName,IMO,CallSign,VesselType,Status,Length,Width,Draft,Cargo\n"
        "036695289,2017-01-01T00:00:09,40.64175,-74.07136,0.0,-102.6,511,BOAT,,,1004,,10,5,,\n"
    )
    row = pings.read_ais_csv(spark, str(ais)).first()
    assert (row.mmsi, row.lat, row.cog, row.draft, row.vessel_type) == ("036695289", 40.64175, -102.6, None, "1004")
    oz = tmp_path / "oz.csv"
    oz.write_text(
        "CRAFT_ID,LON,LAT,COURSE,SPEED,TYPE,SUBTYPE,LENGTH,BEAM,DRAUGHT,TIMESTAMP\n"
        "370123456,143.5639,-42.073288,90,20,30,,,,,01/04/2020 12:00:00 AM\n"
    )
    row = pings.read_oz_csv(spark, str(oz)).first()
    assert (row.mmsi, row.lat, row.lon, row.cog, row.sog) == ("370123456", -42.073288, 143.5639, 90.0, 20.0)
    det = tmp_path / "det.csv"
    det.write_text("Time,Longitude_degrees,Latitude_degrees,MMSI,Type\n2016-01-12 13:02:11,-1.1,50.7,235,Ferry\n")
    found = pings.read_detection_csv(spark, str(det), "Longitude_degrees", "Latitude_degrees", "Time")
    assert found.first().metadata == {"MMSI": "235", "Type": "Ferry"}
    assert pings.detections_as_pings(found).first().mmsi == "235"


def test_numbers_of_rows_are_unique_and_follow_the_offset(spark):
    sent = spark.createDataFrame(
        [(p, str(o), k) for p in (0, 1, 1023, 5000) for o in (0, 1, 2**40, "x") for k in (0, 1, 4095, 4096)], "partition int, offset string, place long"
    ).withColumn("topic", F.lit("t"))
    rows = sent.select("partition", "offset", "place", messages.ping_number(F.col("place")).alias("seq")).collect()
    assert len({r.seq for r in rows}) == len(rows)
    small = [r for r in rows if r.offset in "012" and r.partition < 1024 and r.place < 4096]
    assert [r.seq for r in sorted(small, key=lambda r: (int(r.offset), r.partition, r.place))] == sorted(r.seq for r in small)
    assert all((r.seq >= 0) == (r in small) for r in rows)


@pytest.mark.parametrize("shape", ["row", "batch"])
def test_a_body_is_inflated_once(spark, shape):
    rows, dead = messages.read_rows(frame(spark, [zlib.compress(json.dumps(ROW if shape == "row" else [ROW, ROW]).encode()), b"junk"]), "zlib", shape)
    for part, n in ((rows, 1 if shape == "row" else 2), (dead, 1)):
        assert part._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
        assert part.count() == n


def test_staged_texts_are_compressed_as_asked(spark):
    from tracklake.session import stage

    df = spark.range(5).select("id", F.repeat(F.lit("text "), F.lit(50)).alias("text"))
    kept = stage(df, compression="zstd")
    assert rows_of(kept) == rows_of(df)
    assert all(name.endswith(".zstd.parquet") for name in kept.inputFiles())
