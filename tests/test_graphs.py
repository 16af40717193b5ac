"""Graphs of known inputs have the known sizes and node counts."""

import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tracklake.operators import emitters, mapping, packing, tracks
from tracklake.operators import triples as tr
from tracklake.sources import driver
from tracklake.sources.triples import parse_lines
from tracklake.vocab import ANALYTICS_DATA, DATA, IES, ies


def types_of(triples):
    return Counter(
        r.o.replace(IES, "") for r in triples.where(tr.is_typing()).select("o").collect()
    )


def is_set(triples):
    return triples.count() == triples.distinct().count()


@pytest.fixture(scope="module")
def four_pings(spark):
    # Sample pings.
    rows = [
        (0, "2017-01-01T00:00:09", 40.64175, -74.07136), (1, "2017-01-01T00:01:20", 40.64175, -74.07135),
        (2, "2017-01-01T00:02:29", 40.64176, -74.07136), (3, "2017-01-01T00:03:38", 40.64176, -74.07138),
    ]
    df = spark.createDataFrame(rows, "seq bigint, t string, lat double, lon double")
    return df.select(
        F.lit("366952890").alias("mmsi"), F.col("t").cast("timestamp").alias("ts"), "seq", "lat", "lon",
        F.lit(0.0).alias("sog"), F.lit(-102.6).alias("cog"),
    )


def test_full_track(four_pings):
    g = emitters.track_graphs(tracks.build_tracks(four_pings))
    assert g.count() == 169 and is_set(g)
    t = types_of(g)
    assert sum(t.values()) == 62
    assert (t["ObservedTarget"], t["Measure"], t["MeasureValue"], t["Name"], t["GeoPoint"]) == (5, 8, 8, 6, 4)
    assert (t["ParticularPeriod"], t["BoundingState"], t["Observation"], t["ClassOfMeasure"]) == (4, 2, 1, 2)
    texts = Counter(r.o for r in g.where("o_kind = 'literal'").select("o").collect())
    assert texts["-102.6"] == 4 and texts["0.0"] == 4 and texts["366952890"] == 1
    assert {r.graph_id for r in g.select("graph_id").distinct().collect()} == {"track366952890-0"}
    assert g.where(F.col("s") == DATA + "latlong40.64175,-74.07136").count() == 3


def test_blank_speed_is_no_measurement(four_pings):
    """No triple without an object, and no measure node for what is blank."""
    blank = four_pings.withColumn("sog", F.lit(None).cast("double"))
    g = emitters.track_graphs(tracks.build_tracks(blank))
    assert g.where("s IS NULL OR o IS NULL").count() == 0 and is_set(g)
    assert types_of(g)["Measure"] == types_of(g)["MeasureValue"] == 4


def test_basic_track(minimal):
    seven = minimal.where("mmsi = '366952890'")
    g = emitters.track_graphs(tracks.build_tracks(seven, 7), form="basic")
    assert g.count() == 116 and is_set(g)
    t = types_of(g)
    assert sum(t.values()) == 48
    assert (t["LocationObservation"], t["GeoPoint"], t["ParticularPeriod"], t["BoundingState"]) == (7, 4, 7, 2)
    assert g.where(F.col("s") == DATA + "geohash_dr5r4qwgk5qf").count() == 3


def test_track_sizes_follow_the_closed_form(spark, sf_dir):
    p = driver.pings(spark, sf_dir)
    got = emitters.track_graphs(tracks.build_tracks(p)).groupBy("graph_id").count()
    batches = tracks.number_batches(p)
    want = batches.groupBy("mmsi", "track_no").agg(
        (41 + 23 * F.count("*") + 7 * F.count_distinct("lat", "lon") + 2 * F.count_distinct("ts")).alias("count")
    ).select(F.concat(F.lit("track"), "mmsi", F.lit("-"), F.col("track_no").cast("string")).alias("graph_id"), "count")
    assert rows_of(got, "graph_id", "count") == rows_of(want, "graph_id", "count")


def test_repeated_points_and_times_are_written_once(spark):
    rows = [("v", "2020-01-01", 1.0, 2.0), ("v", "2020-01-01", 1.0, 2.0), ("v", "2020-01-02", 1.0, 2.0), ("v", "2020-01-02", 1.5, 2.0)]
    df = spark.createDataFrame(rows, "mmsi string, t string, lat double, lon double").coalesce(1).select(
        "mmsi", F.col("t").cast("timestamp").alias("ts"), F.monotonically_increasing_id().alias("seq"), "lat", "lon",
        F.lit(1.0).alias("sog"), F.lit(1.0).alias("cog"),
    )
    g = emitters.track_graphs(tracks.build_tracks(df))
    assert is_set(g) and g.count() == 41 + 23 * 4 + 7 * 2 + 2 * 2


def following(spark, follower="367000150", followed="366952890", system="HAL"):
    t = lambda s: dt.datetime.fromisoformat(s + "+00:00")
    # Times of the sample event.
    return spark.createDataFrame(
        [("f", follower, followed, t("2007-01-01T00:00:09"), t("2007-01-01T00:05:40"), system, t("2007-01-02T09:17:04"))],
        "event_id string, follower string, followed string, start timestamp, end timestamp, system string, assessed_at timestamp",
    )


def test_following(spark):
    g = emitters.following_graphs(following(spark), form="basic")
    assert g.count() == 44 and is_set(g)
    t = types_of(g)
    assert sum(t.values()) == 20
    assert (t["Follow"], t["Follower"], t["Followed"], t["LocationTransponder"], t["ParticularPeriod"]) == (1, 1, 1, 2, 3)
    full = emitters.following_graphs(following(spark))
    assert full.count() == 44 + 4 + 3  # scheme name and period texts


def test_following_without_system_or_with_itself(spark):
    g = emitters.following_graphs(following(spark, system=""))
    assert types_of(g)["Assess"] == 0 and types_of(g)["ParticularPeriod"] == 2 and is_set(g)
    same = emitters.following_graphs(following(spark, followed="367000150"))
    assert types_of(same)["LocationTransponder"] == 1 and is_set(same)


def coopering(spark, **changes):
    row = {
        "event_id": "c", "start": "2021-08-11T10:47:48", "end": "2021-08-11T14:01:22",
        "mmsis": ["234234000", "235083854", "356793000"],
        "starts": ["2021-08-11T10:47:48", "2021-08-11T10:47:48", "2021-08-11T11:18:15"],
        "ends": ["2021-08-11T14:01:22", "2021-08-11T12:50:41", "2021-08-11T14:01:22"],
        "probability": 0.3, "assessed_at": "2021-08-12T09:00:00", "use_phia": True, **changes,
    }
    df = spark.createDataFrame(
        [tuple(row.values())],
        "event_id string, start string, end string, mmsis array<string>, starts array<string>, ends array<string>, "
        "probability double, assessed_at string, use_phia boolean",
    )
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ("start", "end", "assessed_at")})


def test_coopering(spark):
    g = emitters.coopering_graphs(coopering(spark), golden_compat=True)
    assert g.count() == 84 and is_set(g)
    t = types_of(g)
    assert sum(t.values()) == 32
    assert (t["CooperingAtSea"], t["Vessel"], t["BoundingState"], t["AssessToBeUnlikely"]) == (3, 3, 8, 1)
    assert g.where(F.col("o") == ANALYTICS_DATA + "_vessel_mmsi_234234000").count() == 1
    assert emitters.coopering_graphs(coopering(spark)).count() == 84


def test_coopering_guards(spark):
    short = emitters.coopering_graphs(coopering(spark, starts=["2021-08-11T10:47:48"], ends=[]))
    assert types_of(short)["BoundingState"] == 2
    gaps = emitters.coopering_graphs(coopering(spark, starts=["", None, "2021-08-11T11:18:15"], start=None, use_phia=False))
    t = types_of(gaps)
    assert t["BoundingState"] == 1 + 1 + 3 and t["AssessProbability"] == 1
    twice = emitters.coopering_graphs(coopering(spark, mmsis=["1", "1", "2"]))
    assert is_set(twice) and types_of(twice)["Vessel"] == 2 and types_of(twice)["CooperingAtSea"] == 3


def destination(spark, ports):
    df = spark.createDataFrame(
        [("d", "234234000", "2021-08-12T09:00:00", ports)],
        "event_id string, mmsi string, t string, "
        "destinations array<struct<port:string,locode:string,iso3:string,probability:double>>",
    )
    return df.withColumn("assessed_at", F.col("t").cast("timestamp"))


PORTS = [("Pontefract", "GB POF", "GBR", 0.5), ("Hull", "GB HUL", "GBR", 0.3), ("Ackworth", "GB AMT ", "GBR", 0.2)]


def test_destinations(spark):
    g = emitters.destination_graphs(destination(spark, PORTS), DATA, golden_compat=True)
    assert g.count() == 106 and is_set(g)
    t = types_of(g)
    assert sum(t.values()) == 40
    assert (t["Port"], t["Sailing"], t["Arrival"], t["VehicleUsed"], t["Country"]) == (3, 3, 3, 3, 1)
    assert (t["AssessToBeRealisticPossibility"], t["AssessToBeUnlikely"], t["AssessToBeHighlyUnlikely"]) == (1, 1, 1)
    assert g.where("o = 'GB AMT '").count() == 1
    assert g.where("s = 'http://www.un.org/locode#GBAMT'").count() == 4


def test_destinations_with_blanks_and_repeats(spark):
    ports = [("A", "", "", 0.5), ("B", "XX B", "", 0.3), ("B2", "XX B", "XXX", 0.2), ("C", None, "XXX", 0.1)]
    g = emitters.destination_graphs(destination(spark, ports))
    assert is_set(g)
    t = types_of(g)
    assert (t["Port"], t["UN_LOCODE"], t["Country"], t["PlaceName"]) == (3, 2, 1, 4)
    assert g.where(F.col("p") == ies("isPartOf")).where(F.col("o").startswith("http://iso.org")).count() == 2


def test_filtered_track(spark):
    rows = [("t1", "235", i, [1.5 + i, 0.1, 1e7, 0.2]) for i in range(3)]
    df = spark.createDataFrame(rows, "track_id string, mmsi string, i int, state array<double>")
    df = df.select("track_id", "mmsi", F.timestamp_seconds("i").alias("ts"), "state")
    g = emitters.filtered_track_graphs(df)
    assert g.count() == 12 + 18 * 3 + 2 * 3 and is_set(g)
    assert g.where("o = '10000000.0' AND o_dtype IS NULL").count() == 3
    assert emitters.filtered_track_graphs(df, epsg="32630").where(F.col("p") == ies("epsgCode")).count() == 3
    other = emitters.filtered_track_graphs(df, mmsi_scheme=False, scheme="http://x#s")
    assert other.where(F.col("s").contains("_transponderID_235")).count() > 0


def test_vessel_state_blanks(spark, sf_dir):
    p = driver.pings(spark, sf_dir)
    mapped = mapping.map_pings(p, mapping.vessel_class_map(spark))
    g = emitters.vessel_state_graphs(mapped)
    assert is_set(g)
    t = types_of(g)
    assert t["VehicleName"] == p.where("vessel_name <> ''").count()
    assert t["Callsign"] == p.where("call_sign <> ''").count()
    assert t["Ship"] == p.where("vessel_type = '1011'").count()


def test_set_operations(spark):
    rows = [("g", "s", "p", "o", "iri", None), ("g", "s", "p", "o", "iri", None), ("h", "s", "p", "o", "iri", None)]
    t = spark.createDataFrame(rows, "graph_id string, s string, p string, o string, o_kind string, o_dtype string")
    assert tr.as_set(t).count() == 2
    assert tr.as_set(tr.as_set(t)).count() == 2
    assert tr.union_sets(t, t).count() == 2
    asked = spark.createDataFrame([("h", "s", "p", "o"), ("x", "s", "p", "o")], "graph_id string, s string, p string, o string")
    assert tr.contained(asked, t).count() == 1
    assert tr.contained(asked, t, scope=()).count() == 2


def test_ntriples_reader(spark):
    lines = [
        "<http://a> <http://p> <http://b> .",
        '<http://a> <http://p> "1.5"^^<http://www.w3.org/2001/XMLSchema#float> .',
        '<http://a> <http://p> "plain" .',
        '<http://a> <http://p> "bonjour"@fr .',
        '<http://a> <http://p> "say \\"hi\\" . now" .',
        "_:b0 <http://p> _:b1 .",
        "# a comment",
        "   ",
        "<http://a> <http://p> no object",
        None,
    ]
    df = spark.createDataFrame([("g", line) for line in lines], "graph_id string, line string")
    good, bad = parse_lines(df)
    got = {(r.s, r.o, r.o_kind, r.o_dtype) for r in good.collect()}
    assert got == {
        ("http://a", "http://b", "iri", None),
        ("http://a", "1.5", "literal", "http://www.w3.org/2001/XMLSchema#float"),
        ("http://a", "plain", "literal", None),
        ("http://a", "bonjour", "literal", "@fr"),
        ("http://a", 'say "hi" . now', "literal", None),
        ("_:b0", "_:b1", "bnode", None),
    }
    assert bad.count() == 2
    back, rest = parse_lines(packing.ntriples_messages(good).select("graph_id", F.explode(F.split("text", "\n")).alias("line")))
    assert rest.count() == 0 and {(r.s, r.o, r.o_kind, r.o_dtype) for r in back.collect()} == got


def test_long_graphs_are_cut_into_messages(four_pings):
    g = emitters.track_graphs(tracks.build_tracks(four_pings))
    parts = packing.ntriples_messages(g, max_lines=50)
    assert sorted(r.n_triples for r in parts.collect()) == [19, 50, 50, 50]
    lines = parts.select("graph_id", F.explode(F.split("text", "\n")).alias("line"))
    good, _ = parse_lines(lines)
    assert rows_of(good) == rows_of(g)


def test_turtle(four_pings):
    g = emitters.track_graphs(tracks.build_tracks(four_pings))
    doc = packing.turtle_documents(g).first().text
    assert doc.startswith("@prefix data: <http://ais.data.gov.uk/ais-ies-test#> .\n")
    assert "data:MMSI_366952890 a ies:LocationTransponder ;\n    ies:isIdentifiedBy data:MMSI_366952890_idObj ." in doc
    assert "<http://ais.data.gov.uk/ais-ies-test#latlong40.64175,-74.07136> a ies:GeoPoint" in doc
    assert '"366952890"^^xsd:string' in doc


def test_graph_files(spark, four_pings, tmp_path):
    g = emitters.track_graphs(tracks.build_tracks(four_pings))
    packing.save_graph_files(g, str(tmp_path / "graphs"))
    back = spark.read.option("basePath", str(tmp_path / "graphs")).text(str(tmp_path / "graphs"))
    assert back.count() == 169 and back.select("graph_id").distinct().count() == 1


def _sparse_pings(spark):
    """Rows that share a number, rows that are repeated, and rows without time, position or measures."""
    rows = [("v", 10, 0, 1.0, 2.0, 3.0, 4.0), ("v", 10, 0, 1.0, 2.0, 3.0, 4.0), ("v", 20, 0, 1.0, 2.0, None, 4.0), ("v", 30, None, 1.5, None, 3.0, None),
            ("v", None, None, None, None, None, None), ("v", None, 0, 1.0, 2.0, 3.0, 4.0), ("v", 30, 7, 1.0, 2.0, 3.0, 4.0), ("v", 30, 7, 9.0, 2.0, 3.0, 4.0)]
    df = spark.createDataFrame(rows, "mmsi string, t long, seq long, lat double, lon double, sog double, cog double")
    return df.withColumn("ts", F.timestamp_seconds("t")).drop("t")


def test_each_ping_of_a_track_stays_an_observation(spark):
    from tracklake.operators import emitters, tracks

    t = emitters.track_graphs(tracks.build_tracks(_sparse_pings(spark), 4)).cache()
    assert t.count() == t.distinct().count()
    seen = t.where(F.col("o").endswith("LocationObservation")).groupBy("graph_id").agg(F.countDistinct("s").alias("n"))
    assert [r.n for r in seen.collect()] == [4, 4]
    assert t.where("s IS NULL OR p IS NULL OR o IS NULL").count() == 0


def test_state_of_a_ping_without_time_or_position_has_no_null_terms(spark):
    from tracklake.operators import emitters, mapping

    p = _sparse_pings(spark).withColumns({c: F.lit(None).cast("string") for c in ("imo", "vessel_name", "call_sign", "vessel_type")})
    p = p.withColumn("seq", F.monotonically_increasing_id())
    t = emitters.vessel_state_graphs(mapping.map_pings(p, mapping.vessel_class_map(spark))).cache()
    assert t.where("s IS NULL OR p IS NULL OR o IS NULL").count() == 0 and t.select("graph_id").distinct().count() == 8
    assert t.where(F.col("o").endswith("GeoPoint")).count() == 6 and t.where(F.col("o").endswith("ParticularPeriod")).count() == 6


def test_ntriples_tokens_may_touch(spark):
    long = "\\n\\\"x" * 30_000
    cases = [
        ('<a><b><c>.', ("a", "b", "c", "iri", None)), ('_:x.y<b>_:z.', ("_:x.y", "b", "_:z", "bnode", None)),
        ('<a>\t<b>\t"v"@en-GB.#note', ("a", "b", "v", "literal", "@en-GB")), ('<a><b>""^^<d> . # x', ("a", "b", "", "literal", "d")),
        ('<a> <b> "1 <x> . \\u00e9\\U0001F600" .\r', ("a", "b", "1 <x> . é😀", "literal", None)), ('<a\\u00e9> <b> <c> .', ("aé", "b", "c", "iri", None)),
        ('<a> <b> " \u0085 \u0002" .', ("a", "b", " \u0085 \u0002", "literal", None)), (f'<a><b>"{long}".', ("a", "b", "\n\"x" * 30_000, "literal", None)),
    ]
    bad = ['<a> <b> .', '<a> "b" <c> .', '<a> <b> <c>', '<a> <b> "x .', '<a> <b> "\\q" .', '<a> <b> "x"@ .', "\x02a\x02b\x02\x02\x02c\x02", '<a> <b> <c> . d', '<a> <b> "x" "y" .']
    rows = [("g", line) for line, _ in cases] + [("g", line) for line in bad] + [("g", "  "), ("g", "# no triple"), ("g", None)]
    good, rest = parse_lines(spark.createDataFrame(rows, "graph_id string, line string"))
    assert {tuple(r)[1:] for r in good.collect()} == {want for _, want in cases}
    assert {r.raw for r in rest.collect()} == {*bad, None}


def test_lines_need_all_terms(spark):
    from tracklake.functions.text import ntriples_line

    rows = [(None, "p", "o"), ("s", None, "o"), ("s", "p", None), ("s", "p", "o")]
    df = spark.createDataFrame(rows, "s string, p string, o string").withColumns({"o_kind": F.lit("iri"), "o_dtype": F.lit(None).cast("string")})
    assert [r[0] for r in df.select(ntriples_line()).collect()] == [None, None, None, "<s> <p> <o> ."]


def test_graph_buckets(spark, tmp_path):
    from pathlib import Path

    from tracklake.operators import packing
    from tracklake.sources.triples import read_graph_buckets

    rows = [(f"g {k % 40}/é", f"s{k}", "p", "a\nb", "literal", None) for k in range(400)] + [("big", f"s{k}", "p", "o", "iri", None) for k in range(400)]
    t = spark.createDataFrame(rows, "graph_id string, s string, p string, o string, o_kind string, o_dtype string").repartition(7)
    packing.save_graph_buckets(t, str(tmp_path), 8, splits=3)
    assert len(list(Path(tmp_path).glob("graphs/bucket=*/part-*"))) <= 24
    got, bad = read_graph_buckets(spark, str(tmp_path))
    names = ("graph_id", "s", "p", "o", "o_kind")
    assert bad.count() == 0 and rows_of(got, *names) == rows_of(t, *names)
    wanted = ["g 7/é", "big", "absent"]
    some, _ = read_graph_buckets(spark, str(tmp_path), wanted)
    assert rows_of(some, *names) == rows_of(t.where(F.col("graph_id").isin(wanted)), *names)
    manifest = spark.read.parquet(str(tmp_path / "manifest"))
    assert manifest.count() == 41 and manifest.agg(F.sum("n_triples")).first()[0] == 800


def test_texts_made_in_the_row_equal_gathered_ones(spark, sf_dir):
    from tracklake.operators import emitters, mapping, packing
    from tracklake.sources import driver

    p = driver.pings(spark, sf_dir).where("seq < 150").withColumns({"ts": F.when(F.col("seq") % 7 != 0, F.col("ts")), "vessel_name": F.when(F.col("seq") % 5 == 0, 'A "b"\n\\c').otherwise(F.col("vessel_name"))})
    mapped = mapping.map_pings(p, mapping.vessel_class_map(spark))
    texts = emitters.vessel_state_texts(mapped, keep=("seq",))
    assert rows_of(texts.drop("seq")) == rows_of(packing.ntriples_messages(emitters.vessel_state_graphs(mapped)))
    assert "Exchange hash" not in texts._jdf.queryExecution().executedPlan().toString()


def test_triples_are_not_gathered_on_the_driver_to_be_looked_up(spark, sf_dir):
    p = driver.pings(spark, sf_dir)
    graph = emitters.track_graphs(tracks.build_tracks(p), only=tr.of_type("ParticularPeriod"))
    some = graph.select("s", "p", "o").distinct().where(F.xxhash64("s") % 3 == 0)
    found = tr.contained(some, graph, scope=())
    assert found.count() == some.count() > 0
    assert "Broadcast" not in found._jdf.queryExecution().executedPlan().toString()


def test_graph_files_are_compressed(spark, tmp_path):
    from pathlib import Path

    row = ("g", "http://e.org/s", "http://e.org/p", "http://e.org/o", "iri", None)
    t = spark.createDataFrame([row], "graph_id string, s string, p string, o string, o_kind string, o_dtype string")
    packing.save_graph_buckets(t, str(tmp_path), 2)
    files = list(Path(tmp_path).glob("graphs/bucket=*/part-*"))
    assert files and all(f.name.endswith(".txt.gz") for f in files)


def test_graphs_are_read_by_ids_of_a_frame_and_the_others_with_the_rest(spark, tmp_path):
    from tracklake.operators import packing
    from tracklake.sources.triples import read_graph_buckets

    rows = [(f"g {k % 40}/é", f"s{k}", "p", "a\nb", "literal", None) for k in range(400)]
    t = spark.createDataFrame(rows, "graph_id string, s string, p string, o string, o_kind string, o_dtype string")
    packing.save_graph_buckets(t, str(tmp_path), 8)
    ids = [f"g {k}/é" for k in range(0, 40, 3)]
    wanted = spark.createDataFrame([(i,) for i in [*ids, ids[0], "absent"]], "graph_id string")
    names = ("graph_id", "s", "p", "o", "o_kind")
    by_id, bad = read_graph_buckets(spark, str(tmp_path), wanted)
    rest, _ = read_graph_buckets(spark, str(tmp_path), wanted, others=True)
    assert bad.count() == 0
    assert rows_of(by_id, *names) == rows_of(t.where(F.col("graph_id").isin(ids)), *names)
    assert rows_of(rest, *names) == rows_of(t.where(~F.col("graph_id").isin(ids)), *names)


def test_graph_files_query_reads_every_third_graph_by_its_id(spark, sf_dir, monkeypatch):
    from tracklake.plans.queries import QUERIES
    from tracklake.sources import triples

    read, parts = triples.read_graph_buckets, []

    def watched(session, path, graph_ids=None, **options):
        good, bad = read(session, path, graph_ids, **options)
        parts.append({r[0] for r in good.select("graph_id").distinct().collect()})
        return good, bad

    monkeypatch.setattr(triples, "read_graph_buckets", watched)
    everything = QUERIES["graph_files_roundtrip"](spark, sf_dir)
    by_id, rest = parts
    assert by_id and rest and not by_id & rest and all(int(i.rsplit("-", 1)[1]) % 3 == 0 for i in by_id)
    assert by_id | rest == {r[0] for r in everything.select("graph_id").distinct().collect()}


def test_lines_are_taken_apart_in_one_pass_with_the_escapes_of_the_column_expression(spark):
    import random

    from tracklake.functions.text import unescape_literal
    from tracklake.sources.triples import _unescaped

    rnd = random.Random(5)
    bits = ["\\", "\\\\", "\\n", "\\f", "\\'", "\\\"", "\\u00e9", "\\uD83D", "\\uDE00", "\\U0001F600", "\\U0000D83D", "\\U00110000", "\\U0010FFFF",
            "\\U00000022", "a", "'", "é", "😀", "\\q", "\\/", "u00e9", "\\U", "\\u12", " ", "\t", "\u0001", "]", ","]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 5))) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "line string")
    assert [r[0] for r in df.select(unescape_literal(F.col("line"))).collect()] == [_unescaped(t) for t in texts]
    good, _ = parse_lines(df.withColumn("graph_id", F.lit("g")))
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "regexp" not in plan and "lambda" not in plan
