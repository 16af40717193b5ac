import datetime as dt

import pytest
from pyspark.sql import functions as F

from tracklake.functions import codec, geo
from tracklake.functions import text as tx
from tracklake.vocab import ies

NUMBERS = [
    0.0, 1.0, -102.6, 40.64175, 0.001, 0.0001, -0.00015, 1.2345678901234567e-4, 1e-5, 1.5e-10, -2e-7, 1e7, 12345678.9,
    1.7976931348623157e308, 1e15, 123456789012345.6, 1e16, 1.5e22, 2.5e-300, 9007199254740993.0,
]


def column(spark, values, kind):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def values(df):
    return [r[0] for r in df.orderBy("i").select("out").collect()]


def test_number_text(spark):
    got = values(column(spark, NUMBERS, "double").withColumn("out", tx.number_text(F.col("v"))))
    assert got == [str(n) for n in NUMBERS]


def test_iso_text(spark):
    times = [dt.datetime(2020, 1, 4), dt.datetime(2017, 1, 1, 0, 0, 9), dt.datetime(2021, 6, 25, 17, 53, 51, 176709)]
    df = column(spark, [t.isoformat() for t in times], "string").withColumn("out", tx.iso_text(tx.parse_time(F.col("v"))))
    assert values(df) == [t.isoformat() for t in times]


@pytest.mark.parametrize(
    "text, iso",
    [
        ("01/04/2020 12:00:00 AM", "2020-01-04T00:00:00"),
        ("01/04/2020 01:02:03 PM", "2020-01-04T13:02:03"),
        ("2020-01-04", "2020-01-04T00:00:00"),
        ("2020-01-04 05:06:07.25", "2020-01-04T05:06:07.250000"),
        ("north", None),
        ("", None),
    ],
)
def test_lenient_times(spark, text, iso):
    assert values(column(spark, [text], "string").withColumn("out", tx.iso_text(tx.parse_time(F.col("v"))))) == [iso]


def test_bands(spark):
    want = {
        0.0: "AssessToBeRemoteChance", 0.05: "AssessToBeRemoteChance", 0.051: "AssessToBeHighlyUnlikely",
        0.225: "AssessToBeHighlyUnlikely", 0.3: "AssessToBeUnlikely", 0.375: "AssessToBeUnlikely",
        0.5: "AssessToBeRealisticPossibility", 0.525: "AssessToBeRealisticPossibility",
        0.775: "AssessToBeLikelyOrProbably", 0.925: "AssessToBeHighlyLikely", 0.93: "AssessToBeAlmostCertain",
        1.0: "AssessToBeAlmostCertain", None: "AssessProbability",
    }
    df = column(spark, list(want), "double")
    assert values(df.withColumn("out", tx.phia_class(F.col("v")))) == [ies(c) for c in want.values()]
    assert set(values(df.withColumn("out", tx.phia_class(F.col("v"), False)))) == {ies("AssessProbability")}


def test_literal_escapes_round_trip(spark):
    texts = ['a "b" \\ c', "line\nbreak\tand\rmore", "\\n is not a newline", "plain", "café", ""]
    df = column(spark, texts, "string")
    assert values(df.withColumn("out", tx.unescape_literal(tx.escape_literal(F.col("v"))))) == texts
    escaped = ["caf\\u00e9", r"x\'\'y", r"x\\'y", r"\U0001F6A2 \U0000005C\U00000022", r"\\U0001F6A2", r"end\\", r"bad\U00110000"]
    decoded = ["café", "x''y", r"x\'y", "\U0001F6A2 \\\"", r"\U0001F6A2", "end\\", None]
    assert values(column(spark, escaped, "string").withColumn("out", tx.unescape_literal(F.col("v")))) == decoded


def test_names_and_labels(spark):
    uris = [ies("Port"), "http://elsewhere.org/x#Y", "http://iso.org/iso8601#2020-01-01T00:00:00"]
    df = column(spark, uris, "string")
    assert values(df.withColumn("out", tx.short_name(F.col("v")))) == ["ies:Port", uris[1], "iso8601:2020-01-01T00:00:00"]
    one = spark.range(1).select(tx.bar_label(F.lit(1.5387), F.lit(6)), tx.option_label(F.lit("ies:Port"), F.lit(6)))
    assert list(one.first()) == ["rate=1.54 count=6", "ies:Port (6)"]


def test_default_epsg(spark):
    df = column(spark, [None, "", "  ", "32630"], "string")
    assert values(df.withColumn("out", tx.epsg_or_default(F.col("v")))) == ["4326", "4326", "4326", "32630"]


def test_port_and_country_names(spark):
    row = spark.range(1).select(tx.locode_uri(F.lit("GB AMT ")), tx.country_uri(F.lit("GBR"))).first()
    assert list(row) == ["http://www.un.org/locode#GBAMT", "http://iso.org/iso3166-alpha3#GBR"]


def test_zlib_and_damage(spark):
    import zlib

    df = spark.createDataFrame(
        [(0, bytearray(zlib.compress(b"hello"))), (1, bytearray(zlib.compress(b"hello")[:-4])), (2, None)], "i int, v binary"
    )
    assert values(df.withColumn("out", codec.inflate("v"))) == ["hello", None, None]


def test_bodies_leave_a_worker_in_pieces():
    import pyarrow as pa

    texts = [None if i % 7 == 0 else f"text {i}" for i in range(3 * codec.PIECE_ROWS + 5)]
    packed = list(codec.deflate.func(iter([pa.array(texts), pa.array(["x"])])))
    assert max(len(piece) for piece in packed) <= codec.PIECE_ROWS
    plain = list(codec.inflate.func(iter([pa.concat_arrays(packed)])))
    assert max(len(piece) for piece in plain) <= codec.PIECE_ROWS
    assert pa.concat_arrays(plain).to_pylist() == [*texts, "x"]


GEOHASHES = {
    (40.64175, -74.07136): "dr5r4qwgk5qf", (40.64175, -74.07135): "dr5r4qwgk7q6", (40.64176, -74.07136): "dr5r4qwgkjnv",
    (40.64176, -74.07138): "dr5r4qwg7tpv", (40.64196, -74.07291): "dr5r4qtu847n", (40.64196, -74.07289): "dr5r4qtu8d3y",
    (40.64197, -74.07291): "dr5r4qtu8h74", (90.0, 180.0): "zzzzzzzzzzzz", (-90.0, -180.0): "000000000000",
}


def test_geohash(spark):
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(GEOHASHES)], "i int, lat double, lon double")
    assert values(df.withColumn("out", geo.geohash(F.col("lat"), F.col("lon")))) == list(GEOHASHES.values())


def test_utm_known_point(spark):
    df = spark.createDataFrame([(0, 50.75, -1.0)], "i int, lat double, lon double")
    e, n = df.select(*geo.to_utm(F.col("lat"), F.col("lon"), geo.Zone(30, True))).first()
    assert abs(e - 641086.33) < 0.01 and abs(n - 5623931.77) < 0.01
    assert geo.Zone(30, True).epsg == "32630"


@pytest.mark.parametrize("zone", [geo.Zone(30, True), geo.Zone(55, False)])
def test_utm_round_trip(spark, zone):
    sign = 1 if zone.northern else -1
    grid = [(0, sign * lat, zone.meridian + d) for lat in (0.5, 20.0, 50.75, 80.0) for d in (-3.0, -0.001, 0.0, 2.9)]
    df = spark.createDataFrame(grid, "i int, lat double, lon double")
    e, n = geo.to_utm(F.col("lat"), F.col("lon"), zone)
    lat, lon = geo.from_utm(F.col("e"), F.col("n"), zone)
    back = df.select("lat", "lon", e.alias("e"), n.alias("n")).select("*", lat.alias("lat2"), lon.alias("lon2"))
    for r in back.collect():
        assert abs(r.lat - r.lat2) < 1e-8 and abs(r.lon - r.lon2) < 1e-8


def test_zones():
    assert geo.zone_of(50.75, -1.0) == geo.Zone(30, True)
    assert geo.zone_of(-42.0, 143.5) == geo.Zone(54, False)
    assert geo.zone_of(60.0, 5.0).number == 32
    assert geo.zone_of(78.0, 20.0).number == 33
    assert geo.zone_of(0.0, 180.0).number == 60
