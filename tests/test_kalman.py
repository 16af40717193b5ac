import math

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tracklake.functions.geo import Zone
from tracklake.operators import kalman, tracks
from tracklake.sources import driver

MINUTE = 60_000_000


def run(points, mmsi="1"):
    live, out = [], []
    for micros, x, y in points:
        live, row = kalman.advance(live, mmsi, micros, x, y)
        out.append(row)
    return live, out


def test_transition_known_values_and_series():
    g, d, *q = kalman.transition(60.0)
    assert [round(v, 2) for v in q] == [35838.45, 894.62, 29.82]
    assert g == pytest.approx((1 - math.exp(-0.006)) / 1e-4) and d == pytest.approx(math.exp(-0.006))
    for a, b in zip(kalman.transition(0.999999), kalman.transition(1.000001)):
        assert a == pytest.approx(b, rel=1e-5)
    assert kalman.transition(0.0) == (0.0, 1.0, 0.0, 0.0, 0.0)


def test_steps_compose():
    axis = (10.0, 1.0, 15.0, 0.5, 10.0)
    once = kalman._predict(axis, kalman.transition(360.0))
    twice = kalman._predict(kalman._predict(axis, kalman.transition(60.0)), kalman.transition(300.0))
    assert once == pytest.approx(twice, rel=1e-9)


def test_two_steps_by_hand():
    _, out = run([(0, 0.0, 0.0), (MINUTE, 30.0, -12.0)])
    g, d, qm, qc, qv = kalman.transition(60.0)
    pm, pc, pv = 15 + g * g * 10 + qm, d * g * 10 + qc, d * d * 10 + qv
    s = pm + 15
    assert out[0][3] == "init" and out[1][3] == "update" and out[0][0] == out[1][0]
    assert out[1][4] == pytest.approx(pm / s * 30) and out[1][5] == pytest.approx(pc / s * 30)
    assert out[1][6] == pytest.approx(pm / s * -12)
    assert out[1][8:11] == pytest.approx((pm - pm * pm / s, pc - pm * pc / s, pv - pc * pc / s))


def test_walk_keeps_one_track_and_jumps_open_another():
    walk = [(i * MINUTE, 10.0 * i, (-1) ** i * 5.0) for i in range(50)]
    assert len({r[0] for r in run(walk)[1]}) == 1
    live, out = run([*walk, (50 * MINUTE, 50_000.0, 0.0), (51 * MINUTE, 510.0, 0.0)])
    assert [r[3] for r in out[-2:]] == ["init", "update"] and out[-1][0] == out[0][0] and len(live) == 2


def test_gap_limits():
    at = lambda gap: [r[3] for r in run([(0, 0.0, 0.0), (gap, 0.0, 0.0)])[1]]
    assert at(600 * 1_000_000) == ["init", "update"]
    assert at(600 * 1_000_000 + 1) == ["init", "init"]
    assert at(0) == ["init", "update"]


@pytest.fixture(scope="module")
def projected(spark, sf_dir):
    p = driver.pings(spark, sf_dir, compressed=True)
    newest = tracks.latest_per_vessel(tracks.sync_to_grid(p, 60, tracks.first_micros(p)))
    return kalman.project(newest, tracks.first_zone(p)).cache()


def test_batches_do_not_cut_tracks(spark, projected):
    want = rows_of(kalman.filter_tracks(projected))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
        assert rows_of(kalman.filter_tracks(projected)) == want
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_filter_matches_the_step_function(projected):
    got = {(r.mmsi, r.ts.timestamp()): (r.track_id, r.x) for r in kalman.filter_tracks(projected).collect()}
    want = {}
    rows = projected.select("mmsi", F.unix_micros("ts").alias("m"), "ts", "x", "y").orderBy("mmsi", "m").collect()
    live, vessel = [], None
    for r in rows:
        live, vessel = (live if r.mmsi == vessel else []), r.mmsi
        live, out = kalman.advance(live, r.mmsi, r.m, r.x, r.y)
        want[(r.mmsi, r.ts.timestamp())] = (out[0], out[4])
    assert got == want


def test_counts_and_polylines(projected):
    steps = kalman.filter_tracks(projected)
    counts = kalman.track_counts(steps).first()
    assert counts.states == projected.count() and counts.vessels == 15
    lines = kalman.polylines(kalman.unproject(steps, Zone(30, True)))
    assert lines.count() == counts.tracks
    one = lines.orderBy(F.desc(F.size("points"))).first()
    assert (one.points[-1].lat, one.points[-1].lon) == (one.last_lat, one.last_lon)
    assert 50 < one.last_lat < 52 and set(one.metadata) == {"MMSI"}


def test_grid_fill_stays_between_updates(projected):
    steps = kalman.filter_tracks(projected).cache()
    filled = kalman.fill_grid(steps)
    both = steps.select("track_id", "ts").join(filled.select("track_id", "ts"), ["track_id", "ts"], "left_semi")
    assert both.count() == 0
    assert filled.count() == filled.select("track_id", "ts").distinct().count()
