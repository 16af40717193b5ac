"""The hot-key path gives what plain windows give."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tracklake.operators import monitor, tracks
from tracklake.operators.ordered import find_hot, keyed_index, look_back
from tracklake.sources import driver


@pytest.fixture(scope="module")
def skewed(spark):
    """One vessel holds half of the rows, and half of those share one timestamp. Half of the other rows
    belong to a vessel without an id."""
    base = spark.range(3000).withColumn("seq", F.col("id"))
    mmsi = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 4 == 1, None).otherwise(
        F.concat(F.lit("v"), (F.col("id") % 60).cast("string"))
    )
    seconds = F.when(F.col("id") % 4 == 0, 1000).otherwise((F.col("id") * 7919) % 5000)
    out = base.select(mmsi.alias("mmsi"), F.timestamp_seconds(seconds).alias("ts"), "seq").repartition(5, "seq")
    return out.select("*", (F.col("seq") % 7).cast("double").alias("lat"), F.lit(1.0).alias("lon")).cache()


def plain(df, keys):
    group = [F.col(k) for k in keys] or [F.lit(0)]
    return Window.partitionBy(*group).orderBy("ts", "seq")


@pytest.mark.parametrize("keys", [["mmsi"], []])
@pytest.mark.parametrize("limit", [120, 10_000])
def test_keyed_index(skewed, keys, limit):
    got = keyed_index(skewed, keys, ["ts", "seq"], index="rn", total="n", limit=limit)
    w = plain(skewed, keys)
    want = skewed.withColumn("rn", F.row_number().over(w).cast("bigint")).withColumn(
        "n", F.count("*").over(Window.partitionBy(*([F.col(k) for k in keys] or [F.lit(0)])))
    )
    assert rows_of(got, "seq", "rn", "n") == rows_of(want, "seq", "rn", "n")


def test_hot_keys_found(skewed):
    assert sorted((str(r[0]), r[1]) for r in find_hot(skewed, ["mmsi"], 700).sizes) == [("None", 750), ("hot", 1500)]
    assert not find_hot(skewed, ["mmsi"], 5000)


@pytest.mark.parametrize("keys", [["mmsi"], []])
@pytest.mark.parametrize("limit", [90, 10_000])
def test_look_back(skewed, keys, limit):
    def add(df, w):
        frame = w.rowsBetween(-4, 0)
        return df.withColumn("sum5", F.sum("seq").over(frame)).withColumn("prev", F.lag("seq", 2).over(w))

    got = look_back(skewed, keys, ["ts", "seq"], 4, add, limit=limit)
    assert got.columns == [*skewed.columns, "sum5", "prev"]
    want = add(skewed, plain(skewed, keys))
    assert rows_of(got, "seq", "sum5", "prev") == rows_of(want, "seq", "sum5", "prev")


@pytest.mark.parametrize("limit", [150, 10_000])
def test_batches_under_skew(skewed, limit):
    got = tracks.number_batches(skewed, 4, limit=limit)
    sizes = {r[2] for r in got.groupBy("mmsi", "track_no").count().collect()}
    assert sizes == {4}
    per_vessel = {r[0]: r[1] for r in skewed.groupBy("mmsi").count().collect()}
    kept = {r[0]: r[1] for r in got.groupBy("mmsi").count().collect()}
    assert kept == {m: n // 4 * 4 for m, n in per_vessel.items()}


def test_skewed_results_do_not_depend_on_the_path(skewed):
    for f in (
        lambda limit: tracks.last_seen(skewed, limit=limit),
        lambda limit: tracks.sessions(skewed, 20, limit=limit),
        lambda limit: tracks.number_batches(skewed, 4, limit=limit),
    ):
        assert rows_of(f(200)) == rows_of(f(1_000_000))


def test_sessions_cover_all_pings(skewed):
    s = tracks.sessions(skewed, 20, limit=200)
    assert s.agg(F.sum("n_pings")).first()[0] == 3000
    w = Window.partitionBy("mmsi").orderBy("session_no")
    gaps = s.withColumn("gap", F.unix_micros("start_ts") - F.unix_micros(F.lag("end_ts").over(w)))
    assert gaps.where("gap <= 20000000").count() == 0


def test_rates_under_skew(spark, sf_dir):
    events = driver.table(spark, sf_dir, "events")
    counts = events.select(
        F.col("event_id").alias("msg_id"), F.col("ts").cast("timestamp").alias("ts"),
        F.lit("c").alias("class"), (F.col("event_id") % 5).alias("n"),
        (F.col("event_id") % 5).alias("trip_count"), (F.col("event_id") % 3).alias("obj_count"),
    )
    assert rows_of(monitor.class_rates(counts, limit=150)) == rows_of(monitor.class_rates(counts))
    assert rows_of(monitor.rolling_rates(counts, limit=150)) == rows_of(monitor.rolling_rates(counts))


def test_result_does_not_depend_on_partitions_or_input_order(spark, sf_dir):
    p = driver.pings(spark, sf_dir).select("mmsi", "ts", "seq")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    results = []
    try:
        for n in ("1", "4", "32"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            shuffled = p.orderBy(F.xxhash64("seq", F.lit(n)))
            results.append(rows_of(tracks.number_batches(shuffled, 4)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0] == results[1] == results[2]


@pytest.fixture(scope="module")
def gappy(skewed):
    """Half of the times and some of the numbers that break ties are missing."""
    return skewed.withColumn("ts", F.when(F.col("seq") % 4 < 2, F.col("ts"))).withColumn("seq", F.when(F.col("seq") != 8, F.col("seq")))


@pytest.mark.parametrize("keys", [["mmsi"], []])
@pytest.mark.parametrize("limit", [90, 10_000])
def test_missing_order_values_come_first(gappy, keys, limit):
    got = keyed_index(gappy, keys, ["ts", "seq"], index="rn", limit=limit)
    want = gappy.withColumn("rn", F.row_number().over(plain(gappy, keys)).cast("bigint"))
    assert rows_of(got, "seq", "rn") == rows_of(want, "seq", "rn")
    add = lambda df, w: df.withColumn("prev", F.lag("seq", 2).over(w))
    assert rows_of(look_back(gappy, keys, ["ts", "seq"], 2, add, limit=limit), "seq", "prev") == rows_of(add(gappy, plain(gappy, keys)), "seq", "prev")


def test_missing_times_give_the_same_at_any_limit(gappy):
    for f in (
        lambda limit: tracks.last_seen(gappy, limit=limit),
        lambda limit: tracks.sessions(gappy, 20, limit=limit),
        lambda limit: tracks.number_batches(gappy, 4, limit=limit),
    ):
        assert rows_of(f(200)) == rows_of(f(1_000_000))
    assert tracks.sessions(gappy, 20, limit=200).agg(F.sum("n_pings")).first()[0] == gappy.where("ts IS NOT NULL").count()


def test_global_order_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "ts timestamp, seq long")
    assert keyed_index(empty, [], ["ts", "seq"], total="n").collect() == []


def test_only_a_single_process_gets_a_folder_of_its_own():
    from types import SimpleNamespace

    from tracklake.session import shared_folder

    def session(master):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        return SimpleNamespace(conf={}, sparkContext=context)

    for master in ("local", "local[*]", "local[8]"):
        assert shared_folder(session(master))
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://https://host"):
        with pytest.raises(RuntimeError):
            shared_folder(session(master))


def test_slices_of_sorted_rows_keep_equal_rows_and_keys_apart():
    """Whatever batches the rows come in: a slice has `size` rows and those equal to its last, and one key."""
    import random

    import numpy as np
    import pandas as pd

    from tracklake.operators.ordered import _slices_of

    rnd = random.Random(5)
    for _ in range(60):
        rows = sorted((rnd.randrange(4), rnd.randrange(30)) for _ in range(rnd.randrange(1, 120)))
        size, step = rnd.randrange(1, 12), rnd.randrange(1, 40)
        batches = [pd.DataFrame(rows[i : i + step], columns=["_hot", "_o0"]) for i in range(0, len(rows), step)]
        got = [tuple(int(v) for v in r) for out in _slices_of(size)(iter(batches)) for r in out.to_numpy(np.int64)]
        want = []
        for i, row in enumerate(rows):
            if i and row[0] == want[-1][0] and (want[-1][2] < size or row == rows[i - 1]):
                want[-1][2] += 1
            else:
                want.append([*row, 1])
        assert got == [tuple(w) for w in want]


def test_split_points_of_many_slices_need_few_tasks(spark, monkeypatch):
    """Ranges hold many slices: neither the tasks nor Spark's sample for the ranges grow with the slices."""
    from tracklake.operators import ordered

    df = spark.range(3000).select(F.timestamp_seconds(F.col("id")).alias("ts"), F.col("id").alias("seq"))
    kind, made = type(df), []
    ranged = kind.repartitionByRange
    monkeypatch.setattr(kind, "repartitionByRange", lambda self, n, *columns: made.append(n) or ranged(self, n, *columns))
    out = ordered.keyed_index(df, [], ["ts", "seq"], limit=10)
    assert made == [1] and out.where("rn != seq + 1").count() == 0 and out.count() == 3000
