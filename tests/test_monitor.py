import datetime as dt

import pytest
from pyspark.sql import functions as F

from tracklake.operators import monitor
from tracklake.vocab import RDF_TYPE, ies


@pytest.fixture(scope="module")
def five(spark):
    times = ["17:53:51.176709", "17:53:52.968885", "17:53:53.379539", "17:53:54.005048", "17:53:54.426163"]
    rows = [(i, dt.datetime.fromisoformat(f"2021-06-25T{t}+00:00"), "c", 1) for i, t in enumerate(times)]
    return spark.createDataFrame(rows, "msg_id bigint, ts timestamp, class string, n bigint")


def test_known_rate(five):
    last = monitor.class_rates(five).orderBy(F.desc("ts")).first()
    assert last.rate == pytest.approx(1.5387200434288344, abs=1e-15)


def test_rate_needs_time_to_pass(spark, five):
    rates = [r.rate for r in monitor.class_rates(five).orderBy("ts").collect()]
    assert rates[0] is None and rates[1] == pytest.approx(2 / 1.792176)
    same = five.withColumn("ts", F.timestamp_seconds(F.lit(5)))
    assert {r.rate for r in monitor.class_rates(same).collect()} == {None}


def test_counts_totals_and_labels(spark):
    rows = [
        (1, 0, "a", RDF_TYPE, ies("Port")), (1, 0, "b", RDF_TYPE, ies("Port")), (1, 0, "a", ies("hasName"), "n"),
        (2, 10, "a", RDF_TYPE, ies("Port")), (2, 10, "a", RDF_TYPE, "http://x/Y"), (3, 20, "a", ies("hasName"), "m"),
    ]
    t = spark.createDataFrame(rows, "msg_id bigint, sec int, s string, p string, o string").withColumn(
        "ts", F.timestamp_seconds("sec")
    )
    counts = monitor.message_counts(t)
    assert {(r.msg_id, r.trip_count, r.obj_count) for r in counts.collect()} == {(1, 3, 2), (2, 2, 2), (3, 1, 0)}
    assert tuple(monitor.totals(counts).first()) == (3, 6, 4)
    per_class = monitor.class_counts(t)
    latest = monitor.latest_rates(monitor.class_rates(per_class))
    assert [tuple(r) for r in monitor.class_options(latest).collect()] == [
        ("http://x/Y", "http://x/Y (1)"), (ies("Port"), "ies:Port (3)"),
    ]
    bars = monitor.rate_table(latest, [ies("Port")]).collect()
    assert [(r.short_name, r.label) for r in bars] == [("ies:Port", "rate=0.3 count=3")]
    rolled = {r.msg_id: (r.trip_rate, r.msg_rate) for r in monitor.rolling_rates(counts).collect()}
    assert rolled == {1: (None, None), 2: (0.5, 0.2), 3: (0.3, 0.15)}


def test_counts_of_watched_messages_shuffle_no_triples(spark, sf_dir):
    """Pings are dealt by message to tasks of bounded size before they become triples, and grouped where they are."""
    from tracklake.operators import monitor
    from tracklake.plans import queries
    from tracklake.session import deal

    for count in (monitor.class_counts, monitor.message_counts):
        plan = count(queries._watched(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "REPARTITION_BY_NUM" in plan
    assert deal(spark.range(1000), "id", rows=10).rdd.getNumPartitions() == 100


def test_newest_of_a_task_are_kept_batch_by_batch():
    import random

    import pyarrow as pa

    from tracklake.operators.monitor import newest_in_task

    rnd = random.Random(3)
    rows = [(rnd.choice("abc"), rnd.choice([None, *range(9)]), k, 1) for k in range(200)]
    columns = lambda part: pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*part)], ["class", "ts", "msg_id", "n"])
    batches = [columns(rows[i : i + 17]) for i in range(0, 200, 17)]
    got = sorted((r["class"], r["msg_id"]) for b in newest_in_task(["class"], ["ts", "msg_id"], 5)(iter(batches)) for r in b.to_pylist())
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
    assert got == sorted((c, r[2]) for c in "abc" for r in [r for r in order if r[0] == c][-5:])


def test_totals_of_others_keep_the_newest_of_a_task():
    """What a task does not send as its newest messages is one row of totals per name and shard."""
    import pyarrow as pa

    from tracklake.operators.monitor import newest_in_task
    from tracklake.streaming.monitor import _total

    rows = [(f"c{k % 2}", 0, None if k % 10 == 0 else k, str(k), 1, 2, 1) for k in range(100)]
    schema = pa.schema([("name", "string"), ("shard", "int32"), ("micros", "int64"), ("msg_id", "string"), ("first", "int64"), ("second", "int64"), ("messages", "int64")])
    parts = [pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[i : i + 9]), schema)], schema=schema) for i in range(0, 100, 9)]
    got = [r for b in newest_in_task(["name", "shard"], ["micros", "msg_id"], 5, _total)(iter(parts)) for r in b.to_pylist()]
    assert len(got) == 12 and sum(r["messages"] for r in got) == sum(r["first"] for r in got) == 100
    assert sorted(r["micros"] for r in got if r["micros"] is not None) == [88, *range(91, 100)]


def test_lines_of_messages_judged_in_one_frame(spark):
    from tracklake.streaming.monitor import message_triples

    node = "<http://e/s> <http://e/p>"
    lines = [f"{node} <http://e/o> .", f'{node} "a\\tb" .', f'{node} "a\\qb" .', f"{node} <http://e/\\u0041> .", f"{node} <http://e/\\q> .", "no triple", "# note", ""]
    rows = [("g", bytearray("\n".join(lines).encode())), ("h", bytearray(f"{node} <http://e/o> .".encode()))]
    sent = spark.createDataFrame(rows, "graph_id string, value binary").withColumn("timestamp", F.timestamp_seconds(F.lit(0)))
    good, bad = message_triples(sent, codec="none")
    both = message_triples(sent, codec="none", apart=False)
    assert sorted(r.o for r in good.collect()) == ["a\tb", "http://e/A", "http://e/o", "http://e/o"]
    assert sorted(r.raw for r in bad.collect()) == sorted([lines[2], lines[4], lines[5]])
    assert sorted(both.where("valid").drop("valid", "line").collect()) == sorted(good.collect())
    assert sorted(r.line for r in both.where("NOT valid").collect()) == sorted(r.raw for r in bad.collect())


def test_messages_are_counted_by_the_worker_that_inflates_them(spark):
    """Odd lines count as the parser of lines judges them, and neither texts nor loops over lines are left to Spark."""
    from tracklake.operators import packing
    from tracklake.sources.triples import parse_lines
    from tracklake.streaming.monitor import count_messages
    from tracklake.vocab import RDF_TYPE

    long = "\\n\\\"x" * 30_000
    lines = [
        "<a><b><c>.", "_:x.y<b>_:z.", '<a>\t<b>\t"v"@en-GB.#note', '<a><b>""^^<d> . # x', '<a> <b> "1 <x> . \\u00e9\\U0001F600" .\r',
        '<a> <b> " \u0085 \u0002" .', f'<a><b>"{long}".', "<a> <b> .", '<a> "b" <c> .', "<a> <b> <c>", '<a> <b> "x .', '<a> <b> "\\q" .',
        '<a> <b> "x"@ .', "\x02a\x02b\x02\x02\x02c\x02", "<a> <b> <c> . d", '<a> <b> "x" "y" .', "_:éx <b> <c> .", "_:  <b> <c> .",
        "_:\U0001F600 <b> <c> .", f"_:b <{RDF_TYPE}> _:c.d .", f'<a> <b> "<{RDF_TYPE}>" .', f"<a><{RDF_TYPE}><C>.",
    ]
    texts = [(str(k), line) for k, line in enumerate(lines)] + [("all", "\n".join([*lines, *lines, " ", "# none"]))]
    df = spark.createDataFrame(texts, "graph_id string, text string")
    good, _ = parse_lines(df.select("graph_id", F.explode(F.array_distinct(F.split("text", "\n"))).alias("line")))
    want = {r[0]: r[1] for r in good.groupBy("graph_id").count().collect()}
    for codec in ("zlib", "none"):
        sent = packing.as_messages(df, topic="t", key="graph_id", codec=codec).withColumn("graph_id", F.col("offset"))
        counts = count_messages(sent, codec)
        got = {r.msg_id: r for r in counts.collect()}
        assert {k: r.trip_count for k, r in got.items() if r.trip_count} == want
        assert got["all"].bad_lines == len(lines) - want["all"] and got["all"].obj_count == 2
        assert [tuple(c) for c in got["all"].classes] == [("_:c.d", 1), ("C", 1)]
    plan = count_messages(sent).where("trip_count IS NOT NULL")._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and plan.count("ArrowEvalPython") == 1


def test_graph_texts_are_made_without_a_loop_over_patterns(spark, sf_dir):
    from tracklake.operators import emitters
    from tracklake.operators import triples as tr
    from tracklake.plans.queries import following_events

    texts = emitters.following_graphs(following_events(spark, sf_dir), emit=tr.emit_texts)
    assert "transform(" not in texts._jdf.queryExecution().optimizedPlan().toString()
