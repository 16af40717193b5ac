import pytest
from pyspark.sql import functions as F

from tests.conftest import rows_of
from tracklake.operators import mapping
from tracklake.vocab import CLASSES, DATA, EXTENSION, PREDICATES, VESSEL_CLASS_MAP, ies


@pytest.fixture(scope="module")
def coded(spark):
    return spark.createDataFrame(
        [(1, "1001", "9"), (2, "1011", ""), (3, "7777", None), (4, None, "9"), (5, "7abc", "8")],
        "seq bigint, vessel_type string, imo string",
    )


def classes_of(df):
    return {r.seq: r.classes for r in df.collect()}


def test_exact_and_default_classes(spark, coded):
    got = classes_of(mapping.type_rows(coded, mapping.vessel_class_map(spark)))
    default = [ies("VehicleState"), ies("Observed")]
    assert got[1] == [*default, EXTENSION + "CommercialFishingVessel"]
    assert got[2] == [ies("Ship"), EXTENSION + "OilRecoveryVessel"]
    assert got[3] == got[4] == got[5] == default
    assert len(VESSEL_CLASS_MAP) == 10


def test_patterns_come_between_exact_and_default(spark, coded):
    rules = [("^7[a-z]", ["Ship"], ["Odd"]), ("^7", ["Vessel"], []), ("^1", ["Port"], [])]
    got = classes_of(mapping.type_rows(coded, mapping.vessel_class_map(spark), patterns=rules))
    assert got[5] == [ies("Ship"), EXTENSION + "Odd"]
    assert got[3] == [ies("Vessel")]
    assert got[2] == [ies("Ship"), EXTENSION + "OilRecoveryVessel"]
    assert len(got) == 5


def test_uri_policies(spark, coded):
    name = lambda **kw: mapping.name_rows(coded, mapping.UriPolicy(**kw), ["seq"])
    assert name(mapping_type="FIELD", field="imo", missing="SKIP").count() == 3
    both = rows_of(name(mapping_type="FIELD", field="imo", missing="GUID"), "seq", "row_uri")
    assert dict(both)[1] == DATA + "9" and dict(both)[2].startswith(DATA) and len(dict(both)[2]) > len(DATA) + 30
    assert rows_of(name()) == rows_of(name())
    assert name(random=True).select("row_uri").distinct().count() == 5
    with pytest.raises(Exception, match="no value in id field"):
        name(mapping_type="FIELD", field="imo", missing="ERROR").collect()
    with pytest.raises(ValueError):
        mapping.UriPolicy("FIELD")


def test_vocabulary():
    assert ies("Follow").endswith("ies4#Follow")
    assert len(set(CLASSES)) == len(CLASSES) and len(PREDICATES) == 21
    with pytest.raises(KeyError):
        ies("NoSuchClass")


def test_class_map_join_is_broadcast_only_by_size(spark, coded):
    typed = mapping.type_rows(coded, mapping.vessel_class_map(spark))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        assert len(classes_of(typed.withColumn("x", F.lit(1)))) == 5
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_fixed_map_does_not_shuffle_the_rows(spark):
    from tracklake.operators.mapping import type_rows, vessel_class_map

    rows = spark.range(1000).selectExpr("id", "cast(id % 90 as string) AS vessel_type")
    plan = type_rows(rows, vessel_class_map(spark))._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_triples_of_dealt_rows_are_gathered_without_a_shuffle(spark, sf_dir):
    from tracklake.operators import packing
    from tracklake.sources import driver
    from tracklake.streaming.mapper import map_messages

    sent = packing.as_messages(packing.pack_json(packing.number_messages(driver.pings(spark, sf_dir))), topic="pings", key="batch_id")
    dealt, plain = (packing.ntriples_messages(map_messages(sent, tasks=n)[0]) for n in (7, None))
    exchanges = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(graph_id")
    assert exchanges(dealt) == 1 and "graph_id#" in dealt._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, plain.collect()))
