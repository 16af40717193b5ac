"""Every registered query against its SQL on the driver tables."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry_point
from tracklake.plans.oracle import ORACLE
from tracklake.plans.queries import QUERIES



@pytest.fixture(scope="module")
def db(sf_dir):
    con = duckdb.connect()
    for name in ("customer", "documents", "events", "lineitem", "nation"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLE) <= set(entry_point.oracle_sql())


def test_entry(spark):
    out = entry_point.entry(spark)
    assert out.columns == ["graph_id", "n_triples", "n_objects"] and out.count() == 244


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, sf_dir, name):
    got = QUERIES[name](spark, sf_dir)
    columns = sorted(got.columns)
    cursor = db.execute(ORACLE[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    order = [names.index(c) for c in columns]
    want = Counter(tuple(r[i] for i in order) for r in cursor.fetchall())
    assert Counter(tuple(r) for r in got.select(*columns).collect()) == want
