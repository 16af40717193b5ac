import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tracklake.session import build_session, prepare  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = prepare(build_session("local[4]", app="tracklake-tests", partitions=4))
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


@pytest.fixture(scope="session")
def minimal(spark):
    """Ten pings of two vessels, one minute or so apart."""
    from tracklake.sources.pings import minimal_pings

    # Sample pings.
    rows = [
        ("366952890", "2007-01-01T00:00:09", 40.64175, -74.07136),
        ("366952890", "2007-01-01T00:01:20", 40.64175, -74.07135),
        ("367000150", "2007-01-01T00:01:57", 40.64196, -74.07289),
        ("366952890", "2007-01-01T00:02:29", 40.64176, -74.07136),
        ("366952890", "2007-01-01T00:03:38", 40.64176, -74.07138),
        ("366952890", "2007-01-01T00:04:39", 40.64176, -74.07138),
        ("367000150", "2007-01-01T00:04:55", 40.64197, -74.07291),
        ("366952890", "2007-01-01T00:05:40", 40.64175, -74.07136),
        ("366952890", "2007-01-01T00:06:50", 40.64175, -74.07135),
        ("367000150", "2007-01-01T00:07:56", 40.64196, -74.07291),
    ]
    return minimal_pings(spark.createDataFrame(rows, "mmsi string, ts string, lat double, lon double"))


def rows_of(df, *columns):
    """Rows as a sorted list of tuples, for comparison."""
    picked = df.select(*(columns or sorted(df.columns)))
    return sorted((tuple(r) for r in picked.collect()), key=repr)
