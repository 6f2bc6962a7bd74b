from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from sparktrips.session import build_session
    s = build_session("local[4]", app="sparktrips-tests", shuffle_partitions=8)
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf_small():
    return SF_SMALL


@pytest.fixture()
def raw_trips(spark):
    """Ten raw trips: 20-minute durations, one zero-distance trip, an
    all-null ``ehail_fee`` (the reference's synthetic trip frame)."""
    from sparktrips.sources.tables import TRIP_SCHEMA
    base = dt.datetime(2026, 5, 1, 10, 0)
    flags = ["N", "Y", "N", "N", "Y", "N", "Y", "N", "N", "Y"]
    dist = [2.5, 3.0, 1.2, 0.0, 4.5, 2.0, 3.5, 1.8, 5.0, 2.2]
    rows = []
    for i in range(10):
        p = base + dt.timedelta(minutes=15 * i)
        rows.append((1, p, p + dt.timedelta(minutes=20), flags[i], 1.0, 10, 20, 1.0, dist[i], 12.0, 0.0, 0.5,
                     2.0, 0.0, None, 1.0, 15.0, 1.0, 1.0, 0.0, 0.75))
    return spark.createDataFrame(rows, TRIP_SCHEMA)
