"""Every registered query against its DuckDB oracle on the smallest tables."""

import math
import os
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest

from quarryframe.plans import REGISTRY

FOLDER = os.environ.get("QUARRY_TEST_TABLES", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables")


def plain(value):
    if isinstance(value, (list, tuple, np.ndarray)):
        return tuple(map(plain, value))
    if value is None or value is pd.NA or value is pd.NaT or isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, (bool, np.bool_)):
        return bool(value)
    if isinstance(value, (int, float, np.integer, np.floating)):
        return round(float(value), 5)
    return str(value)


def rows(frame: pd.DataFrame) -> Counter:
    return Counter(tuple(map(plain, r)) for r in frame[sorted(frame.columns)].itertuples(index=False))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(name, spark, duck):
    q = REGISTRY[name]
    got = q.build(spark, FOLDER).toPandas()
    if q.sql is None:
        assert len(got.columns)
        return
    want = duck.sql(q.sql).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry_and_guard(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(REGISTRY) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
