"""Every query with SQL against DuckDB on the smallest tables; the others run."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pytest

from colonnade.plans import registry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for name in registry.TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", registry.QUERIES)
def test_query(spark, duck, name):
    df = registry.QUERIES[name](spark, SF)
    rows = Counter(tuple(plain(r[c]) for c in sorted(df.columns)) for r in df.collect())
    if name in registry.ORACLE:
        result = duck.execute(registry.ORACLE[name])
        names = [d[0] for d in result.description]
        order = sorted(range(len(names)), key=names.__getitem__)
        assert sorted(df.columns) == sorted(names)
        assert rows == Counter(tuple(plain(r[i]) for i in order) for r in result.fetchall())


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
