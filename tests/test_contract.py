"""Registered queries: every one is known, and the SQL covers only known ones."""

from pathlib import Path

import pytest

import __spark_entry__ as entry

DATA = Path("/root/testdata/sf0.001")


def test_names():
    queries, oracles = entry.queries(), entry.oracle_sql()
    assert set(oracles) <= set(queries) and len(queries) > 100
    assert all(sql.strip() for sql in oracles.values())


@pytest.mark.skipif(not DATA.exists(), reason="test tables are not at hand")
def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "aqi_rolling_mean_24h" in df.columns
