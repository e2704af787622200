"""The operators that SQL can express, against DuckDB on the smallest tables."""

import os

import pytest

duckdb = pytest.importorskip("duckdb")

from tidelock.llm import queries  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")


@pytest.mark.parametrize("name", queries.ORACLES)
def test_oracle(spark, name):
    duck = duckdb.connect()
    for table in os.listdir(SF):
        duck.execute(f"CREATE VIEW {table.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{table}'")
    got = queries.QUERIES[name](spark, SF)
    want = duck.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLES[name]}) q").fetchall()
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(map(str, want)) and want
