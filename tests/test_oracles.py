"""Every query against its oracle, as the driver does it, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the driver's tables are not here")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{name}'")
    return con


def text(rows):
    return sorted(tuple("" if v is None else f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", ORACLES)
def test_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    want = duck.execute(f"SELECT {', '.join(chr(34) + c + chr(34) for c in columns)} FROM ({ORACLES[name]}) q").fetchall()
    assert text(df.select(*columns).collect()) == text(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_its_query():
    assert set(ORACLES) <= set(QUERIES)
