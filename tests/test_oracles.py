"""Every registered query against its SQL oracle, on the smallest driver tables."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as entry  # noqa: E402
from devmetrics.registry import ORACLES, QUERIES  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def counted(table):
    names = sorted(table.column_names)
    return Counter(zip(*(map(str, table.column(n).to_pylist()) for n in names)))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_oracle(spark, duck, name):
    got = entry.queries()[name](spark, str(SF_DIR)).toArrow()
    wanted = duck.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(wanted.column_names)
    for column in got.column_names:
        assert str(got.schema.field(column).type) == str(wanted.schema.field(column).type), column
    assert counted(got) == counted(wanted)
    assert got.num_rows > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.items() <= entry.queries().items() and ORACLES.items() <= entry.oracle_sql().items()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
