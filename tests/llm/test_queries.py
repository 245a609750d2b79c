"""Registered queries against their SQL on the smallest tables, and the pipeline stage by stage."""

import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from devmetrics.llm.queries import ORACLES, QUERIES  # noqa: E402

SF_DIR = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not SF_DIR.exists(), reason="driver tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in SF_DIR.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def counted(table):
    return Counter(zip(*(map(str, table.column(n).to_pylist()) for n in sorted(table.column_names))))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_oracle(spark, duck, name):
    got = QUERIES[name](spark, str(SF_DIR)).toArrow()
    wanted = duck.sql(ORACLES[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(wanted.column_names)
    assert counted(got) == counted(wanted) and got.num_rows > 0


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline(spark, tmp_path):
    docs = spark.read.parquet(str(SF_DIR / "documents.parquet"))
    columns, counts = docs.columns, [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, str(SF_DIR)).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] == counts[3] > 0
    ends = docs.selectExpr("sequence_id", "offset + length AS end").groupBy("sequence_id").max("end")
    assert ends.filter("`max(end)` > 1024").count() == 0
