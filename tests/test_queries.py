"""Every registered query against its SQL twin on the smallest sample."""

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracle import TABLES, canonical
from crowdpulse.plans.oracle import oracle_sql
from crowdpulse.plans.queries import queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["notify_ts", "post_id", "num_comments", "num_replies", "num_people"]
    assert df.count() > 0


def test_every_query_has_a_twin():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", sorted(queries()))
def test_query(spark, duck, name):
    df = queries()[name](spark, SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    rows = [tuple(r) for r in df.collect()]
    result = duck.execute(oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert canonical(rows, df.columns) == canonical(result.fetchall(), columns)
