"""Every registered query against its SQL in DuckDB."""

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as entry
from oracle import ORACLE
from roadledger.plans.table_queries import all_queries

FOLDER = "/root/testdata/sf0.01"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()
TYPES = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
         "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{FOLDER}/{table}.parquet'")
    return con


def test_every_query_has_its_sql():
    assert set(ORACLE) == set(all_queries())
    assert set(entry.queries()) >= set(all_queries()) and entry.oracle_sql().items() >= ORACLE.items()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query(spark, duck, name):
    df = all_queries()[name](spark, FOLDER)
    plan = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in plan
    answer = duck.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    assert {n: TYPES[t] for n, t in df.dtypes} == types
    expected = [dict(zip(types, r)) for r in answer.fetchall()]
    columns = sorted(types)
    assert len(expected) > 0
    assert rows(df.select(*columns)) == sorted((tuple(r[c] for c in columns) for r in expected), key=repr)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0


def test_the_sample_reaches_every_branch(spark):
    def values(name, column):
        return {r[column] for r in entry.queries()[name](spark, FOLDER).collect()}

    assert values("risk_category", "risk_category") == {"EXCELLENT", "GOOD", "AVERAGE", "POOR", "HIGH_RISK"}
    assert values("severity_level", "severity_level") == {"CRITICAL", "SEVERE", "HIGH", "MODERATE", "NORMAL"}
    assert values("response_priority_rank", "response_priority") == {1, 2, 3, 4}
    assert values("time_category", "time_category") == {"MORNING_RUSH", "EVENING_RUSH", "DAYTIME"}
    assert values("time_category_wrapped", "time_category") == {"MORNING_RUSH", "EVENING_RUSH", "NIGHT", "DAYTIME"}
    assert values("compaction_preview", "grade") == {"below minimum", "eligible", "good", "excellent"}
    assert values("customer_risk_profile", "risk_category") == {"HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"}
    assert values("customer_risk_profile_fanout", "risk_category") == {"HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"}
