import duckdb
import pytest

import __spark_entry__ as entry
from quayside.plans import catalog
from quayside.plans.feeds import BASE_TABLES

SF = "/root/testdata/sf0.001"


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())


def test_flagship_runs(spark):
    assert entry.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize(
    "name", ["triage_decisions", "extract_results", "dedup_fuzzy_match", "breaker_states", "intake_with_ledger"]
)
def test_queries_match_sql(spark, name):
    from check import rows

    db = duckdb.connect()
    for table in BASE_TABLES:
        db.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    result = entry.queries()[name](spark, SF)
    cursor = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(columns) == sorted(result.columns)
    got = rows(result.columns, [tuple(r) for r in result.collect()])
    assert got == rows(columns, cursor.fetchall()) and got
