"""Registered queries of the subpackage against their SQL."""

import pytest

import __spark_entry__ as registered
from ledgerloom.llm.registry import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, small, name):
    duckdb = pytest.importorskip("duckdb")
    from tools.check_oracles import TABLES, canonical

    database = duckdb.connect()
    for table in TABLES:
        database.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')")
    df = QUERIES[name](spark, small)
    cursor = database.execute(ORACLES[name])
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(df.columns, df.collect()) == want


def test_all_operators_and_the_pipeline():
    names = [name for name in registered.queries() if name.startswith("op")]
    assert sorted(int(name[2:].split("_")[0]) for name in names) == list(range(1, 14))
    assert "pipeline" in registered.queries()
