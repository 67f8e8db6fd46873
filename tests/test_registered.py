"""The driver contract at the smallest scale."""

import sys
import types

import pytest

import __spark_entry__ as registered
from ledgerloom import catalog

QUERIES = registered.queries()
CATALOG = catalog.QUERIES


def test_every_query_of_the_library_has_sql():
    assert set(CATALOG) <= set(registered.oracle_sql())
    assert set(registered.oracle_sql()) <= set(QUERIES)


def test_entry(spark, small):
    assert registered.entry(spark).count() > 0


@pytest.mark.parametrize(
    "name", ["purchases", "favourite_weekday", "rfm_scores", "mann_whitney", "trade_components",
             "page_records", "aa_audit", "bootstrap_median"]
)
def test_same_as_sql(spark, small, name):
    duckdb = pytest.importorskip("duckdb")
    from tools.check_oracles import TABLES, canonical

    database = duckdb.connect()
    for table in TABLES:
        database.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small}/{table}.parquet')"
        )
    df = QUERIES[name](spark, small)
    cursor = database.execute(registered.oracle_sql()[name])
    want = canonical([d[0] for d in cursor.description], cursor.fetchall())
    assert canonical(df.columns, df.collect()) == want


@pytest.mark.parametrize("missing", ["corpus_pipeline", "public_tokenizers", "ledgerloom.llm", "ledgerloom.llm.registry"])
def test_other_queries_stay_when_the_training_data_part_cannot_be_imported(monkeypatch, missing):
    from ledgerloom.catalog import QUERIES
    from oracles import ORACLES

    import ledgerloom

    for name in list(sys.modules):
        if name == "corpus_pipeline" or name.startswith("ledgerloom.llm"):
            monkeypatch.delitem(sys.modules, name)
    monkeypatch.delattr(ledgerloom, "llm", raising=False)
    # None: as if not installed; an empty module: as if only its folder were left.
    left = types.ModuleType(missing) if missing == "ledgerloom.llm" else None
    monkeypatch.setitem(sys.modules, missing, left)
    assert set(registered.queries()) == set(QUERIES) and set(registered.oracle_sql()) == set(ORACLES)
    assert set(ORACLES) == set(QUERIES)
