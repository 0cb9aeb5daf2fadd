"""Every registered query against its DuckDB oracle (small scale)."""

import pytest

from conftest import SF_SMALL
from oracle_compare import compare, duck_connection, load_entry

ENTRY = load_entry()


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF_SMALL)


OWN = {k for k, f in ENTRY.queries().items() if f.__module__ == ENTRY.__name__}


def test_every_query_has_an_oracle():
    """The document operators, an optional part, are tested in tests/llm where SQL cannot express them."""
    assert OWN and OWN <= set(ENTRY.oracle_sql()) <= set(ENTRY.queries())


def test_entry_smoke(spark):
    df = ENTRY.entry(spark)
    assert len(df.columns) == 25
    assert df.count() > 0


@pytest.mark.parametrize("key", list(ENTRY.oracle_sql()))
def test_query_matches_oracle(spark, con, key):
    res = compare(spark, ENTRY, con, key, SF_SMALL)
    assert res["rows_spark"] == res["rows_oracle"], res
    assert res["names_match"], res
    assert res["types_match"], res
    assert res["hash_match"], res
