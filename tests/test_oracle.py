"""Every named query with SQL returns what the SQL returns, over whole tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from oracle import DATA, connect, differences

SQL = oracle_sql()
# The smallest tables hold one listing key twice; what depends on unique keys
# is compared on the next size.
UNIQUE_KEYS = {
    "attach_image_paths", "ingest_stream", "extract_rows_cells9", "extract_rows_cells8",
    "extract_rows_card", "extract_rows_grid",
}


@pytest.fixture(scope="module")
def connections():
    return {sf: connect(str(DATA / sf)) for sf in ("sf0.001", "sf0.01")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, connections, name):
    sf = "sf0.01" if name in UNIQUE_KEYS else "sf0.001"
    found = differences(
        spark, connections[sf], name, queries()[name], SQL[name], str(DATA / sf)
    )
    assert found == []


def test_every_sql_has_a_query():
    assert set(SQL) <= set(queries())
