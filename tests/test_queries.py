"""Every query of the core with SQL gives the SQL's rows; the others run over their whole tables."""

import pytest
from oracle import DATA, connect, same

from broadsheet.plans import catalog

SQL = catalog.oracle_sql()
QUERIES = catalog.queries()


@pytest.fixture(scope="module")
def con():
    return connect()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, DATA)
    if name in SQL:
        same(con, df, SQL[name])
    else:
        rows = df.collect()
        assert rows and len(set(map(str, rows))) > len(rows) // 2  # every column is computed, and they are not all one value


def test_sql_belongs_to_queries():
    assert set(SQL) <= set(QUERIES)
