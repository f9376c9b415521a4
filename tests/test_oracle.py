"""Every query against its SQL in another engine, over whole tables."""

import duckdb
import pytest

from tallyroll.oracle import ORACLE_SQL as ORACLE
from tallyroll.queries import QUERIES

TABLES = ("customer", "events")


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')")
    yield con
    con.close()


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows_as_sql(spark, duck, sf_dir, name):
    result = QUERIES[name](spark, sf_dir)
    ours = _sorted_rows(result.columns, result.collect())
    cursor = duck.execute(ORACLE[name])
    columns = [c[0] for c in cursor.description]
    theirs = _sorted_rows(columns, cursor.fetchall())
    assert sorted(result.columns) == sorted(columns)
    assert len(ours) == len(theirs)
    assert ours == theirs
    assert ours, "a query over the test tables should return rows"


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
