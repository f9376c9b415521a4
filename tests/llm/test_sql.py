"""Numbered queries against SQL in another engine, over whole tables."""

import duckdb
import pytest

from tallyroll.llm.oracle import ORACLE_SQL
from tallyroll.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, sf_dir, name):
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_dir}/documents.parquet')")
        cursor = con.execute(ORACLE_SQL[name])
        columns = sorted(c[0] for c in cursor.description)
        theirs = sorted(cursor.fetchdf()[columns].itertuples(index=False, name=None), key=repr)
    ours = QUERIES[name](spark, sf_dir)
    assert sorted(ours.columns) == columns
    assert sorted(ours.select(columns).toPandas().itertuples(index=False, name=None), key=repr) == theirs
