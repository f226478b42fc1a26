"""The registered queries on the small tables: DuckDB where SQL can say it, rows otherwise."""

from collections import Counter

import duckdb
import pytest

from tripflow.llm.queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    rows = [tuple(r) for r in df.select(*columns).collect()]
    assert rows
    if name not in ORACLE_SQL:
        return
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    own = con.sql(ORACLE_SQL[name])
    assert sorted(own.columns) == columns
    assert Counter(own.select(*columns).fetchall()) == Counter(rows)
