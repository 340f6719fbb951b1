import duckdb
import pytest

from hourgrid.llm import queries
from hourgrid.llm.oracle import SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_its_sql(spark, small_dir, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "conversations"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{small_dir}/{table}.parquet')")
    got = queries.queries()[name](spark, small_dir)
    want = db.execute(SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r[n] for n in names) for r in got.collect()))) == sorted(map(repr, want.fetchall()))
