"""Corpus queries that SQL can express, against DuckDB on the smallest test data."""

import duckdb
import pytest

from martline.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_oracle(spark, tmp_path, name):
    spark.sparkContext.setCheckpointDir(str(tmp_path))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF).select(*want.columns).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want.fetchall()))
