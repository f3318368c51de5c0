"""Every catalogue query against its DuckDB oracle on the smallest test data."""

import decimal

import duckdb
import pytest

import __spark_entry__ as E
from martline import constants as K
from martline.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def _norm(v):
    if v is None:
        return "<NULL>"
    if isinstance(v, float):
        return repr(round(v, 9))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(E.queries()) and set(catalog.queries()) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns[0] == "transportation_number"
    assert df.count() >= 0


SPARK_TO_DUCKDB = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "StringType()": "VARCHAR",
                   "DateType()": "DATE", "TimestampNTZType()": "TIMESTAMP", "DoubleType()": "DOUBLE"}


def _duck_type(dt) -> str:
    r = repr(dt)
    return SPARK_TO_DUCKDB.get(r, r.replace("DecimalType(", "DECIMAL(").replace(", ", ","))


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    """Same column names and types, and the same rows (order-insensitive)."""
    df = E.queries()[name](spark, SF)
    sql = E.oracle_sql()[name]
    types = {f.name.lower(): _duck_type(f.dataType) for f in df.schema.fields}
    assert types == {r[0].lower(): r[1] for r in con.execute("DESCRIBE " + sql).fetchall()}
    cols = sorted(df.columns)
    got = sorted(tuple(_norm(r[c]) for c in cols) for r in df.collect())
    rel = con.execute(sql)
    names = [d[0] for d in rel.description]
    want = sorted(tuple(_norm(dict(zip(names, r))[c]) for c in cols) for r in rel.fetchall())
    assert got == want


def test_the_test_data_reaches_every_branch(con):
    """Labels, defaults, tombstones and repeated versions all occur in what the oracle compares."""
    sql = E.oracle_sql()

    def values(query, column):
        return {r[0] for r in con.execute(f"SELECT DISTINCT {column} FROM ({sql[query]}) AS x").fetchall()}

    assert values("nested_category", "sales_channel_nd") == {K.CHANNEL_LAST_MILE, K.CHANNEL_EXPORT, K.CHANNEL_DOMESTIC,
                                                             K.CHANNEL_INTERNAL, K.NO_DATA}
    units = values("label_fallback_chain", "business_unit_nd")
    assert units >= {label for _, label in K.BUSINESS_UNIT_BY_SALES_ORG} | {K.NO_DATA}
    assert any(u.startswith("BU_") for u in units) and "OLD" not in units
    coded = {label for _, label in K.SHIPMENT_POINT_DASHBOARD_NAMES}
    names = values("dimension_rebuild", "shipment_point_dashboard_name")
    assert names & coded and names - coded
    headers = con.execute("SELECT COUNT(*) FROM orders").fetchone()[0]
    assert 0 < len(values("star_enrich", "transportation_number")) < headers  # some newest headers are deleted
    assert None in values("star_enrich", "consignee_name") and None in values("star_enrich", "forwarder_name")
    assert all(r[0] > 0 for r in con.execute(f"SELECT validation_result FROM ({sql['mart_key_checks']}) AS x").fetchall())
    assert len(values("incremental_load", "tech_load_ts")) == 2


def test_dimension_is_sorted_as_loaded(spark):
    rows = [(r.shipment_point_code, r.shipment_point_name) for r in catalog.dimension_rebuild(spark, SF).collect()]
    assert rows == sorted(rows) and len(rows) > 1
