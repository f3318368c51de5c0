"""Loads that differ in their headers only share the resolved sides; both marts of the key checks read the same shipments."""

from collections import Counter

import pytest

from martline.plans import actual, catalog, shipment_mart, variability_mart

VTTK = "mandt string, tknum string, datbg date, zzmatrix string, ernam string, erdat date, erzet string, add02 string, tdlnr string, route string, tech_load_ts timestamp_ntz, tech_is_deleted int"
TABLES = {
    "vttp": "mandt string, tknum string, tpnum int, vbeln string, tech_load_ts timestamp_ntz, tech_is_deleted int",
    "likp": "vbeln string, wadat date, vkorg string, kunnr string, ntgew decimal(18,3), tech_load_ts timestamp_ntz, tech_is_deleted int",
    "vtts": "mandt string, tknum string, tstyp int, vstel string, tech_load_ts timestamp_ntz, tech_is_deleted int",
    "otif_delivery": "SHIPMENT_NUM bigint, ETA_ACCORDING_CLIENT_PO date, FACT_UNLOADING_DATE date, TECH_LOAD_TS timestamp_ntz",
    "transportation_costs": "SHIPMENT_NUMBER bigint, CURRENCY_FACT string, CURRENCY_PLAN string, CURRENCY_BUSINESS_PLAN string, FACT_COST decimal(18,2), PLAN_COST decimal(18,2), BUSINESS_PLAN_COST decimal(18,2), AUCTION string, TECH_LOAD_TS timestamp_ntz",
    "currency_rate_ref": "rate_date date, rate_usd decimal(18,6), rate_eur decimal(18,6), TECH_LOAD_TS timestamp_ntz",
    "tvrab": "route string, abnum string, knanf string, knend string, tech_load_ts timestamp_ntz, tech_is_deleted int",
    "transport_leg": "id bigint, code string, transportation_time decimal(18,2), primitive_entity_data_state_id int, tech_load_ts timestamp_ntz, tech_is_deleted int",
    "kna1": "kunnr string, name1 string, tech_load_ts timestamp_ntz, tech_is_deleted int",
    "lfa1": "lifnr string, name1 string, tech_load_ts timestamp_ntz, tech_is_deleted int",
    "delivery_point_ref": "delivery_point_code string, delivery_point_dashboard_name string, tech_load_ts timestamp_ntz",
    "business_unit_ref": "business_unit_code string, shipping_point_code string, business_unit_name string, tech_load_ts timestamp_ntz",
}
T1, T2 = "2024-01-01 00:00:00", "2024-01-02 00:00:00"
DAY = "2024-01-05"
# two clients share shipment 1; 2 has a stage only, 3 goods only, 4 an item 1 without delivery, 5 items that are all deleted
ROWS = {
    "vttk": [(m, n, DAY, "01", "u", DAY, "08:00:00", "a1", "f1", r, T1, 0)
             for m, n, r in [("100", "0001", "r1"), ("200", "0001", "r2"), ("100", "0002", "r1"), ("100", "0003", None),
                             ("100", "0004", "r9"), ("100", "0005", "r1"), ("100", "0006", "r1"), ("100", None, "r1")]],
    "vttp": [("100", "0001", 1, "d1", T1, 0), ("100", "0001", 2, "d2", T1, 0), ("200", "0001", 1, "d3", T1, 0),
             ("100", "0003", 1, "d2", T1, 1), ("100", "0003", 1, "d4", T2, 0), ("100", "0004", 1, "dx", T1, 0),
             ("100", "0005", 1, "d1", T1, 0), ("100", "0005", 1, "d1", T2, 1), ("100", None, 1, "d1", T1, 0),
             ("100", "0006", 1, "d1", T1, 0)],
    "likp": [("d1", DAY, "9001", "c1", "1.5", T1, 0), ("d2", DAY, "9002", "c2", "2.5", T1, 0), ("d3", DAY, "9001", None, None, T1, 0),
             ("d4", None, "9001", "c9", "4", T1, 0), (None, DAY, "9001", "c1", "9", T1, 0)],
    "vtts": [("100", "0001", 1, "s1", T1, 0), ("200", "0001", 2, "s2", T1, 0), ("100", "0002", 1, "s1", T1, 0),
             ("100", "0005", 1, None, T1, 0), ("100", None, 1, "s1", T1, 0)],
    "otif_delivery": [(1, DAY, DAY, T1), (None, DAY, None, T1), (5, None, DAY, T1)],
    "transportation_costs": [(1, "USD", "RUB", None, "10", "20", "30", "1", T1), (None, "USD", "RUB", None, "1", "2", "3", "1", T1)],
    "currency_rate_ref": [(DAY, "90", "100", T1), (None, "1", "1", T1)],
    "tvrab": [("r1", "1", "p", "q", T1, 0), ("r1", "2", "p", "q", T1, 0), ("r1", "3", "p", None, T1, 0), ("r2", "1", "q", "p", T1, 0), (None, "1", "p", "q", T1, 0)],
    "transport_leg": [(1, "p_q_Auto", "2.5", 1, T1, 0), (2, "p_q_Auto", "1", 1, T1, 0), (3, "q_p_Auto", "7", 2, T1, 0), (4, None, "7", 1, T1, 0)],
    "kna1": [("c1", "C1", T1, 0), ("c2", "C2", T1, 1)],
    "lfa1": [("f1", "F1", T1, 0)],
    "delivery_point_ref": [("a1", "A1", T1), ("a1", "A1 new", T2)],
    "business_unit_ref": [("9001", "s1", "B1", T1), ("9001", "s2", "B2", T1)],
}


@pytest.fixture
def src(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    out = {}
    for name, ddl in {"vttk": VTTK, **TABLES}.items():
        fields = T.StructType.fromDDL(ddl).fields
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
        rows = [tuple(None if v is None else str(v) for v in r) for r in ROWS[name]]
        out[name] = spark.createDataFrame(rows, texts).select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    return out


def _rows(df):
    return Counter(str(r) for r in df.collect())


@pytest.mark.parametrize("client", [False, True])
def test_stored_sides_give_the_same_rows(spark, src, client):
    want = _rows(shipment_mart.enriched(src, client_in_join=client))
    assert sum(want.values()) >= 8
    with shipment_mart.stored_sides(src) as made:
        assert _rows(shipment_mart.enriched(src, client_in_join=client, made=made)) == want
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("martline_")]


def test_stored_sides_are_read_as_they_are_dealt(spark, src):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        with shipment_mart.stored_sides(src) as made:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
            spark.conf.set("spark.sql.adaptive.enabled", "false")
            plan = shipment_mart.enriched(src, made=made)._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    for key in ("vbeln", "g_tknum", "s_tknum", "r_route", "route", "o_SHIPMENT_NUM", "SHIPMENT_NUM", "ca_SHIPMENT_NUMBER", "SHIPMENT_NUMBER"):
        assert f"hashpartitioning({key}#" not in plan


def test_mart_shipments_serve_the_variability_mart(src):
    names = ["k_tknum", "k_zzmatrix", "l_wadat", "l_vkorg", "s_vstel", "b_name", "d_name"]
    got = variability_mart.from_mart_shipments(shipment_mart.shipments(src)).select(*names)
    assert _rows(got) == _rows(variability_mart.shipments(src).select(*names))


@pytest.mark.parametrize("query", ["incremental_load", "mart_key_checks"])
def test_each_side_is_resolved_once(spark, monkeypatch, query):
    calls = Counter()
    for name in ("likp", "vtts", "vttp"):
        def counted(df, name=name, resolve=getattr(actual, name)):
            calls[name] += 1
            return resolve(df)

        monkeypatch.setattr(actual, name, counted)
    catalog.queries()[query](spark, "/root/testdata/sf0.001")
    assert set(calls.values()) == {1}
