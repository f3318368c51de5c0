"""Columns of the shipment star travel only as far as a join needs them; the candidates are stored as versions and comparison need them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from martline.plans import actual, catalog, shipment_mart
from martline.session import cut_lineage, scratch_tables
from martline.sources import testdata as TD

SF = "/root/testdata/sf0.001"
T1, T2, DAY = "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-05"
LOADED = "tech_load_ts timestamp_ntz, tech_is_deleted int"
# shipment 1 twice for one client (leading zeros) and once for another, a header without number, codes that repeat or are missing
TABLES = {
    "vttk": (f"mandt string, tknum string, datbg date, zzmatrix string, ernam string, erdat date, erzet string, add02 string, tdlnr string, route string, {LOADED}",
             [(m, n, DAY, "01", u, DAY, "08:00:00", a, f, r, T1, 0)
              for m, n, u, a, f, r in [("100", "0001", "u1", "a1", "f1", "r1"), ("200", "0001", "u2", "a2", "f2", "r2"), ("100", "01", "u3", "a2", None, "r1"),
                                       ("100", None, "u4", "a1", "f2", "r2"), (None, None, "u5", None, "f1", "r1"), (None, "0002", "u6", "a3", "f9", None), ("100", "0003", "u7", "a1", "f1", "r1")]]),
    "vttp": (f"mandt string, tknum string, tpnum int, vbeln string, {LOADED}",
             [("100", "0001", 1, "d1", T1, 0), ("100", "0001", 2, "d2", T1, 0), ("200", "0001", 1, "d2", T1, 0), ("100", "01", 1, "d3", T1, 0), ("100", None, 1, "d1", T1, 0), (None, "0002", 1, "d1", T1, 0)]),
    "likp": (f"vbeln string, wadat date, vkorg string, kunnr string, ntgew decimal(18,3), {LOADED}",
             [("d1", DAY, "9001", "c1", "1.5", T1, 0), ("d2", DAY, "9002", "c2", "2.5", T1, 0), ("d3", None, "9001", None, None, T1, 0)]),
    "vtts": (f"mandt string, tknum string, tstyp int, vstel string, {LOADED}", [("100", "0001", 1, "s1", T1, 0), ("200", "0001", 2, "s2", T1, 0), ("100", "01", 1, "s1", T1, 0), (None, "0002", 1, None, T1, 0)]),
    "otif_delivery": ("SHIPMENT_NUM bigint, ETA_ACCORDING_CLIENT_PO date, FACT_UNLOADING_DATE date, TECH_LOAD_TS timestamp_ntz", [(1, DAY, DAY, T1), (None, DAY, None, T1)]),
    "transportation_costs": ("SHIPMENT_NUMBER bigint, CURRENCY_FACT string, CURRENCY_PLAN string, CURRENCY_BUSINESS_PLAN string, FACT_COST decimal(18,2), PLAN_COST decimal(18,2), BUSINESS_PLAN_COST decimal(18,2), AUCTION string, TECH_LOAD_TS timestamp_ntz",
                             [(1, "USD", "RUB", None, "10", "20", "30", "1", T1), (2, "RUB", "RUB", None, "10", "20", "30", "1", T1)]),
    "currency_rate_ref": ("rate_date date, rate_usd decimal(18,6), rate_eur decimal(18,6), TECH_LOAD_TS timestamp_ntz", [(DAY, "90", "100", T1)]),
    "tvrab": (f"route string, abnum string, knanf string, knend string, {LOADED}", [("r1", "1", "p", "q", T1, 0), ("r2", "1", "q", None, T1, 0), (None, "1", "p", "q", T1, 0)]),
    "transport_leg": (f"id bigint, code string, transportation_time decimal(18,2), primitive_entity_data_state_id int, {LOADED}", [(1, "p_q_Auto", "2.5", 1, T1, 0), (2, "p_q_Auto", "1", 1, T1, 0)]),
    "kna1": (f"kunnr string, name1 string, {LOADED}", [("c1", "C1", T1, 0), ("c2", "C2", T1, 0)]),
    "lfa1": (f"lifnr string, name1 string, {LOADED}", [("f1", "F1", T1, 0), ("f2", None, T1, 0)]),
    "delivery_point_ref": ("delivery_point_code string, delivery_point_dashboard_name string, tech_load_ts timestamp_ntz", [("a1", "A1", T1), ("a1", "A1 new", T2), ("a2", "A2", T1)]),
    "business_unit_ref": ("business_unit_code string, shipping_point_code string, business_unit_name string, tech_load_ts timestamp_ntz", [("9001", "s1", "B1", T1), ("9001", "s1", "B1 new", T2), ("9002", "s2", "B2", T1)]),
}


@pytest.fixture
def src(spark):
    from pyspark.sql import types as T

    out = {}
    for name, (ddl, rows) in TABLES.items():
        fields = T.StructType.fromDDL(ddl).fields
        texts = T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
        df = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows], texts)
        out[name] = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
    return out


@pytest.fixture
def plainly(spark):
    """Every join is planned as if no side could be broadcast, and plans are final."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _below(plan: str, exchange: str) -> str:
    lines = plan.splitlines()
    return lines[1 + next(i for i, line in enumerate(lines) if exchange in line)]


def _one_after_the_other(src, resolve_dims, client) -> Counter:
    """The star as one chain of left joins, with each table prefixed as in the mart."""
    def t(df, p):
        return df.toDF(*[p + c for c in df.columns])

    def dim(name, keys):
        return actual.reference_dim(src[name], keys, resolve_dims)

    made = shipment_mart.sides(src)
    same = (lambda o: (F.col("k_tknum") == F.col(f"{o}_tknum")) & (F.col("k_mandt") == F.col(f"{o}_mandt"))) if client else (lambda o: F.col("k_tknum") == F.col(f"{o}_tknum"))
    items = t(actual.vttp(src["vttp"]).where("tpnum = 1"), "p_").join(t(actual.likp(src["likp"]), "l_"), F.col("p_vbeln") == F.col("l_vbeln"), "left")
    x = (t(actual.vttk(src["vttk"]), "k_").join(t(made["goods"], "g_"), F.col("k_tknum") == F.col("g_tknum"), "left")
         .join(items, same("p"), "left").join(t(made["stages"], "s_"), same("s"), "left")
         .join(t(actual.lfa1(src["lfa1"]), "f_"), F.col("f_lifnr") == F.col("k_tdlnr"), "left")
         .join(t(dim("delivery_point_ref", ["delivery_point_code"]), "d_"), F.col("k_add02") == F.col("d_delivery_point_code"), "left")
         .join(t(made["lead_times"], "r_"), F.col("r_route") == F.col("k_route"), "left")
         .join(t(actual.kna1(src["kna1"]), "c_"), F.col("l_kunnr") == F.col("c_kunnr"), "left")
         .join(t(dim("business_unit_ref", ["business_unit_code", "shipping_point_code"]), "b_"),
               (F.col("l_vkorg") == F.col("b_business_unit_code")) & (F.col("s_vstel") == F.col("b_shipping_point_code")), "left")
         .join(t(actual.currency_rates(src["currency_rate_ref"]), "cu_"), F.col("l_wadat") == F.col("cu_rate_date"), "left"))
    return _rows(x.withColumn("k_no", F.col("k_tknum").cast("bigint")).select(*shipment_mart.SHIPMENT_COLUMNS))


def _rows(df) -> Counter:
    return Counter(str(r) for r in df.collect())


@pytest.mark.parametrize("client", [False, True])
@pytest.mark.parametrize("resolve_dims", [True, False])
def test_shipments_equal_a_chain_of_joins(src, resolve_dims, client):
    want = _one_after_the_other(src, resolve_dims, client)
    assert sum(want.values()) >= (7 if resolve_dims else 10)
    assert _rows(shipment_mart.shipments(src, resolve_dims, client)) == want


def test_lookups_carry_their_own_columns_only(spark, plainly):
    plan = _plan(shipment_mart.enriched(TD.staging(spark, SF)))
    own, named, brought = shipment_mart.OWN, shipment_mart.NAMED, shipment_mart.BROUGHT
    for keys, others in ((("k_tdlnr", "k_add02", "k_route"), own + brought), (("l_kunnr", "l_vkorg", "l_wadat"), own + named)):
        for key in keys:
            carried = _below(plan, f"hashpartitioning({key}#")
            assert "k_tknum" in carried and not any(f"{c}#" in carried for c in others)
    # the rows that met go on to delivery dates, costs and the mart as they are dealt
    assert "hashpartitioning(k_no#" not in plan and "hashpartitioning(transportation_number#" not in plan


def test_headers_are_resolved_from_one_exchange(spark, plainly):
    plan = _plan(shipment_mart.enriched(TD.staging(spark, SF)))
    versions = [line for line in plan.splitlines() if "Exchange hashpartitioning(tknum#" in line and "Reused" not in line]
    assert len(versions) == 4 and plan.count("ReusedExchange [tknum#") == 2  # headers, stages, items and the weights of goods


def test_changes_read_the_stored_candidates_as_they_are_dealt(spark, plainly):
    assert "Exchange" not in _plan(catalog.shipment_mart_changes(spark, SF))


def test_dealt_copy(spark, plainly):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "b"), (2, None)], "k long, v string")
    with scratch_tables(spark):
        copy = cut_lineage(rows, "k")
        assert _rows(copy) == _rows(rows)
        assert "Exchange" not in _plan(copy.groupBy("k").count())
        assert not [t for t in spark.catalog.listTables() if t.name.startswith("martline_")]
        files = copy.inputFiles()
    folder = spark._jvm.org.apache.hadoop.fs.Path(files[0])
    assert not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
