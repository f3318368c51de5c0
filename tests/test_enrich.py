from decimal import Decimal

from martline.operators.enrich import child_total, distinct_legs, route_lead_time
from martline.operators.joins import first_item_join


def test_first_item_join_keeps_headers_without_item_one(spark):
    header = spark.createDataFrame([("1",), ("2",)], "tknum string")
    items = spark.createDataFrame([("1", 1, "D1"), ("1", 2, "D2"), ("2", 2, "D3")], "p_tknum string, tpnum int, vbeln string")
    out = sorted((r.tknum, r.vbeln) for r in first_item_join(header, items, [("tknum", "p_tknum")], "tpnum").collect())
    assert out == [("1", "D1"), ("2", None)]


def test_route_lead_time_distinct_legs_and_repeated_codes(spark):
    legs = spark.createDataFrame(
        [("R1", "10", "A", "B"), ("R1", "20", "A", "B"),     # same leg under two numbers: counted once
         ("R1", "30", "B", "C"), ("R2", "10", "X", "Y"), ("R3", "10", None, "Z")],
        "route string, abnum string, knanf string, knend string")
    service = spark.createDataFrame(
        [(1, "A_B_Auto", Decimal("2.00")), (2, "A_B_Auto", Decimal("3.00")),  # one code on two service legs: both
         (3, "B_C_Auto", Decimal("1.50")), (4, "X_Y_Auto", None)],
        "id bigint, code string, transportation_time decimal(18,2)")
    d = distinct_legs(legs)
    assert d.count() == 4
    out = {r.route: r.svt_route_lead_time for r in route_lead_time(d, service).collect()}
    assert out == {"R1": Decimal("6.50"), "R2": None, "R3": None}


def test_child_total_null_when_children_missing(spark):
    items = spark.createDataFrame([("S1", "D1"), ("S1", "D2"), ("S2", "D9")], "tknum string, vbeln string")
    deliveries = spark.createDataFrame([("D1", Decimal("1.500")), ("D2", None)], "vbeln string, ntgew decimal(18,3)")
    out = {r.tknum: r.w for r in child_total(items, deliveries, "tknum", "vbeln", "vbeln", "ntgew", "w").collect()}
    assert out == {"S1": Decimal("1.500"), "S2": None}
