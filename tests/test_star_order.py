"""The shipment star shuffles headers while they are narrow; the earlier loads come from one reading of the candidates."""

from martline.plans import catalog, shipment_mart
from martline.sources import testdata as TD

SF = "/root/testdata/sf0.001"


def _below(plan: str, text: str) -> str:
    """The part of a printed plan under the line that holds ``text``."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if text in line)

    def depth(line):
        return len(line) - len(line.lstrip(" :+-"))

    end = next((i for i in range(at + 1, len(lines)) if depth(lines[i]) <= depth(lines[at])), len(lines))
    return "\n".join(lines[at:end])


def test_headers_meet_their_own_dimensions_first_and_end_dealt_by_the_key(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        rows = shipment_mart.enriched(TD.staging(spark, SF))
        plan = rows._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert "Join" not in _below(plan, "hashpartitioning(k_tdlnr")
    assert "ca_" not in _below(plan, "hashpartitioning(l_kunnr")


def test_earlier_loads(spark):
    mart = "transportation_number long, tariff_matrix_code string, consignee_name string, forwarder_name string"
    codes = ["01", "04", "05", "06", None, "04"]
    cand = spark.createDataFrame([(i, c, f"c{i}", f"f{i}") for i, c in enumerate(codes)], mart)
    previous = catalog.previous_shipment_mart(cand)
    old, new = (f"{t[:10]}" for t in catalog.PREVIOUS_LOAD_TS)
    got = sorted((r[0], str(r[4])[:10], r.consignee_name, r.forwarder_name) for r in previous.collect())
    assert got == [(0, old, "OLD", "f0"), (0, new, "c0", "f0"), (1, old, "OLD", "f1"), (1, new, "c1", None),
                   (3, old, "OLD", "f3"), (5, old, "OLD", "f5"), (5, new, "c5", None)]
    assert "Union" not in previous._jdf.queryExecution().optimizedPlan().toString()
