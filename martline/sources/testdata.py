"""Staging tables derived from the driver's TPC-H-like test tables.

The marts read SAP-style staging tables that the test data does not have.
This adapter derives each of them from one test table by a projection, so
every job runs on whole tables and its work grows with them:

* ``lineitem`` is versioned: (l_orderkey, l_linenumber) repeats with
  different ``l_shipdate``; ``l_shipdate`` plays the load time and
  ``l_returnflag = 'R'`` the tombstone. It feeds shipment items, deliveries,
  shipment stages, delivery dates, route legs and service legs.
* ``orders`` feeds shipment headers and costs (a draft, then the final
  version a day later; some headers are then deleted) and daily currency
  rates (several orders per day = several versions of a rate; no rates on
  Sundays).
* ``customer``, ``part`` and ``supplier`` feed the reference dimensions (an
  older and a newer load each, some deleted, some loaded twice).
* Some suppliers carry coded shipping points and the sales organisations
  that the rules name; some headers an unknown or no matrix code, so every
  branch of the rules is met.
* ``events`` feeds the plan norms.

Derivation rules are plain column expressions; the oracle SQL in
``plans.oracle`` restates them independently.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..constants import SHIPMENT_POINT_DASHBOARD_NAMES

CLIENT = "100"
# Load time of the older version of the reference dimensions; the newer one is a day later.
DIM_LOAD_TS = "2000-01-01 00:00:00"
# Sales organisations of some suppliers (the others: 9000 + supplier).
SALES_ORGS = ((5, "4102"), (7, "9999"), (8, "4103"), (9, "4104"))


_READ: dict[str, tuple[SparkSession, DataFrame]] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The test table, read once per session.

    ``spark.read.parquet`` runs a footer-reading job to infer the schema on
    every call; the staging tables derive six inputs from ``lineitem`` alone,
    so the resolved DataFrame is reused (it is only a plan; the files are
    read-only test data).
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    hit = _READ.get(path)
    if hit is not None and hit[0] is spark:
        return hit[1]
    df = spark.read.parquet(path)
    _READ[path] = (spark, df)
    return df


def _tknum(c) -> F.Column:
    return F.lpad(F.col(c).cast("string"), 10, "0")


def _deleted(flag: str = "l_returnflag") -> F.Column:
    return F.when(F.col(flag) == "R", F.lit(1)).otherwise(F.lit(0))


def _versions(df: DataFrame, loaded_twice=None) -> DataFrame:
    """Each row as version 0 (older) and 1 (newer); version 1 twice where ``loaded_twice``."""
    v = F.array(F.lit(0), F.lit(1))
    if loaded_twice is not None:
        v = F.when(loaded_twice, F.array(F.lit(0), F.lit(1), F.lit(1))).otherwise(v)
    return df.select("*", F.explode(v).alias("v"))


def _days_later(ts: F.Column) -> F.Column:
    return ts + F.make_dt_interval(F.col("v"))


def _dim_ts() -> F.Column:
    return _days_later(F.lit(DIM_LOAD_TS).cast("timestamp_ntz")).alias("tech_load_ts")


def _newer(newer, older) -> F.Column:
    return F.when(F.col("v") == 1, newer).otherwise(older)


def _newest_deleted(cond: F.Column) -> F.Column:
    return F.when((F.col("v") == 1) & cond, F.lit(1)).otherwise(F.lit(0))


def _shipping_point(supplier: str) -> F.Column:
    """Even suppliers take the coded shipping points in turn while they last, the others their own number."""
    codes = F.array(*[F.lit(code) for code, _ in SHIPMENT_POINT_DASHBOARD_NAMES])
    half = F.floor(F.col(supplier) / 2).cast("int")
    coded = (F.col(supplier) % 2 == 0) & (half < len(SHIPMENT_POINT_DASHBOARD_NAMES))
    return F.when(coded, F.get(codes, half)).otherwise(F.col(supplier).cast("string"))


def _sales_org(supplier: str) -> F.Column:
    out = None
    for s, org in SALES_ORGS:
        cond = F.col(supplier) == s
        out = F.when(cond, F.lit(org)) if out is None else out.when(cond, F.lit(org))
    return out.otherwise((F.col(supplier) + F.lit(9000)).cast("string"))


def vttk(spark, d) -> DataFrame:
    """Shipment headers <- orders: a draft, then the final version or its deletion."""
    o = _versions(table(spark, d, "orders"))
    digit = F.col("o_custkey") % 10
    matrix = (F.when(digit == 9, F.lit("09")).when(digit == 8, F.lit(None))
              .otherwise(F.concat(F.lit("0"), F.substring("o_orderpriority", 1, 1))))
    return o.select(
        F.lit(CLIENT).alias("mandt"),
        _tknum("o_orderkey").alias("tknum"),
        F.col("o_orderdate").cast("date").alias("datbg"),
        _newer(matrix, F.lit("01")).alias("zzmatrix"),
        _newer(F.col("o_orderstatus"), F.lit("DRAFT")).alias("ernam"),
        F.col("o_orderdate").cast("date").alias("erdat"),
        F.date_format("o_orderdate", "HH:mm:ss").alias("erzet"),
        F.col("o_custkey").cast("string").alias("add02"),
        F.col("o_custkey").cast("string").alias("tdlnr"),
        F.col("o_orderkey").cast("string").alias("route"),
        _days_later(F.col("o_orderdate")).alias("tech_load_ts"),
        _newest_deleted((F.col("o_orderstatus") == "P") & (F.col("o_custkey") % 20 == 0)).alias("tech_is_deleted"),
    )


def _vbeln() -> F.Column:
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("-"), F.col("l_linenumber").cast("string"))


def vttp(spark, d) -> DataFrame:
    """Shipment items <- lineitem versions."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.lit(CLIENT).alias("mandt"),
        _tknum("l_orderkey").alias("tknum"),
        F.col("l_linenumber").alias("tpnum"),
        _vbeln().alias("vbeln"),
        F.col("l_shipdate").alias("tech_load_ts"),
        _deleted().alias("tech_is_deleted"),
    )


def likp(spark, d) -> DataFrame:
    """Deliveries <- lineitem versions (one delivery per item)."""
    li = table(spark, d, "lineitem")
    return li.select(
        _vbeln().alias("vbeln"),
        F.col("l_shipdate").cast("date").alias("wadat"),
        _sales_org("l_suppkey").alias("vkorg"),
        F.col("l_partkey").cast("string").alias("kunnr"),
        F.col("l_quantity").cast("decimal(18,3)").alias("ntgew"),
        F.col("l_shipdate").alias("tech_load_ts"),
        _deleted().alias("tech_is_deleted"),
    )


def vtts(spark, d) -> DataFrame:
    """Shipment stages <- lineitem versions; stage type = line number."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.lit(CLIENT).alias("mandt"),
        _tknum("l_orderkey").alias("tknum"),
        F.col("l_linenumber").alias("tstyp"),
        _shipping_point("l_suppkey").alias("vstel"),
        F.col("l_shipdate").alias("tech_load_ts"),
        _deleted().alias("tech_is_deleted"),
    )


def otif_delivery(spark, d) -> DataFrame:
    """Planned and actual delivery dates <- lineitem versions."""
    li = table(spark, d, "lineitem")
    ship = F.col("l_shipdate").cast("date")
    return li.select(
        F.col("l_orderkey").alias("SHIPMENT_NUM"),
        F.date_add(ship, 7).alias("ETA_ACCORDING_CLIENT_PO"),
        F.date_add(ship, F.col("l_linenumber")).alias("FACT_UNLOADING_DATE"),
        F.col("l_shipdate").alias("TECH_LOAD_TS"),
    )


def kna1(spark, d) -> DataFrame:
    """Consignees <- part."""
    p = _versions(table(spark, d, "part"))
    return p.select(
        F.col("p_partkey").cast("string").alias("kunnr"),
        _newer(F.col("p_name"), F.col("p_type")).alias("name1"),
        _dim_ts(),
        _newest_deleted(F.col("p_size") <= 2).alias("tech_is_deleted"),
    )


def lfa1(spark, d) -> DataFrame:
    """Forwarders <- customer."""
    c = _versions(table(spark, d, "customer"))
    return c.select(
        F.col("c_custkey").cast("string").alias("lifnr"),
        _newer(F.col("c_name"), F.lit("OLD")).alias("name1"),
        _dim_ts(),
        _newest_deleted(F.col("c_mktsegment") == "MACHINERY").alias("tech_is_deleted"),
    )


def transportation_costs(spark, d) -> DataFrame:
    """Costs in three currencies <- orders: an estimate of the actual costs, then the final version."""
    o = _versions(table(spark, d, "orders"))
    price = F.col("o_totalprice").cast("decimal(18,2)")
    prio = F.substring("o_orderpriority", 1, 1)
    status = F.col("o_orderstatus")
    return o.select(
        F.col("o_orderkey").alias("SHIPMENT_NUMBER"),
        F.when(status == "F", "USD").when(status == "O", "EUR").otherwise("RUB").alias("CURRENCY_FACT"),
        F.when(prio == "1", "USD").when(prio == "2", "EUR").when(prio == "3", "RUB")
        .when(prio == "4", "CNY").alias("CURRENCY_PLAN"),
        F.when(status == "P", "USD").when(status == "F", "EUR").otherwise("RUB").alias("CURRENCY_BUSINESS_PLAN"),
        _newer(price, F.lit(0).cast("decimal(18,2)")).alias("FACT_COST"),
        (price * F.lit(0.9).cast("decimal(2,1)")).cast("decimal(18,2)").alias("PLAN_COST"),
        (price * F.lit(1.1).cast("decimal(2,1)")).cast("decimal(18,2)").alias("BUSINESS_PLAN_COST"),
        F.col("o_orderpriority").alias("AUCTION"),
        _days_later(F.col("o_orderdate")).alias("TECH_LOAD_TS"),
    )


def currency_rates(spark, d) -> DataFrame:
    """Daily rates <- orders (every order of a day is a version; Sunday versions carry no rates)."""
    o = table(spark, d, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)")
    quoted = F.dayofweek("o_orderdate") != 1
    return o.select(
        F.col("o_orderdate").cast("date").alias("rate_date"),
        F.when(quoted, (price * F.lit(0.001).cast("decimal(3,3)")).cast("decimal(18,6)")).alias("rate_usd"),
        F.when(quoted, (price * F.lit(0.0011).cast("decimal(4,4)")).cast("decimal(18,6)")).alias("rate_eur"),
        F.col("o_orderdate").alias("TECH_LOAD_TS"),
    )


def tvrab(spark, d) -> DataFrame:
    """Route legs <- lineitem versions: route = order, leg = supplier -> part."""
    li = table(spark, d, "lineitem")
    return li.select(
        F.col("l_orderkey").cast("string").alias("route"),
        F.col("l_linenumber").cast("string").alias("abnum"),
        F.col("l_suppkey").cast("string").alias("knanf"),
        F.col("l_partkey").cast("string").alias("knend"),
        F.col("l_shipdate").alias("tech_load_ts"),
        _deleted().alias("tech_is_deleted"),
    )


def transport_leg(spark, d) -> DataFrame:
    """Service legs <- lineitem versions; state 1 = open line."""
    li = table(spark, d, "lineitem")
    return li.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.concat(F.col("l_suppkey").cast("string"), F.lit("_"), F.col("l_partkey").cast("string"),
                 F.lit("_Auto")).alias("code"),
        F.col("l_quantity").cast("decimal(18,2)").alias("transportation_time"),
        F.when(F.col("l_linestatus") == "O", F.lit(1)).otherwise(F.lit(2)).alias("primitive_entity_data_state_id"),
        F.col("l_shipdate").alias("tech_load_ts"),
        _deleted().alias("tech_is_deleted"),
    )


def delivery_point_ref(spark, d) -> DataFrame:
    """Delivery points <- customer; one segment is stored blank, one loaded twice."""
    seg = F.col("c_mktsegment")
    c = _versions(table(spark, d, "customer"), seg == "BUILDING")
    return c.select(
        F.col("c_custkey").cast("string").alias("delivery_point_code"),
        _newer(F.when(seg == "AUTOMOBILE", F.lit("")).otherwise(seg), F.lit("OLD")).alias("delivery_point_dashboard_name"),
        _dim_ts(),
    )


def business_unit_ref(spark, d) -> DataFrame:
    """Business units <- supplier (its sales organisation and shipping point); five nations are loaded twice."""
    s = _versions(table(spark, d, "supplier"), F.col("s_nationkey") < 5)
    return s.select(
        _sales_org("s_suppkey").alias("business_unit_code"),
        _shipping_point("s_suppkey").alias("shipping_point_code"),
        _newer(F.concat(F.lit("BU_"), F.col("s_nationkey").cast("string")), F.lit("OLD")).alias("business_unit_name"),
        _dim_ts(),
    )


def tvst(spark, d) -> DataFrame:
    """Shipping point texts <- supplier."""
    s = _versions(table(spark, d, "supplier"))
    return s.select(
        _shipping_point("s_suppkey").alias("vstel"),
        _newer(F.col("s_name"), F.lit("OLD")).alias("vtext"),
        _dim_ts(),
    )


def plan_norm(spark, d) -> DataFrame:
    """Plan norms <- events: a user's norm, loaded daily (several events of a day = repeated keys)."""
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").alias("id"),
        F.col("event_type").alias("norm_kind"),
        F.col("value").alias("norm"),
        F.date_trunc("day", "ts").cast("timestamp_ntz").alias("tech_load_ts"),
    )


STAGING = {
    "vttk": vttk,
    "vttp": vttp,
    "likp": likp,
    "vtts": vtts,
    "otif_delivery": otif_delivery,
    "kna1": kna1,
    "lfa1": lfa1,
    "transportation_costs": transportation_costs,
    "currency_rate_ref": currency_rates,
    "tvrab": tvrab,
    "transport_leg": transport_leg,
    "delivery_point_ref": delivery_point_ref,
    "business_unit_ref": business_unit_ref,
    "tvst": tvst,
}


class Staging(Mapping):
    """Staging tables over one test-data folder, each defined on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = STAGING[name](self.spark, self.sf_dir)
        return self._built[name]

    def __iter__(self):
        return iter(STAGING)

    def __len__(self) -> int:
        return len(STAGING)


_STAGING: dict[str, Staging] = {}


def staging(spark: SparkSession, sf_dir: str) -> Staging:
    """All staging tables over ``sf_dir`` (built lazily, once per session)."""
    hit = _STAGING.get(sf_dir)
    if hit is None or hit.spark is not spark:
        hit = _STAGING[sf_dir] = Staging(spark, sf_dir)
    return hit
