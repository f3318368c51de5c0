"""Incremental per-shipment logistics mart.

Latest versions of the staging tables -> two pre-aggregates (net weight
per shipment, lead time per route) -> a left-join star around the shipment
header -> business rules -> new-or-changed filter against the mart's current
state -> append with a load timestamp.

Join keys follow the source system: headers meet items and stages on the
text shipment number; delivery dates, costs and the mart itself on the
shipment number as BIGINT (both sides cast, so leading zeros never matter).
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rules import business_unit, sales_channel, to_bigint, to_roubles
from ..operators.enrich import child_total, distinct_legs, route_lead_time
from ..session import dealt_table
from . import actual

KEY = "transportation_number"

SCHEMA = T.StructType(
    [
        T.StructField("transportation_number", T.LongType()),
        T.StructField("shipment_date_plan", T.DateType()),
        T.StructField("transportation_start_date", T.DateType()),
        T.StructField("delivery_date_plan", T.DateType()),
        T.StructField("delivery_date_fact", T.DateType()),
        T.StructField("shipment_point_code", T.StringType()),
        T.StructField("delivery_point", T.StringType()),
        T.StructField("business_unit", T.StringType()),
        T.StructField("tariff_matrix_code", T.StringType()),
        T.StructField("sales_channel", T.StringType()),
        T.StructField("consignee_name", T.StringType()),
        T.StructField("transportation_creator", T.StringType()),
        T.StructField("transportation_creation_date", T.DateType()),
        T.StructField("transportation_creation_time", T.StringType()),
        T.StructField("net_weight", T.DecimalType(18, 3)),
        T.StructField("expences_fact_rub", T.DecimalType(18, 2)),
        T.StructField("expences_matrix_plan_rub", T.DecimalType(18, 2)),
        T.StructField("expences_business_plan_rub", T.DecimalType(18, 2)),
        T.StructField("auction_flag", T.StringType()),
        T.StructField("forwarder_name", T.StringType()),
        T.StructField("lead_time_plan", T.DecimalType(18, 2)),
    ]
)
COLUMNS = tuple(f.name for f in SCHEMA.fields)


def _pref(df: DataFrame, p: str) -> DataFrame:
    """Prefix every column name (one rename call instead of one per column)."""
    return df.toDF(*[p + c for c in df.columns])


def net_weight(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """SUM of delivery weights per shipment over all its live items."""
    return child_total(items, deliveries, "tknum", "vbeln", "vbeln", "ntgew", "net_weight")


def goods(items: DataFrame, deliveries: DataFrame) -> DataFrame:
    """One row per shipment number: the weight of its live items and its items numbered 1 with their deliveries.

    Items meet deliveries once and serve both. Item 1 occurs once per client, so the list it is kept in is as
    long as the shipment number has clients.
    """
    lines = items.join(deliveries.withColumnRenamed("vbeln", "__delivery"), F.col("vbeln") == F.col("__delivery"), "left")
    first = F.when(F.col("tpnum") == 1, F.struct("mandt", "wadat", "vkorg", "kunnr"))
    return lines.groupBy("tknum").agg(F.sum("ntgew").alias("net_weight"), F.collect_list(first).alias("first_items"))


def lead_times(route_legs: DataFrame, service_legs: DataFrame) -> DataFrame:
    """Planned lead time per route: service-leg times over distinct legs."""
    return route_lead_time(distinct_legs(route_legs), service_legs)


def _as_stored(df: DataFrame, total: str, column: str) -> DataFrame:
    """A total in the mart column's type: sums are wider, and every shuffle of the star would carry that."""
    return df.withColumn(total, F.col(total).cast(SCHEMA[column].dataType))


#: The sides of the star that hold a row for each shipment or route, with the key they are joined by.
SIDES = {"goods": "tknum", "stages": "tknum", "lead_times": "route", "delivery_dates": "SHIPMENT_NUM", "costs": "SHIPMENT_NUMBER"}


def sides(src: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """The resolved and aggregated sides of the star that do not depend on the headers (``SIDES``)."""
    deliveries = actual.likp(src["likp"]).select("vbeln", "wadat", "vkorg", "kunnr", "ntgew")
    legs = lead_times(actual.tvrab(src["tvrab"]), actual.transport_leg(src["transport_leg"]))
    return {
        "goods": _as_stored(goods(actual.vttp(src["vttp"]).select("mandt", "tknum", "tpnum", "vbeln"), deliveries),
                            "net_weight", "net_weight"),
        "stages": actual.vtts(src["vtts"]).select("mandt", "tknum", "vstel"),
        "lead_times": _as_stored(legs, "svt_route_lead_time", "lead_time_plan"),
        "delivery_dates": actual.otif_delivery(src["otif_delivery"]).drop("TECH_LOAD_TS"),
        "costs": actual.transportation_costs(src["transportation_costs"]).drop("TECH_LOAD_TS"),
    }


@contextmanager
def stored_sides(src: Mapping[str, DataFrame]) -> Iterator[dict[str, DataFrame]]:
    """``sides``, each computed once for several loads and stored by the key it is joined by; dropped after the block.

    A load then shuffles its headers only: a side is read as it is dealt.
    """
    with ExitStack() as stack:
        yield {name: stack.enter_context(dealt_table(df, SIDES[name])) for name, df in sides(src).items()}


#: The key of a header; its own columns, what its codes name, and what its goods and stages bring.
HEADER = ("k_mandt", "k_tknum")
OWN = ("k_datbg", "k_zzmatrix", "k_ernam", "k_erdat", "k_erzet")
NAMED = ("f_name1", "d_delivery_point_dashboard_name", "r_svt_route_lead_time")
BROUGHT = ("g_net_weight", "l_wadat", "l_vkorg", "s_vstel", "c_name1", "b_business_unit_name", "cu_rate_usd", "cu_rate_eur")
#: What ``shipments`` keeps of each header and its sides.
SHIPMENT_COLUMNS = ("k_no", "k_tknum", *OWN, *NAMED, *BROUGHT)


def shipments(src: Mapping[str, DataFrame], resolve_dims: bool = True, client_in_join: bool = False,
              made: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Live headers with all that is joined by other keys than the mart's (``SHIPMENT_COLUMNS``); ``made`` as in ``enriched``."""
    made = made or sides(src)
    k = _pref(actual.vttk(src["vttk"]), "k_")
    g, s, rlt = _pref(made["goods"], "g_"), _pref(made["stages"], "s_"), _pref(made["lead_times"], "r_")
    d = _pref(
        actual.reference_dim(src["delivery_point_ref"], ["delivery_point_code"], resolve_dims)
        .select("delivery_point_code", "delivery_point_dashboard_name"),
        "d_",
    )
    c = _pref(actual.kna1(src["kna1"]).select("kunnr", "name1"), "c_")
    b = _pref(
        actual.reference_dim(src["business_unit_ref"], ["business_unit_code", "shipping_point_code"], resolve_dims)
        .select("business_unit_code", "shipping_point_code", "business_unit_name"),
        "b_",
    )
    f = _pref(actual.lfa1(src["lfa1"]).select("lifnr", "name1"), "f_")

    cu = _pref(actual.currency_rates(src["currency_rate_ref"]).drop("TECH_LOAD_TS"), "cu_")

    # Rows are shuffled once per key whose other side is too large to broadcast, so what the codes of a header
    # name is looked up beside its goods and stages. Either way carries only its own columns, the header's wait
    # for both, and all meet at the shipment number as BIGINT, by which the mart goes on.
    own = k.select(*HEADER, F.struct(*OWN).alias("__own"))
    named = (
        k.select(*HEADER, "k_tdlnr", "k_add02", "k_route")
        .join(f, F.col("f_lifnr") == F.col("k_tdlnr"), "left")
        .join(d, F.col("k_add02") == F.col("d_delivery_point_code"), "left")
        .join(rlt, F.col("r_route") == F.col("k_route"), "left")
        .select(*HEADER, F.struct(*NAMED).alias("__named"))
    )

    def same_shipment(other: str):
        cond = F.col("k_tknum") == F.col(f"{other}_tknum")
        return (cond & (F.col("k_mandt") == F.col(f"{other}_mandt"))) if client_in_join else cond

    # a header meets item 1 of every client with its shipment number, or (client_in_join) of its own
    first_items = F.filter("g_first_items", lambda i: i["mandt"] == F.col("k_mandt")) if client_in_join \
        else F.col("g_first_items")
    rows = (
        k.select(*HEADER)
        .join(g, F.col("k_tknum") == F.col("g_tknum"), "left")
        .withColumn("l", F.explode_outer(first_items))
        .drop("g_first_items")
        .withColumns({f"l_{c}": F.col("l")[c] for c in ("wadat", "vkorg", "kunnr")})
        .drop("l")
        .join(s, same_shipment("s"), "left")
        .join(c, F.col("l_kunnr") == F.col("c_kunnr"), "left")
        .join(
            b,
            (F.col("l_vkorg") == F.col("b_business_unit_code"))
            & (F.col("s_vstel") == F.col("b_shipping_point_code")),
            "left",
        )
        .join(cu, F.col("l_wadat") == F.col("cu_rate_date"), "left")
        .select(*HEADER, *BROUGHT)
    )
    return _met(rows, own, named).select(to_bigint("k_tknum").alias("k_no"), *SHIPMENT_COLUMNS[1:])


def _met(rows: DataFrame, own: DataFrame, named: DataFrame) -> DataFrame:
    """``rows`` with the ``OWN`` and ``NAMED`` columns of their header, dealt by the shipment number as BIGINT.

    All are shuffled once, together. A window meets them by the whole key of a header, NULL like any other value.
    A header has one row in ``own``; with dimension keys that are not unique it has several in ``named``, and each
    goes to each of its ``rows``.
    """
    header = Window.partitionBy(to_bigint("k_tknum"), *HEADER)
    return (
        rows.unionByName(own, allowMissingColumns=True)
        .unionByName(named, allowMissingColumns=True)
        .repartition(to_bigint("k_tknum"))
        .withColumns({"__head": F.first("__own", ignorenulls=True).over(header), "__all": F.collect_list("__named").over(header)})
        .where(F.col("__own").isNull() & F.col("__named").isNull())
        .withColumn("__names", F.explode("__all"))
        .withColumns({c: F.col("__head")[c] for c in OWN} | {c: F.col("__names")[c] for c in NAMED})
    )


def enriched(src: Mapping[str, DataFrame], resolve_dims: bool = True, client_in_join: bool = False,
             made: Mapping[str, DataFrame] | None = None, rows: DataFrame | None = None) -> DataFrame:
    """Candidate mart rows (the 21 mart columns, cast to ``SCHEMA``).

    ``client_in_join``: join headers to items and stages on (client, shipment
    number) instead of the shipment number alone (the source's behaviour).
    It is the same with one client, avoids the fan-out across several
    clients, and reuses the partitioning of the version windows, which are
    keyed by (client, shipment number). ``made``: the ``sides`` of ``src`` and
    ``rows``: its ``shipments``, if they are stored because others read them too.
    """
    made = made or sides(src)
    rows = shipments(src, resolve_dims, client_in_join, made) if rows is None else rows
    o, ca = _pref(made["delivery_dates"], "o_"), _pref(made["costs"], "ca_")

    # rows end up dealt by the mart's key, as the comparison with the stored mart needs them
    ship_no = F.col("k_no")
    x = (
        rows.join(o, ship_no == F.col("o_SHIPMENT_NUM"), "left")
        .join(ca, ship_no == F.col("ca_SHIPMENT_NUMBER").cast("bigint"), "left")
    )

    def rub(amount, ccy):
        return to_roubles(F.col("ca_" + amount), F.col("ca_" + ccy), F.col("cu_rate_usd"), F.col("cu_rate_eur"))

    values = {
        "transportation_number": ship_no,
        "shipment_date_plan": F.col("l_wadat"),
        "transportation_start_date": F.col("k_datbg"),
        "delivery_date_plan": F.col("o_ETA_ACCORDING_CLIENT_PO"),
        "delivery_date_fact": F.col("o_FACT_UNLOADING_DATE"),
        "shipment_point_code": F.col("s_vstel"),
        "delivery_point": F.col("d_delivery_point_dashboard_name"),
        "business_unit": business_unit("b_business_unit_name", "l_vkorg"),
        "tariff_matrix_code": F.col("k_zzmatrix"),
        "sales_channel": sales_channel("k_zzmatrix", "l_vkorg"),
        "consignee_name": F.col("c_name1"),
        "transportation_creator": F.col("k_ernam"),
        "transportation_creation_date": F.col("k_erdat"),
        "transportation_creation_time": F.col("k_erzet"),
        "net_weight": F.col("g_net_weight"),
        "expences_fact_rub": rub("FACT_COST", "CURRENCY_FACT"),
        "expences_matrix_plan_rub": rub("PLAN_COST", "CURRENCY_PLAN"),
        "expences_business_plan_rub": rub("BUSINESS_PLAN_COST", "CURRENCY_BUSINESS_PLAN"),
        "auction_flag": F.col("ca_AUCTION"),
        "forwarder_name": F.col("f_name1"),
        "lead_time_plan": F.col("r_svt_route_lead_time"),
    }
    return x.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
