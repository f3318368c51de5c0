"""Query catalogue: one entry per operator family, over the test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole test tables (through ``sources.testdata``). It is lazy unless a table
feeds several consumers (stored first) or the query is a load that is read back. ``plans.oracle`` holds the
equivalent DuckDB SQL for every entry.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as K
from ..functions import periods
from ..functions.rules import (
    blank_default,
    business_unit,
    label_from_table,
    null_default,
    sales_channel,
    to_bigint,
    to_roubles,
)
from ..operators import quality
from ..operators import variability as V
from ..operators.changes import new_or_changed
from ..operators.enrich import distinct_legs
from ..operators.joins import first_item_join
from ..operators.versions import current_state, latest_version
from ..session import checkpoint_dir, cut_lineage
from ..sources import testdata as TD
from ..sources.files import folder_duplicates
from ..sources.sinks import stamp
from ..sources.state import advance
from . import actual, jobs, shipment_mart, shipment_points, variability_mart

Query = Callable[[SparkSession, str], DataFrame]

# Fixed run parameters of the catalogue (not data).
RUN_DATE = "2024-06-30"
ENVIRONMENT = "test"
EVENTS_SNAPSHOT_CUT = "2024-01-10 00:00:00"
FIRST_LOAD_CUT = "1999-01-01"
REPORT_DATES = ("2024-06-29", RUN_DATE)
PREVIOUS_LOAD_TS = ("2020-01-01 00:00:00", "2020-02-01 00:00:00")


# --- latest versions ------------------------------------------------------------


def latest_version_tombstone(spark, d):
    return actual.vttp(TD.vttp(spark, d))


def latest_version_no_tombstone(spark, d):
    ev = TD.table(spark, d, "events")
    return latest_version(ev, ["user_id", "event_type"], order=("ts",), deleted_col=None)


def latest_version_prefilter_secondary_order(spark, d):
    return actual.vtts(TD.vtts(spark, d))


def latest_version_state_filter(spark, d):
    return actual.transport_leg(TD.transport_leg(spark, d))


# --- rules ----------------------------------------------------------------------


def code_label_map(spark, d):
    """Supplier -> nation name from the nation table, else the supplier name."""
    s = TD.table(spark, d, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = TD.table(spark, d, "nation")
    out = label_from_table(s, "s_nationkey", n, "n_nationkey", "n_name", "label", default="s_name")
    return out.select("s_suppkey", "label")


def _shipments(spark, d):
    return variability_mart.shipments(TD.staging(spark, d))


def label_fallback_chain(spark, d):
    s = _shipments(spark, d)
    return s.select(
        F.col("k_tknum").alias("tknum"),
        business_unit("b_name", "l_vkorg").alias("business_unit"),
        business_unit("b_name", "l_vkorg", otherwise=K.NO_DATA).alias("business_unit_nd"),
    )


def nested_category(spark, d):
    s = _shipments(spark, d)
    return s.select(
        F.col("k_tknum").alias("tknum"),
        sales_channel("k_zzmatrix", "l_vkorg").alias("sales_channel"),
        sales_channel("k_zzmatrix", "l_vkorg", otherwise=K.NO_DATA).alias("sales_channel_nd"),
    )


def blank_default_q(spark, d):
    s = _shipments(spark, d)
    return s.select(
        F.col("k_tknum").alias("tknum"),
        blank_default("s_vstel").alias("shipment_point_code"),
        blank_default("d_name").alias("delivery_point_name"),
        null_default("d_name").alias("delivery_point_nvl"),
    )


def currency_normalise(spark, d):
    src = TD.staging(spark, d)
    k = actual.vttk(src["vttk"]).select("tknum")
    items = actual.vttp(src["vttp"]).select(F.col("tknum").alias("p_tknum"), "tpnum", F.col("vbeln").alias("p_vbeln"))
    lk = actual.likp(src["likp"]).select(F.col("vbeln").alias("l_vbeln"), "wadat")
    ca = actual.transportation_costs(src["transportation_costs"])
    cu = actual.currency_rates(src["currency_rate_ref"]).drop("TECH_LOAD_TS")
    x = (
        first_item_join(k, items, [("tknum", "p_tknum")], "tpnum")
        .join(lk, F.col("p_vbeln") == F.col("l_vbeln"), "left")
        .join(ca, to_bigint("tknum") == F.col("SHIPMENT_NUMBER"), "left")
        .join(cu, F.col("wadat") == F.col("rate_date"), "left")
    )
    out = [to_bigint("tknum").alias("transportation_number")]
    for name, amount, ccy in (
        ("expences_fact_rub", "FACT_COST", "CURRENCY_FACT"),
        ("expences_matrix_plan_rub", "PLAN_COST", "CURRENCY_PLAN"),
        ("expences_business_plan_rub", "BUSINESS_PLAN_COST", "CURRENCY_BUSINESS_PLAN"),
    ):
        out.append(to_roubles(amount, ccy, "rate_usd", "rate_eur").cast("decimal(18,2)").alias(name))
    return x.select(*out)


def composite_key_join(spark, d):
    """Distinct route legs, their text leg code and the summed time of the
    service legs carrying that code."""
    legs = distinct_legs(actual.tvrab(TD.tvrab(spark, d)))
    tl = actual.transport_leg(TD.transport_leg(spark, d))
    per_code = tl.groupBy(F.col("code").alias("__code")).agg(
        F.sum("transportation_time").cast("decimal(18,2)").alias("leg_time"))
    return legs.join(per_code, F.col("sap_leg_code") == F.col("__code"), "left").drop("__code")


def cast_key_join(spark, d):
    src = TD.staging(spark, d)
    k = actual.vttk(src["vttk"]).select("tknum")
    o = actual.otif_delivery(src["otif_delivery"]).drop("TECH_LOAD_TS")
    ca = actual.transportation_costs(src["transportation_costs"]).select("SHIPMENT_NUMBER", "AUCTION")
    no = to_bigint("tknum")
    x = k.join(o, no == F.col("SHIPMENT_NUM"), "left").join(ca, no == F.col("SHIPMENT_NUMBER").cast("bigint"), "left")
    return x.select(
        no.alias("transportation_number"),
        F.col("ETA_ACCORDING_CLIENT_PO").alias("delivery_date_plan"),
        F.col("FACT_UNLOADING_DATE").alias("delivery_date_fact"),
        F.col("AUCTION").alias("auction_flag"),
    )


def _ship_dates(spark, d):
    return TD.table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()


def iso_week_key(spark, d):
    return _ship_dates(spark, d).select("d", periods.iso_week_key("d").alias("week_no"))


def calendar_parts(spark, d):
    return _ship_dates(spark, d).select(
        "d",
        periods.calendar_year("d").alias("year_no"),
        periods.calendar_month("d").alias("month_no"),
        periods.calendar_day("d").alias("day_no"),
    )


def synthetic_week(spark, d):
    return _ship_dates(spark, d).select("d", periods.synthetic_week("d").alias("week_sintetic"))


# --- joins and pre-aggregates -----------------------------------------------------


def first_leg_join(spark, d):
    src = TD.staging(spark, d)
    k = actual.vttk(src["vttk"]).select("tknum")
    items = actual.vttp(src["vttp"]).select(F.col("tknum").alias("p_tknum"), "tpnum", "vbeln")
    lk = actual.likp(src["likp"]).select(F.col("vbeln").alias("l_vbeln"), "wadat", "vkorg")
    x = first_item_join(k, items, [("tknum", "p_tknum")], "tpnum").join(
        lk, F.col("vbeln") == F.col("l_vbeln"), "left")
    return x.select("tknum", "vbeln", "wadat", "vkorg")


def child_total(spark, d):
    src = TD.staging(spark, d)
    t = shipment_mart.net_weight(actual.vttp(src["vttp"]), actual.likp(src["likp"]))
    return t.select("tknum", F.col("net_weight").cast("decimal(18,3)").alias("net_weight"))


def route_lead_time(spark, d):
    t = shipment_mart.lead_times(actual.tvrab(TD.tvrab(spark, d)), actual.transport_leg(TD.transport_leg(spark, d)))
    return t.select("route", F.col("svt_route_lead_time").cast("decimal(18,2)").alias("svt_route_lead_time"))


def distinct_legs_q(spark, d):
    return distinct_legs(actual.tvrab(TD.tvrab(spark, d)))


def star_enrich(spark, d):
    return shipment_mart.enriched(TD.staging(spark, d))


# --- change detection -------------------------------------------------------------


def new_or_changed_rows(spark, d):
    """Latest event per (user, type) that is new or changed since the
    snapshot of events before the cut."""
    ev = TD.table(spark, d, "events")
    keys = ["user_id", "event_type"]
    now = latest_version(ev, keys, order=("ts",), deleted_col=None)
    before = latest_version(ev.where(F.col("ts") < F.lit(EVENTS_SNAPSHOT_CUT).cast("timestamp_ntz")), keys,
                            order=("ts",), deleted_col=None)
    return new_or_changed(now, before, keys)


def previous_shipment_mart(cand: DataFrame) -> DataFrame:
    """Two earlier loads of the mart, derived from the candidates: the older
    one for every key but matrix 05 (with another consignee), the newer one
    for matrices 01-04 (matrix 04 without forwarder)."""
    newer = F.col("tariff_matrix_code").isin("01", "02", "03", "04")
    loads = F.when(newer, F.array(F.lit(0), F.lit(1))).when(F.col("tariff_matrix_code") != "05", F.array(F.lit(0)))
    first = F.col("__load") == 0
    # both loads of a row come from one reading of it
    return (cand.withColumn("__load", F.explode(loads))
            .withColumn("consignee_name", F.when(first, F.lit("OLD")).otherwise(F.col("consignee_name")))
            .withColumn("forwarder_name", F.when(first | (F.col("tariff_matrix_code") != "04"), F.col("forwarder_name")))
            .withColumn(K.LOAD_TS, F.when(first, F.lit(PREVIOUS_LOAD_TS[0])).otherwise(F.lit(PREVIOUS_LOAD_TS[1])).cast("timestamp_ntz"))
            .drop("__load"))


def shipment_mart_changes(spark, d):
    # the candidates feed both sides (the previous loads are derived from
    # them), so they are written once instead of computed twice, as they are
    # dealt: by the key that versions and comparison need
    cand = cut_lineage(shipment_mart.enriched(TD.staging(spark, d)), shipment_mart.KEY)
    target = previous_shipment_mart(cand)
    return new_or_changed(cand, current_state(target, [shipment_mart.KEY]), [shipment_mart.KEY],
                          shipment_mart.COLUMNS)


# --- variability ------------------------------------------------------------------


def _day(spark, d):
    return variability_mart.day_cells(TD.staging(spark, d))


def _mart_rows(spark, d):
    """The wide mart reads its day cells three times, so they are written once."""
    return variability_mart.mart_rows(cut_lineage(_day(spark, d)))


def day_cells(spark, d):
    return _day(spark, d)


def synthetic_week_cells(spark, d):
    return V.synthetic_week_cells(_day(spark, d))


def base_rows(spark, d):
    return V.base_rows(_day(spark, d))


PTM_TABLES = {
    # query suffix -> metric family
    "leaf": "dest",
    "all_leaf": "all_dest",
    "weighted_sp": "sp",
    "weighted_bu": "bu",
    "weighted_sc": "sc",
    "weighted_total": "total",
    "weighted_all_sp": "all_sp",
    "weighted_all_bu": "all_bu",
    "cross_sc_bu_dest": "sc_bu_dest",
    "cross_sc_dest": "sc_dest",
    "cross_bu_dest": "bu_dest",
    "cross_dest": "only_dest",
}


def _ptm(metric_name: str, kind: str) -> Query:
    def q(spark, d):
        fine = V.fine_stats(_day(spark, d), kind)
        return V.metric_table(fine, kind, V.METRIC_BY_NAME[metric_name])

    q.__name__ = f"ptm_{metric_name}_{kind}"
    return q


def variability_mart_q(spark, d):
    return _mart_rows(spark, d)


def previous_variability_mart(rows: DataFrame) -> DataFrame:
    """Two earlier loads: the older one for every channel but LastMile with
    total week variability 0, the newer one for non-export rows with the
    delivery-point month variability dropped for channel NO DATA."""
    v1 = (rows.where(F.col("sales_channel") != K.CHANNEL_LAST_MILE)
          .withColumn("total_week_variability", F.lit(0).cast("decimal(18,6)"))
          .withColumn(K.LOAD_TS, F.lit(PREVIOUS_LOAD_TS[0]).cast("timestamp_ntz")))
    v2 = (rows.where((F.col("sales_channel") != K.CHANNEL_LAST_MILE) & (F.col("sales_channel") != K.CHANNEL_EXPORT))
          .withColumn("delivery_point_month_variability",
                      F.when(F.col("sales_channel") == K.NO_DATA, F.lit(None).cast("decimal(18,6)"))
                      .otherwise(F.col("delivery_point_month_variability")))
          .withColumn(K.LOAD_TS, F.lit(PREVIOUS_LOAD_TS[1]).cast("timestamp_ntz")))
    return v1.unionByName(v2)


def variability_changes(spark, d):
    rows = cut_lineage(_mart_rows(spark, d))
    target = previous_variability_mart(rows)
    keys = list(variability_mart.KEYS)
    return new_or_changed(rows, current_state(target, keys), keys, variability_mart.COLUMNS)


# --- dimension rebuild and quality ---------------------------------------------------


def dimension_rebuild(spark, d):
    return shipment_points.rows(TD.tvst(spark, d))


def dup_key_check(spark, d):
    """Duplicated (order, line, ship date) groups of lineitem."""
    li = TD.table(spark, d, "lineitem")
    return quality.duplicate_key_groups(li, ["l_orderkey", "l_linenumber"], "l_shipdate")


DQ_CONFIG = (
    {"lineitem": [K.RULE_DUPLICATE_CHECK]},
    {"vttp": [K.RULE_DUPLICATE_CHECK, "null_key_check"]},
    {"currency_rate_ref": [K.RULE_DUPLICATE_CHECK]},
    {"delivery_point_ref": [K.RULE_DUPLICATE_CHECK]},
    {"business_unit_ref": [K.RULE_DUPLICATE_CHECK, "unknown_rule"]},
    {"events": [K.RULE_DUPLICATE_CHECK]},
)


def dq_resolver(spark, d):
    src = TD.staging(spark, d)
    tables = {
        "lineitem": quality.CheckedTable("lineitem", TD.table(spark, d, "lineitem"),
                                         ("l_orderkey", "l_linenumber"), "l_shipdate"),
        "vttp": quality.CheckedTable("vttp", src["vttp"], ("tknum", "tpnum")),
        "currency_rate_ref": quality.CheckedTable("currency_rate_ref", src["currency_rate_ref"], ("rate_date",),
                                                  "TECH_LOAD_TS"),
        "delivery_point_ref": quality.CheckedTable("delivery_point_ref", src["delivery_point_ref"],
                                                   ("delivery_point_code",)),
        "business_unit_ref": quality.CheckedTable("business_unit_ref", src["business_unit_ref"],
                                                  ("business_unit_code", "shipping_point_code")),
        "events": quality.CheckedTable("events", TD.table(spark, d, "events"), ("user_id", "event_type"), "ts"),
    }

    def resolve(name: str) -> quality.CheckedTable:
        if name not in tables:
            raise KeyError(f"no key definition for table {name!r}")
        return tables[name]

    return resolve


def dq_report(spark, d):
    return quality.key_check_report(DQ_CONFIG, dq_resolver(spark, d), ENVIRONMENT, RUN_DATE)


MART_CHECKS = tuple({name: [K.RULE_DUPLICATE_CHECK]} for name, _ in K.MART_TABLE_KEYS)


def _loaded_twice(df: DataFrame, cond) -> DataFrame:
    """Rows with ``cond`` occur twice (what the key checks must find)."""
    return df.withColumn("__copy", F.explode(F.when(cond, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
                         ).drop("__copy")


def mart_tables(spark, d) -> dict[str, DataFrame]:
    """The marts as one load would store them (rows stamped with one load
    time, some of them twice), two views on them, and the reference tables as staged."""
    src = TD.staging(spark, d)
    run = PREVIOUS_LOAD_TS[1]
    # both marts read the same stored shipments, a mart and its view the same stored rows
    made = shipment_mart.sides(src)
    ships = cut_lineage(shipment_mart.shipments(src, made=made), "k_no")
    rows = shipment_mart.enriched(src, made=made, rows=ships)
    main = cut_lineage(_loaded_twice(stamp(rows, run), F.col("tariff_matrix_code") == "02"))
    day = cut_lineage(variability_mart.counted(variability_mart.from_mart_shipments(ships)))
    var = cut_lineage(_loaded_twice(stamp(variability_mart.mart_rows(day), run), F.col("sales_channel") == K.CHANNEL_LAST_MILE))
    points = _loaded_twice(stamp(shipment_points.rows(src["tvst"]), run),
                           F.col("shipment_point_name") != F.col("shipment_point_dashboard_name"))
    return {
        "metrics_main": main,
        "metrics_variability": var,
        "business_unit_ref": src["business_unit_ref"],
        "currency_rate_ref": src["currency_rate_ref"],
        "delivery_point_ref": src["delivery_point_ref"],
        "plan_norm": TD.plan_norm(spark, d),
        "shipment_point_ref": points,
        "v_metrics_main": main.where(F.col("business_unit").isNotNull()),
        "v_metrics_variability": var.where(F.col("business_unit") != K.NO_DATA),
    }


def mart_key_checks(spark, d):
    """Duplicate-key check of every mart and reference table, keys from the registry."""
    resolve = quality.registry_resolver(mart_tables(spark, d))
    return quality.key_check_report(MART_CHECKS, resolve, ENVIRONMENT, RUN_DATE)


CHECKED_ENVIRONMENTS = ("prod", "test")


def environment_key_checks(spark, d):
    """The same rules on the tables of two environments (test: error norms and quoted rates only)."""
    norms, rates = TD.plan_norm(spark, d), TD.staging(spark, d)["currency_rate_ref"]
    environments = {
        "prod": {"plan_norm": norms, "currency_rate_ref": rates},
        "test": {"plan_norm": norms.where(F.col("norm_kind") == "error"),
                 "currency_rate_ref": rates.where(F.col("rate_usd").isNotNull())},
    }
    config = [{"plan_norm": [K.RULE_DUPLICATE_CHECK]}, {"currency_rate_ref": [K.RULE_DUPLICATE_CHECK]}]
    prod, test = (quality.key_check_report(config, quality.environment_resolver(environments, e), e, RUN_DATE)
                  for e in CHECKED_ENVIRONMENTS)
    return prod.unionByName(test)


# --- the write path: jobs run into a fresh folder and are read back -------------------


def _fresh_folder(spark, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def incremental_load(spark, d):
    """E1 twice: first without the later headers and with other creators for matrix 02, then as staged."""
    src, target = TD.staging(spark, d), _fresh_folder(spark, "incremental-load")
    creator = F.when(F.col("zzmatrix") == "02", F.lit("EARLY")).otherwise(F.col("ernam"))
    early = dict(src)
    early["vttk"] = src["vttk"].where(F.col("erdat") < F.lit(FIRST_LOAD_CUT).cast("date")).withColumn("ernam", creator)
    # the loads differ in their headers only
    with shipment_mart.stored_sides(src) as made:
        jobs.load_shipment_mart(spark, early, target, PREVIOUS_LOAD_TS[0], made=made)
        jobs.load_shipment_mart(spark, src, target, PREVIOUS_LOAD_TS[1], made=made)
    return jobs.read_target(spark, target)


def incremental_versions(spark, d):
    """Shipment items resolved from a state that three loads carried on, versions of a key arriving in any order."""
    items, source, state = TD.vttp(spark, d), _fresh_folder(spark, "staged-vttp"), _fresh_folder(spark, "state-vttp")
    for part in range(3):
        items.where(F.pmod(F.dayofmonth("tech_load_ts"), F.lit(3)) == part).write.mode("append").parquet(source)
        rows, _ = advance(spark, source, state, actual.VERSIONED["vttp"])
    return actual.vttp(rows)


def dimension_refresh(spark, d):
    """E3 twice: with the older shipping point texts, then as staged; the refresh replaces the table."""
    tvst, target = TD.staging(spark, d)["tvst"], _fresh_folder(spark, "dimension-refresh")
    older = tvst.where(F.col("tech_load_ts") == F.lit(TD.DIM_LOAD_TS).cast("timestamp_ntz"))
    jobs.rebuild_shipment_points(older, target, PREVIOUS_LOAD_TS[0])
    jobs.rebuild_shipment_points(tvst, target, PREVIOUS_LOAD_TS[1])
    return jobs.read_target(spark, target)


def report_append(spark, d):
    """E4 on two dates, the second run twice under one run id, appended to one report."""
    path = _fresh_folder(spark, "key-report")
    for date in (*REPORT_DATES, REPORT_DATES[-1]):
        jobs.run_key_checks(DQ_CONFIG, dq_resolver(spark, d), ENVIRONMENT, path, date, f"night of {date}")
    return spark.read.schema(quality.KEY_REPORT_SCHEMA).option("header", True).csv(path)


def file_dup_check(spark, d):
    """Write lineitem and orders as CSV datasets into a fresh folder under the
    shared checkpoint folder, then check their first columns."""
    folder = _fresh_folder(spark, "file-check")
    for name in ("lineitem", "orders"):
        TD.table(spark, d, name).write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder_duplicates(spark, folder, RUN_DATE)


def _csv_folder(spark, d, name: str) -> str:
    folder = _fresh_folder(spark, "file-check")
    TD.table(spark, d, name).write.option("header", True).csv(f"{folder}/{name}.csv")
    return folder


def folder_without_csv(spark, d):
    """A folder that holds lineitem as Parquet only gives no rows; one that holds it as CSV gives its duplicates."""
    plain = _fresh_folder(spark, "file-check")
    TD.table(spark, d, "lineitem").select("l_orderkey").write.parquet(f"{plain}/lineitem.parquet")
    return folder_duplicates(spark, plain, RUN_DATE).unionByName(folder_duplicates(spark, _csv_folder(spark, d, "lineitem"), RUN_DATE))


def file_report(spark, d):
    """E5 on two dates, the first run twice under one run id, appended to a report path of its own and read back."""
    path, folder = _fresh_folder(spark, "file-report"), _csv_folder(spark, d, "lineitem")
    for date in (REPORT_DATES[0], *REPORT_DATES):
        jobs.run_file_checks(spark, folder, path, date, f"night of {date}")
    return spark.read.schema(quality.FILE_REPORT_SCHEMA).option("header", True).csv(path)


def queries() -> dict[str, Query]:
    q: dict[str, Query] = {
        "latest_version_tombstone": latest_version_tombstone,
        "latest_version_no_tombstone": latest_version_no_tombstone,
        "latest_version_prefilter_secondary_order": latest_version_prefilter_secondary_order,
        "latest_version_state_filter": latest_version_state_filter,
        "code_label_map": code_label_map,
        "label_fallback_chain": label_fallback_chain,
        "nested_category": nested_category,
        "blank_default": blank_default_q,
        "currency_normalise": currency_normalise,
        "composite_key_join": composite_key_join,
        "cast_key_join": cast_key_join,
        "iso_week_key": iso_week_key,
        "calendar_parts": calendar_parts,
        "synthetic_week": synthetic_week,
        "first_leg_join": first_leg_join,
        "child_total": child_total,
        "route_lead_time": route_lead_time,
        "distinct_legs": distinct_legs_q,
        "star_enrich": star_enrich,
        "new_or_changed_rows": new_or_changed_rows,
        "day_cells": day_cells,
        "synthetic_week_cells": synthetic_week_cells,
        "base_rows": base_rows,
    }
    for suffix, metric in PTM_TABLES.items():
        for kind in ("week", "month"):
            q[f"ptm_{suffix}_{kind}"] = _ptm(metric, kind)
    q.update(
        {
            "variability_mart": variability_mart_q,
            "variability_changes": variability_changes,
            "dimension_rebuild": dimension_rebuild,
            "dup_key_check": dup_key_check,
            "dq_report": dq_report,
            "mart_key_checks": mart_key_checks,
            "environment_key_checks": environment_key_checks,
            "incremental_load": incremental_load,
            "incremental_versions": incremental_versions,
            "dimension_refresh": dimension_refresh,
            "report_append": report_append,
            "file_dup_check": file_dup_check,
            "folder_without_csv": folder_without_csv,
            "file_report": file_report,
            "shipment_mart_changes": shipment_mart_changes,
        }
    )
    return q
