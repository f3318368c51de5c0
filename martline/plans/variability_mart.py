"""Incremental demand-variability mart (24 peak-to-mean metrics).

Latest versions -> shipments with four dimensions (sales channel, business
unit, shipping point, delivery point; unknown -> ``NO DATA``) -> day cells
-> calendar keys -> two leaf aggregates -> 24 metric tables -> wide rows ->
new-or-changed filter -> append.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import constants as K
from ..functions.rules import blank_default, business_unit, sales_channel
from ..operators import variability as V
from . import actual

KEYS = ("sales_channel", "business_unit", "shipment_point_code", "delivery_point", "year", "month", "week")

SCHEMA = T.StructType(
    [
        T.StructField("sales_channel", T.StringType()),
        T.StructField("business_unit", T.StringType()),
        T.StructField("shipment_point_code", T.StringType()),
        T.StructField("delivery_point", T.StringType()),
        T.StructField("week", T.StringType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
    ]
    + [T.StructField(c, T.DecimalType(18, 6)) for c in V.MART_COLUMNS[len(V.MART_KEYS):]]
)
COLUMNS = tuple(f.name for f in SCHEMA.fields)


def shipments(src: Mapping[str, DataFrame], resolve_dims: bool = True, client_in_join: bool = False) -> DataFrame:
    """Live shipment headers with first item, its delivery, stage and dimensions.

    ``client_in_join`` as in ``shipment_mart.enriched``.
    """
    k = actual.vttk(src["vttk"]).select(F.col("mandt").alias("k_mandt"), F.col("tknum").alias("k_tknum"),
                                        F.col("zzmatrix").alias("k_zzmatrix"), F.col("add02").alias("k_add02"))
    p = actual.vttp(src["vttp"]).where(F.col("tpnum") == 1).select(
        F.col("mandt").alias("p_mandt"), F.col("tknum").alias("p_tknum"), F.col("vbeln").alias("p_vbeln"))
    lk = actual.likp(src["likp"]).select(F.col("vbeln").alias("l_vbeln"), F.col("wadat").alias("l_wadat"),
                                         F.col("vkorg").alias("l_vkorg"))
    s = actual.vtts(src["vtts"]).select(F.col("mandt").alias("s_mandt"), F.col("tknum").alias("s_tknum"),
                                        F.col("vstel").alias("s_vstel"))
    d = actual.reference_dim(src["delivery_point_ref"], ["delivery_point_code"], resolve_dims).select(
        F.col("delivery_point_code").alias("d_code"), F.col("delivery_point_dashboard_name").alias("d_name"))
    b = actual.reference_dim(src["business_unit_ref"], ["business_unit_code", "shipping_point_code"],
                             resolve_dims).select(
        F.col("business_unit_code").alias("b_bu"), F.col("shipping_point_code").alias("b_sp"),
        F.col("business_unit_name").alias("b_name"))
    # joins on the same key are adjacent (shipment number, then delivery)
    def same_shipment(other: str):
        cond = F.col("k_tknum") == F.col(f"{other}_tknum")
        return (cond & (F.col("k_mandt") == F.col(f"{other}_mandt"))) if client_in_join else cond

    return (
        k.join(p, same_shipment("p"), "left")
        .join(s, same_shipment("s"), "left")
        .join(lk, F.col("p_vbeln") == F.col("l_vbeln"), "left")
        .join(b, (F.col("l_vkorg") == F.col("b_bu")) & (F.col("s_vstel") == F.col("b_sp")), "left")
        .join(d, F.col("k_add02") == F.col("d_code"), "left")
    )


def day_cells(src: Mapping[str, DataFrame], resolve_dims: bool = True, client_in_join: bool = False) -> DataFrame:
    """Shipments counted per (date, four dimensions), with calendar keys."""
    return counted(shipments(src, resolve_dims, client_in_join))


def from_mart_shipments(rows: DataFrame) -> DataFrame:
    """``shipments`` as columns of ``shipment_mart.shipments``, which meets the same tables by the same keys."""
    return rows.select("k_tknum", "k_zzmatrix", "l_wadat", "l_vkorg", "s_vstel", F.col("b_business_unit_name").alias("b_name"),
                       F.col("d_delivery_point_dashboard_name").alias("d_name"))


def counted(rows: DataFrame) -> DataFrame:
    """The day cells of ``shipments``."""
    dims = {
        V.SC: sales_channel("k_zzmatrix", "l_vkorg", otherwise=K.NO_DATA),
        V.BU: business_unit("b_name", "l_vkorg", otherwise=K.NO_DATA),
        V.SP: blank_default("s_vstel"),
        V.DEST: blank_default("d_name"),
    }
    cells = V.day_cells(rows, F.col("l_wadat"), dims, F.col("k_tknum"))
    return V.with_periods(cells)


def mart_rows(day: DataFrame) -> DataFrame:
    """Wide mart rows, cast to ``SCHEMA``."""
    wide = V.variability_mart(day)
    return wide.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMA.fields])
