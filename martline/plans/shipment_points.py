"""Shipping-point dimension, rebuilt in full on every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as K
from ..functions.rules import code_label
from . import actual

COLUMNS = ("shipment_point_code", "shipment_point_name", "shipment_point_dashboard_name")


def rows(tvst: DataFrame, dashboard_names=K.SHIPMENT_POINT_DASHBOARD_NAMES) -> DataFrame:
    """Distinct (code, text, dashboard name) of the latest shipping-point texts,
    sorted by code and text. Dashboard name: fixed label for known codes,
    else the text."""
    a = actual.tvst(tvst)
    out = a.select(
        F.col("vstel").alias("shipment_point_code"),
        F.col("vtext").alias("shipment_point_name"),
        code_label("vstel", dashboard_names, default="vtext").alias("shipment_point_dashboard_name"),
    ).distinct()
    return out.orderBy("shipment_point_code", "shipment_point_name")
