"""End-to-end jobs on the smallest test data: first load, idempotent rerun, refresh, reports."""

import datetime as dt
import os

from pyspark.sql import functions as F

from martline import constants as K
from martline.plans import catalog, jobs, shipment_mart, variability_mart
from martline.session import checkpoint_dir
from martline.sources import testdata as TD

SF = "/root/testdata/sf0.001"


def test_shipment_mart_load_is_idempotent(spark, tmp_dir):
    target = os.path.join(tmp_dir, "metrics_main")
    src = TD.staging(spark, SF)
    first = jobs.load_shipment_mart(spark, src, target, run_ts=dt.datetime(2024, 1, 1))
    assert first == shipment_mart.enriched(src).count() > 0
    assert jobs.load_shipment_mart(spark, src, target, run_ts=dt.datetime(2024, 1, 2)) == 0
    stored = spark.read.parquet(target)
    assert stored.count() == first
    assert stored.columns == list(shipment_mart.COLUMNS) + [K.LOAD_TS]
    # a changed source row is appended as a new version
    src2 = dict(src)
    src2["vttk"] = src["vttk"].withColumn("ernam", F.when(F.col("tknum") == F.lpad(F.lit("1"), 10, "0"),
                                                            F.lit("changed")).otherwise(F.col("ernam")))
    assert jobs.load_shipment_mart(spark, src2, target, run_ts=dt.datetime(2024, 1, 3)) == 1


def test_variability_mart_load_is_idempotent(spark, tmp_dir):
    target = os.path.join(tmp_dir, "metrics_variability")
    src = TD.staging(spark, SF)
    first = jobs.load_variability_mart(spark, src, target, run_ts=dt.datetime(2024, 1, 1))
    assert first > 0
    assert jobs.load_variability_mart(spark, src, target, run_ts=dt.datetime(2024, 1, 2)) == 0
    stored = spark.read.parquet(target)
    assert stored.count() == first
    assert set(stored.columns) == set(variability_mart.COLUMNS) | {K.LOAD_TS}
    files = [f for _, _, names in os.walk(target) for f in names if f.endswith(".parquet")]
    assert len(files) == stored.select("year").distinct().count()  # the rows of a year are gathered before the write


def test_variability_load_leaves_no_tables_behind(spark, tmp_dir):
    tables = os.path.join(checkpoint_dir(spark).removeprefix("file:"), "tables")
    before = set(os.listdir(tables)) if os.path.exists(tables) else set()
    jobs.load_variability_mart(spark, TD.staging(spark, SF), os.path.join(tmp_dir, "mv"))
    assert set(os.listdir(tables)) == before


def test_dimension_rebuild_replaces(spark, tmp_dir):
    target = os.path.join(tmp_dir, "shipment_point_ref")
    tvst = TD.tvst(spark, SF)
    jobs.rebuild_shipment_points(tvst, target)
    jobs.rebuild_shipment_points(tvst, target)
    assert jobs.read_target(spark, target).count() == tvst.select("vstel").distinct().count()


def test_reports_append(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dq_report")
    resolve = catalog.dq_resolver(spark, SF)
    jobs.run_key_checks(catalog.DQ_CONFIG, resolve, "test", path, "2024-06-30")
    jobs.run_key_checks(catalog.DQ_CONFIG, resolve, "test", path, "2024-06-30")
    rep = spark.read.option("header", True).csv(path)
    assert rep.count() == 14 and set(rep.columns) == {"date", "environment", "dm_table", "validation_rule",
                                                       "validation_result"}


def test_client_in_join_same_result_with_one_client(spark):
    src = TD.staging(spark, SF)
    a = shipment_mart.enriched(src)
    b = shipment_mart.enriched(src, client_in_join=True)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    c = variability_mart.day_cells(src)
    e = variability_mart.day_cells(src, client_in_join=True)
    assert c.exceptAll(e).count() == 0 and e.exceptAll(c).count() == 0
