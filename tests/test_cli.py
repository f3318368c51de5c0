"""The command line runs the loads over staging tables stored as Parquet folders."""

import os

import pytest

from martline import cli
from martline.sources import testdata as TD

SF = "/root/testdata/sf0.001"


def _write_staging(spark, root):
    for name in TD.STAGING:
        TD.staging(spark, SF)[name].write.parquet(os.path.join(root, name))


def test_cli_jobs(spark, tmp_dir):
    staging = os.path.join(tmp_dir, "staging")
    _write_staging(spark, staging)
    mm, mv, sp = (os.path.join(tmp_dir, x) for x in ("metrics_main", "metrics_variability", "shipment_point_ref"))
    first = cli.run(["shipment-mart", "--staging", staging, "--target", mm, "--run-ts", "2024-01-01 00:00:00",
                     "--client-in-join"],
                    spark)
    again = cli.run(["shipment-mart", "--staging", staging, "--target", mm, "--run-ts", "2024-01-02 00:00:00"],
                    spark)
    assert first > 0 and again == 0
    assert cli.run(["variability-mart", "--staging", staging, "--target", mv], spark) > 0
    assert cli.run(["shipment-points", "--staging", staging, "--target", sp], spark) is None
    report = cli.run(["key-check", f"metrics_main={mm}", f"metrics_variability={mv}", f"shipment_point_ref={sp}",
                      "--environment", "test", "--date", "2024-06-30"], spark).collect()
    assert sorted((r.dm_table, r.validation_result) for r in report) == [
        ("metrics_main", 0), ("metrics_variability", 0), ("shipment_point_ref", 0)]


def test_cli_environment_selects_the_tables(spark, tmp_dir):
    prod, test = (os.path.join(tmp_dir, e) for e in ("prod", "test"))
    rows = "k long, transportation_number long, tech_load_ts string"
    spark.createDataFrame([(1, 1, "a"), (2, 1, "a")], rows).write.parquet(os.path.join(prod, "metrics_main"))
    spark.createDataFrame([(1, 1, "a")], rows).write.parquet(os.path.join(test, "metrics_main"))
    roots = ["--root", f"prod={prod}", "--root", f"test={test}"]
    for environment, groups in (("prod", 1), ("test", 0)):
        report = cli.run(["key-check", "metrics_main", "--environment", environment, *roots], spark).collect()
        assert [(r.environment, r.validation_result) for r in report] == [(environment, groups)]
    with pytest.raises(SystemExit):
        cli.run(["key-check", "metrics_main", "--environment", "other", *roots], spark)
