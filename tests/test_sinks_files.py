"""Safe full refresh and CSV folders with quoted values, odd headers and nested folders."""

import pytest
from pyspark.sql import functions as F

from martline.sources import files, sinks


def _failing(spark):
    return spark.range(5).withColumn("v", F.raise_error(F.lit("boom")).cast("string"))


def test_failed_refresh_keeps_path(spark, tmp_dir):
    target = f"{tmp_dir}/dim"
    sinks.full_refresh(spark.range(5).withColumn("v", F.lit("a")), target, ["id", "v"], "2024-01-01")
    with pytest.raises(Exception, match="boom"):
        sinks.full_refresh(_failing(spark), target, ["id", "v"], "2024-01-02")
    assert sinks.read_current(spark, target).count() == 5
    sinks.full_refresh(spark.range(3).withColumn("v", F.lit("b")), target, ["id", "v"], "2024-01-03")
    assert {r.v for r in sinks.read_current(spark, target).collect()} == {"b"}


def test_failed_refresh_keeps_table(spark):
    spark.sql("drop table if exists refresh_dim")
    sinks.full_refresh(spark.range(5).withColumn("v", F.lit("a")), "refresh_dim", ["id", "v"], "2024-01-01", is_table=True)
    with pytest.raises(Exception, match="boom"):
        sinks.full_refresh(_failing(spark), "refresh_dim", ["id", "v"], "2024-01-02", is_table=True)
    assert spark.table("refresh_dim").count() == 5
    sinks.full_refresh(spark.range(3).withColumn("v", F.lit("b")), "refresh_dim", ["id", "v"], "2024-01-03", is_table=True)
    assert [r.v for r in spark.table("refresh_dim").collect()] == ["b"] * 3
    spark.sql("drop table refresh_dim")


def _report(spark, folder):
    return sorted((r["source"], r["pk"]) for r in files.first_column_rows(spark, folder).collect())


def test_quotes_and_line_feeds(spark, tmp_path):
    (tmp_path / "q.csv").write_text('order.id,v\n"a ""b"", c",1\n"a ""b"", d",2\nx,"line1\nB"\n')
    assert _report(spark, str(tmp_path)) == [("q.csv", 'a "b", c'), ("q.csv", 'a "b", d'), ("q.csv", "x")]


def test_only_csv_entries_count_and_ids_are_anchored(spark, tmp_path, monkeypatch):
    d = tmp_path / "abd" / "d"
    (d / "sub").mkdir(parents=True)
    (d / "one.csv").write_text("k\n1\n")
    (d / "two.csv").write_text("k\n1\n")
    (d / "sub" / "x.csv").write_text("k\n1\n")
    assert _report(spark, str(d)) == [("one.csv", "1"), ("two.csv", "1")]
