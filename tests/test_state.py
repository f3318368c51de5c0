"""State of staging tables carried on by new files only."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from martline.plans import actual, jobs
from martline.plans.actual import VERSIONED
from martline.sources import testdata as TD
from martline.operators.quality import duplicate_key_groups
from martline.sources.state import StagingState, advance, checked_loads, data_files

SF = "/root/testdata/sf0.001"
SCHEMA = "vbeln string, wadat date, vkorg string, kunnr string, ntgew decimal(18,3), tech_load_ts timestamp_ntz, tech_is_deleted int"


def deliveries(spark, rows):
    day = dt.date(2024, 1, 1)
    return spark.createDataFrame([(k, day, v, "c", None, dt.datetime(2024, 1, ts), dead) for k, v, ts, dead in rows], SCHEMA)


def live(df):
    return sorted((r.vbeln, r.vkorg) for r in actual.likp(df).collect())


def test_only_new_files_are_read(spark, tmp_dir):
    source, state = f"{tmp_dir}/likp", f"{tmp_dir}/state"
    deliveries(spark, [("1", "a", 1, 0), ("2", "a", 1, 0), ("3", "a", 3, 1)]).coalesce(1).write.parquet(source)
    got, files = advance(spark, source, state, VERSIONED["likp"])
    assert live(got) == [("1", "a"), ("2", "a")] and files == data_files(spark, source)
    for f in files:  # the files of the first load can no longer be read
        with open(f.removeprefix("file:"), "wb") as out:
            out.write(b"gone")
    # a newer version, a tombstone, a late older load of a deleted key, a new key
    deliveries(spark, [("1", "b", 2, 0), ("2", "x", 2, 1), ("3", "late", 2, 0), ("4", "n", 1, 0)]).coalesce(1).write.mode("append").parquet(source)
    got, files = advance(spark, source, state, VERSIONED["likp"])
    assert live(got) == [("1", "b"), ("4", "n")] and len(files) == 1
    again, files = advance(spark, source, state, VERSIONED["likp"])
    assert files == [] and live(again) == live(got)


def test_a_killed_advance_leaves_the_state(spark, tmp_dir, monkeypatch):
    from martline.sources import state as module

    source, state = f"{tmp_dir}/likp", f"{tmp_dir}/state"
    deliveries(spark, [("1", "a", 1, 0)]).write.parquet(source)
    advance(spark, source, state, VERSIONED["likp"])
    deliveries(spark, [("1", "b", 2, 0)]).write.mode("append").parquet(source)
    with monkeypatch.context() as m:
        m.setattr(module.Versions, "publish", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            advance(spark, source, state, VERSIONED["likp"])
    assert live(advance(spark, source, state, VERSIONED["likp"])[0]) == [("1", "b")]


@pytest.mark.parametrize("name", ["vttk", "vttp", "vtts", "currency_rate_ref", "transport_leg", "business_unit_ref"])
def test_three_loads_equal_the_whole_history(spark, tmp_dir, name):
    source, state, table = f"{tmp_dir}/{name}", f"{tmp_dir}/state", VERSIONED[name]
    whole = TD.staging(spark, SF)[name]
    ts = next(c for c in whole.columns if c.lower() == "tech_load_ts")
    for part in (1, 0, 2):  # versions of a key in any order
        whole.where(F.pmod(F.xxhash64(ts, *table.keys), F.lit(3)) == part).write.mode("append").parquet(source)
        got, _ = advance(spark, source, state, table)
    want, got = table.current(whole), table.current(got)
    assert want.exceptAll(got).count() == 0 == got.exceptAll(want).count() and want.count() > 0


def test_load_from_state_equals_load_from_history(spark, tmp_dir):
    staging = os.path.join(tmp_dir, "staging")
    src = TD.staging(spark, SF)
    for name in VERSIONED:
        src[name].write.parquet(f"{staging}/{name}")
    n = jobs.load_shipment_mart(spark, src, f"{tmp_dir}/a", "2024-01-01")
    first = StagingState(spark, staging, f"{tmp_dir}/state")
    assert jobs.load_shipment_mart(spark, first, f"{tmp_dir}/b", "2024-01-01") == n > 0
    a, b = jobs.read_target(spark, f"{tmp_dir}/a"), jobs.read_target(spark, f"{tmp_dir}/b")
    assert a.exceptAll(b).count() == 0 == b.exceptAll(a).count()
    second = StagingState(spark, staging, f"{tmp_dir}/state")
    assert jobs.load_shipment_mart(spark, second, f"{tmp_dir}/b", "2024-01-02") == 0
    assert set(second.new_files) and not any(second.new_files.values())


def mart_rows(spark, rows):
    return spark.createDataFrame([(k, None if ts is None else dt.datetime(2024, 1, ts)) for k, ts in rows], "k string, tech_load_ts timestamp_ntz")


def groups(loads):
    return loads.agg(F.sum("groups")).first()[0]


def test_loads_checked_before_are_not_read_again(spark, tmp_dir):
    source, state = f"{tmp_dir}/mart", f"{tmp_dir}/state"
    whole = []

    def load(rows):
        whole.extend(rows)
        mart_rows(spark, rows).coalesce(1).write.mode("append").parquet(source)
        got, files = checked_loads(spark, source, state, ["k"])
        want = duplicate_key_groups(mart_rows(spark, whole), ["k"]).first().validation_result
        assert groups(got) == want
        return files

    load([("a", 1), ("a", 1), ("b", 1), (None, 1), (None, 1)])
    assert len(load([("a", 2), ("b", 2), ("b", 2), ("c", 2), ("c", 2)])) == 1
    assert groups(checked_loads(spark, source, state, ["k"])[0]) == 3 and checked_loads(spark, source, state, ["k"])[1] == []
    # more rows of a load checked before: that load is read from all files
    assert len(load([("b", 1), ("z", 3)])) == 3
    assert len(load([("n", None), ("n", None)])) == 1


def test_stored_key_checks_equal_the_full_checks(spark, tmp_dir):
    keys = [("t", ["k"])]
    for part in ([("a", 1), ("a", 1)], [("a", 2), ("b", 2), ("b", 2)]):
        mart_rows(spark, part).write.mode("append").parquet(f"{tmp_dir}/t")
        rep = jobs.run_stored_key_checks(spark, {"t": f"{tmp_dir}/t"}, f"{tmp_dir}/state", "test", keys, f"{tmp_dir}/report", "2024-06-30")
        want = duplicate_key_groups(spark.read.parquet(f"{tmp_dir}/t"), ["k"]).first().validation_result
        assert [(r.date, r.environment, r.dm_table, r.validation_result) for r in rep.collect()] == [("2024-06-30", "test", "t", want)]
    assert spark.read.option("header", True).csv(f"{tmp_dir}/report").count() == 2
    with pytest.raises(KeyError):
        jobs.run_stored_key_checks(spark, {"x": f"{tmp_dir}/t"}, f"{tmp_dir}/state", "test", keys)
