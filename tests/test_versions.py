import datetime as dt

from pyspark.sql import functions as F

from martline.operators.versions import current_state, latest_version

T0, T1, T2 = (dt.datetime(2024, 1, d) for d in (1, 2, 3))


def _df(spark, rows, cols):
    return spark.createDataFrame(rows, cols)


def test_newest_deleted_removes_key_older_alive_never_resurfaces(spark):
    df = _df(spark, [("a", "v1", T0, 0), ("a", "v2", T1, 1), ("b", "v1", T0, 1), ("b", "v2", T1, 0)],
             ["k", "v", "tech_load_ts", "tech_is_deleted"])
    out = {r.k: r.v for r in latest_version(df, ["k"]).collect()}
    assert out == {"b": "v2"}


def test_no_tombstone_keeps_newest(spark):
    df = _df(spark, [("a", 1, T0), ("a", 2, T2), ("a", 3, T1)], ["k", "v", "ts"])
    out = latest_version(df, ["k"], order=("ts",), deleted_col=None).collect()
    assert [(r.k, r.v) for r in out] == [("a", 2)]


def test_prefilter_before_rank_and_secondary_order(spark):
    cols = ["tknum", "tstyp", "vstel", "tech_load_ts", "tech_is_deleted"]
    df = _df(spark, [
        ("1", 2, "SP2", T0, 0), ("1", 3, "SP3", T1, 0),          # type 3 is newer but filtered out first
        ("2", 1, "SP1", T1, 0), ("2", 2, "SP2", T1, 0),          # same load time: higher type wins
    ], cols)
    out = latest_version(df, ["tknum"], order=("tech_load_ts", "tstyp"), pre=F.col("tstyp") <= 2)
    assert {r.tknum: r.vstel for r in out.collect()} == {"1": "SP2", "2": "SP2"}


def test_state_filter_after_rank(spark):
    cols = ["id", "state", "tech_load_ts", "tech_is_deleted"]
    df = _df(spark, [(1, 1, T0, 0), (1, 2, T1, 0), (2, 1, T1, 0)], cols)
    out = latest_version(df, ["id"], post=F.col("state") == 1)
    assert [r.id for r in out.collect()] == [2]


def test_ties_are_repeatable(spark):
    df = _df(spark, [("a", "x", T0), ("a", "z", T0), ("a", "y", T0)], ["k", "v", "ts"])
    for _ in range(3):
        out = latest_version(df.repartition(3), ["k"], order=("ts",), deleted_col=None).collect()
        assert [r.v for r in out] == ["z"]


def test_null_load_time_sorts_last(spark):
    df = _df(spark, [("a", 1, None), ("a", 2, T0)], "k string, v int, ts timestamp")
    out = latest_version(df, ["k"], order=("ts",), deleted_col=None).collect()
    assert [r.v for r in out] == [2]


def test_current_state_of_self_versioned_mart(spark):
    df = _df(spark, [(1, "old", T0), (1, "new", T1), (2, "only", T0)], ["transportation_number", "v", "tech_load_ts"])
    out = {r.transportation_number: r.v for r in current_state(df, ["transportation_number"]).collect()}
    assert out == {1: "new", 2: "only"}


def test_plan_limits_rows_before_shuffle(spark):
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_returnflag")
    df = latest_version(li, ["l_orderkey", "l_linenumber"], order=("l_shipdate",), deleted_col=None)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
