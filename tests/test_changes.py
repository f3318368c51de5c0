import datetime as dt


from martline.operators.changes import new_or_changed
from martline.operators.versions import current_state
from martline.sources import sinks

SCHEMA = "k bigint, a string, b string"


def test_new_changed_and_unchanged(spark):
    cand = spark.createDataFrame([(1, "x", None), (2, None, "x"), (3, None, None), (4, "y", "z")], SCHEMA)
    cur = spark.createDataFrame([(1, "x", None), (2, "x", None), (3, None, None)], SCHEMA)
    out = sorted(r.k for r in new_or_changed(cand, cur, ["k"]).collect())
    # 1 unchanged (NULL on both sides), 2 value moved between nullable columns, 3 unchanged, 4 new
    assert out == [2, 4]


def test_types_cast_before_compare(spark):
    cand = spark.createDataFrame([(1, 5)], "k bigint, v bigint")
    cur = spark.createDataFrame([(1, 5)], "k int, v int")
    assert new_or_changed(cand, cur, ["k"]).count() == 0


def test_compare_subset(spark):
    cand = spark.createDataFrame([(1, "x", "new")], SCHEMA)
    cur = spark.createDataFrame([(1, "x", "old")], SCHEMA)
    assert new_or_changed(cand, cur, ["k"], compare=["k", "a"]).count() == 0
    assert new_or_changed(cand, cur, ["k"]).count() == 1


def test_append_is_idempotent(spark, tmp_dir):
    """Appending new-or-changed rows, then re-running, appends nothing."""
    target = f"{tmp_dir}/mart"
    cols = ["k", "a", "b"]
    src = spark.createDataFrame([(1, "x", None), (2, "y", "z")], SCHEMA)
    empty = spark.createDataFrame([], SCHEMA + ", tech_load_ts timestamp_ntz")
    empty.write.parquet(target)
    for run, expected in ((dt.datetime(2024, 1, 1), 2), (dt.datetime(2024, 1, 2), 0)):
        cur = current_state(spark.read.parquet(target), ["k"])
        changes = new_or_changed(src, cur, ["k"], cols)
        n = changes.count()
        sinks.append_versioned(changes, target, cols, run_ts=run)  # reads and appends the same table
        assert n == expected
    changed = spark.createDataFrame([(1, "x", "now set"), (2, "y", "z")], SCHEMA)
    cur = current_state(spark.read.parquet(target), ["k"])
    assert [r.k for r in new_or_changed(changed, cur, ["k"], cols).collect()] == [1]
    assert spark.read.parquet(target).count() == 2


def test_failed_append_leaves_target_unchanged(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F

    target = f"{tmp_dir}/mart"
    good = spark.createDataFrame([(1, "x", None), (2, "y", "z")], SCHEMA)
    sinks.append_versioned(good, target, ["k", "a", "b"], run_ts=dt.datetime(2024, 1, 1))
    bad = spark.range(0, 1000, 1, 4).select(
        F.col("id").alias("k"),
        F.when(F.col("id") == 999, F.raise_error(F.lit("task fails mid-write"))).otherwise(F.lit("v")).alias("a"),
        F.lit(None).cast("string").alias("b"))
    with pytest.raises(Exception):
        sinks.append_versioned(bad, target, ["k", "a", "b"], run_ts=dt.datetime(2024, 1, 2))
    assert sorted(r.k for r in spark.read.parquet(target).collect()) == [1, 2]
