"""A key holding a third of all rows: results stay whole and the plans split or pre-reduce it."""

from pyspark.sql import functions as F

from martline.operators.versions import latest_version


def _final_plan(df) -> str:
    df.collect()  # runs df's own query execution, so its adaptive plan is final
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_in_latest_version(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("k"),  # key -1: a third of the rows
        F.col("id").cast("timestamp").alias("tech_load_ts"),
        F.lit(0).alias("tech_is_deleted"),
        F.col("id").alias("v"),
    ).repartition(8)
    out = latest_version(df, ["k"])
    rows = {r.k: r.v for r in out.collect()}
    assert len(rows) == n - n // 3 + 1 and rows[-1] == n - (n % 3 or 3)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan  # one row per key per map task before the shuffle


def test_hot_key_in_aggregation_is_combined_map_side(spark):
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("NO DATA")).otherwise(
        F.col("id").cast("string")).alias("dim"))
    agg = df.groupBy("dim").agg(F.count(F.lit(1)).alias("n"))
    plan = agg._jdf.queryExecution().executedPlan().toString()
    assert "partial_count" in plan
    assert agg.where("dim = 'NO DATA'").first().n == 10000


def test_null_hot_key_in_left_join_is_split(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 60000
        left = spark.range(n).select(
            F.col("id"),
            F.when(F.col("id") % 3 == 0, F.lit(None).cast("bigint")).otherwise(F.col("id") % 1000).alias("k"))
        right = spark.range(1000).select(F.col("id").alias("k2"), (F.col("id") * 2).alias("w"))
        j = left.join(right, left.k == right.k2, "left")
        plan = _final_plan(j)
        assert "SortMergeJoin" in plan and "skew=true" in plan
        assert j.count() == n and j.where(F.col("w").isNull()).count() == n // 3
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
