import os

from pyspark.sql import functions as F

from martline.operators.changes import new_or_changed
from martline.operators.versions import current_state, latest_version
from martline.sources import sinks
from martline.streaming.incremental import run_on_new_files

SCHEMA = "k bigint, v string, tech_load_ts timestamp_ntz, tech_is_deleted int"


def test_incremental_load_runs_once_per_new_files(spark, tmp_dir):
    staging, target, ckpt = (os.path.join(tmp_dir, x) for x in ("staging", "mart", "ckpt"))
    spark.createDataFrame([], "k bigint, v string, tech_load_ts timestamp_ntz").write.parquet(target)
    schema = spark.createDataFrame([], SCHEMA).schema
    loads = []

    def load(batch_id):
        src = latest_version(spark.read.schema(schema).parquet(staging), ["k"]).drop("tech_load_ts", "tech_is_deleted")
        cur = current_state(spark.read.parquet(target), ["k"])
        changes = new_or_changed(src, cur, ["k"], ["k", "v"])
        loads.append(changes.count())
        sinks.append_versioned(changes, target, ["k", "v"])

    def add(rows, name):
        df = spark.createDataFrame(rows, "k bigint, v string, ts string, tech_is_deleted int")
        df.select("k", "v", F.to_timestamp_ntz("ts").alias("tech_load_ts"), "tech_is_deleted") \
            .write.mode("append").parquet(staging)

    add([(1, "a", "2024-01-01 00:00:00", 0), (2, "b", "2024-01-01 00:00:00", 0)], "f1")
    run_on_new_files(spark, staging, schema, ckpt, load, fmt="parquet").awaitTermination()
    run_on_new_files(spark, staging, schema, ckpt, load, fmt="parquet").awaitTermination()  # nothing new
    add([(1, "a2", "2024-01-02 00:00:00", 0)], "f2")
    run_on_new_files(spark, staging, schema, ckpt, load, fmt="parquet").awaitTermination()
    assert loads == [2, 1]
    assert spark.read.parquet(target).count() == 3
