"""Run an incremental mart load whenever new staging files arrive.

The marts are incremental: each run appends the rows that are new or
changed since the mart's current state. Versions of a key can arrive in
different files, so a load must see the whole staging history, not only the
new files. The stream is used as a trigger: a file-source stream over the
staging folder tracks which files were already seen (in its checkpoint), and
every micro-batch that brings new files runs the load once over the full
tables. ``availableNow`` processes what is there and stops, like a scheduled
batch run; a processing-time trigger keeps it running.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def run_on_new_files(
    spark: SparkSession,
    staging_dir: str,
    schema: StructType,
    checkpoint: str,
    load: Callable[[int], None],
    fmt: str = "parquet",
    available_now: bool = True,
    interval: str = "10 minutes",
) -> StreamingQuery:
    """Call ``load(batch_id)`` once per micro-batch that contains new files.

    ``checkpoint`` must be a folder shared by the cluster; it records the
    files already handled, so a restarted stream (or a lost executor) does
    not load twice, and the append itself is idempotent anyway.
    """
    stream = spark.readStream.schema(schema).format(fmt).load(staging_dir)

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            load(batch_id)

    writer = stream.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()
