"""Replay a table as a file stream, and run a query to completion.

``write_replay`` cuts a frame into contiguous ranges of an ordering column and
writes them one after another, so file modification order equals event order;
each range is itself range-partitioned into several files, written and read in
parallel.  ``replay_stream`` reads them back with ``maxFilesPerTrigger``, one
range per micro-batch.  ``run_available_now`` drains a streaming query into a
parquet sink and returns the committed output as a static frame.  All folders
are fresh sub-folders of the shared checkpoint directory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.session import scratch_path


FILES_PER_BATCH = 4


def write_replay(df: DataFrame, path: str, batches: int = 5, order_col: str = "event_id",
                 files_per_batch: int = FILES_PER_BATCH) -> None:
    """Write ``batches`` contiguous ranges of ``order_col``.

    The input is computed once into a staging table next to ``path``; the
    ranges are then cut from it (range filters reach the parquet scan), each
    into ``files_per_batch`` files.
    """
    staging = f"{path.rstrip('/')}-staging"
    df.write.mode("overwrite").parquet(staging)
    df = df.sparkSession.read.parquet(staging)
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) // batches + 1
    for i in range(batches):
        part = df.where((F.col(order_col) >= lo + i * step) & (F.col(order_col) < lo + (i + 1) * step))
        part.repartitionByRange(files_per_batch, order_col).write.mode("append").parquet(path)


def replay_stream(spark: SparkSession, path: str, schema, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    return (spark.readStream.schema(schema)
            .option("maxFilesPerTrigger", str(files_per_batch))
            .parquet(path))


def _start(writer, spark: SparkSession, partitions: int | None):
    """Start a query with ``partitions`` state partitions, the session's number
    unless given.  A fresh query takes it from the session at start (it runs
    on a clone of the session); a restarted one keeps its checkpoint's."""
    if not partitions:
        return writer.start()
    key = "spark.sql.shuffle.partitions"
    old = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, old)


def run_available_now(stream: DataFrame, name: str, output_mode: str = "append",
                      out_path: str | None = None, partitions: int | None = None) -> DataFrame:
    """Run a streaming frame over all available input into parquet; read it back."""
    spark = stream.sparkSession
    out = out_path or scratch_path(spark, f"{name}-out")
    ckpt = scratch_path(spark, f"{name}-ckpt")
    q = _start(stream.writeStream.format("parquet").outputMode(output_mode)
               .option("path", out).option("checkpointLocation", ckpt)
               .queryName(f"{name}_{ckpt[-12:]}")
               .trigger(availableNow=True), spark, partitions)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(stream.schema).parquet(out)


def run_foreach_batch(stream: DataFrame, name: str, fn, partitions: int | None = None) -> str:
    """Run ``fn(batch_df, batch_id)`` over all available input; returns the checkpoint path."""
    spark = stream.sparkSession
    ckpt = scratch_path(spark, f"{name}-ckpt")
    q = _start(stream.writeStream.foreachBatch(fn).option("checkpointLocation", ckpt)
               .queryName(f"{name}_{ckpt[-12:]}")
               .trigger(availableNow=True), spark, partitions)
    q.awaitTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))
    return ckpt
