"""Connected components by alternating stars, and cuts of a long job's lineage."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterflow.session import scratch_path, shared_dir


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges``: columns ``a`` and ``b``.  Returns ``node``, ``component``.
    Null ends, self loops and repeated edges change nothing; an empty table
    gives an empty result.  Each round moves every node's larger neighbours
    to its smallest one (large star), then its smaller ones (small star),
    until nothing changes; neighbour minima are aggregated before the
    shuffle, so a hub with very many neighbours is one small buffer per task.
    """
    e = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while True:
        both = e.union(e.select("v", "u")).toDF("u", "v")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        # after the large star every edge points from a larger to a smaller node
        large = large.where("u <> v").distinct()
        m2 = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(m2, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        nxt = cut(small.where("u <> v").union(m2.toDF("u", "v")).distinct())
        changed = nxt.exceptAll(e).limit(1).count() + e.exceptAll(nxt).limit(1).count()
        e = nxt
        if not changed:
            break
    star = e.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return star.union(e.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a step's result to the shared folder, read it back, and let the driver free the step's shuffle files.

    Spark frees shuffle files when the driver's JVM collects its garbage, which
    may not happen for half an hour; a long job asks for it after each step.
    The result's ``scratch`` names its table, for :func:`release`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.parquet(path)
    out.scratch = [path]
    return out


def remove(spark, path: str) -> None:
    """Delete a scratch table that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(*settled: DataFrame) -> None:
    """Delete the tables of settled steps once nothing reads them any more."""
    for df in settled:
        for path in df.scratch:
            remove(df.sparkSession, path)
