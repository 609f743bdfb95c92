"""Session helpers: a configured SparkSession and the shared scratch folder.

Scratch data (replay files, stream checkpoints, document logs) always lives
under the folder the cluster names in ``spark.checkpoint.dir``.  Only when
that setting is absent (unit tests, local runs) do we create one ourselves.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # state for streaming aggregations; RocksDB keeps large state off-heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def get_session(master: str | None = None, app: str = "meterflow",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder for lineage cuts and scratch tables.

    Reads ``spark.checkpoint.dir`` (or the context's checkpoint dir).  When
    neither is set, a session in local mode (tests) gets a fresh folder; on a
    cluster that is an error, since a machine-local folder is not shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        d = tempfile.mkdtemp(prefix="meterflow-ckpt-")
        spark.sparkContext.setCheckpointDir(d)
        spark.conf.set("spark.checkpoint.dir", d)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused sub-folder of the shared folder."""
    return f"{shared_dir(spark)}/meterflow/{name}-{uuid.uuid4().hex[:12]}"

