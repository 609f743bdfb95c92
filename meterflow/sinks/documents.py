"""Document store with replay-safe upserts.

The original sink indexes each window result under ``{siteId}-{windowStart}``
in a daily index, so a replayed result overwrites the earlier one.  Here the
store is a log of batches (:mod:`meterflow.sinks.commits`): every row carries
the run and micro-batch that wrote it, and readers take the latest (run,
batch) per document key.  A new checkpoint, whose batch ids start at 0 again,
gets the next run, so versions only grow.  :func:`compact` folds the log into
one version per key in place; the log goes on taking batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meterflow.functions.expressions import epoch_ms_to_date
from meterflow.operators.rollup import with_document_keys
from meterflow.sinks.commits import VERSION, Store

# the index name holds the window size and the day; the date is in the key so that a day's filter prunes folders
DOC_KEY = ["windowSizeMinutes", "index_date", "index_name", "doc_id"]
PARTITIONS = ("windowSizeMinutes", "index_date")
OUTPUT = "documents"


def to_documents(rollup: DataFrame) -> DataFrame:
    """Rollup rows with index name, document id and the UTC index date."""
    return with_document_keys(rollup).withColumn("index_date", epoch_ms_to_date("windowEnd"))


def open_run(spark: SparkSession, path: str, checkpoint: str) -> int:
    """Run number of a checkpoint on this log."""
    return Store(spark, path).open_run(checkpoint)


def write_batch(docs: DataFrame, path: str, batch_id: int, run: int = 0) -> None:
    """Write one batch of documents; a repeat replaces exactly what the batch wrote before."""
    store = Store(docs.sparkSession, path)
    commit = store.begin(run, batch_id)
    store.write(OUTPUT, docs, commit, run, batch_id, PARTITIONS)
    store.commit(commit, run, batch_id)
    store.drop_earlier(OUTPUT, commit, run, batch_id)


def newest(rows: DataFrame, key: list[str]) -> DataFrame:
    """One row per key: the version of the highest (run, batch).

    ``max_by`` is a partial aggregate, so repeated replays of a hot key are
    reduced before the shuffle.
    """
    cols = [c for c in rows.columns if c not in key]
    latest = rows.groupBy(*key).agg(F.max_by(F.struct(*cols), F.struct(*VERSION)).alias("_d"))
    return latest.select(*key, "_d.*")


def latest_wins(spark: SparkSession, path: str, key: list[str] | None = None) -> DataFrame:
    """The newest version of every document.  A filter on the size or day prunes folders."""
    return newest(Store(spark, path).read(OUTPUT).drop("commit"), key or DOC_KEY)


def compact(spark: SparkSession, path: str, key: list[str] | None = None) -> None:
    """Fold the log into the newest version of every document, in place."""
    Store(spark, path).compact(OUTPUT, lambda rows: newest(rows, key or DOC_KEY), PARTITIONS)


def elasticsearch_writer(docs: DataFrame, nodes: str, resource: str = "{index_name}"):
    """Writer for the Elasticsearch connector when its jar is on the classpath:
    per-row index from ``index_name`` and ``doc_id`` as the document id (the whole document replaces an older one)."""
    return (docs.write.format("es")
            .option("es.nodes", nodes)
            .option("es.resource", resource)
            .option("es.mapping.id", "doc_id")
            .option("es.mapping.exclude", "index_name,doc_id,index_date,run,batch_id")
            .option("es.write.operation", "index")
            .mode("append"))
