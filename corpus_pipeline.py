"""Corpus pipeline: each stage reads what the one before it kept."""

from __future__ import annotations

from meterflow.llm.decontaminate import stage_decontaminate
from meterflow.llm.language_id import stage_language_id
from meterflow.llm.mixing import stage_mix
from meterflow.llm.ngram_join import stage_jaccard
from meterflow.llm.suffix_dedup import stage_suffix_dedup
from meterflow.session import scratch_path

STAGES = [
    ("language_id", stage_language_id),
    ("ngram_jaccard_join", stage_jaccard),
    ("suffix_array_dedup", stage_suffix_dedup),
    ("benchmark_decontamination", stage_decontaminate),
    ("source_mixing", stage_mix),
]

#: The stages verify whole texts by rules that SQL can't express; tests hold their operators against brute force.
ORACLE_SQL = None


def run(spark, sf_dir: str):
    """Apply the stages to ``documents``, each written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
