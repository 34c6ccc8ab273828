"""Training-data pipeline: quality rules, near duplicates, decontamination,
pseudonyms, packing. Each stage is a function of (spark, docs, sf_dir); its
result is written as Parquet and reread as the next stage's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ticketlake.llm.common import stored, table
from ticketlake.llm.stages import STAGES

#: SQL cannot express the forest, the pseudonyms or the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
