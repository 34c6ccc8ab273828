"""``load``: truncate, then load typed NDJSON files."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators.merge import KeyedTable
from ..sources.pages import read_ndjson


def reload_ndjson(spark: SparkSession, path: str, schema: str, table: KeyedTable) -> dict:
    """Replace the table's rows by those of the files under ``path``, all with
    one load stamp. Files are read with the given schema and fail on a bad
    row before anything is truncated."""
    rows = read_ndjson(spark, path, schema).withColumn("updated_at", F.current_timestamp()).persist()
    try:
        rows.count()                                   # a bad row fails here
        table.create()
        table.truncate()
        return table.upsert(rows.withColumns({"page_no": F.lit(0).cast("long"), "pos": F.monotonically_increasing_id()}))
    finally:
        rows.unpersist()
