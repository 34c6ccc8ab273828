"""Run counters and the run log.

Counters are aggregates over per-row outcome tables - no driver-side loops.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COUNTER_COLS = ("total_processed", "total_errors", "total_batches", "rows_kept")


def counters_from_rows(object_type: str, table_name: str, rows: DataFrame, keys,
                       batch_cols=("run_id", "page_no")) -> DataFrame:
    """A8 in one pass over the transformed rows (valid and rejected, told
    apart by ``reject_reason``): the pages are parsed once, and the two
    distinct counts are planned as partial aggregates on their own columns,
    so duplicates are combined map-side before the shuffle."""
    ok = F.col("reject_reason").isNull()
    has_key = ok
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    a = rows.agg(
        F.count(F.when(ok, 1)).cast("long").alias("total_processed"),
        F.count(F.when(~ok, 1)).cast("long").alias("total_errors"),
        F.count_distinct(F.when(ok, F.struct(*[F.col(c) for c in batch_cols]))).cast("long").alias("total_batches"),
        F.count_distinct(F.when(has_key, F.struct(*[F.col(k) for k in keys]))).cast("long").alias("rows_kept"))
    return a.select(F.lit(object_type).alias("object_type"), F.lit(table_name).alias("table_name"),
                    *COUNTER_COLS)


def with_overall(results: DataFrame) -> DataFrame:
    """Per-object rows plus an ``all`` rollup row; success = no errors."""
    r = results.rollup("object_type").agg(*[F.sum(c).cast("long").alias(c) for c in COUNTER_COLS],
                                          F.max("table_name").alias("table_name"))
    return r.select(F.coalesce("object_type", F.lit("all")).alias("object_type"),
                    F.when(F.col("object_type").isNull(), F.lit(None).cast("string"))
                     .otherwise(F.col("table_name")).alias("table_name"),
                    *COUNTER_COLS, (F.col("total_errors") == 0).alias("success"))


#: The run log holds every command's counters; a command leaves others' NULL.
RUN_LOG = ("command string, object_type string, table_name string, total_processed bigint, total_errors bigint, "
           "total_batches bigint, rows_kept bigint, total_classified bigint, total_updated bigint, total_analyzed bigint, "
           "total_closed bigint, rows_before bigint, rows_after bigint, success boolean, error string, run_at timestamp")


def append_run_log(df: DataFrame, path: str, command: str) -> None:
    """Append a command's counters to the run-log table with the run time."""
    df = df.withColumn("command", F.lit(command)).withColumn("run_at", F.current_timestamp())
    columns = [c.split() for c in RUN_LOG.split(", ")]
    df.select(*[(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in columns]).write.mode("append").parquet(path)


def log_failure(spark: SparkSession, path: str, command: str, error: Exception) -> None:
    """A command that failed as a whole."""
    text = str(error).splitlines()[0][:500] if str(error) else type(error).__name__
    append_run_log(spark.createDataFrame([(1, False, text)], "total_errors bigint, success boolean, error string"), path, command)


def log_run(out: dict, path: str, command: str) -> None:
    """I10 of a command whose outputs are still to be computed: its counters
    are computed (its decisions stay cached for the outputs) and logged; if
    that fails, the failure is logged and raised."""
    try:
        append_run_log(out["counters"], path, command)
    except Exception as e:
        log_failure(out["counters"].sparkSession, path, command, e)
        raise
