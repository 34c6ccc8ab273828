"""Shared helpers: tables, scratch tables on the shared folder, word splitting.

Scratch tables go to the folder named by ``spark.checkpoint.dir``. They cut
lineage the way ``checkpoint()`` does: a lost executor costs a reread of
stored files, not a recomputation of everything before.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Bytes of an Arrow batch: a worker holds few texts at a time, and the JVM
#: few bytes outside its heap.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Every query of this package runs with BATCH_BYTES batches."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) != f"{BATCH_BYTES}b":
        spark.conf.set(key, f"{BATCH_BYTES}b")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark only (any file system Spark knows)."""
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; where it is
    unset, a cluster's warehouse folder serves (see ``session``)."""
    return checkpoint_dir(spark)


#: Operators whose workers remember something from task to task: how it is forgotten.
_FORGET: dict[str, Callable[[], None]] = {}


def remembers(operator: str, forget: Callable[[], None]) -> None:
    """Tells how what a worker remembers for ``operator`` is forgotten."""
    _FORGET[operator] = forget


def works_for(operator: str) -> None:
    """A task begins in this worker. Workers outlive queries: what they remember
    for other operators goes, so one worker holds that of one operator at most."""
    for other, forget in _FORGET.items():
        if other != operator:
            forget()
    pa.default_memory_pool().release_unused()


#: Spark's setting to delete a query's shuffle files when it has ended.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """``df`` written as Parquet under the shared folder (a folder for each value
    of the column ``by``) and read back. What was shuffled for it is deleted
    when it is written, not when the driver happens to collect its garbage."""
    spark = df.sparkSession
    small_batches(spark)
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex[:12]}"
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.parquet(path, partitionBy=by)
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def doc_bytes(text: str = "text"):
    """The text's UTF-8 bytes (NULL: empty)."""
    return F.coalesce(F.col(text), F.lit("")).cast("binary")


#: Logarithmic bins for a doubling of a count.
_BINS = 64


def most_frequent(counts: DataFrame, column: str, most: int) -> DataFrame:
    """The rows with the largest counts, ``most`` at most. The cut is a bin of a
    logarithmic histogram (some thousand bins at any size), and equal counts
    are kept or left out together: no task and not the driver sorts the rows."""
    bin_ = F.floor(F.log2(F.col(column)) * _BINS).cast("int")
    sizes = counts.groupBy(bin_.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
    cut, have = None, 0
    for r in sorted(sizes, key=lambda r: -r["b"]):
        have += r["n"]
        if have > most:
            break
        cut = r["b"]
    return counts.where(bin_ >= cut) if cut is not None else counts.where("false")


def hash_sample(rows: DataFrame, n: int, *by) -> DataFrame:
    """About ``n`` rows, never over 2 ``n`` but for chance: those whose hash
    over the columns ``by`` is small enough for the table's size. Which rows
    they are depends on the data alone."""
    total = rows.count()
    share = 1 << 30
    keep = share if total <= n else int(share * n / total)
    return rows.where(F.pmod(F.xxhash64(*by), F.lit(share)) < keep)
