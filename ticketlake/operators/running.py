"""Running totals and rank cuts that no single task holds.

Ordered rows are dealt to ranges of their order once and stored with the
number of their range: what follows relies on these numbers, so they must not
change when a task is run again. Totals of whole ranges then need a window over
a few rows (as many as there are ranges), and only inside a range are rows
ordered.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_RANGE = "_range"


def in_ranges(df: DataFrame, order: list, apart: bool = False) -> DataFrame:
    """``df`` stored in ranges of ``order`` (sort Columns), as many as there
    are shuffle partitions, with the column ``_range``; ``apart``: a folder
    for each range, so that whole ranges are skipped when read."""
    spark = df.sparkSession
    path = scratch_path(spark, "ranges")
    dealt = df.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    dealt = dealt.withColumn(_RANGE, F.spark_partition_id())
    (dealt.write.partitionBy(_RANGE) if apart else dealt.write).parquet(path)
    return spark.read.schema(dealt.schema).parquet(path)


def running_total(df: DataFrame, by: list[str], order: list[str], value: str, into: str = "before") -> DataFrame:
    """``df`` with ``into``: the sum of ``value`` over the earlier rows of the
    same ``by``. Rows must differ in ``by`` and ``order`` together. A ``by``
    that holds all rows is spread over all ranges."""
    rows = in_ranges(df, [F.col(c) for c in [*by, *order]])
    totals = rows.groupBy(*by, _RANGE).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*by).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    ahead = totals.select(*[F.col(c).alias(f"_{c}") for c in by], F.col(_RANGE).alias("_r"),
                          F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_ahead"))
    inside = Window.partitionBy(*by, _RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    own = rows.withColumn("_own", F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], F.col(_RANGE) == F.col("_r"))
    return own.join(ahead, same).select(*df.columns, (F.col("_ahead") + F.col("_own")).cast("long").alias(into))


def first_rows(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows under ``order``, unsorted. Ranges before the n-th
    row are kept whole, those behind it are not read; only the range that
    holds the n-th row is ranked. ``order`` must be total, else rows that tie
    at the cut are chosen freely."""
    rows = in_ranges(df, order, apart=True)
    sizes = rows.groupBy(_RANGE).agg(F.count(F.lit(1)).alias("n")).collect()       # a row for each range
    have = 0
    for r in sorted(sizes, key=lambda r: r[_RANGE]):
        if have + r["n"] > n:
            edge = rows.where(F.col(_RANGE) == r[_RANGE]).orderBy(*order).limit(n - have)
            return rows.where(F.col(_RANGE) < r[_RANGE]).unionByName(edge).drop(_RANGE)
        have += r["n"]
    return rows.drop(_RANGE)


def flush_numbers(rows: DataFrame, size: int, run: str, pages: list[str], pos: str = "pos") -> DataFrame:
    """``rows`` with ``flush_no``: the number of the flush that takes the
    record when a run's records, in the order of ``pages`` and ``pos``, are
    written in batches of ``size``. A flush takes the end of one page and the
    beginning of the next.

    Pages are bounded, runs are not: a page's records are counted, pages get a
    running total, and a record finds its flush from the places on its page at
    which a new flush begins."""
    own = [run, *pages]
    counted = rows.groupBy(*own).agg(F.count(F.lit(1)).alias("_n"), F.sort_array(F.collect_list(pos)).alias("_at"))
    before = running_total(counted, [run], pages, "_n", "_before")
    size_ = F.lit(int(size))
    rest = (size_ - F.col("_before") % size_).cast("int")                # records until the next flush begins
    begins = F.when(rest < F.col("_n"), F.transform(F.sequence(rest, (F.col("_n") - 1).cast("int"), F.lit(int(size))),
                                                    lambda i: F.get("_at", i))).otherwise(F.array().cast("array<long>"))
    page = before.select(*[F.col(c).alias(f"_{c}") for c in own], F.floor(F.col("_before") / size_).cast("long").alias("_first"),
                         begins.alias("_begins"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in own])
    later = F.size(F.filter("_begins", lambda p: p <= F.col(pos)))
    return rows.join(page, same).select(*rows.columns, (F.col("_first") + later).alias("flush_no"))


def flushes(rows: DataFrame, size: int, run: str) -> DataFrame:
    """``flushes``: batches of ``size`` that all runs' records are written in."""
    runs = rows.groupBy(run).agg(F.count(F.lit(1)).alias("n"))
    return runs.agg(F.coalesce(F.sum(F.ceil(F.col("n") / F.lit(int(size)))), F.lit(0)).cast("long").alias("flushes"))
