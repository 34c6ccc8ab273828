"""Deduplication by primary key.

``row_number() == 1`` over the key is planned with a partial WindowGroupLimit
before the shuffle, so a key holding a third of all rows is cut to one row
per map partition before it reaches a single task.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def key_present(keys) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def dedup(df: DataFrame, keys, order: list) -> DataFrame:
    """Keep the first row per key under ``order`` (a list of sort Columns);
    rows with any NULL key part are dropped."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.where(key_present(keys))
            .withColumn("_rn", F.row_number().over(w))
            .where(F.col("_rn") == 1).drop("_rn"))


def dedup_first(df: DataFrame, keys, seen=("page_no", "pos")) -> DataFrame:
    """Parity mode (Q1): first seen in landing order wins."""
    return dedup(df, keys, [F.col(c).asc() for c in seen])


def dedup_latest(df: DataFrame, keys, ts: str = "updated_at", seen=("page_no", "pos")) -> DataFrame:
    """Documented contract: greatest ``ts``; equal values keep the first seen."""
    return dedup(df, keys, [F.col(ts).desc_nulls_last()] + [F.col(c).asc() for c in seen])


def dedup_batches(df: DataFrame, keys, batch: str = "batch_no", seen=("page_no", "pos")) -> DataFrame:
    """Sequential-batch semantics in one pass (I4): a later batch beats an
    earlier one; inside a batch the first row wins."""
    return dedup(df, keys, [F.col(batch).desc()] + [F.col(c).asc() for c in seen])


#: Landing position: run, page (one flushed batch), place in the page.
LANDED_COLS = ("run_id", "page_no", "pos")


def dedup_landed(df: DataFrame, keys, position=LANDED_COLS) -> DataFrame:
    """The one winner rule of replication, batch and stream: a later run
    beats an earlier one, in a run a later page, inside a page the first item.
    Columns that ``df`` lacks do not take part."""
    run, page, pos = position
    order = [*[F.col(c).desc_nulls_last() for c in (run, page) if c in df.columns],
             *[F.col(pos).asc_nulls_last() for _ in (1,) if pos in df.columns]]
    return dedup(df, keys, order)


def dedup_flushed(df: DataFrame, keys) -> DataFrame:
    """Records flushed in numbered batches (``flush_no``, see ``running``): a
    later run beats an earlier one, in a run a later flush, inside a flush the
    first record."""
    order = [F.col(c).desc_nulls_last() for c in ("run_id", "flush_no")]
    return dedup(df, keys, order + [F.col(c).asc_nulls_last() for c in ("issue_id", "page_no", "pos") if c in df.columns])


def dedup_counts(df: DataFrame, keys) -> DataFrame:
    """Duplicate accounting (A6): original, null-key, kept and removed rows in
    one aggregate (the distinct count is planned as a partial aggregate on
    the keys, so duplicates are combined map-side)."""
    null_key = F.when(~key_present(keys), 1).otherwise(0)
    a = df.agg(F.count(F.lit(1)).alias("original"),
               F.coalesce(F.sum(null_key), F.lit(0)).alias("null_keys"),
               F.count_distinct(*[F.col(k) for k in keys]).alias("kept"))
    return a.select(F.col("original").cast("long"), F.col("null_keys").cast("long"),
                    F.col("kept").cast("long"),
                    (F.col("original") - F.col("null_keys") - F.col("kept")).cast("long").alias("removed"))
