"""Pluggable scorer (F1): request table -> response table.

The network model client is not part of the data path. Two scorers are
provided:

* ``keyword_responses`` - deterministic default over the taxonomy, all
  built-in functions: words are exploded from the *whole* text, joined with a
  fixed-size keyword table (broadcast: 32 labels), counted per (issue, label)
  with a partial aggregate, and the best label per field is picked.
* ``score_with`` - any user function over pandas batches via
  ``mapInPandas`` (Arrow batches; a failure in a batch gives NULL responses).
* ``score_logged`` - the same over a response log: what was answered once is
  not asked again, and a failed run is resumed.
"""

from __future__ import annotations

from typing import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import CATEGORIES, RESOLUTIONS
from ..session import scratch_path
from .commits import Files

# Token rule: maximal runs of Unicode letters/digits, lower-cased.
WORD_SPLIT = r"[^\p{L}\p{N}]+"


def keyword_table(spark: SparkSession) -> DataFrame:
    """(field, label, word): the words of each label key (split on '_')."""
    rows = [("resolution", k, w) for k, _, _ in RESOLUTIONS for w in k.split("_")]
    rows += [("category", k, w) for k, _, _ in CATEGORIES for w in k.split("_")]
    return spark.createDataFrame(rows, "field string, label string, word string").distinct()


def keyword_hits(docs: DataFrame, id_col: str, text_col: str, keywords: DataFrame) -> DataFrame:
    """(id, field, label, hits): keyword occurrences per document and label."""
    words = docs.select(F.col(id_col).alias("id"),
                        F.explode(F.split(F.lower(F.col(text_col)), WORD_SPLIT)).alias("word"))
    return (words.join(F.broadcast(keywords), "word")
            .groupBy("id", "field", "label").agg(F.count(F.lit(1)).cast("long").alias("hits")))


def keyword_responses(reqs: DataFrame, keywords: DataFrame) -> DataFrame:
    """(issue_id, response): best label per field (most hits, then the
    alphabetically first label), confidence = best hits / all hits of the field."""
    hits = keyword_hits(reqs, "issue_id", "conversation", keywords)
    per_field = (hits.groupBy("id", "field")
                 .agg(F.min_by("label", F.struct((-F.col("hits")).alias("h"), F.col("label"))).alias("label"),
                      F.max("hits").alias("best"), F.sum("hits").alias("total")))
    conf = F.round(F.col("best") / F.col("total"), 4)
    wide = (per_field.groupBy("id")
            .agg(F.max(F.when(F.col("field") == "resolution", F.col("label"))).alias("resolution"),
                 F.max(F.when(F.col("field") == "resolution", conf)).alias("resolution_confidence"),
                 F.max(F.when(F.col("field") == "category", F.col("label"))).alias("category"),
                 F.max(F.when(F.col("field") == "category", conf)).alias("category_confidence")))
    resp = wide.select(F.col("id").alias("issue_id"),
                       F.to_json(F.struct("resolution", "resolution_confidence", "category",
                                          "category_confidence")).alias("response"))
    return reqs.select("issue_id").join(resp, "issue_id", "left")


def score_with(reqs: DataFrame, fn: Callable[[pd.DataFrame], pd.Series]) -> DataFrame:
    """Run ``fn(batch[issue_id, system, user]) -> Series of response text`` on
    Arrow batches: ``issue_id, response, error``. When a batch's call raises,
    its requests are tried one by one, so one failing request loses only its
    own response, and ``error`` tells why."""
    cols = ["issue_id", "system", "user"]

    def attempt(b: pd.DataFrame) -> list:
        out = list(fn(b[cols]))
        if len(out) != len(b):
            raise ValueError(f"{len(out)} responses for {len(b)} requests")
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            errors: list = [None] * len(b)
            try:
                out = attempt(b)
            except Exception:  # noqa: BLE001
                out = []
                for i in range(len(b)):
                    try:
                        out += attempt(b.iloc[i:i + 1])
                    except Exception as e:  # noqa: BLE001
                        out.append(None)
                        errors[i] = f"{type(e).__name__}: {e}"
            yield pd.DataFrame({"issue_id": b["issue_id"], "response": pd.Series(out, index=b.index, dtype=object),
                                "error": pd.Series(errors, index=b.index, dtype=object)})
    return reqs.select(*cols).mapInPandas(run, "issue_id string, response string, error string")


RESPONSE_LOG = "digest string, response string, scored_at timestamp"


def request_digest(*texts) -> Column:
    """What a request asks, as 64 hex digits: equal requests have one answer."""
    return F.sha2(F.to_json(F.struct(*texts)).cast("binary"), 256)


def answered(spark: SparkSession, log_path: str) -> DataFrame:
    """(digest, response) of the response log, one row for each request."""
    log = spark.read.schema(RESPONSE_LOG).parquet(log_path) if Files(spark).exists(log_path) else spark.createDataFrame([], RESPONSE_LOG)
    return log.groupBy("digest").agg(F.min("response").alias("response"))


def score_logged(reqs: DataFrame, fn: Callable[[pd.DataFrame], pd.Series], log_path: str, slices: int = 16) -> DataFrame:
    """``issue_id, response`` of all requests, asked at most once each.

    The response log is keyed by what is asked, not by who asks: requests are
    reduced to their distinct digests, those in the log are not asked again,
    and the rest is scored in ``slices`` (by digest, so a run that comes after
    cuts them alike). Each slice is committed to the log when it is done; a run
    that fails midway loses one slice, and the next asks what is missing. A
    request whose call raises is not logged and is asked again next time.
    """
    spark = reqs.sparkSession
    keyed = reqs.select("issue_id", "system", "user", request_digest("system", "user").alias("digest"))
    todo = (keyed.join(answered(spark, log_path), "digest", "left_anti")
            .dropDuplicates(["digest"]).withColumn("slice", F.pmod(F.xxhash64("digest"), F.lit(slices)).cast("int")))
    path = scratch_path(spark, "requests")
    todo.select(F.col("digest").alias("issue_id"), "system", "user", "slice").write.partitionBy("slice").parquet(path)
    left = spark.read.schema("issue_id string, system string, user string, slice int").parquet(path)
    for r in left.select("slice").distinct().orderBy("slice").collect():          # a row for each slice
        got = score_with(left.where(F.col("slice") == r["slice"]), fn)
        got.where(F.col("error").isNull() & F.col("response").isNotNull()) \
           .select(F.col("issue_id").alias("digest"), "response", F.current_timestamp().alias("scored_at")).write.mode("append").parquet(log_path)
    return keyed.select("issue_id", "digest").join(answered(spark, log_path), "digest", "left").select("issue_id", "response")


def replay(reqs: DataFrame, landed: DataFrame) -> DataFrame:
    """Responses landed by an external scorer, matched to the requests."""
    return reqs.select("issue_id").join(landed.select("issue_id", "response"), "issue_id", "left")
