"""Stages of the corpus pipeline (see corpus_pipeline.py).

Every stage takes documents as its predecessor left them, judges every row by
itself and returns the rows that stay with all their columns, whatever other
columns there are and however they are called. Operators 9 and 2 name rows by
an id: they get the row's own (a 64-bit hash of doc_id and text), not the
doc_id, so verdicts reach rows without a doc_id, and not those that only share
one. Equal rows have one id and one verdict. Texts are read whole; NULL and
empty texts are texts without words. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, ngram_join, packing, pii, rules
from .common import stored, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the quality rules reject go. NULL, empty and
    short texts fail the rules; equal rows fare alike; without labels only the
    base rules decide."""
    return rules.keep_documents(docs, table(spark, sf_dir, "labels"))


def row_key() -> Column:
    """A row's own id. NULL and its absence differ from any value."""
    return F.xxhash64(F.col("doc_id").isNull(), "doc_id", F.col("text").isNull(), "text")


def _named(docs: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with its row ids, in a column of a name that it does not have."""
    name = "row_id"
    while name in docs.columns:
        name += "_"
    return docs.withColumn(name, row_key()), name


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """``docs`` without the rows whose id is in ``gone`` (id)."""
    keyed, key = _named(docs)
    return keyed.join(gone, keyed[key] == gone["id"], "left_anti").select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: of each group of linked documents one stays, that with the
    smallest doc_id (a NULL is larger than any; among ties the smallest row
    id); of equal rows one. Texts without words link with nothing."""
    found = stored(ngram_join.linked_documents(docs.select(row_key().alias("doc_id"), "text"))
                   .select(F.col("doc_id").alias("id"), F.col("component_id").alias("group")), "linked-rows")
    several = found.where("id <> group").select("group").distinct()
    ids = docs.select(row_key().alias("id"), "doc_id")
    linked = found.join(several, "group", "left_semi").distinct().join(ids, "id").distinct()
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id")
    stays = linked.groupBy("group").agg(F.min(order)["id"].alias("id"))
    gone = stored(linked.join(stays, "id", "left_anti").select("id").distinct(), "near-copies")
    out = _without(docs, gone)
    # equal rows: only those are dealt out by their id
    again = stored(found.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "equal-rows")
    keyed, key = _named(out)
    one = keyed.join(again, keyed[key] == again["id"], "left_semi").dropDuplicates([key]).select(*docs.columns)
    return _without(out, again).unionByName(one)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: documents that hold a window of a test item go. Texts
    without words hold none; an empty benchmark takes nothing."""
    found = decontam.contamination(docs.select(row_key().alias("doc_id"), "text"), table(spark, sf_dir, "benchmark"))
    return _without(docs, stored(found.where("contaminated").select(F.col("doc_id").alias("id")).distinct(), "contaminated"))


def pseudonyms(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: personal data become pseudonyms; ``n_chars`` follows. Every
    row stays; NULL texts stay NULL, equal texts stay equal."""
    out = pii.pseudonymize(docs, count=None)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: the documents that are left, packed into sequences, a row
    for each piece. NULL and empty texts are one piece; repeated rows are
    packed each by themselves; ties in length are placed by id and content."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", quality), ("ngram_jaccard_join", near_duplicates), ("decontamination", decontaminate),
          ("pii", pseudonyms), ("packing", packed)]
