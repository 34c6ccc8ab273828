"""Stale-ticket selection and the closing decision table (E5: P9-P12, A1,
L2, JN2, JN7, J15, J20, A11).

The reference asks the service 3-5 times per candidate; here the current
state comes from one left join with an issues snapshot, and every decision is
a column of one table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import json_str, json_value, parse, text_of, time_of
from ..functions.labels import TAG_CLASSIFIED, append_tag, close_payload
from .running import first_rows

WAITING = "waiting_on_customer"
SLACK = "slack"
CLOSED = "closed"
STALE_AFTER = dt.timedelta(weeks=1)


def last_message_times(messages: DataFrame) -> DataFrame:
    """A1: MAX(message timestamp) per issue. Hash aggregate with a partial
    (map-side) step, so a hot issue is combined before the shuffle."""
    return (messages.select("issue_id", time_of(messages, "timestamp").alias("ts"))
            .groupBy("issue_id").agg(F.max("ts").alias("last_message_time")))


def waiting_pool(issues: DataFrame) -> DataFrame:
    """Ids of Slack issues waiting on the customer (both predicates reach
    the parquet scan, on typed columns or as VARIANT field filters)."""
    return issues.where((text_of(issues, "state") == WAITING) & (text_of(issues, "source") == SLACK)).select("issue_id")


def stale_from(pool: DataFrame, messages: DataFrame, as_of: dt.datetime, limit: int | None = None,
               stale_after: dt.timedelta = STALE_AFTER, ordered: bool = True) -> DataFrame:
    """P10, L2, JN2 over a candidate pool: last message strictly older than
    ``as_of - stale_after``; issues without messages drop out."""
    last = last_message_times(messages)
    cutoff = F.lit(as_of - stale_after).cast("timestamp")
    out = (pool.join(last, "issue_id")
           .where(F.col("last_message_time") < cutoff)
           .select("issue_id", "last_message_time"))
    order = [F.col("last_message_time").asc(), F.col("issue_id").asc()]
    if limit:
        out = first_rows(out, order, limit)
    return out.orderBy(*order) if ordered else out


def stale_candidates(issues: DataFrame, messages: DataFrame, as_of: dt.datetime,
                     limit: int | None = None, stale_after: dt.timedelta = STALE_AFTER,
                     ordered: bool = True) -> DataFrame:
    """Candidates for closing (P9, P10, L2, JN2).

    Slack issues waiting on the customer whose last message is strictly older
    than ``as_of - stale_after``; issues without messages drop out. Messages
    are aggregated *before* the join (partial maxima of one narrow field
    map-side, then one row per issue), ordered by last
    message time (issue id breaks ties); ``limit`` is the record cap (a
    top-k, planned as TakeOrderedAndProject). ``ordered=False`` skips the
    global sort when the set only feeds joins (a cap always sorts).
    """
    return stale_from(waiting_pool(issues), messages, as_of, limit, stale_after, ordered)


def missing_fields(data: Column) -> Column:
    """Fields whose value is falsy ('' counts as missing), in the order
    resolution, category."""
    res = json_value(data, "$.custom_fields.resolution.value")
    cat = json_value(data, "$.custom_fields.category.value")
    return F.array_compact(F.array(
        F.when(F.coalesce(res, F.lit("")) == "", F.lit("resolution")),
        F.when(F.coalesce(cat, F.lit("")) == "", F.lit("category"))))


def is_closed(data: Column) -> Column:
    """State is 'closed' (NULL state -> false)."""
    return F.coalesce(json_str(data, "$.state") == CLOSED, F.lit(False))


def current_state(candidates: DataFrame, snapshot: DataFrame) -> DataFrame:
    """JN7: one left join replaces the per-issue GETs."""
    s = snapshot.select("issue_id", F.col("data").alias("current"))
    return candidates.join(s, "issue_id", "left")


def parse_questions(response: Column) -> Column:
    """Question-analysis response -> struct(questions, n_questions,
    all_resolved). Unparseable text -> NULL struct; ``all_resolved`` is only
    true for a JSON boolean true (Q14: a string "false" does not close)."""
    v = parse(response)
    qs = F.try_variant_get(v, "$.questions", "array<struct<id:int,question:string,resolved:boolean>>")
    is_bool = F.schema_of_variant(F.try_variant_get(v, "$.all_resolved", "variant")) == "BOOLEAN"
    all_res = F.coalesce(F.when(is_bool, F.try_variant_get(v, "$.all_resolved", "boolean")), F.lit(False))
    ok = v.isNotNull() & F.schema_of_variant(v).startswith("OBJECT")
    return F.when(ok, F.struct(qs.alias("questions"),
                               F.coalesce(F.size(qs), F.lit(0)).cast("long").alias("n_questions"),
                               all_res.alias("all_resolved")))


def closing_decisions(candidates: DataFrame, snapshot: DataFrame, conversations: DataFrame,
                      question_responses: DataFrame, classified: DataFrame | None = None) -> DataFrame:
    """Decision per candidate (E5 truth table; first match wins).

    ``classified`` (optional) is the triage decision table of the issues that
    were classified first: its accepted fields count as set, and an update
    adds to ``total_classified``.
    """
    c = current_state(candidates.select("issue_id"), snapshot)
    data = F.col("current")
    missing = missing_fields(data)
    cls_updated = F.lit(False)
    if classified is not None:
        k = classified.select("issue_id", F.col("outcome").alias("cls_outcome"),
                              F.transform("custom_fields", lambda x: x["slug"]).alias("cls_slugs"),
                              F.col("payload").isNotNull().alias("cls_written"))
        c = c.join(k, "issue_id", "left")
        missing = F.filter(missing, lambda f: ~F.coalesce(F.array_contains(F.col("cls_slugs"), f), F.lit(False)))
        cls_updated = F.coalesce(F.col("cls_outcome") == "updated", F.lit(False))
    conv = conversations.select("issue_id", "conversation")
    q = question_responses.select("issue_id", F.col("response").alias("q_response"))
    c = c.join(conv, "issue_id", "left").join(q, "issue_id", "left")
    analysis = parse_questions(F.col("q_response"))
    outcome = (F.when(is_closed(data), F.lit("already_closed"))
                .when(F.size(missing) > 0, F.lit("still_unclassified"))
                .when(F.coalesce(F.col("conversation"), F.lit("")) == "", F.lit("no_conversation"))
                .when(F.coalesce(F.col("q_response"), F.lit("")) == "", F.lit("analysis_failed"))
                .when(analysis.isNull(), F.lit("analysis_failed"))
                .when(analysis["all_resolved"], F.lit("closed"))
                .otherwise(F.lit("not_resolved")))
    tags = F.try_variant_get(data, "$.tags", "array<string>")
    if classified is not None:   # the classification write-back added its tag first
        tags = F.when(F.coalesce(F.col("cls_written"), F.lit(False)), append_tag(tags, TAG_CLASSIFIED)) \
                .otherwise(tags)
    return c.select(
        "issue_id", outcome.alias("outcome"), cls_updated.alias("classified_first"),
        analysis["n_questions"].alias("n_questions"),
        F.when(outcome == "closed", close_payload(tags)).alias("payload"))


def close_outbox(decisions: DataFrame, created_at: Column | None = None) -> DataFrame:
    """One outbox row per issue to close."""
    ts = created_at if created_at is not None else F.current_timestamp()
    return (decisions.where(F.col("outcome") == "closed")
            .select("issue_id", F.lit("close").alias("kind"), "payload", ts.alias("created_at")))


def close_counters(decisions: DataFrame) -> DataFrame:
    """Closing counters; every candidate adds 1 to processed."""
    o = F.col("outcome")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
    errors = o.isin("still_unclassified", "no_conversation", "analysis_failed", "close_failed", "exception")
    a = decisions.agg(
        F.count(F.lit(1)).cast("long").alias("total_processed"),
        n(o.isin("closed", "not_resolved", "close_failed")).alias("total_analyzed"),
        n(o == "closed").alias("total_closed"),
        n(F.col("classified_first")).alias("total_classified"),
        n(errors).alias("total_errors"))
    return a.withColumn("success", F.col("total_errors") == 0)
