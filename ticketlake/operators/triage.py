"""Classification of closed issues (E4: P8, L1, J13, J14, J16, J17, I8, A10).

One plan for all issues: unclassified issues ⟕ conversations -> requests ->
scorer responses -> parse -> gate -> decision table -> outbox + counters.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import json_type, json_value, parse, text_of, time_of
from ..functions.labels import (FIELDS, accept_error_staged, accepted_staged, gate_staged,
                               response_features, update_payload)
from ..functions.prompts import system_for, user_text
from .keysets import BY_SHUFFLE
from .running import first_rows

CLOSED = "closed"


def unclassified(issues: DataFrame, fields=FIELDS, created_start: str | None = None,
                 created_end: str | None = None, limit: int | None = None,
                 ordered: bool = True, with_tags: bool = False) -> DataFrame:
    """P8 + L1: closed issues with a NULL label among ``fields`` (no fields ->
    none), optional inclusive created_at bounds, newest first (issue id
    breaks ties), optional record cap (a rank cut, see ``running``).
    ``ordered=False`` skips the global sort when the set only feeds joins; ``with_tags`` carries the issue's tags along, so the
    decision step needs no second read of the issues table."""
    d = F.col("data")
    conds = [json_value(d, f"$.custom_fields.{f}.value").isNull() for f in fields if f in FIELDS]
    missing = reduce(or_, conds) if conds else F.lit(False)
    created = time_of(issues, "created_at")
    pred = (text_of(issues, "state") == CLOSED) & missing
    if created_start:
        pred = pred & (created >= F.lit(created_start).cast("timestamp"))
    if created_end:
        pred = pred & (created <= F.lit(created_end).cast("timestamp"))
    cols = [json_value(d, "$.id").alias("issue_id"), created.alias("created_at")]
    if with_tags:
        cols.append(F.try_variant_get(d, "$.tags", "array<string>").alias("tags"))
    out = issues.where(pred).select(*cols)
    order = [F.col("created_at").desc_nulls_last(), F.col("issue_id").asc()]
    if limit:
        out = first_rows(out, order, limit)
    return out.orderBy(*order) if ordered else out


def requests(targets: DataFrame, conversations: DataFrame, fields: Column | None = None,
             debug: bool = False) -> DataFrame:
    """``(issue_id, fields, conversation, system, user)`` per target issue.
    ``fields`` is an ``array<string>`` column (default: both fields)."""
    f = fields if fields is not None else F.array(*[F.lit(x) for x in FIELDS])
    t = targets.select("issue_id", f.alias("fields")) if "fields" not in targets.columns \
        else targets.select("issue_id", "fields")
    c = conversations.select("issue_id", "conversation")
    j = t.join(c.hint(BY_SHUFFLE), "issue_id", "left").withColumn("conversation", F.coalesce("conversation", F.lit("")))
    return j.select("issue_id", "fields", "conversation",
                    system_for(F.col("fields"), debug).alias("system"),
                    user_text(F.col("conversation")).alias("user"))


def parse_response(response: Column) -> Column:
    """Response text -> VARIANT object; bad JSON, '' and non-objects ->
    NULL; an empty object also reads as no classification."""
    v = parse(response)
    t = F.schema_of_variant(v)
    return F.when(t.startswith("OBJECT") & (F.to_json(v) != "{}"), v)


def decisions(reqs: DataFrame, responses: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Decision per request (E4 truth table).

    ``responses``: (issue_id, response text); ``snapshot``: current issue rows
    (issue_id, data) - or (issue_id, tags) - whose tags the payload keeps.
    The response is parsed once
    and its members staged as columns, so every rule below is plain column
    logic (small generated code, no repeated parsing). Responses and snapshot
    have a row for each issue and are never broadcast (see ``keysets``).
    """
    r = responses.select("issue_id", F.col("response"))
    tags = F.col("tags") if "tags" in snapshot.columns \
        else F.try_variant_get(F.col("data"), "$.tags", "array<string>").alias("tags")
    s = snapshot.select("issue_id", tags)
    j = reqs.select("issue_id", "conversation").join(r.hint(BY_SHUFFLE), "issue_id", "left").join(s.hint(BY_SHUFFLE), "issue_id", "left")
    j = j.select("issue_id", "conversation", "tags", parse_response(F.col("response")).alias("_v"))
    j = j.select("issue_id", "conversation", "tags", F.col("_v").isNull().alias("_none"),
                 *response_features(F.col("_v")))
    g = j.select("issue_id", "conversation", "tags", "_none", gate_staged().alias("_gate"),
                 accept_error_staged().alias("_aerr"), accepted_staged().alias("_fields"))
    outcome = (F.when(F.col("conversation") == "", F.lit("no_conversation"))
                .when(F.col("_none"), F.lit("skipped"))
                .when(F.col("_gate") == "error", F.lit("exception"))
                .when(F.col("_gate") == "low", F.lit("skipped"))
                .when(F.col("_aerr"), F.lit("update_failed"))
                .otherwise(F.lit("updated")))
    out = g.select("issue_id", outcome.alias("outcome"), "_fields", "tags")
    fields = F.when(F.col("outcome") == "updated", F.col("_fields"))
    out = out.select("issue_id", "outcome", fields.alias("custom_fields"), "tags")
    return out.select("issue_id", "outcome", "custom_fields",
                      F.when(F.size("custom_fields") > 0,
                             update_payload(F.col("custom_fields"), F.col("tags"))).alias("payload"))


def update_outbox(dec: DataFrame, created_at: Column | None = None) -> DataFrame:
    """I8: one outbox row per issue with fields to write."""
    ts = created_at if created_at is not None else F.current_timestamp()
    return (dec.where(F.col("payload").isNotNull())
            .select("issue_id", F.lit("classify").alias("kind"), "payload", ts.alias("created_at")))


def counters(dec: DataFrame) -> DataFrame:
    """A10: processed, classified, updated, errors, success."""
    o = F.col("outcome")
    n = lambda cond: F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).cast("long")
    a = dec.agg(F.count(F.lit(1)).cast("long").alias("total_processed"),
                n(o.isin("updated", "update_failed")).alias("total_classified"),
                n(o == "updated").alias("total_updated"),
                n(o.isin("no_conversation", "update_failed", "exception")).alias("total_errors"))
    return a.withColumn("success", F.col("total_errors") == 0)


def response_type(response: Column, key: str) -> Column:
    """Type of a response member: NULL absent, VOID JSON null, else the type."""
    return json_type(parse(response), f"$.{key}")
