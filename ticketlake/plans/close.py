"""``close`` (E5) as one plan: candidates -> current state -> classify the
ones missing labels -> closing conversations -> question analysis ->
decision table -> outbox + counters."""

from __future__ import annotations

import datetime as dt
from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prompts import QUESTION_SYSTEM, question_user_text
from ..operators import closing
from ..operators.keysets import restrict_to
from ..operators.runlog import log_run
from ..operators.threads import closing_conversations
from .classify import classify


def question_requests(candidates: DataFrame, convs: DataFrame) -> DataFrame:
    """J13 (question form): (issue_id, conversation, system, user)."""
    j = candidates.select("issue_id").join(convs.select("issue_id", "conversation"), "issue_id", "left") \
                  .withColumn("conversation", F.coalesce("conversation", F.lit("")))
    return j.select("issue_id", "conversation", F.lit(QUESTION_SYSTEM).alias("system"),
                    question_user_text(F.col("conversation"), F.col("issue_id")).alias("user"))


def close(warehouse: DataFrame, current: DataFrame | Callable[[DataFrame], DataFrame], messages: DataFrame, teams: DataFrame,
          as_of: dt.datetime, question_responder: Callable[[DataFrame], DataFrame],
          label_responder: Callable[[DataFrame], DataFrame] | None = None,
          max_records: int | None = None, created_at: Column | None = None, log_path: str | None = None) -> dict:
    """Candidates come from the warehouse table; their current state (closed?
    labels? tags?) from ``current``, the service's latest snapshot, or a
    function that gives the snapshot of the issues it is asked for.

    Messages are read twice: partial maxima of one narrow field over all of
    them, then the candidates' own messages by a semi join. The snapshot is
    read once, for the candidates' current rows.
    The candidate-sized sets are persisted (executor loss -> recomputed from
    lineage) and feed the classification, both conversation forms and the
    decisions, so every later step scales with the number of candidates, not
    with the tables.
    """
    cand = closing.stale_candidates(warehouse, messages, as_of, max_records, ordered=False).persist()
    ids = cand.select("issue_id")
    cur = closing.current_state(ids, current(ids) if callable(current) else restrict_to(current, ids)).persist()
    cand_msgs = restrict_to(messages, ids).persist()
    need = cur.where(~closing.is_closed(F.col("current"))) \
              .select("issue_id", closing.missing_fields(F.col("current")).alias("fields")) \
              .where(F.size("fields") > 0)
    cur_rows = cur.select("issue_id", F.col("current").alias("data"))
    cls = classify(cur_rows, cand_msgs, teams, label_responder, targets=need, created_at=created_at)
    convs = closing_conversations(cand_msgs)
    qreq = question_requests(cand, convs)
    dec = closing.closing_decisions(cand, cur_rows, convs, question_responder(qreq), cls["decisions"]).persist()
    persisted = [cand, cur, cand_msgs, dec] + cls["persisted"]
    out = {"candidates": cand.orderBy("last_message_time", "issue_id"), "decisions": dec,
           "classify_outbox": cls["outbox"], "outbox": closing.close_outbox(dec, created_at),
           "counters": closing.close_counters(dec), "persisted": persisted}
    if log_path:
        log_run(out, log_path, "close")
    return out
