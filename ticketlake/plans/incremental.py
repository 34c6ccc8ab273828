"""Incremental runs (ST2, E4, E6): only what changed since the last run.

A keyed table's versions say what was written after a mark, so a run reads
the changed rows' issue ids from the newer versions, rebuilds the
conversations of these issues alone and merges them into a table of
conversations. The mark is stored beside that table after the merge; a run
that fails before is simply done again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.keysets import restrict_to
from ..operators.merge import KeyedTable
from ..operators.threads import triage_conversations

CONVERSATIONS = T.StructType([
    T.StructField("issue_id", T.StringType(), False), T.StructField("n_lines", T.LongType(), True),
    T.StructField("conversation", T.StringType(), True), T.StructField("updated_at", T.TimestampType(), False)])


def conversation_table(spark, path: str) -> KeyedTable:
    return KeyedTable(spark, path, keys=["issue_id"], schema=CONVERSATIONS)


def _mark_path(table: KeyedTable, source: str, n: int) -> str:
    return f"{table.path}/_marks/{source}-{n:010d}.json"


def mark_of(table: KeyedTable, source: str) -> int:
    """The newest version of ``source`` that ``table`` has taken in; -1: none."""
    names = [x for x in table.files.names(f"{table.path}/_marks") if x.startswith(f"{source}-") and x.endswith(".json")]
    return json.loads(table.files.text(f"{table.path}/_marks/{names[-1]}"))["version"] if names else -1


def touched_issues(messages: KeyedTable, after: int) -> tuple[DataFrame, int]:
    """(issue ids with a message written after version ``after``, the newest
    version). Only the newer versions are read, and of them only the id."""
    rows, newest = messages.changes(after)
    return rows.select("issue_id").distinct(), newest


def refresh_conversations(messages: KeyedTable, teams: DataFrame, target: KeyedTable, full_refresh: bool = False) -> DataFrame:
    """E6 incrementally: the conversations of the issues touched since the
    last run (of all with ``full_refresh``), merged into ``target``. Returns
    the ids of the rebuilt issues.

    The messages table is read for touched issues only: their ids bound the
    scan by a pushed range (rows lie sorted by issue, so row groups outside are
    skipped) and cut it by a semi join before anything is assembled. The
    teams table is taken as it is now; a changed team reaches conversations
    that are touched later, or all by ``full_refresh``.
    """
    after = -1 if full_refresh else mark_of(target, "messages")
    ids, newest = touched_issues(messages, after)
    ids = ids.persist()
    try:
        low, high = ids.agg(F.min("issue_id"), F.max("issue_id")).first()
        target.create()
        if low is not None:
            own = restrict_to(messages.read().where(F.col("issue_id").between(low, high)), ids)
            convs = triage_conversations(own, teams).withColumns({"updated_at": F.current_timestamp(), "page_no": F.lit(0).cast("long"),
                                                                  "pos": F.lit(0).cast("long")})
            target.upsert(convs)
        if newest > mark_of(target, "messages"):
            target.files.put_if_absent(_mark_path(target, "messages", newest), json.dumps({"version": newest}))
    finally:
        ids.unpersist()
    return touched_issues(messages, after)[0]
