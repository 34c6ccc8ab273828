"""Conversation assembly for every issue in one job (E6, E7, W1, W2, A4, A7, JN1, JN4).

Plan shape (per issue, whatever the skew):

1. first ``head`` and last ``tail`` messages by ``(ts, message_id)`` - one
   ``row_number()`` over (issue, direction) on a doubled row stream (one
   scan, one shuffle). Spark plans it with a *partial* WindowGroupLimit
   before the shuffle, so even an issue holding a third of all messages
   sends at most max(head, tail) rows per direction and map partition.
   Keeping the head copy's ``rn <= head`` and the tail copy's ``rn <= tail``
   equals the reference's "all when n <= head+tail, else first head + last
   tail" for every n.
2. the staff directory is joined *after* truncation (<= head+tail rows per
   issue), one team per e-mail; AQE turns the join into a broadcast when the
   directory's measured size is under the threshold and keeps a shuffle join
   otherwise. ``fan_out=True`` reproduces the reference's duplicate lines for
   staff in several teams (join before truncation).
3. one hash aggregate by issue over <= head+tail rows: distinct, sort, join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.jsonx import json_array, json_value
from ..functions.text import author_email, conversation_line, team_label

TRIAGE_WINDOW = (3, 6)    # first 3 + last 6 when more than 9 messages
CLOSING_WINDOW = (5, 15)  # first 5 + last 15 when more than 20 messages


def message_rows(messages: DataFrame) -> DataFrame:
    """Messages table -> (issue_id, message_id, author, ts, body) as text."""
    d = F.col("data")
    return messages.select(
        "issue_id",
        json_value(d, "$.id").alias("message_id"),
        author_email(json_value(d, "$.author.user.email"),
                     json_value(d, "$.author.contact.email")).alias("author"),
        json_value(d, "$.timestamp").alias("ts"),
        json_value(d, "$.message_html").alias("body"))


def staff_directory(teams: DataFrame) -> DataFrame:
    """DISTINCT (email, user_id, team_name) over every team's users (A4 with
    the lateral unnest J2/JN4); teams without a users array add nothing."""
    d = F.col("data")
    u = teams.select(json_value(d, "$.name").alias("team_name"),
                     F.explode(json_array(d, "$.users")).alias("u"))
    return u.select(json_value("u", "$.email").alias("email"),
                    json_value("u", "$.id").alias("user_id"), "team_name").distinct()


def team_by_email(directory: DataFrame) -> DataFrame:
    """One team per staff e-mail (the alphabetically first)."""
    return (directory.where(F.col("email").isNotNull())
            .groupBy("email").agg(F.min("team_name").alias("team_name")))


def truncate_thread(rows: DataFrame, head: int, tail: int,
                    order: tuple = ("ts", "message_id"), by: str = "issue_id") -> DataFrame:
    """Rows among the first ``head`` or the last ``tail`` of each thread.

    One scan, one shuffle: every row is emitted twice, tagged with a
    direction, and one ``row_number`` runs over ``(thread, direction)``; the
    sort keys are conditional, so the head copy orders ascending and the tail
    copy descending. The explicit ``rn <= max(head, tail)`` conjunct lets
    Spark infer a partial WindowGroupLimit before the shuffle, so a thread
    holding a third of all rows still sends at most ``max(head, tail)`` rows
    per direction and map task. A row can come back twice (threads shorter
    than head+tail); callers take distinct rows.
    """
    is_head = F.col("_dir") == 0
    keys = []
    for c in order:
        keys += [F.when(is_head, F.col(c)).asc_nulls_first(), F.when(~is_head, F.col(c)).desc_nulls_last()]
    w = Window.partitionBy(by, "_dir").orderBy(*keys)
    rn = F.col("_rn")
    keep = (rn <= max(head, tail)) & (rn <= F.when(is_head, F.lit(head)).otherwise(F.lit(tail)))
    return (rows.withColumn("_dir", F.explode(F.array(F.lit(0), F.lit(1))))
            .withColumn("_rn", F.row_number().over(w)).where(keep).drop("_rn", "_dir"))


def assemble(kept: DataFrame, line: Column, order: tuple, by: str = "issue_id") -> DataFrame:
    """Ordered newline-joined text per thread from <= head+tail rows."""
    ent = F.struct(*[F.col(c) for c in order], line.alias("line"))
    agg = kept.groupBy(by).agg(F.array_sort(F.array_distinct(F.collect_list(ent))).alias("_e"))
    return agg.select(by, F.size("_e").cast("long").alias("n_lines"),
                      F.array_join(F.transform("_e", lambda x: x["line"]), "\n").alias("conversation"))


def conversations(rows: DataFrame, directory: DataFrame | None = None,
                  window: tuple = TRIAGE_WINDOW, fan_out: bool = False) -> DataFrame:
    """(issue_id, n_lines, conversation) for every issue with messages.

    ``rows`` has (issue_id, message_id, author, ts, body). With a directory the
    triage form ``[ts] author(team): body`` is produced, else the closing
    form ``[ts] author: body``. Issues without messages are absent (callers
    left-join and read a missing conversation as '').
    """
    head, tail = window
    order = ("ts", "message_id")
    if directory is not None and fan_out:
        d = directory.select(F.col("email").alias("_email"), "user_id", "team_name")
        rows = rows.join(d, rows.author == d._email, "left").drop("_email")
        order = ("ts", "message_id", "team_name", "user_id")
    kept = truncate_thread(rows, head, tail, order)
    if directory is not None and not fan_out:
        t = team_by_email(directory).withColumnRenamed("email", "_email")
        kept = kept.join(t, kept.author == t._email, "left").drop("_email")
    team = team_label(F.col("team_name")) if directory is not None else None
    line = conversation_line(F.col("ts"), F.col("author"), F.col("body"), team)
    return assemble(kept, line, order)


def triage_conversations(messages: DataFrame, teams: DataFrame, fan_out: bool = False) -> DataFrame:
    """Triage form (team labels, 3+6 window) from the warehouse tables."""
    return conversations(message_rows(messages), staff_directory(teams), TRIAGE_WINDOW, fan_out)


def closing_conversations(messages: DataFrame) -> DataFrame:
    """Closing form (no team join, 5+15 window) from the messages table."""
    return conversations(message_rows(messages), None, CLOSING_WINDOW)
