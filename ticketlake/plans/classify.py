"""``classify`` (E4) as one plan."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import FIELDS
from ..operators import scorer, triage
from ..operators.keysets import restrict_to
from ..operators.runlog import log_run
from ..operators.threads import triage_conversations


def classify(issues: DataFrame, messages: DataFrame, teams: DataFrame,
             responder: Callable[[DataFrame], DataFrame] | None = None,
             fields=FIELDS, targets: DataFrame | None = None, created_start: str | None = None,
             created_end: str | None = None, max_records: int | None = None, debug: bool = False,
             created_at: Column | None = None, log_path: str | None = None) -> dict:
    """Returns ``{"decisions", "outbox", "counters", "requests"}`` DataFrames
    and ``"persisted"``, the cached intermediates (``plans.release`` them
    once the outputs are written).

    ``responder(requests) -> (issue_id, response)``; default: keyword scorer.
    ``targets`` (issue_id[, fields]) replaces the unclassified selection (the
    single-issue form and the closing flow). With ``log_path`` the run's
    counters are computed now and go to the run log (I10).
    """
    snapshot = issues
    persisted = []
    if targets is None:
        # one read of the issues table: the target set (with tags) is
        # persisted and feeds the message semi join, the requests and the
        # decisions; unsorted unless a record cap needs the order
        targets = triage.unclassified(issues, fields, created_start, created_end, max_records,
                                      ordered=False, with_tags=True) \
                        .select("issue_id", F.array(*[F.lit(f) for f in fields]).alias("fields"), "tags") \
                        .persist()
        persisted.append(targets)
        snapshot = targets.select("issue_id", "tags")
    convs = triage_conversations(restrict_to(messages, targets), teams)
    reqs = triage.requests(targets, convs, debug=debug)
    if responder is None:
        kw = scorer.keyword_table(issues.sparkSession)
        responder = lambda r: scorer.keyword_responses(r, kw)
    resp = responder(reqs)
    # The decision table feeds the outbox, the counters and the closing flow:
    # computed once (executor loss -> recomputed from lineage). Persisting also
    # keeps a filter on its outputs from being inlined into the parse chain.
    dec = triage.decisions(reqs, resp, snapshot).persist()
    out = {"requests": reqs, "decisions": dec,
           "outbox": triage.update_outbox(dec, created_at), "counters": triage.counters(dec),
           "persisted": persisted + [dec]}
    if log_path:
        log_run(out, log_path, "classify")
    return out
