"""``truncate <table>`` (E8): empty a keyed table with a before/after audit row."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.merge import KeyedTable
from ..operators.runlog import append_run_log, log_failure


def truncate(table: KeyedTable, name: str | None = None, log_path: str | None = None) -> DataFrame:
    """The audit row; it, or the failure, goes to the run log."""
    try:
        audit = table.truncate(name)
    except Exception as e:
        if log_path:
            log_failure(table.spark, log_path, "truncate", e)
        raise
    if log_path:
        append_run_log(audit, log_path, "truncate")
    return audit
