"""Record transform and key checks.

``to_rows`` turns exploded items into registry rows: ``{singular}_id`` from
``$.id``, the whole record as ``data``, a load stamp, the parent ``issue_id``
for messages and ``account_id`` for contacts. Items whose key is missing or
falsy go to a reject table instead of failing the whole object (``strict``
restores the reference's fail-fast behaviour).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonx import is_number, json_number, json_str, json_type, json_value
from ..schema import spec


def falsy(item: Column, path: str) -> Column:
    """Python truthiness of the JSON value at ``path``: absent, null, '', 0,
    false, {} and [] are falsy."""
    t, s = json_type(item, path), json_str(item, path)
    return (t.isNull() | (t == "VOID") | (s == "")
            | ((t == "BOOLEAN") & (s == "false"))
            | (is_number(item, path) & (t != "BOOLEAN") & (json_number(item, path) == 0))
            | (t.startswith("OBJECT") & (s == "{}")) | (t.startswith("ARRAY") & (s == "[]")))


def to_rows(items: DataFrame, object_type: str, item: str = "item", parent: str | None = None,
            stamp: Column | None = None, keep=("run_id", "page_no", "pos"), strict: bool = False) -> DataFrame:
    """J5 transform with a ``reject_reason`` column (NULL for valid rows)."""
    s = spec(object_type)
    it = F.col(item)
    reason = F.when(falsy(it, "$.id"), F.lit("missing_id"))
    cols = [json_str(it, "$.id").alias(s.id_col)]
    if object_type == "messages":
        p = F.col(parent or "issue_id")
        reason = reason.when(F.coalesce(p.cast("string"), F.lit("")) == "", F.lit("missing_issue_id"))
        cols = [p.cast("string").alias("issue_id"), json_str(it, "$.id").alias("message_id")]
    if object_type == "contacts":
        cols.append(json_value(it, "$.account_id").alias("account_id"))
    if strict:
        reason = F.when(reason.isNotNull(), F.raise_error(F.concat(F.lit(f"{object_type}: "), reason))) \
                  .otherwise(reason)
    ts = stamp if stamp is not None else F.current_timestamp()
    present = [c for c in keep if c in items.columns]
    return items.select(*cols, it.alias("data"), ts.alias("updated_at"), *present,
                        reason.alias("reject_reason"))


def split_rejects(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows without the reason column, reject rows)."""
    valid = rows.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return valid, rows.where(F.col("reject_reason").isNotNull())
