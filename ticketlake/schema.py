"""Object registry and warehouse table schemas (section 1.2 of the survey).

Each object type maps to a table with explicit key columns, the whole record
as a VARIANT ``data`` column and a load-time ``updated_at`` stamp.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T


@dataclass(frozen=True)
class ObjectSpec:
    name: str            # object type, e.g. "issues"
    table: str           # warehouse table name
    keys: tuple          # primary key columns
    pagination: str      # "cursor", "offset" or "none" (messages: one call per issue)
    extra: tuple = ()    # optional non-key columns lifted from the record
    typed: tuple = ()    # (member, type): kept as plain columns beside the record, for filters
    cluster: tuple = ()  # members by which stored files are sorted, before the keys

    @property
    def id_col(self) -> str:
        """``{singular}_id``: the type name minus its last letter."""
        return f"{self.name[:-1]}_id"


# Object registry (type, table, keys, pagination), in replication order.
OBJECTS = {
    "accounts": ObjectSpec("accounts", "accounts", ("account_id",), "cursor"),
    "issues": ObjectSpec("issues", "issues", ("issue_id",), "cursor", (),
                         (("state", "string"), ("source", "string"), ("created_at", "timestamp"), ("modified_at", "timestamp")),
                         ("state", "modified_at")),
    "messages": ObjectSpec("messages", "messages", ("issue_id", "message_id"), "none", (), (("timestamp", "timestamp"),)),
    "contacts": ObjectSpec("contacts", "contacts", ("contact_id",), "offset", ("account_id",)),
    "users": ObjectSpec("users", "users", ("user_id",), "offset"),
    "teams": ObjectSpec("teams", "teams", ("team_id",), "offset"),
}
REPLICATION_ORDER = tuple(OBJECTS)


def spec(object_type: str) -> ObjectSpec:
    try:
        return OBJECTS[object_type]
    except KeyError:
        raise ValueError(f"Unknown object type: {object_type}") from None


def table_schema(object_type: str) -> T.StructType:
    """Registry columns: keys STRING NOT NULL, extras STRING NULL, data
    VARIANT, updated_at TIMESTAMP NOT NULL (always the full column set)."""
    s = spec(object_type)
    fields = [T.StructField(k, T.StringType(), False) for k in s.keys]
    fields += [T.StructField(k, T.StringType(), True) for k in s.extra]
    fields += [T.StructField("data", T.VariantType(), True),
               T.StructField("updated_at", T.TimestampType(), False)]
    return T.StructType(fields)


# Flattened issue table (read only): id, created_at, latest_message_time, state (display form).
FLAT_ISSUE_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
    T.StructField("latest_message_time", T.TimestampType(), True),
    T.StructField("state", T.StringType(), True),
])

# Outbox of updates to send back to the service.
OUTBOX_SCHEMA = T.StructType([
    T.StructField("issue_id", T.StringType(), False),
    T.StructField("kind", T.StringType(), False),
    T.StructField("payload", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), True),
])

# Page envelope as landed: {"data": [...], "pagination": {...}} (plus offset for offset paging).
PAGE_SCHEMA = ("data array<variant>, "
               "pagination struct<has_next_page:boolean,cursor:string,offset:bigint>")
