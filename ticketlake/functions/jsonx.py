"""JSON payload functions over VARIANT columns.

The payload of every table is parsed once into a VARIANT; paths are read with
``try_variant_get``. ``json_value`` follows warehouse ``JSON_VALUE`` rules: a
scalar comes back as text; a missing path, a JSON null, an object and an
array all come back as NULL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Output timestamp formats (RFC 3339, UTC, 'Z' suffix).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TS_FORMAT_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse(text: Column | str) -> Column:
    """JSON text -> VARIANT; malformed text -> NULL."""
    return F.try_parse_json(_c(text))


def json_str(v: Column | str, path: str) -> Column:
    """Plain text extraction. Objects/arrays come back as JSON text; use this
    form for equality predicates so the filter can reach the scan."""
    return F.try_variant_get(_c(v), path, "string")


def json_type(v: Column | str, path: str) -> Column:
    """Variant type name at ``path`` ('VOID' for JSON null, NULL when absent)."""
    return F.schema_of_variant(F.try_variant_get(_c(v), path, "variant"))


def json_value(v: Column | str, path: str) -> Column:
    """Scalar at ``path`` as text; missing, JSON null, object, array -> NULL."""
    t = json_type(v, path)
    return F.when(~(t.startswith("OBJECT") | t.startswith("ARRAY")), json_str(v, path))


def json_array(v: Column | str, path: str) -> Column:
    """Array at ``path`` as ``array<variant>``; missing or non-array -> NULL."""
    return F.try_variant_get(_c(v), path, "array<variant>")


def json_ts(v: Column | str, path: str, strict: bool = True) -> Column:
    """RFC 3339 text at ``path`` -> TIMESTAMP (session zone UTC).

    ``strict`` follows the reference: malformed text is an error (ANSI cast);
    otherwise malformed text becomes NULL.
    """
    s = json_value(v, path)
    return s.cast("timestamp") if strict else F.try_to_timestamp(s)


def typed_name(member: str) -> str:
    """Column of a stored table that holds a member of the record as itself."""
    return f"_t_{member}"


def typed_copy(v: Column | str, member: str, kind: str) -> Column:
    """A member as stored beside the record. A time that does not parse is
    NULL, so a record is stored whatever it holds."""
    return json_ts(v, f"$.{member}", strict=False) if kind == "timestamp" else json_str(v, f"$.{member}").cast(kind)


def text_of(rows: DataFrame, member: str, data: str = "data") -> Column:
    """Text of a top-level member: the stored column where the table was read
    with its typed columns (a plain comparison reaches the files' statistics),
    else extracted from the record."""
    return F.col(typed_name(member)) if typed_name(member) in rows.columns else json_str(data, f"$.{member}")


def time_of(rows: DataFrame, member: str, data: str = "data") -> Column:
    """A top-level member as TIMESTAMP, in the same way."""
    return F.col(typed_name(member)) if typed_name(member) in rows.columns else json_ts(data, f"$.{member}")


def to_text_ts(ts: Column | str, micros: bool = False) -> Column:
    """TIMESTAMP -> RFC 3339 text with a 'Z' suffix."""
    return F.date_format(_c(ts), TS_FORMAT_MICROS if micros else TS_FORMAT)


def is_number(v: Column | str, path: str) -> Column:
    """True when the value at ``path`` is a JSON number or boolean (a Python
    bool compares as a number)."""
    t = json_type(v, path)
    return (t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT", "BOOLEAN")
            | t.startswith("DECIMAL"))


def json_number(v: Column | str, path: str) -> Column:
    """Numeric value at ``path`` as DOUBLE when it is a number/boolean, else NULL."""
    t = json_type(v, path)
    boolean = F.try_variant_get(_c(v), path, "boolean").cast("double")
    num = F.try_variant_get(_c(v), path, "double")
    return F.when(t == "BOOLEAN", boolean).when(is_number(v, path), num)


def unwrap(v: Column | str, key: str = "data") -> Column:
    """Point-lookup body: the ``data`` member when present, else the body."""
    inner = F.try_variant_get(_c(v), f"$.{key}", "variant")
    return F.when(json_type(v, f"$.{key}").startswith("OBJECT"), inner).otherwise(_c(v))
