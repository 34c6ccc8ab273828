"""Text functions for conversation assembly.

All built-in regex/replace expressions, so they stay inside whole-stage
codegen. The whitespace class is built from a rule (``str.isspace`` over all
code points) so it equals Python's Unicode ``\\s`` exactly; the same pattern
runs on Java regex and RE2.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F


def _whitespace_class() -> str:
    ranges, start, prev = [], None, None
    for cp in range(sys.maxunicode + 1):
        if chr(cp).isspace():
            if start is None:
                start = cp
            elif cp != prev + 1:
                ranges.append((start, prev))
                start = cp
            prev = cp
    ranges.append((start, prev))
    parts = [f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges]
    return "[" + "".join(parts) + "]"


# Whitespace as Python's str.isspace defines it (includes U+001C-U+001F, U+0085).
WHITESPACE_RUN = _whitespace_class() + "+"

# Tag pattern and the entities decoded, in the order applied.
TAG_PATTERN = "<[^>]+>"
ENTITIES = [
    ("&nbsp;", " "),
    ("&amp;", "&"),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
]
# Team label for non-staff authors, printed form of a null.
CUSTOMER = "Customer"
NONE_TEXT = "None"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_html(html: Column | str) -> Column:
    """NULL/'' -> ''; drop tags (no space put in); decode six entities in order
    (so ``&amp;lt;`` -> ``<``); collapse whitespace runs to one space; trim."""
    t = F.regexp_replace(F.coalesce(_c(html), F.lit("")), TAG_PATTERN, "")
    for ent, rep in ENTITIES:
        t = F.replace(t, F.lit(ent), F.lit(rep))
    t = F.regexp_replace(t, WHITESPACE_RUN, " ")
    return F.trim(t)


def author_email(user_email: Column | str, contact_email: Column | str) -> Column:
    """Staff user email first, then the contact email."""
    return F.coalesce(_c(user_email), _c(contact_email))


def team_label(team_name: Column | str) -> Column:
    """Team of the author, 'Customer' when not in the staff directory."""
    return F.coalesce(_c(team_name), F.lit(CUSTOMER))


def _printed(c: Column) -> Column:
    return F.coalesce(c, F.lit(NONE_TEXT))


def conversation_line(ts: Column | str, author: Column | str, body_html: Column | str,
                      team: Column | str | None = None) -> Column:
    """``[ts] author(team): body`` (J9). ``(team)`` is left out for customers
    and in the closing form (``team=None``); NULL ts/author print ``None``."""
    who = _printed(_c(author))
    if team is not None:
        t = _c(team)
        who = F.when(t != F.lit(CUSTOMER), F.concat(who, F.lit("("), t, F.lit(")"))).otherwise(who)
    return F.concat(F.lit("["), _printed(_c(ts)), F.lit("] "), who, F.lit(": "), strip_html(body_html))
