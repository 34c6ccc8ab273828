"""Request texts for the scorer.

The instruction texts below are fixed values: the scorer must receive the
same text as the reference sends. The system text for each variant is a
constant computed once on the driver; per-issue text is a ``concat`` column.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .labels import CATEGORIES, RESOLUTIONS

# ---------------------------------------------------------------------------
# Instruction sections, in the order they are composed.
SCOPE_RESOLUTION = (
    "Scope: You are an expert customer support analyst. Based on the conversation "
    "history provided, classify the resolution type for this closed support issue.")
SCOPE_CATEGORY = (
    "Scope: You are an expert customer support analyst. Based on the conversation "
    "history provided, classify the category type for this support issue.")
SCOPE_COMBINED = (
    "Scope: You are an expert customer support analyst. Based on the conversation history "
    "provided, classify both the resolution type and the category for this closed support issue.")
CATEGORY_FOCUS = (
    "Base your classification on the primary nature of the customer's issue or request.\n"
    "If multiple issues or topics are discussed, prioritize the most important one.")
IMPORTANT_RULES = """<Important Rules>
Identify LangChain vs customer based on the email address. All langchain emails are from langchain.dev
Weigh the initial few messages and the last few messages higher than the middle messages.
Weigh the LangChain emails higher than the customer emails to determine resolution
Base your classification on the actual resolution described in the conversation, not just the final outcome.
If multiple issues or topics are discussed, prioritize the most important one.
</Important Rules>"""
OUTPUT_RESOLUTION = ("Return a JSON object with: resolution (string - must be exact key from options) "
                     "and confidence (number 0.0-1.0).")
OUTPUT_RESOLUTION_DEBUG = ("Return a JSON object with: resolution (string - must be exact key from options), "
                           "confidence (number 0.0-1.0), and resolution_reason (one sentance on how the "
                           "decision was made).")
OUTPUT_CATEGORY = ("Return a JSON object with: category (string - must be exact key from options) "
                   "and confidence (number 0.0-1.0).")
OUTPUT_CATEGORY_DEBUG = ("Return a JSON object with: category (string - must be exact key from options), "
                         "confidence (number 0.0-1.0) and category_reason (one sentance on how the "
                         "decision was made).")
OUTPUT_COMBINED = ("Return a JSON object with: resolution (string - exact key), resolution_confidence "
                   "(number 0.0-1.0), category (string - exact key), category_confidence (number 0.0-1.0).")
OUTPUT_COMBINED_DEBUG = ("Return a JSON object with: resolution (string - exact key), resolution_confidence "
                         "(number 0.0-1.0), resolution_reason (one sentence), category (string - exact key), "
                         "category_confidence (number 0.0-1.0), category_reason (one sentence).")
EMPTY_HISTORY = "<Conversation History>\n\n</Conversation History>"
QUESTION_SYSTEM = """Scope: You are an expert customer support analyst. Based on the conversation history provided, extract all customer questions and determine if they have been resolved.

<Important Rules>
Identify LangChain vs customer based on the email address. All langchain emails are from langchain.dev
Focus only on actual questions asked by the customer (non-LangChain participants).
A question is resolved if there's a clear answer or solution provided by LangChain team members.
Questions can be explicit (with ?) or implicit requests for help/information.
Ignore purely conversational or acknowledgment messages.
Extract a simple summary of each question, not the full text.
</Important Rules>

<Output Format>
Return a JSON object with:
- pylon_issue_id (string): The Pylon issue ID provided
- questions (array): Each question object with:
  - id (number): Sequential ID starting from 1
  - question (string): Simple summary of the customer question
  - resolved (boolean): Whether this question was answered/resolved
- quantity (integer): Number of questions in the array
- all_resolved (boolean): Whether ALL customer questions were resolved

Example:
{
  "pylon_issue_id": "abc-123",
  "questions": [
    {"id": 1, "question": "How to configure LangChain with custom model", "resolved": true},
    {"id": 2, "question": "Why is deployment failing", "resolved": false}
  ],
  "quantity": "2",
  "all_resolved": false
}
</Output Format>

{_CONVERSATION_HISTORY}"""
HISTORY_OPEN, HISTORY_CLOSE = "<Conversation History>\n", "\n</Conversation History>"
ISSUE_ID_PREFIX = "\n\nPylon Issue ID: "
# End of fixed values.
# ---------------------------------------------------------------------------


def _options(rows) -> str:
    """Label options as rendered in the instructions (a mapping literal)."""
    return str({k: {"description": d, "examples": e} for k, d, e in rows})


def system_text(fields, debug: bool = False) -> str:
    """System instructions for a field set: one field -> that field's
    variant, otherwise the combined one."""
    fields = list(fields)
    res, cat = _options(RESOLUTIONS), _options(CATEGORIES)
    if len(fields) == 1 and "resolution" in fields:
        out = OUTPUT_RESOLUTION_DEBUG if debug else OUTPUT_RESOLUTION
        parts = [SCOPE_RESOLUTION, IMPORTANT_RULES, f"<Resolution Categories>\n{res}", out, EMPTY_HISTORY]
        return "\n\n".join(parts)
    if len(fields) == 1:
        out = OUTPUT_CATEGORY_DEBUG if debug else OUTPUT_CATEGORY
        parts = [f"{SCOPE_CATEGORY}\n{CATEGORY_FOCUS}", IMPORTANT_RULES,
                 f"<Categories>\n{cat}\n</Categories>\n", out, EMPTY_HISTORY]
        return "\n\n".join(parts)
    out = OUTPUT_COMBINED_DEBUG if debug else OUTPUT_COMBINED
    parts = [SCOPE_COMBINED, IMPORTANT_RULES, f"<Resolutions>\n{res}\n</Resolutions>",
             f"<Categories>\n{cat}\n</Categories>", out, EMPTY_HISTORY]
    return "\n\n".join(parts)


def system_for(fields: Column, debug: bool = False) -> Column:
    """Per-row system text from an ``array<string>`` of fields to classify."""
    n = F.size(fields)
    return (F.when((n == 1) & F.array_contains(fields, "resolution"), F.lit(system_text(["resolution"], debug)))
             .when(n == 1, F.lit(system_text(["category"], debug)))
             .otherwise(F.lit(system_text(["resolution", "category"], debug))))


def user_text(conversation: Column) -> Column:
    return F.concat(F.lit(HISTORY_OPEN), conversation, F.lit(HISTORY_CLOSE))


def question_user_text(conversation: Column, issue_id: Column) -> Column:
    return F.concat(user_text(conversation), F.lit(ISSUE_ID_PREFIX), issue_id)
