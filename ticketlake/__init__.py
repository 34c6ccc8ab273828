"""Ticketlake: support-desk data work as Spark DataFrame jobs.

Landed API pages become keyed tables with a VARIANT payload; the tables are
deduplicated and upserted in batch or with Structured Streaming; issues are
selected by time and state; conversations are assembled for every issue in one
distributed job; scored responses are gated into an outbox of updates.
"""

__version__ = "0.1.0"
