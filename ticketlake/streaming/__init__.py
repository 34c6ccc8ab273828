"""Structured Streaming forms of the page loop (ST1) and the incremental cut (ST2)."""
