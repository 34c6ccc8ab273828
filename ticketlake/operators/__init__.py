"""DataFrame -> DataFrame operators (filters, dedup, merge, threads, triage, closing)."""
