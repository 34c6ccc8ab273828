"""Column -> Column helpers (all built-in Spark expressions)."""
