"""Operators for a training-data pipeline (language id, decontamination,
sharding, page extraction, language-model scoring, packing, quality rules,
pseudonyms, near-duplicate joins, repeated passages). Nothing else in the
library imports this package."""
