"""Registered queries of the training-data operators."""

from __future__ import annotations

from . import (collocations, decontam, htmltext, langid, licences, lm, ngram_join, packing, pii, rules, sharding, suffix,
               whitening)
from .common import table

QUERIES = {
    "op1_language_id": langid.op1,
    "op2_decontaminate": decontam.op2,
    "op3_shard_hash_tree": lambda s, d: sharding.shard_documents(table(s, d, "documents")),
    "op4_html_tree_scoring": htmltext.op4,
    "op5_gru_scores": lm.op5,
    "op6_pack_linear_grouping": packing.op6,
    "op7_quality_forest": rules.op7,
    "op8_pseudonyms": pii.op8,
    "op9_jaccard_join": ngram_join.op9,
    "op10_sparse_suffix_array": suffix.op10,
    "op11_license_set_join": licences.op11,
    "op12_stripes_collocations": collocations.op12,
    "op13_lanczos_whitening": whitening.op13,
}

ORACLES: dict[str, str] = {
    "op2_decontaminate": decontam.OP2_SQL,
    "op11_license_set_join": licences.OP11_SQL,
    "op12_stripes_collocations": collocations.OP12_SQL,
}
