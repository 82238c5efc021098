"""Registered queries of the training-data operators, one for each, and their DuckDB SQL."""
from __future__ import annotations

from . import (chat_format, decontamination, hard_negatives, language_id, lexical_search, line_dedup, ngram_join, packing,
               quality_rules, sharding, simhash, substring_dedup, token_counts)
from .common import table


def _over(op, *names):
    return lambda spark, sf_dir: op(spark, *(table(spark, sf_dir, n) for n in names))


QUERIES = {
    "op1_decontamination": _over(decontamination.op1, "documents", "benchmark"),
    "op2_substring_dedup": _over(substring_dedup.op2, "documents"),
    "op3_line_dedup": _over(line_dedup.op3, "documents"),
    "op4_quality_rules": _over(quality_rules.op4, "documents"),
    "op5_token_counts": _over(token_counts.op5, "documents"),
    "op6_ngram_join": _over(ngram_join.op6, "documents"),
    "op7_packing": _over(packing.op7, "documents"),
    "op8_chat_format": _over(chat_format.op8, "conversations"),
    "op9_language_id": _over(language_id.op9, "documents"),
    "op10_sharding": _over(sharding.op10, "documents"),
    "op11_lexical_search": _over(lexical_search.op11, "documents", "benchmark"),
    "op12_hard_negatives": _over(hard_negatives.op12, "embeddings"),
    "op13_simhash": _over(simhash.op13, "documents"),
}
