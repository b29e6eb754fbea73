"""The corpus operators' queries and their SQL."""

from __future__ import annotations

from starfold.llm import (
    decontaminate, exact_dedup, hard_negatives, language_id, line_dedup, lm_score, pieces, token_files, toxicity,
    trie_join, url_filter, vector_codes, warc,
)

_MODULES = (toxicity, trie_join, exact_dedup, token_files, language_id, url_filter, lm_score, warc, pieces,
            decontaminate, hard_negatives, line_dedup, vector_codes)
QUERIES = {name: f for m in _MODULES for name, f in m.QUERIES.items()}
SQL = {name: s for m in _MODULES for name, s in m.SQL.items()}
