"""The registered queries of this subpackage, by name."""

from __future__ import annotations

from shelfmark.llm import (
    alignment,
    bpe,
    chat,
    decontaminate,
    exact_dedup,
    language,
    line_dedup,
    personal,
    quality,
    simhash,
    token_counts,
    token_files,
    whitening,
)

MODULES = (
    quality, token_counts, exact_dedup, line_dedup, bpe, language, decontaminate, token_files,
    personal, simhash, alignment, whitening, chat,
)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
