"""Queries and oracles of the training-data operators, in the operators' order."""

from __future__ import annotations

from tidemark.llm import (
    bpe,
    decontaminate,
    filteraudit,
    language,
    licenses,
    merkle,
    neighbours,
    pii,
    quality,
    sharding,
    simhash,
    suffixdedup,
    urls,
)

MODULES = [suffixdedup, pii, urls, licenses, bpe, simhash, neighbours, language, decontaminate, quality,
           merkle, filteraudit, sharding]

QUERIES = {name: q for m in MODULES for name, q in m.QUERIES.items()}
ORACLE_SQL = {name: sql.strip() for m in MODULES for name, sql in m.ORACLE_SQL.items()}
