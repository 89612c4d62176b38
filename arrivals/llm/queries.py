"""Registered queries of the operators on training documents, with their SQL where SQL can say it."""

from __future__ import annotations

from arrivals.llm import (
    decontaminate,
    exactdedup,
    language,
    licenses,
    linededup,
    merkle,
    minhash,
    mixing,
    periods,
    pii,
    quality,
    substring,
    tokens,
)

_MODULES = (quality, mixing, minhash, decontaminate, language, linededup, exactdedup, substring, pii, tokens, periods, merkle, licenses)

QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
