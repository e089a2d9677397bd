"""Queries and DuckDB oracles of the training-data operators."""

from __future__ import annotations

from orderloom.llm import (chat, decontaminate, exactdup, infill, lloyd, mixing, neardup, quality, secretscan,
                           sharding, suffixdup, tokenfiles, vectordup)

MODULES = [mixing, suffixdup, quality, chat, neardup, decontaminate, vectordup, sharding, tokenfiles, secretscan,
           infill, lloyd, exactdup]

QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
ORACLES = {name: sql for m in MODULES for name, sql in m.ORACLES.items()}
