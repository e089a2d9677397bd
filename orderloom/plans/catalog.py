"""Registry of named queries and their DuckDB oracles."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from orderloom.session import apply_defaults

Query = Callable[[SparkSession, str], DataFrame]


def _modules():
    from orderloom.plans import q_pipelines, q_relational, q_streams, q_text
    return [q_pipelines, q_relational, q_text, q_streams]


def _wrap(fn: Query) -> Query:
    @functools.wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_defaults(spark)
        return fn(spark, sf_dir)
    return run


def queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for m in _modules():
        for name, fn in m.QUERIES.items():
            out[name] = _wrap(fn)
    return out


def oracles() -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _modules():
        out.update(m.ORACLES)
    return out


def query(name: str) -> Query:
    return queries()[name]
