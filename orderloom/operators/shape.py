"""Projection and schema shaping: nested-path flatten, drop, rename."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.schemas import AUDIT_COLUMNS, DQ_COLUMNS

Mapping = Iterable[tuple["str | Column", str]]


def flatten(df: DataFrame, mapping: Mapping, head: list[str] | None = None,
            tail: list[str] | None = None) -> DataFrame:
    """One ``select`` of nested paths renamed to flat names.

    ``mapping`` is ``[(path_or_column, alias), ...]``; ``head`` / ``tail``
    default to the audit and DQ columns, passed through unchanged.  A single
    projection keeps nested-column pruning working: the Parquet scan reads
    only the leaves named here.
    """
    head = AUDIT_COLUMNS if head is None else head
    tail = DQ_COLUMNS if tail is None else tail
    cols = [F.col(c) for c in head]
    for src, alias in mapping:
        cols.append((F.col(src) if isinstance(src, str) else src).alias(alias))
    cols += [F.col(c) for c in tail]
    return df.select(*cols)


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop a list of columns; names that are absent are ignored."""
    return df.drop(*names)


def rename(df: DataFrame, old: str, new: str) -> DataFrame:
    return df.withColumnRenamed(old, new)


def unwrap(df: DataFrame, root: str) -> DataFrame:
    """Root-column unwrap: ``root.*`` to top level."""
    return df.select(F.col(f"{root}.*"))
