"""Latest row per key, duplicate handling.

``latest_per_key`` is an aggregation, not a window: ``max_by`` over a struct
of (sort column, tie-break columns) is combined map-side, so a key holding a
third of all rows is reduced inside every map task before the shuffle.  Null
key parts group together (null-safe), so re-delivering a row with a null key
part cannot duplicate it (K17).  Rows whose sort value is null lose to any
dated row of the same key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], sort_col: str,
                   tie_break: Sequence[str] = ()) -> DataFrame:
    """One row per ``keys``: greatest ``(sort_col, *tie_break)``."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(F.col(sort_col).isNotNull().alias("_has"), F.col(sort_col).alias("_s"),
                     *[F.col(c).alias(f"_t{i}") for i, c in enumerate(tie_break)])
    picked = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*[F.col(c) for c in rest]), order).alias("_row")))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .filter(F.col("dup_count") > 1))


def remove_duplicates(df: DataFrame, keys: Sequence[str] | None = None,
                      order: Sequence[str] = ()) -> DataFrame:
    """Exact duplicates removed (``keys=None``), or one row per ``keys``.

    With keys, the kept row is the smallest by ``order`` (deterministic),
    chosen with a map-side-combined ``min_by``.
    """
    if keys is None:
        return df.dropDuplicates()
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    ordering = F.struct(*[F.col(c) for c in (list(order) or rest)])
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)
