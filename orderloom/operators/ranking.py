"""Ranking windows: nth highest, top-n per group.

Filters of the form ``rank <= n`` / ``rank = n`` over ``rank``,
``dense_rank`` or ``row_number`` let Catalyst insert a partial
``WindowGroupLimit`` before the shuffle, so each map task forwards at most
the rows that can still reach rank n for each group.  ``rank`` and ``dense_rank``
are taken over distinct values with counts and joined back, so rows tied near
the top do not meet in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.operators.joins import BROADCAST_MAX_BYTES, fixed_width

RANKERS = {"rank": F.rank, "dense_rank": F.dense_rank, "row_number": F.row_number}


def _order(order_col: str, tie_break: Sequence[str]) -> list[Column]:
    return [F.col(order_col).desc()] + [F.col(c).asc() for c in tie_break]


def ranked(df: DataFrame, order_col: str, kind: str = "rank",
           partition_by: Sequence[str] = (), tie_break: Sequence[str] = (),
           name: str = "rnk") -> DataFrame:
    w = Window.orderBy(*_order(order_col, tie_break))
    if partition_by:
        w = Window.partitionBy(*partition_by).orderBy(*_order(order_col, tie_break))
    return df.withColumn(name, RANKERS[kind]().over(w))


def _distinct_ranks(df: DataFrame, order_col: str, kind: str, group: Sequence[str], n: int,
                    name: str) -> DataFrame:
    """``(*group, value)`` with its rank, for values that can be within ``n``.

    Ranks are taken over distinct values with their counts (combined before
    the shuffle), so rows tied at one value cost one row a task.  The best n
    distinct values are found first under a partial group limit.
    """
    values = df.groupBy(*group, order_col).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*group) if group else Window
    best = (values.withColumn("_pos", F.row_number().over(w.orderBy(F.col(order_col).desc())))
            .filter(F.col("_pos") <= n))
    if kind == "dense_rank":
        return best.select(*group, order_col, F.col("_pos").alias(name))
    before = w.orderBy("_pos").rowsBetween(Window.unboundedPreceding, -1)
    rnk = (F.coalesce(F.sum("_c").over(before), F.lit(0)) + 1).cast("int")
    return best.select(*group, order_col, rnk.alias(name)).filter(F.col(name) <= n)


def _small(df: DataFrame, group: Sequence[str], order_col: str, n: int) -> bool:
    """Whether n values of each group surely fit a broadcast: by their number,
    which groups bound, and their types.  The ranking itself is not run."""
    if not group:
        return True  # n rows
    width = fixed_width(df.select(*group, order_col).schema)
    if width is None:
        return False
    most = BROADCAST_MAX_BYTES // (n * width)
    return df.select(*group).distinct().limit(most + 1).count() <= most


def _of_values(df: DataFrame, values: DataFrame, group: Sequence[str], order_col: str, n: int) -> DataFrame:
    """Rows of ``df`` with one of the ranked values (null matches null)."""
    keys = [*group, order_col]
    v = values.select(*[F.col(k).alias(f"_v{i}") for i, k in enumerate(keys)],
                      *[c for c in values.columns if c not in keys])
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_v{i}")) for i, k in enumerate(keys)])
    v = F.broadcast(v) if _small(df, group, order_col, n) else v
    return df.join(v, cond).drop(*[f"_v{i}" for i in range(len(keys))])


def nth_highest(df: DataFrame, order_col: str, n: int, kind: str = "rank",
                tie_break: Sequence[str] = (), partition_by: Sequence[str] = ()) -> DataFrame:
    """Rows ranked exactly ``n`` (may be empty for ``rank`` when ties skip n)."""
    if kind == "row_number":
        return (ranked(df, order_col, kind, partition_by, tie_break, "_rnk")
                .filter(F.col("_rnk") == n).drop("_rnk"))
    values = _distinct_ranks(df, order_col, kind, partition_by, n, "_rnk").filter(F.col("_rnk") == n)
    return _of_values(df, values.drop("_rnk"), partition_by, order_col, n)


def top_n_per_group(df: DataFrame, group: Sequence[str], order_col: str, n: int,
                    kind: str = "dense_rank", tie_break: Sequence[str] = (),
                    name: str = "rnk") -> DataFrame:
    """Rows whose rank within their group is at most ``n``."""
    if kind == "row_number":
        return ranked(df, order_col, kind, group, tie_break, name).filter(F.col(name) <= n)
    return _of_values(df, _distinct_ranks(df, order_col, kind, group, n, name), group, order_col, n)


def extremes(df: DataFrame, col: str, k: int = 2) -> DataFrame:
    """Largest and smallest ``k`` distinct values as rows ``(kind, pos, value)``.

    Distinct values first (partial aggregation), then two rankings filtered to
    ``<= k`` (partial window-group limits keep k values per task).
    """
    vals = df.select(col).filter(F.col(col).isNotNull()).distinct()
    parts = []
    for kind, order in (("max", F.col(col).desc()), ("min", F.col(col).asc())):
        pos = F.row_number().over(Window.orderBy(order))
        parts.append(vals.select(F.lit(kind).alias("kind"), pos.alias("pos"),
                                 F.col(col).alias("value")).filter(F.col("pos") <= k))
    return parts[0].unionByName(parts[1])
