"""Joins with a size-checked broadcast, range joins and pairings.

Broadcast is only ever applied behind a check: ``sized_broadcast`` measures
the side's size (fixed widths plus actual value bytes) and returns a plain
(shuffle-joinable) DataFrame beyond the bound.  AQE can still turn a shuffle
join into a broadcast at run time when the measured shuffle size is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.operators.sweep import sweep_join

# Broadcast bound for a dimension side (bytes, estimated).
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_FIXED = {T.DecimalType: 16, T.LongType: 8, T.DoubleType: 8, T.TimestampType: 8,
          T.TimestampNTZType: 8, T.DateType: 4, T.IntegerType: 4, T.FloatType: 4,
          T.ShortType: 2, T.ByteType: 1, T.BooleanType: 1}
_ROW_OVERHEAD = 16


def fixed_width(schema: T.StructType) -> int | None:
    """Bytes of a broadcast row, None if a column's width is not fixed."""
    widths = [_FIXED.get(type(f.dataType)) for f in schema.fields]
    return None if None in widths else _ROW_OVERHEAD + sum(widths)


def measured_bytes(df: DataFrame) -> int:
    """Size of ``df`` as broadcast rows: fixed widths plus the actual byte
    length of every variable-width value (nested values via their JSON text),
    by one aggregate.
    """
    fixed = _ROW_OVERHEAD + sum(_FIXED.get(type(f.dataType), 0) for f in df.schema.fields)
    var = []
    for f in df.schema.fields:
        if type(f.dataType) in _FIXED:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.StringType, T.BinaryType)):
            var.append(F.coalesce(F.sum(F.octet_length(c)), F.lit(0)))
        else:
            var.append(F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(c)))), F.lit(0)))
    row = df.agg(F.count(F.lit(1)).alias("n"), *[v.alias(f"v{i}") for i, v in enumerate(var)]).first()
    return row["n"] * fixed + sum(row[f"v{i}"] for i in range(len(var)))


def sized_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """``broadcast(df)`` only if its measured size is within ``max_bytes``."""
    if df.isStreaming:
        return df
    return F.broadcast(df) if measured_bytes(df) <= max_bytes else df


def join_dimension(fact: DataFrame, dim: DataFrame, condition, how: str = "inner",
                   max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Fact x dimension join; the dimension is broadcast only when small.  A
    bound below the usual one holds for AQE too: it does not turn the join of
    a larger dimension into a broadcast at run time."""
    side = sized_broadcast(dim, max_bytes)
    if side is dim and max_bytes < BROADCAST_MAX_BYTES:
        side = dim.hint("merge")
    return fact.join(side, condition, how)


def left_join_few(few: DataFrame, many: DataFrame, on: str) -> DataFrame:
    """``few`` left join ``many`` on one column that has few values: the few
    rows are broadcast, so the many stay where they are instead of meeting in
    one task a value."""
    matched = F.broadcast(few).join(many, on)
    alone = few.join(many.select(on).distinct(), on, "left_anti")
    return matched.unionByName(alone, allowMissingColumns=True)


def anti_join(left: DataFrame, right: DataFrame, condition) -> DataFrame:
    """Rows of ``left`` without a partner (``NOT EXISTS``)."""
    return left.join(right, condition, "left_anti")


def effective_dated_join(fact: DataFrame, versions: DataFrame, key: str, at: str,
                         start: str = "effective_start_date",
                         end: str = "effective_end_date",
                         how: str = "inner", max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Fact row joined to the version whose ``[start, end)`` holds ``at``.

    Versions of a key do not overlap; null bounds are open.  Versions whose
    measured size is within ``max_bytes`` are broadcast and looked up by key
    and range; beyond it the join is a sweep over time (``sweep_join``), whose
    work is linear in facts and versions.
    """
    if measured_bytes(versions) > max_bytes:
        return sweep_join(fact, versions, key, at, start, end, how)
    v = versions.withColumnRenamed(key, "_v_key")
    cond = ((fact[key] == v["_v_key"]) & (v[start].isNull() | (fact[at] >= v[start]))
            & (v[end].isNull() | (fact[at] < v[end])))
    return fact.join(F.broadcast(v), cond, how).drop("_v_key")


def connection_counts(nodes: DataFrame, group: str, key: str) -> DataFrame:
    """Connections among the distinct nodes of each group: n(n-1)/2.

    The pairs themselves are never materialised (that would be quadratic per
    group); the count follows from the distinct node count, an aggregation
    with map-side combine.
    """
    counted = nodes.groupBy(group).agg(F.count_distinct(F.col(key)).alias("node_count"))
    return counted.select(group, "node_count", _pairs("node_count").alias("connections"))


def _pairs(n: str) -> Column:
    """n(n-1)/2 in exact integers: one of n and n-1 is even, so the product
    fits a long as long as the result does."""
    return F.when(F.col(n) % 2 == 0, F.expr(f"{n} div 2") * (F.col(n) - 1)).otherwise(
        F.expr(f"({n} - 1) div 2") * F.col(n))


def added_connection_counts(known: DataFrame, added: DataFrame, group: str,
                            key: str) -> DataFrame:
    """New connections when ``added`` nodes join the ``known`` ones, per group.

    k genuinely new nodes next to n known ones add k*n + k(k-1)/2 connections
    (new x known, plus among the new); nodes already known add none.
    """
    k_old = known.select(group, key).distinct().withColumn("_known", F.lit(True))
    new = (added.select(group, key).distinct()
           .join(k_old, [group, key], "left_anti"))
    n_old = known.groupBy(group).agg(F.count_distinct(key).alias("known_nodes"))
    n_new = new.groupBy(group).agg(F.count(F.lit(1)).alias("new_nodes"))
    j = n_old.join(n_new, group, "full_outer").na.fill(0, ["known_nodes", "new_nodes"])
    k, n = F.col("new_nodes"), F.col("known_nodes")
    return j.select(group, "known_nodes", "new_nodes",
                    (k * n + _pairs("new_nodes")).alias("new_connections"))
