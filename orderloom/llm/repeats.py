"""Rows that are repeated very often, told apart so that hashed cells stay
even; DataFrame functions only.

A row's cell is a hash of its key, so rows of one key share a cell.  Keys
that more than a given number of rows have (of which there are few) get a
number for each row, and the row a new key from both.  The numbers of a key
are 0, 1, ... whatever the layout of the input, so cells hold the same rows
in every run; which of several equal rows has which number is left open.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm import common as C

# Rows that one task sorts at most, about.
CELL_ROWS = 1 << 16


def cell_count(rows: int, least: int) -> int:
    """``least``, doubled until a cell has ``CELL_ROWS`` rows at most."""
    n = least
    while n * CELL_ROWS < rows:
        n *= 2
    return n


def limit(rows: int, cells: int) -> int:
    """Rows that may share a key: four times those of an even cell."""
    return max(64, 4 * -(-rows // cells))


def told_apart(rows: DataFrame, same: list[str], key: str, place: str, sizes: DataFrame, most: int) -> DataFrame | None:
    """``rows`` with a key of its own for each row of those that more than
    ``most`` have in common (equal in the columns ``same``, ``key`` among
    them); None if there are none.

    ``sizes`` holds the number ``n`` of rows of each ``place``, a column that
    ``key`` decides.  Places and keys above ``most`` are at most
    count / ``most`` each, a fourth of the cells, and are broadcast.
    """
    crowded = C.stored(sizes.where(F.col("n") > most).select(place), "repeats-places")
    if not crowded.head(1):
        return None
    known = C.stored(rows.join(F.broadcast(crowded), place, "left_semi").groupBy(*same).agg(
        F.count(F.lit(1)).alias("n")).where(F.col("n") > most).select(*same), "repeats-keys")
    if not known.head(1):
        return None
    # Numbered by the stored order: the part that wrote a row, and its place in it.
    repeated = C.stored(rows.join(F.broadcast(known), same, "left_semi").select(
        *rows.columns, F.spark_partition_id().alias("__part"), F.monotonically_increasing_id().alias("__at")),
        "repeats-rows")
    earlier = Window.partitionBy(*same).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    base = repeated.groupBy(*same, "__part").agg(F.count(F.lit(1)).alias("__n")).select(
        *same, "__part", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__base"))
    in_part = Window.partitionBy(*same, "__part").orderBy("__at")
    numbered = (repeated.withColumn("__k", F.row_number().over(in_part)).join(base, [*same, "__part"])
                .withColumn(key, F.xxhash64(key, F.col("__k") + F.col("__base"))).select(*rows.columns))
    return rows.join(F.broadcast(known), same, "left_anti").select(*rows.columns).unionByName(numbered)
