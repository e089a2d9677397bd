"""Source-to-target reconciliation that names the rows that differ.

Both sides are compared by checksums before any row is moved.  The hash of a
row's key places it in one of ``RANGES`` ranges of the hash's space, and each
range in as many subranges.  A range's checksum is its row count and two sums
of row hashes, which do not depend on order and are combined in every task.
Only ranges whose checksums differ are looked into: first their subranges,
then the rows of the subranges that differ, of both sides together, are
shuffled by key and compared.  What is broadcast is the list of differing ranges,
at most ``RANGES``, then that of subranges, while their number is within
``MAX_SUBRANGES``; with more, the rows of the differing ranges are compared.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import scratch_path

RANGES = 4096
SUBRANGES = 256
MAX_SUBRANGES = 1 << 20
_BITS = (RANGES - 1).bit_length(), (SUBRANGES - 1).bit_length()


def _hash(columns: Sequence[Column], salt: int) -> Column:
    """Hash that tells nulls from each other's places."""
    return F.xxhash64(F.lit(salt), *columns, *[c.isNull() for c in columns])


def _prepared(df: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Keys, values, the range and subrange, and two hashes of each row."""
    k, all_ = [F.col(c) for c in keys], [F.col(c) for c in (*keys, *values)]
    place = _hash(k, 1)
    return df.select(*keys, *values,
                     F.shiftrightunsigned(place, 64 - _BITS[0]).cast("int").alias("_range"),
                     F.shiftrightunsigned(F.shiftleft(place, _BITS[0]), 64 - _BITS[1]).cast("int").alias("_sub"),
                     _hash(all_, 2).alias("_h1"), _hash(all_[::-1], 3).alias("_h2"))


def checksums(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    exact = [F.sum(F.col(h).cast("decimal(20,0)")).alias(h) for h in ("_h1", "_h2")]
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), *exact)


def _differing(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """The groups whose checksums differ or that one side lacks, stored."""
    sums = ["_n", "_h1", "_h2"]
    both = checksums(a, by).join(checksums(b, by).withColumnsRenamed({c: f"{c}_b" for c in sums}), list(by), "full_outer")
    equal = F.lit(True)
    for c in sums:
        equal = equal & F.col(c).eqNullSafe(F.col(f"{c}_b"))
    path = scratch_path(a.sparkSession, "reconcile")
    both.where(~equal).select(*by).write.parquet(path)
    return a.sparkSession.read.parquet(path)


def differing_rows(source: DataFrame, target: DataFrame, keys: Sequence[str],
                   values: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The rows of both sides that lie in differing subranges."""
    a, b = _prepared(source, keys, values), _prepared(target, keys, values)
    ranges = F.broadcast(_differing(a, b, ["_range"]))
    a, b = a.join(ranges, "_range", "left_semi"), b.join(ranges, "_range", "left_semi")
    subranges = _differing(a, b, ["_range", "_sub"])
    if subranges.count() <= MAX_SUBRANGES:
        both = F.broadcast(subranges)
        a, b = a.join(both, ["_range", "_sub"], "left_semi"), b.join(both, ["_range", "_sub"], "left_semi")
    return a, b


def _per_key(source: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Row counts and checksums of each value column of both sides, by key.

    Rows of both sides go to their key in one shuffle and as they are: the
    sums, which few rows share, are wider than the values."""
    columns = [*keys, *values]
    both = (source.select(*columns, F.lit(True).alias("_source"))
            .unionByName(target.select(*columns, F.lit(False).alias("_source"))))
    aggs = []
    for side, mine in (("source", F.col("_source")), ("target", ~F.col("_source"))):
        aggs.append(F.count(F.when(mine, 1)).alias(f"{side}_rows"))
        hashes = {**{f"_{side}_{i}": _hash([F.col(c)], 4) for i, c in enumerate(values)},
                  f"_{side}_row": _hash([F.col(c) for c in columns], 2)}
        aggs += [F.sum(F.when(mine, h.cast("decimal(20,0)"))).alias(name) for name, h in hashes.items()]
    return both.repartition(*keys).groupBy(*keys).agg(*aggs)


def reconcile(source: DataFrame, target: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(*keys, status, source_rows, target_rows, changed_columns) of every key
    that differs.

    ``status`` is ``missing`` (in the source alone), ``extra`` (in the target
    alone) or ``changed``; ``changed_columns`` lists, by comma, the value
    columns whose values differ.  Null keys are equal to each other, null
    values too.  Rows of one key are compared as a set with repeats, whatever
    their order: a key whose rows hold the same values in every column, but
    combined otherwise, is changed with no column listed.
    """
    a, b = differing_rows(source, target, keys, values)
    j = _per_key(a, b, keys, values)
    status = (F.when(F.col("target_rows") == 0, "missing").when(F.col("source_rows") == 0, "extra")
              .when((F.col("source_rows") != F.col("target_rows")) | (F.col("_source_row") != F.col("_target_row")), "changed"))
    changed = [F.when(F.col(f"_source_{i}") != F.col(f"_target_{i}"), F.lit(c)) for i, c in enumerate(values)]
    out = j.select(*keys, status.alias("status"), "source_rows", "target_rows",
                   F.concat_ws(",", *changed).alias("changed_columns"))
    return out.where("status is not null")
