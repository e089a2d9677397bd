"""Effective-dated join as a sweep over time, for version tables of any size.

Facts and versions are united, sorted by time, and the version in force is
carried forward, so a key with many facts and many versions costs their sum
and not their product.  Keys with many rows are cut into time ranges: cut
points are quantiles of the key's own times, and a version goes to every
range that it reaches into, so each range starts with the version in force.
Where many facts share one instant, several cut points fall on it and the
facts are dealt over the ranges between them by hash.

A key is cut if its rows exceed one in ``GRAINS`` of a partition's even
share; there are at most ``GRAINS`` such keys (and twice as many ranges) for
each shuffle partition, so the table of cut points that is broadcast does not
grow with the rows.  Versions of one key must not overlap; where two do, the
job fails with an error rather than choose one of them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Ranges that a partition's even share of rows is cut into.
GRAINS = 8


def _cut_points(points: DataFrame, partitions: int) -> tuple[DataFrame, bool]:
    """(k, cuts) of every key that is to be cut; ``cuts`` is a sorted array of
    arrays of times.  The flag says whether there is any."""
    counts = points.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    total = points.count()
    grain = max(1, total // (partitions * GRAINS))
    large = counts.where(F.col("n") > grain).withColumn("ranges", F.ceil(F.col("n") / grain).cast("int"))
    most = large.agg(F.max("ranges")).first()[0]
    if not most or total <= partitions * GRAINS:
        return large.select("k", F.array().cast("array<array<string>>").alias("cuts")).limit(0), False
    wanted = [i / most for i in range(1, most)]
    times = (points.where(F.col("t").isNotNull()).join(F.broadcast(large.select("k", "ranges")), "k")
             .groupBy("k").agg(F.first("ranges").alias("ranges"),
                               F.percentile_approx("t", wanted, F.lit(max(10_000, 20 * most))).alias("q")))
    # Of the longest key's quantiles, those that this key's number of ranges has.
    own = F.transform(F.sequence(F.lit(1), F.col("ranges") - 1),
                      lambda i: F.get("q", F.ceil(i * most / F.col("ranges")).cast("int") - 1))
    width = math.isqrt(most) + 1
    rows = F.ceil((F.col("ranges") - 1) / width).cast("int")
    nested = F.transform(F.sequence(F.lit(0), rows - 1), lambda r: F.slice("flat", r * width + 1, F.lit(width)))
    return times.where("ranges > 1").withColumn("flat", F.sort_array(own)).select("k", nested.alias("cuts")), True


def _reached(cuts: Column, time: Column, strictly: bool) -> Column:
    """How many cut points lie before ``time`` (``strictly``) or at it as
    well: first the row of the nested array, then the place in it."""
    before = (lambda c: c < time) if strictly else (lambda c: c <= time)
    row = F.greatest(F.size(F.filter(cuts, lambda r: before(r[0]))) - 1, F.lit(0))
    width = F.size(F.get(cuts, 0))
    return row * width + F.size(F.filter(F.get(cuts, row), before))


def sweep_join(fact: DataFrame, versions: DataFrame, key: str, at: str, start: str = "effective_start_date",
               end: str = "effective_end_date", how: str = "inner", partitions: int | None = None) -> DataFrame:
    """Fact row joined to the version whose ``[start, end)`` holds ``at``.

    Null bounds are open; a fact without a key, or without a time, has no
    version (but for one that is open at both ends).  ``how`` is ``inner`` or
    ``left``.  Columns: those of ``fact``, then those of ``versions`` but the
    key.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    spark = fact.sparkSession
    partitions = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    kept = [c for c in versions.columns if c != key]
    time_type = fact.select(at).union(versions.select(start)).schema[0].dataType
    facts = fact.select(F.col(key).alias("k"), F.col(at).cast(time_type).alias("t"),
                        F.struct(*[F.col(c) for c in fact.columns]).alias("f"))
    spans = versions.where(F.col(key).isNotNull()).select(
        F.col(key).alias("k"), F.col(start).cast(time_type).alias("t"), F.col(end).cast(time_type).alias("until"),
        F.struct(*[F.col(c) for c in kept]).alias("v"))
    spans = spans.where(F.col("t").isNull() | F.col("until").isNull() | (F.col("t") < F.col("until")))  # not empty
    keyed = facts.where("k is not null")
    cuts, any_cut = _cut_points(keyed.select("k", "t").union(spans.select("k", "t")), partitions)
    if any_cut:
        keyed, spans = (df.join(F.broadcast(cuts), "k", "left") for df in (keyed, spans))
        least, most = _reached("cuts", F.col("t"), True), _reached("cuts", F.col("t"), False)
        last = F.aggregate("cuts", F.lit(0), lambda n, r: n + F.size(r))
        # Facts at a cut point may be in any range that starts at it; facts
        # without a time in any at all, as a version open at both ends is.
        dealt = lambda n: F.pmod(F.xxhash64("f", F.spark_partition_id()), n).cast("int")
        place = (F.when(F.col("cuts").isNull(), 0).when(F.col("t").isNull(), dealt(last + 1))
                 .when(most > least, least + 1 + dealt(most - least)).otherwise(most))
        first_range = F.when(F.col("t").isNull(), 0).when(most > least, least + 1).otherwise(most)
        last_range = F.when(F.col("until").isNull(), last).otherwise(_reached("cuts", F.col("until"), True))
        ranges = F.when(F.col("cuts").isNull(), F.array(F.lit(0))).otherwise(
            F.sequence(first_range, F.greatest(first_range, last_range)))
    else:
        place, ranges = F.lit(0), F.array(F.lit(0))
    rows = (spans.select("k", F.explode(ranges).alias("r"), "t", F.lit(0).alias("kind"), "until", "v",
                         F.lit(None).cast(facts.schema["f"].dataType).alias("f"))
            .union(keyed.select("k", place.alias("r"), "t", F.lit(1), F.lit(None).cast(time_type),
                                F.lit(None).cast(spans.schema["v"].dataType), "f")))
    swept = Window.partitionBy("k", "r").orderBy("t", "kind")
    so_far = swept.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    version = F.when(F.col("kind") == 0, F.struct("t", "until", "v"))
    rows = rows.select("kind", "t", "f", F.last(version, ignorenulls=True).over(so_far).alias("now"),
                       F.last(version, ignorenulls=True).over(swept.rowsBetween(Window.unboundedPreceding, -1)).alias("earlier"))
    overlap = F.col("earlier").isNotNull() & (
        F.col("earlier.until").isNull() | F.coalesce(F.col("earlier.until") > F.col("t"), F.lit(True)))
    found = rows.where(F.when(F.col("kind") == 1, True).when(
        overlap, F.raise_error(F.lit("versions of a key overlap")).cast("boolean")).otherwise(False))
    holds = (F.col("now").isNotNull()
             & (F.col("now.t").isNull() | F.coalesce(F.col("t") >= F.col("now.t"), F.lit(False)))
             & (F.col("now.until").isNull() | F.coalesce(F.col("t") < F.col("now.until"), F.lit(False))))
    if how == "inner":
        found = found.where(holds)
    value = F.when(holds, F.col("now.v"))
    out = found.select(*[F.col("f").getField(c).alias(c) for c in fact.columns], *[value.getField(c).alias(c) for c in kept])
    if how == "left":
        none = fact.where(F.col(key).isNull())
        types = versions.schema
        out = out.union(none.select("*", *[F.lit(None).cast(types[c].dataType).alias(c) for c in kept]))
    return out
