"""Effective-dated join as a sweep: equal to the range join, even work."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderloom.operators import joins, sweep

V = "k string, effective_start_date date, effective_end_date date, rate int"
F_ = "id int, k string, d date"


def day(n):
    return None if n is None else dt.date(2020, 1, 1) + dt.timedelta(days=n)


def both(spark, facts, versions, how="inner", partitions=4):
    f = spark.createDataFrame([(i, k, day(d)) for i, (k, d) in enumerate(facts)], F_).repartition(3)
    v = spark.createDataFrame([(k, day(a), day(z), i) for i, (k, a, z) in enumerate(versions)], V)
    got = sweep.sweep_join(f, v, "k", "d", how=how, partitions=partitions)
    plain = joins.effective_dated_join(f, v, "k", "d", how=how)
    assert got.columns == plain.columns
    key = lambda df: sorted([tuple(r) for r in df.collect()], key=repr)
    assert key(got) == key(plain)
    return got


def random_tables(rng, n):
    versions = []
    for k in ["a", "b", "c", "d", None]:
        at = sorted(rng.sample(range(400), rng.randrange(2, 60)))
        spans = list(zip(at, at[1:], strict=False))
        spans = [s for s in spans if rng.random() < 0.8]            # with gaps
        if spans and k in ("a", "b"):
            spans[0] = (None, spans[0][1])
            spans[-1] = (spans[-1][0], None)
        versions += [(k, *s) for s in spans] + [(k, 50, 50), (k, 90, 20)]    # empty versions
    versions.append(("open", None, None))
    facts = [(rng.choice(["a"] * 6 + ["b", "c", "d", None, "none", "open"]),
              rng.choice([None, 111, 111, 111, 111, *range(-5, 405)])) for _ in range(n)]
    return facts, versions


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("partitions", [1, 4, 32])
def test_equal_to_the_range_join(spark, how, partitions):
    both(spark, *random_tables(random.Random(partitions), 900), how, partitions)


def test_small_and_empty_tables(spark):
    for how in ("inner", "left"):
        both(spark, [("a", 1), ("a", None), (None, 3)], [("a", 0, 5)], how)
        both(spark, [("a", 1)], [], how)
        both(spark, [], [("a", 0, 5)], how)


def test_overlapping_versions_fail(spark):
    f = spark.createDataFrame([(1, "a", day(3))], F_)
    for spans in ([(0, 5), (4, 9)], [(None, 5), (None, 9)], [(0, None), (7, 9)], [(2, 5), (2, 4)]):
        v = spark.createDataFrame([("a", day(a), day(z), i) for i, (a, z) in enumerate(spans)], V)
        with pytest.raises(Exception, match="overlap"):
            sweep.sweep_join(f, v, "k", "d").collect()


def test_hot_key_with_many_versions_is_even_work(spark):
    """One key has a third of all facts and 10,000 versions, and a tenth of
    its facts share one instant: no task has twice its share of rows."""
    n, parts = 120_000, 8
    at = F.timestamp_seconds(F.when(F.col("id") % 30 == 0, F.lit(600_000)).otherwise(F.pmod(F.xxhash64("id"), F.lit(1_200_000))))
    facts = spark.range(0, n, 1, 6).select("id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 5000).alias("k"),
                                           at.alias("at"))
    one = spark.range(10_000).select(F.lit(-1).cast("long").alias("k"), F.timestamp_seconds(F.col("id") * 120).alias("s"),
                                     F.timestamp_seconds((F.col("id") + 1) * 120).alias("e"), F.col("id").alias("version"))
    rest = spark.range(5000).select(F.col("id").alias("k"), F.timestamp_seconds(F.lit(0)).alias("s"),
                                    F.lit(None).cast("timestamp").alias("e"), F.col("id").alias("version"))
    versions = one.union(rest)
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(parts)}
    before = {c: spark.conf.get(c) for c in confs}
    for c, v in confs.items():
        spark.conf.set(c, v)
    try:
        out = sweep.sweep_join(facts, versions, "k", "at", "s", "e")
        plan = out._jdf.queryExecution().executedPlan().toString()
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        checked = out.select(F.count(F.lit(1)), F.count(F.when(
            F.col("k") == -1, F.col("version") == F.floor(F.unix_seconds("at") / 120)).otherwise(F.col("version") == F.col("k"))),
            F.min(F.when(F.col("k") == -1, F.col("version") == F.floor(F.unix_seconds("at") / 120))
                  .otherwise(F.col("version") == F.col("k")))).first()
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert checked[0] == n and checked[2] is True        # no join output exceeds the facts
    assert len(sizes) == parts and max(sizes) < 2 * n / parts
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
