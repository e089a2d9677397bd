"""Reconciliation by key: rows named, and only differing ranges read on."""

import random

from pyspark.sql import functions as F

from orderloom.operators import reconcile as rc

S = "k int, n string, a string, b double"


def brute(source, target):
    """(k, n, status, source_rows, target_rows, changed) by sorted rows."""
    out = []
    key = lambda v: (v is None, str(v))
    for k in {r[:2] for r in source} | {r[:2] for r in target}:
        a, b = ([r[2:] for r in side if r[:2] == k] for side in (source, target))
        if sorted(a, key=repr) == sorted(b, key=repr):
            continue
        status = "missing" if not b else "extra" if not a else "changed"
        columns = [c for i, c in enumerate("ab") if status == "changed"
                   and sorted([r[i] for r in a], key=key) != sorted([r[i] for r in b], key=key)]
        out.append((*k, status, len(a), len(b), ",".join(columns)))
    return sorted(out, key=repr)


def check(spark, source, target):
    a, b = (spark.createDataFrame(rows, S).repartition(3) for rows in (source, target))
    got = sorted([tuple(r) for r in rc.reconcile(a, b, ["k", "n"], ["a", "b"]).collect()], key=repr)
    assert got == brute(source, target)
    return got


def test_against_plain_comparison(spark):
    rng = random.Random(4)
    rows = [(rng.choice([None, *range(60)]), rng.choice([None, "x", "y"]), rng.choice([None, "", "p", "q"]),
             rng.choice([None, 0.0, 1.5])) for _ in range(400)]
    other = [r for r in rows if rng.random() > 0.05]
    other = [(*r[:2], "new", r[3]) if rng.random() < 0.05 else r for r in other] + [(999, "z", "p", 0.0)] * 2 + rows[:3]
    rows += [(777, "m", "p", 1.0), (777, None, "p", 1.0)]
    assert {r[2] for r in check(spark, rows, other)} == {"missing", "extra", "changed"}


def test_nulls_do_not_trade_places_and_repeats_count(spark):
    assert [r[2] for r in check(spark, [(1, "x", None, 1.0)], [(1, "x", "", 1.0)])] == ["changed"]
    assert check(spark, [(1, "x", "p", 1.0)] * 3, [(1, "x", "p", 1.0)] * 2)[0][2:] == ("changed", 3, 2, "a,b")
    assert check(spark, [(1, "x", "p", 1.0), (1, "x", "q", 2.0)], [(1, "x", "p", 2.0), (1, "x", "q", 1.0)])[0][2:] == ("changed", 2, 2, "")
    assert check(spark, [(None, None, "p", None)], [(None, None, "p", None)]) == []


def test_empty_sides(spark):
    assert check(spark, [], []) == []
    assert check(spark, [(1, "x", "p", 1.0)], [])[0][2] == "missing"
    assert check(spark, [], [(1, "x", "p", 1.0)])[0][2] == "extra"


def test_only_differing_ranges_are_read_on(spark):
    source = spark.range(200_000).select("id", (F.col("id") * 3).alias("v"))
    target = source.where("id <> 77").withColumn("v", F.when(F.col("id") == 1234, -1).otherwise(F.col("v"))).union(
        spark.range(300_000, 300_002).selectExpr("id", "id"))
    got = sorted((r["id"], r["status"]) for r in rc.reconcile(source, target, ["id"], ["v"]).collect())
    assert got == [(77, "missing"), (1234, "changed"), (300_000, "extra"), (300_001, "extra")]
    left, right = rc.differing_rows(source, target, ["id"], ["v"])
    # four subranges of 4096 x 256: the rows that go on to the join
    assert left.count() <= 8 and right.count() <= 8


def test_more_subranges_than_are_listed(spark, monkeypatch):
    monkeypatch.setattr(rc, "MAX_SUBRANGES", 2)
    source = spark.range(5000).select("id", F.lit(1).alias("v"))
    got = rc.reconcile(source, source.withColumn("v", F.when(F.col("id") % 10 == 0, 2).otherwise(1)), ["id"], ["v"])
    assert got.count() == 500 and got.where("changed_columns <> 'v'").count() == 0
