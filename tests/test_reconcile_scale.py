"""Rows that differ are brought to their key once, both sides together."""

from orderloom.operators.reconcile import _per_key, reconcile


def test_one_shuffle_by_key_for_both_sides(spark):
    a = spark.createDataFrame([(1, "x"), (None, "n"), (2, "y"), (2, "y")], "k int, v string")
    b = spark.createDataFrame([(1, "z"), (None, "n"), (2, "y"), (3, None)], "k int, v string")
    plan = _per_key(a, b, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    got = sorted(tuple(r) for r in reconcile(a, b, ["k"], ["v"]).collect())
    assert got == [(1, "changed", 1, 1, "v"), (2, "changed", 2, 1, "v"), (3, "extra", 0, 1, "")]
