"""Joins that neither meet in one task nor pass the driver by batch."""

from orderloom.operators.joins import join_dimension, left_join_few
from pyspark.sql import functions as F


def test_few_rows_left_joined(spark):
    few = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "t string")
    many = spark.createDataFrame([("a", 1), ("a", 2), ("c", 3), (None, 4)], "t string, v int")
    out = left_join_few(few, many, "t")
    key = lambda r: (str(r[0]), str(r[1]))
    assert sorted(map(tuple, out.collect()), key=key) == sorted(map(tuple, few.join(many, "t", "left").collect()), key=key)
    assert out.columns == ["t", "v"]
    assert "BroadcastHashJoin [t" in out._jdf.queryExecution().executedPlan().toString()


def test_a_lower_bound_keeps_a_dimension_from_the_driver(spark):
    fact, dim = spark.range(50).withColumnRenamed("id", "f"), spark.range(40)
    out = join_dimension(fact, dim, F.col("f") == F.col("id"), max_bytes=100)
    assert out.count() == 40
    out.collect()
    assert "BroadcastHashJoin" not in out._jdf.queryExecution().executedPlan().toString()
