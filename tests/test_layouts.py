"""Upsert tables that outgrow their buckets, clustered writes, configured runs."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from orderloom.plans import q_relational
from orderloom.sources import config, sinks
from orderloom.sources.tables import load
from orderloom.streaming import upsert as up

SF = "/root/testdata/sf0.001"
SCHEMA = "k string, ts timestamp_ntz, v int"


def _rows(spark, path):
    return sorted([tuple(r) for r in up.read_current(spark, path).select("k", "ts", "v").collect()], key=repr)


def _batch(spark, ids, hour):
    return spark.createDataFrame([(f"k{i}", dt.datetime(2024, 1, 1, hour), i) for i in ids], SCHEMA)


def test_bucket_counts_follow_the_rows():
    assert [up.buckets_for(n, 10) for n in (0, 1, 10, 11, 40, 41, 161)] == [1, 1, 1, 4, 4, 16, 64]


def test_a_table_grows_from_4_to_16_buckets(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    up.upsert(_batch(spark, range(300), 1), p, ["k"], "ts", 0, rows_per_bucket=100)
    assert up.bucket_count(spark, p) == 4
    up.upsert(_batch(spark, range(200, 1000), 2), p, ["k"], "ts", 1, rows_per_bucket=100)
    assert up.bucket_count(spark, p) == 4            # measured before the batch
    up.upsert(_batch(spark, range(900, 1010), 3), p, ["k"], "ts", 2, rows_per_bucket=100)
    assert up.bucket_count(spark, p) == 16
    up.upsert(_batch(spark, range(0, 5), 0), p, ["k"], "ts", 3, rows_per_bucket=100)     # late rows lose
    hour = lambda i: 3 if i >= 900 else 2 if i >= 200 else 1
    assert _rows(spark, p) == sorted([(f"k{i}", dt.datetime(2024, 1, 1, hour(i)), i) for i in range(1010)], key=repr)
    stored = up.read_table(spark, p)
    assert stored.select(up.BUCKET_COL).distinct().count() == 16
    assert stored.where(F.col(up.BUCKET_COL) != up.bucket_of(["k"], 16)).count() == 0


def test_a_rebucketing_that_is_lost_leaves_the_table(spark, tmp_dir, monkeypatch):
    p = os.path.join(tmp_dir, "t")
    up.upsert(_batch(spark, range(50), 1), p, ["k"], "ts", 0, rows_per_bucket=20)
    before = _rows(spark, p)
    write = up._write

    def lost(rows, folder, keys, files):
        write(rows, folder, keys, files)
        raise RuntimeError("lost before the switch")
    monkeypatch.setattr(up, "_write", lost)
    with pytest.raises(RuntimeError):
        up.rebucket(spark, p, ["k"], 16)
    monkeypatch.undo()
    assert _rows(spark, p) == before and up.bucket_count(spark, p) == 4
    up.rebucket(spark, p, ["k"], 16)
    assert _rows(spark, p) == before and up.bucket_count(spark, p) == 16
    up.rebucket(spark, p, ["k"], 4)                   # a third layout
    up.upsert(_batch(spark, [7], 5), p, ["k"], "ts", 1, buckets=4)
    assert up.read_current(spark, p).count() == 50 and ("k7", dt.datetime(2024, 1, 1, 5), 7) in _rows(spark, p)


def _scanned_rows(df):
    """Rows that the scan gave, from its own metric."""
    df.write.format("noop").mode("overwrite").save()
    scan = df._jdf.queryExecution().executedPlan()
    df.collect()
    node, todo = None, [scan]
    while todo:
        n = todo.pop()
        if "FileSourceScan" in n.getClass().getSimpleName():
            node = n
        if "AdaptiveSparkPlan" in n.getClass().getSimpleName():
            todo.append(n.executedPlan())
        children = n.children()
        todo += [children.apply(i) for i in range(children.length())]
    return node.metrics().apply("numOutputRows").value()


def test_clustered_files_are_skipped(spark, tmp_dir):
    lo, hi = (F.lit(d).cast("date") for d in q_relational.QUARTER)
    mine = lambda path: spark.read.parquet(path).where((F.col("ship_date") >= lo) & (F.col("ship_date") < hi))
    clustered, plain = q_relational.clustered_lines(spark, SF), os.path.join(tmp_dir, "plain")
    lines = load(spark, SF, "lineitem").withColumn("ship_date", F.col("l_shipdate").cast("date"))
    lines.repartition(16).write.parquet(plain)
    plan = mine(clustered)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ship_date), GreaterThanOrEqual(ship_date," in plan
    n, total = mine(clustered).count(), lines.count()
    assert n == mine(plain).count() > 0
    assert n <= _scanned_rows(mine(clustered)) <= n + 2 * total / 16 + 1 < total / 2
    assert _scanned_rows(mine(plain)) == total


def test_many_rows_of_one_value_are_spread(spark, tmp_dir):
    path = os.path.join(tmp_dir, "one")
    rows = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 5).otherwise(F.col("id")).alias("d"), "id")
    sinks.write_clustered(rows, path, ["d", "id"], partitions=8)
    sizes = [r["count"] for r in spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 4000 / 8
    assert spark.read.parquet(path).count() == 4000


def test_a_config_that_is_not_there(spark, tmp_dir):
    configs = spark.createDataFrame([], config.CONFIG_SCHEMA)
    with pytest.raises(KeyError):
        config.run_configured(spark, configs, ["release"], "r", {})
