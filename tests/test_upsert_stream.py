"""Latest-wins upsert and streaming: late rows, ties, replay, restart."""

import datetime as dt
import os

from pyspark.sql import functions as F

from orderloom.streaming import upsert as up
from orderloom.streaming.jobs import JobConfig, append_stream, foreach_batch_stream, run_to_end
from orderloom.sources.tables import read_table

KEYS = ["k"]
SCHEMA = "k string, ts timestamp_ntz, v int"


def _t(h):
    return dt.datetime(2024, 1, 1, h)


def _rows(spark, path):
    return sorted(((r.k, r.ts, r.v) for r in up.read_current(spark, path).collect()), key=repr)


def test_older_row_after_newer_is_ignored(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    up.upsert(spark.createDataFrame([("a", _t(5), 1)], SCHEMA), p, KEYS, "ts", 0)
    up.upsert(spark.createDataFrame([("a", _t(3), 2), ("b", _t(1), 3)], SCHEMA), p, KEYS, "ts", 1)
    assert _rows(spark, p) == [("a", _t(5), 1), ("b", _t(1), 3)]


def test_newer_row_wins_and_tie_goes_to_later_batch(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    up.upsert(spark.createDataFrame([("a", _t(5), 1), ("b", _t(5), 1)], SCHEMA), p, KEYS, "ts", 0)
    up.upsert(spark.createDataFrame([("a", _t(6), 2), ("b", _t(5), 9)], SCHEMA), p, KEYS, "ts", 1)
    assert _rows(spark, p) == [("a", _t(6), 2), ("b", _t(5), 9)]


def test_null_sort_loses_and_null_key_is_one_row(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    up.upsert(spark.createDataFrame([(None, _t(2), 1), ("a", None, 5)], SCHEMA), p, KEYS, "ts", 0)
    up.upsert(spark.createDataFrame([(None, _t(2), 1), ("a", _t(1), 6)], SCHEMA), p, KEYS, "ts", 1)
    assert _rows(spark, p) == sorted([(None, _t(2), 1), ("a", _t(1), 6)], key=repr)


def test_replayed_batch_changes_nothing(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    b0 = spark.createDataFrame([("a", _t(1), 1), ("b", _t(2), 2)], SCHEMA)
    b1 = spark.createDataFrame([("a", _t(3), 3)], SCHEMA)
    up.upsert(b0, p, KEYS, "ts", 0)
    up.upsert(b1, p, KEYS, "ts", 1)
    before = _rows(spark, p)
    up.upsert(b1, p, KEYS, "ts", 1)
    assert _rows(spark, p) == before


def test_out_of_order_batches_same_final_table(spark, tmp_dir):
    rows = [("a", _t(h), h) for h in (1, 4, 2, 3)] + [("b", _t(h), 10 + h) for h in (2, 1)]
    batches = [rows[:2], rows[2:4], rows[4:]]
    finals = []
    for order in ([0, 1, 2], [2, 1, 0], [1, 0, 2]):
        p = os.path.join(tmp_dir, "t" + "".join(map(str, order)))
        for i, b in enumerate(order):
            up.upsert(spark.createDataFrame(batches[b], SCHEMA), p, KEYS, "ts", i)
        finals.append(_rows(spark, p))
    assert finals[0] == finals[1] == finals[2] == [("a", _t(4), 4), ("b", _t(2), 12)]


def _stage(spark, tmp_dir, name, rows, files):
    path = os.path.join(tmp_dir, name)
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(path)
    return path


def test_append_stream_restart_is_noop(spark, tmp_dir):
    src = _stage(spark, tmp_dir, "src", [(str(i), _t(i % 24), i) for i in range(40)], 4)
    cfg = JobConfig("t", (src,), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"),
                    max_files_per_trigger=1)
    for _ in range(2):
        s = read_table(spark, src, stream=True, max_files_per_trigger=1)
        run_to_end(append_stream(s.withColumn("v2", F.col("v") * 2), cfg))
        assert spark.read.parquet(cfg.output_path).count() == 40


def test_stream_upsert_equals_batch_latest(spark, tmp_dir):
    rows = [("k%d" % (i % 5), _t(i % 24), i) for i in range(60)]
    src = _stage(spark, tmp_dir, "src", rows, 6)
    table = os.path.join(tmp_dir, "table")
    cfg = JobConfig("u", (src,), table, os.path.join(tmp_dir, "ckpt"))
    s = read_table(spark, src, stream=True, max_files_per_trigger=2)
    run_to_end(foreach_batch_stream(s, cfg, up.upsert_writer(table, KEYS, "ts", ["v"])))
    from orderloom.operators.dedupe import latest_per_key
    expect = sorted((r.k, r.ts, r.v) for r in
                    latest_per_key(spark.createDataFrame(rows, SCHEMA), KEYS, "ts", ["v"]).collect())
    assert _rows(spark, table) == expect


def test_stream_quarantine_split_is_exactly_once(spark, tmp_dir):
    from orderloom.operators import quality as dq
    from orderloom.streaming.jobs import split_quarantine_stream
    rows = [(str(i) if i % 3 else None, _t(i % 24), i) for i in range(30)]
    src = _stage(spark, tmp_dir, "src", rows, 3)
    cfg = JobConfig("q", (src,), os.path.join(tmp_dir, "good"), os.path.join(tmp_dir, "ckpt"),
                    bad_records_location=os.path.join(tmp_dir, "bad"))
    s = read_table(spark, src, stream=True, max_files_per_trigger=1)
    run_to_end(split_quarantine_stream(dq.tag_rows(s, [dq.not_null("k")]), cfg))
    good = spark.read.parquet(cfg.output_path)
    bad = spark.read.parquet(cfg.bad_records_location)
    assert good.count() == 20 and bad.count() == 10
    assert bad.filter(F.col("k").isNotNull()).count() == 0


def test_key_that_moves_between_months_stays_one_row(spark, tmp_dir):
    """Every key is re-published in another month; one row a key is left."""
    p = os.path.join(tmp_dir, "t")
    old = [(f"k{i}", dt.datetime(2023, 1 + i % 6, 1, 1), i) for i in range(60)]
    up.upsert(spark.createDataFrame(old, SCHEMA), p, KEYS, "ts", 0, buckets=4)
    new = [(f"k{i}", dt.datetime(2023, 7 + i % 5, 1, 1), 100 + i) for i in range(60)]
    up.upsert(spark.createDataFrame(new, SCHEMA), p, KEYS, "ts", 1, buckets=4)
    rows = {r.k: r.v for r in up.read_current(spark, p).collect()}
    assert up.read_current(spark, p).count() == 60 and rows == {f"k{i}": 100 + i for i in range(60)}


def test_upsert_rewrites_only_touched_buckets(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    up.upsert(spark.createDataFrame([(f"k{i}", _t(1), i) for i in range(60)], SCHEMA), p, KEYS, "ts", 0, buckets=8)
    files = lambda: {os.path.join(d, f) for d, _, fs in os.walk(p) for f in fs if f.endswith(".parquet")}
    before = files()
    up.upsert(spark.createDataFrame([("k1", _t(2), 100)], SCHEMA), p, KEYS, "ts", 1, buckets=8)
    assert len({os.path.dirname(f) for f in before - files()}) == 1
    assert up.read_current(spark, p).count() == 60


def test_empty_stream_leaves_an_empty_table(spark, tmp_dir):
    from orderloom.schemas import CHARGE_KINDS
    from orderloom.sources import events as ev
    from orderloom.sources.tables import load
    from orderloom.streaming import pipelines as jobs
    sf = "/root/testdata/sf0.001"
    feed = ev.charge_feed(load(spark, sf, "events").limit(0))
    srcs = [os.path.join(tmp_dir, k) for k, _ in CHARGE_KINDS]
    for (k, _), path in zip(CHARGE_KINDS, srcs):
        feed[k].write.parquet(path)
    orders = os.path.join(tmp_dir, "orders")
    ev.customer_orders(load(spark, sf, "orders")).write.parquet(orders)
    cfg = JobConfig("cc", (*srcs, orders), os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ck"))
    run_to_end(jobs.convenience_charge_job(spark, cfg, buckets=4))
    table = up.read_current(spark, cfg.output_path)
    assert table.count() == 0 and "convenience_charge_amount" in table.columns
    src = os.path.join(tmp_dir, "rel")
    ev.release_headers(load(spark, sf, "orders").limit(0)).write.parquet(src)
    cfg = JobConfig("rel", (src,), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck2"))
    run_to_end(jobs.release_job(spark, cfg))
    assert spark.read.parquet(cfg.output_path).count() == 0


def test_run_to_end_with_a_passed_limit_raises(spark, tmp_dir):
    import pytest
    src = _stage(spark, tmp_dir, "slow", [(str(i), _t(i % 24), i) for i in range(40)], 20)
    cfg = JobConfig("slow", (src,), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    s = read_table(spark, src, stream=True, max_files_per_trigger=1)
    with pytest.raises(TimeoutError):
        run_to_end(append_stream(s, cfg), timeout_s=0.5)


def test_oversized_folder_is_split_over_tasks(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    rows = spark.range(200000).select(F.concat(F.lit("k"), F.col("id")).alias("k"),
                                      F.lit(_t(1)).alias("ts"), F.col("id").cast("int").alias("v"))
    confs = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
             "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false"}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        up.upsert(rows, p, KEYS, "ts", 0, buckets=1, files_per_folder=4)
    finally:
        for k in confs:
            spark.conf.unset(k)
    files = [f for f in os.listdir(os.path.join(p, "_bucket=0")) if f.endswith(".parquet")]
    assert len(files) > 1          # one folder, written by several tasks
    assert up.read_current(spark, p).count() == 200000


def test_processing_time_trigger_runs_continuously(spark, tmp_dir):
    src = _stage(spark, tmp_dir, "src", [(str(i), _t(1), i) for i in range(10)], 2)
    cfg = JobConfig("c", (src,), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"),
                    trigger_once=False, trigger_interval="1 second")
    q = append_stream(read_table(spark, src, stream=True), cfg)
    try:
        q.processAllAvailable()
        assert q.isActive
        spark.createDataFrame([("x", _t(2), 99)], SCHEMA).write.mode("append").parquet(src)
        q.processAllAvailable()
    finally:
        q.stop()
    assert spark.read.parquet(cfg.output_path).count() == 11


def test_bucket_count_mismatch_is_refused(spark, tmp_dir):
    import pytest
    p = os.path.join(tmp_dir, "t")
    up.upsert(spark.createDataFrame([("a", _t(1), 1)], SCHEMA), p, KEYS, "ts", 0, buckets=4)
    with pytest.raises(ValueError):
        up.upsert(spark.createDataFrame([("a", _t(2), 2)], SCHEMA), p, KEYS, "ts", 1, buckets=8)
    assert _rows(spark, p) == [("a", _t(1), 1)]


def test_crash_after_write_then_restart_replays_cleanly(spark, tmp_dir):
    """The sink fails after writing a batch but before the stream commits it;
    the restarted job replays that batch on the same checkpoint, and the
    idempotent upsert leaves exactly the latest row per key."""
    import pytest
    rows = [("k%d" % (i % 7), _t(i % 24), i) for i in range(70)]
    src = _stage(spark, tmp_dir, "src", rows, 5)
    table = os.path.join(tmp_dir, "table")
    cfg = JobConfig("crash", (src,), table, os.path.join(tmp_dir, "ckpt"))
    write = up.upsert_writer(table, KEYS, "ts", ["v"])
    calls = {"n": 0}

    def crashing(df, batch_id):
        write(df, batch_id)
        calls["n"] += 1
        if calls["n"] == 2:
            raise RuntimeError("driver lost after the write")

    s = read_table(spark, src, stream=True, max_files_per_trigger=1)
    with pytest.raises(Exception):
        run_to_end(foreach_batch_stream(s, cfg, crashing))
    s = read_table(spark, src, stream=True, max_files_per_trigger=1)
    run_to_end(foreach_batch_stream(s, cfg, write))
    from orderloom.operators.dedupe import latest_per_key
    expect = sorted(((r.k, r.ts, r.v) for r in
                     latest_per_key(spark.createDataFrame(rows, SCHEMA), KEYS, "ts", ["v"]).collect()), key=repr)
    assert _rows(spark, table) == expect


def test_foreach_batch_sinks_stamp_epoch_id(spark, tmp_dir):
    rows = [("k%d" % i, _t(i % 24), i) for i in range(20)]
    src = _stage(spark, tmp_dir, "src", rows, 4)
    table = os.path.join(tmp_dir, "table")
    cfg = JobConfig("e", (src,), table, os.path.join(tmp_dir, "ckpt"))
    s = read_table(spark, src, stream=True, max_files_per_trigger=1).withColumn("epoch_id", F.lit(-1).cast("bigint"))
    run_to_end(foreach_batch_stream(s, cfg, up.upsert_writer(table, KEYS, "ts")))
    epochs = {r[0] for r in spark.read.parquet(table).select("epoch_id").distinct().collect()}
    assert epochs == {0, 1, 2, 3}


def test_append_stream_partitions_by_date(spark, tmp_dir):
    rows = [(str(i), dt.datetime(2024, 1, 1 + i % 3, 1), i) for i in range(30)]
    src = _stage(spark, tmp_dir, "src", rows, 2)
    cfg = JobConfig("p", (src,), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"),
                    partition_by=("d",))
    s = read_table(spark, src, stream=True).withColumn("d", F.col("ts").cast("date"))
    run_to_end(append_stream(s, cfg))
    folders = sorted(f for f in os.listdir(cfg.output_path) if f.startswith("d="))
    assert folders == ["d=2024-01-01", "d=2024-01-02", "d=2024-01-03"]
    one_day = spark.read.parquet(cfg.output_path).filter(F.col("d") == "2024-01-02")
    assert one_day.count() == 10


def test_charge_job_puts_failing_rows_aside(spark, tmp_dir):
    from orderloom.plans import charges as ch
    from orderloom.schemas import CHARGE_KINDS
    from orderloom.sources import events as ev
    from orderloom.sources.tables import load
    from orderloom.streaming import pipelines as jobs
    sf = "/root/testdata/sf0.001"
    events = load(spark, sf, "events").limit(400).withColumn(
        "value", F.when(F.col("event_id") % 5 == 0, -F.abs("value")).otherwise(F.abs("value") + 1))
    feed = ev.charge_feed(events)
    srcs = [os.path.join(tmp_dir, k) for k, _ in CHARGE_KINDS]
    for (k, _), path in zip(CHARGE_KINDS, srcs):
        feed[k].write.parquet(path)
    orders = os.path.join(tmp_dir, "orders")
    ev.customer_orders(load(spark, sf, "orders")).write.parquet(orders)
    cfg = JobConfig("cc", (*srcs, orders), os.path.join(tmp_dir, "table"), os.path.join(tmp_dir, "ck"),
                    bad_records_location=os.path.join(tmp_dir, "bad"), split_bad_rows=True)
    run_to_end(jobs.convenience_charge_job(spark, cfg, buckets=4))
    bad = spark.read.parquet(cfg.bad_records_location)
    union = ch.charge_union(ev.charge_feed(events))
    assert bad.count() == union.filter(~F.coalesce(F.col("charge.amount") > 0, F.lit(False))).count() > 0
    assert up.read_current(spark, cfg.output_path).filter("convenience_charge_amount <= 0").count() == 0
