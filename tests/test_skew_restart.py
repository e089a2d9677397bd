"""Hot keys (a third of all rows on one key), nested pruning, job restart."""

import io
import contextlib
import os

from pyspark.sql import functions as F

from orderloom.operators import dedupe, ranking
from orderloom.plans import release
from orderloom.sources import events as ev
from orderloom.sources.tables import load

SF = "/root/testdata/sf0.001"


def _formatted(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _hot_lines(spark, n=3000):
    """lineitem-like rows where order 0 holds a third of all rows."""
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("l_orderkey"),
        (F.col("id") % 7 + 1).cast("int").alias("l_linenumber"),
        F.col("id").alias("l_partkey"))


def test_hot_order_is_spread_over_its_ship_nodes(spark):
    """An order with a third of all lines is as many events as it has ship
    nodes; every line is kept and no event holds more than its node's lines."""
    lines = load(spark, SF, "lineitem")
    orders = load(spark, SF, "orders")
    n = lines.count()
    key = lines.groupBy("l_orderkey").count().orderBy(F.desc("count")).first()["l_orderkey"]
    hot = lines.filter(F.col("l_orderkey") != key).limit(n // 2).withColumn("l_orderkey", F.lit(key).cast("long"))
    big = lines.unionByName(hot.withColumn("l_orderkey", F.col("l_orderkey").cast(lines.schema["l_orderkey"].dataType)))
    d = F.col("data.releaseEventDetails")
    events = ev.release_events(orders, big).select(
        d["id"].alias("id"), d["orderId"].alias("o"), F.size(d["releaseItems"]).alias("n")).collect()
    want = {(r["l_orderkey"], r["l_suppkey"]): r["count"] for r in big.groupBy("l_orderkey", "l_suppkey").count().collect()}
    got = {r["id"]: r["n"] for r in events if (r["n"] or 0) > 0}
    assert got == {f"R{o}-{s}": c for (o, s), c in want.items()}
    assert max(got.values()) <= max(want.values()) < n // 6


def test_latest_per_key_with_hot_key(spark):
    df = _hot_lines(spark).withColumn("ts", F.col("l_partkey"))
    out = dedupe.latest_per_key(df, ["l_orderkey"], "ts", ["l_partkey"])
    hot = out.filter(F.col("l_orderkey") == 0).collect()
    assert len(hot) == 1 and hot[0].ts == 2997
    assert out.count() == 2001


def test_top_n_with_hot_group(spark):
    df = _hot_lines(spark)
    out = ranking.top_n_per_group(df, ["l_orderkey"], "l_partkey", 3, "row_number")
    assert [r.l_partkey for r in out.filter(F.col("l_orderkey") == 0).orderBy("rnk").collect()] == [2997, 2994, 2991]


def test_nested_scan_reads_only_used_leaves(spark, tmp_dir):
    path = os.path.join(tmp_dir, "release_events")
    ev.release_events(load(spark, SF, "orders"), load(spark, SF, "lineitem")).write.parquet(path)
    events = spark.read.parquet(path)
    plan = _formatted(release.release_flatten(events).select("release_id", "order_id"))
    read_schema = [l for l in plan.splitlines() if "ReadSchema" in l][0]
    assert "releaseItems" not in read_schema and "orderId" in read_schema
    lines = release.release_lines(events).select("release_item.product.skuNumber")
    read_schema = [l for l in _formatted(lines).splitlines() if "ReadSchema" in l][0]
    assert "skuNumber" in read_schema and "price" not in read_schema and "market" not in read_schema


def test_charge_job_restart_picks_up_only_new_files(spark, tmp_dir):
    from orderloom.plans import charges as ch
    from orderloom.schemas import CHARGE_KINDS, CHARGE_PRIMARY_KEY, CHARGE_SORT_COLUMN
    from orderloom.streaming import pipelines as jobs
    from orderloom.streaming import upsert as up
    from orderloom.streaming.jobs import JobConfig, run_to_end
    events = load(spark, SF, "events")
    early, late = events.filter(F.col("event_id") % 2 == 0), events.filter(F.col("event_id") % 2 == 1)
    srcs = [os.path.join(tmp_dir, f"src-{k}") for k, _ in CHARGE_KINDS]
    orders = os.path.join(tmp_dir, "orders")
    ev.customer_orders(load(spark, SF, "orders")).write.parquet(orders)
    cfg = JobConfig("cc", tuple(srcs) + (orders,), os.path.join(tmp_dir, "table"),
                    os.path.join(tmp_dir, "ckpt"), max_files_per_trigger=1)

    def deliver(part):
        for (kind, _), path in zip(CHARGE_KINDS, srcs):
            ev.charge_feed(part)[kind].repartition(2).write.mode("append").parquet(path)

    deliver(early)
    run_to_end(jobs.convenience_charge_job(spark, cfg, buckets=8))
    first = up.read_current(spark, cfg.output_path).count()
    run_to_end(jobs.convenience_charge_job(spark, cfg, buckets=8))   # nothing new: no change
    assert up.read_current(spark, cfg.output_path).count() == first
    deliver(late)
    run_to_end(jobs.convenience_charge_job(spark, cfg, buckets=8))
    got = up.read_current(spark, cfg.output_path)
    batch = ch.latest_charges(ch.convenience_charges(None, ev.charge_feed(events)))
    cols = CHARGE_PRIMARY_KEY + [CHARGE_SORT_COLUMN, "convenience_charge_amount"]
    assert got.count() == batch.count()
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0


def test_fresh_sku_snapshot_sees_new_skus(spark, tmp_dir):
    from orderloom.streaming import pipelines as jobs
    from orderloom.streaming.jobs import JobConfig, run_to_end
    events = ev.release_events(load(spark, SF, "orders"), load(spark, SF, "lineitem"))
    src, sku = os.path.join(tmp_dir, "ev"), os.path.join(tmp_dir, "sku")
    events.filter(F.col("data.releaseEventDetails.orderId").cast("int") % 2 == 0).write.parquet(src)
    part = load(spark, SF, "part")
    ev.sku_dimension(part.filter(F.col("p_partkey") % 2 == 0)).write.parquet(sku)
    cfg = JobConfig("ri", (src, sku), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ckpt"))
    run_to_end(jobs.release_item_job(spark, cfg, fresh_sku=True))
    first = spark.read.parquet(cfg.output_path).count()
    # the catalogue grows, then new events arrive: they join against the new SKUs
    ev.sku_dimension(part.filter(F.col("p_partkey") % 2 == 1)).write.mode("append").parquet(sku)
    events.filter(F.col("data.releaseEventDetails.orderId").cast("int") % 2 == 1).write.mode("append").parquet(src)
    run_to_end(jobs.release_item_job(spark, cfg, fresh_sku=True))
    out = spark.read.parquet(cfg.output_path)
    expect = release.release_items(events, ev.sku_dimension(part)).count()
    second_half = release.release_items(
        events.filter(F.col("data.releaseEventDetails.orderId").cast("int") % 2 == 1),
        ev.sku_dimension(part)).count()
    first_half = release.release_items(
        events.filter(F.col("data.releaseEventDetails.orderId").cast("int") % 2 == 0),
        ev.sku_dimension(part.filter(F.col("p_partkey") % 2 == 0))).count()
    assert first == first_half                    # first run: catalogue as it was
    assert out.count() == first + second_half     # new events joined the new SKUs
    assert second_half > 0 and out.count() < expect


def test_layered_streams_equal_batch_pipeline(spark, tmp_dir):
    """raw invoice events -> four base+1 section streams -> base+2 charge
    upsert stream; the final table equals the one-pass batch pipeline."""
    from orderloom.plans import charges as ch
    from orderloom.plans import invoice
    from orderloom.schemas import CHARGE_KINDS
    from orderloom.streaming import pipelines as jobs
    from orderloom.streaming import upsert as up
    from orderloom.streaming.jobs import JobConfig, run_to_end
    orders = load(spark, SF, "orders")
    events = ev.invoice_events(orders, load(spark, SF, "lineitem"))
    raw = os.path.join(tmp_dir, "raw")
    events.repartition(3).write.parquet(raw)
    base1 = []
    for kind, _ in CHARGE_KINDS:
        name = {"ship_preference": "shipment_preference", "gift_preference": "gift_preference",
                "ship_preference_adjustment": "shipment_preference_adjustment",
                "gift_preference_adjustment": "gift_preference_adjustment"}[kind]
        out = os.path.join(tmp_dir, f"b1-{kind}")
        cfg = JobConfig(name, (raw,), out, os.path.join(tmp_dir, f"ck-{kind}"), max_files_per_trigger=1)
        run_to_end(jobs.PIPELINES[name](spark, cfg))
        base1.append(out)
    co = os.path.join(tmp_dir, "customer_order")
    ev.customer_orders(orders).write.parquet(co)
    table = os.path.join(tmp_dir, "charges")
    cfg = JobConfig("convenience_charge", tuple(base1) + (co,), table, os.path.join(tmp_dir, "ck-cc"),
                    max_files_per_trigger=1)
    run_to_end(jobs.convenience_charge_job(spark, cfg, buckets=8))
    got = up.read_current(spark, table)
    batch = ch.finish_charges(ch.stacked_rows(invoice.charge_sources_flatten(events)), None, latest=True)
    cols = ["convenience_charge_type", "invoice_id", "convenience_charge_category",
            "convenience_charge_name", "convenience_charge_amount", "published_time_utc"]
    assert got.count() == batch.count() > 0
    assert got.select(cols).exceptAll(batch.select(cols)).count() == 0
