"""Library pieces without a registered query: stream-stream join, metrics,
config lookup, table creation, CSV quarantine side, audit stamping."""

import datetime as dt
import json
import os

from pyspark.sql import Observation
from pyspark.sql import functions as F

from orderloom.operators import quality as dq
from orderloom.sources import config, files, sinks
from orderloom.sources.tables import read_table
from orderloom.streaming.joins import bounded_join
from orderloom.streaming.jobs import JobConfig, append_stream, run_to_end
from orderloom.streaming.metrics import observe_counts


def test_bounded_stream_stream_join(spark, tmp_dir):
    t0 = dt.datetime(2024, 1, 1, 12)
    lines = spark.createDataFrame([("A", t0), ("B", t0), ("C", t0)], "sku string, line_time timestamp")
    skus = spark.createDataFrame([("A", t0 + dt.timedelta(minutes=10)), ("B", t0 + dt.timedelta(hours=5)),
                                  ("C", t0 - dt.timedelta(minutes=30))], "sku_number string, sku_time timestamp")
    lp, sp = os.path.join(tmp_dir, "l"), os.path.join(tmp_dir, "s")
    lines.write.parquet(lp)
    skus.write.parquet(sp)
    ls = read_table(spark, lp, stream=True)
    ss = read_table(spark, sp, stream=True)
    j = bounded_join(ls, ss, F.col("sku") == F.col("sku_number"), "line_time", "sku_time",
                     "1 hour", "1 hour", "1 hour", "1 hour")
    cfg = JobConfig("j", (lp, sp), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    run_to_end(append_stream(j, cfg))
    got = sorted(r.sku for r in spark.read.parquet(cfg.output_path).collect())
    assert got == ["A", "C"]   # B is outside the one-hour bound


def test_observed_counts(spark):
    df = spark.createDataFrame([(1, ["r1"]), (2, [])], "x int, failed_rule_id array<string>")
    obs = Observation("m")
    observe_counts(df, obs).write.format("noop").mode("overwrite").save()
    assert obs.get == {"rows": 2, "failed_rows": 1}


def test_config_lookup(spark, tmp_dir):
    p = os.path.join(tmp_dir, "cfg.json")
    with open(p, "w") as f:
        for name in ("a", "b"):
            f.write(json.dumps({"name": name, "source_table_name": [f"/s/{name}1", f"/s/{name}2"],
                                "target_table_name": f"t_{name}", "output_path": f"/o/{name}",
                                "checkpoint_location": f"/c/{name}", "bad_records_location": f"/b/{name}"}) + "\n")
    cfg = config.get_config(config.load_configs(spark, p), "b")
    assert cfg.source_paths == ("/s/b1", "/s/b2") and cfg.name == "t_b"


def test_create_table_from_schema(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    sinks.create_if_absent(spark, p, spark.range(1).schema)
    assert sinks.table_exists(spark, p)
    assert spark.read.parquet(p).count() == 0


def test_csv_quarantine_keeps_good_fields_and_raw_text(spark, tmp_dir):
    p = os.path.join(tmp_dir, "c")
    os.makedirs(p)
    with open(os.path.join(p, "x.csv"), "w") as f:
        f.write('id,name,amount\n1,"a ""quoted"" name",1.5\n2,b,oops\n')
    good, bad = files.read_csv_checked(spark, p, spark.createDataFrame([], "id int, name string, amount double").schema)
    g = good.collect()
    assert [(r.id, r.name, r.amount) for r in g] == [(1, 'a "quoted" name', 1.5)]
    b = bad.collect()
    assert b[0].id == 2 and b[0].amount is None and "oops" in b[0]._corrupt_record


def test_dq_split(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "id int, t string")
    tagged = dq.tag_rows(df, [dq.not_null("t")])
    assert [r.id for r in dq.passed(tagged).collect()] == [1]
    assert [r.failed_rule_id for r in dq.quarantined(tagged).collect()] == [["not_null_t"]]


def test_release_job_stamps_latency(spark, tmp_dir):
    from orderloom.sources import events as ev
    from orderloom.sources.tables import load
    from orderloom.streaming import pipelines as jobs
    src = os.path.join(tmp_dir, "ev")
    ev.release_headers(load(spark, "/root/testdata/sf0.001", "orders")).write.parquet(src)
    cfg = JobConfig("rel", (src,), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"), run_id="r42")
    run_to_end(jobs.release_job(spark, cfg))
    out = spark.read.parquet(cfg.output_path)
    r = out.agg(F.min("latency").alias("lat"), F.first("processed_by").alias("by")).first()
    assert r.lat > 0 and r.by == "rel:r42"


def test_scale_settings_for_100tb():
    from orderloom.session import scale_settings
    s = scale_settings(100 * 1024 ** 4, total_cores=8000)
    assert s["spark.sql.shuffle.partitions"] == "50000"           # capped, AQE merges
    assert s["spark.sql.files.maxPartitionBytes"] == "256m"
    small = scale_settings(10 * 1024 ** 2, total_cores=8)
    assert small["spark.sql.shuffle.partitions"] == "16"           # two waves minimum


def test_stream_job_reports_observed_counts(spark, tmp_dir):
    from orderloom.sources import events as ev
    from orderloom.sources.tables import load
    from orderloom.streaming import pipelines as jobs
    src = os.path.join(tmp_dir, "ev")
    ev.release_headers(load(spark, "/root/testdata/sf0.001", "orders")).write.parquet(src)
    cfg = JobConfig("relm", (src,), os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck"))
    q = jobs.release_job(spark, cfg)
    run_to_end(q)
    rows = sum(p["observedMetrics"]["relm_metrics"]["rows"] for p in q.recentProgress
               if "relm_metrics" in p.get("observedMetrics", {}))
    assert rows == load(spark, "/root/testdata/sf0.001", "orders").count()


def test_dq_with_no_rules_keeps_rows_clean(spark):
    df = spark.createDataFrame([(1, ["old"]), (2, [])], "id int, failed_rule_id array<string>")
    out = dq.tag_rows(df, [])
    assert sorted((r.id, r.failed_rule_id) for r in out.collect()) == [(1, ["old"]), (2, [])]


def test_root_column_unwrap_on_read(spark, tmp_dir):
    p = os.path.join(tmp_dir, "wrapped")
    spark.createDataFrame([((1, "a"),)], "data struct<id:int, name:string>").write.parquet(p)
    df = read_table(spark, p, root_column="data")
    assert df.columns == ["id", "name"] and df.first().name == "a"
    s = read_table(spark, p, stream=True, root_column="data")
    assert s.isStreaming and s.columns == ["id", "name"]


def test_write_table_layout(spark, tmp_dir):
    p = os.path.join(tmp_dir, "t")
    df = spark.range(100).select("id", (F.col("id") % 2).alias("part"))
    sinks.write_table(df, p, mode="overwrite", partitions=3, partition_by=["part"])
    assert sorted(f for f in os.listdir(p) if f.startswith("part=")) == ["part=0", "part=1"]
    q = os.path.join(tmp_dir, "c")
    sinks.write_table(df.repartition(6), q, mode="overwrite", partitions=2, coalesce=True)
    assert len([f for f in os.listdir(q) if f.endswith(".parquet")]) == 2
    assert spark.read.parquet(q).count() == 100


def test_pair_counts_are_exact(spark):
    from orderloom.operators.joins import _pairs
    rows = spark.createDataFrame([(0,), (1,), (2,), (200_000_003,), (4_000_000_000,)], "n long")
    got = [r[0] for r in rows.select(_pairs("n")).collect()]
    assert got == [n * (n - 1) // 2 for n in (0, 1, 2, 200_000_003, 4_000_000_000)]


def test_last_six_months_keeps_the_time_of_day(spark, tmp_dir):
    import duckdb
    from orderloom.plans import q_relational as q
    rows = [(1, dt.datetime(2024, 8, 31, 18), 1.0), (2, dt.datetime(2024, 2, 29, 17), 1.0),
            (3, dt.datetime(2024, 2, 29, 18), 1.0), (4, dt.datetime(2024, 3, 1), 1.0)]
    (spark.createDataFrame(rows, "o_orderkey long, o_orderdate timestamp_ntz, o_totalprice double")
     .coalesce(1).write.parquet(os.path.join(tmp_dir, "orders.parquet")))
    got = sorted(r[0] for r in q.q_last_six_months(spark, tmp_dir).collect())
    c = duckdb.connect()
    c.execute(f"CREATE VIEW orders AS SELECT * FROM '{tmp_dir}/orders.parquet/*.parquet'")
    assert got == sorted(r[0] for r in c.execute(q.ORACLES["last_six_months"]).fetchall()) == [1, 3, 4]


def test_shared_folder_is_needed_on_a_cluster(spark, monkeypatch):
    import pytest
    from orderloom import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_rates_before_the_first_and_after_the_last_version(spark):
    from orderloom.operators.joins import effective_dated_join
    from orderloom.plans.q_relational import rate_versions
    supplier = spark.createDataFrame([(1, 100.0)], "s_suppkey long, s_acctbal double")
    lines = spark.createDataFrame([(1, dt.date(1980, 1, 1)), (1, dt.date(1995, 5, 5)), (1, dt.date(2030, 1, 1))],
                                  "l_suppkey long, d date")
    out = effective_dated_join(lines, rate_versions(supplier), "l_suppkey", "d").orderBy("d").collect()
    assert [float(r["supplier_rate"]) for r in out] == [100.0, 103.0, 110.0]


def test_ranks_with_heavy_ties(spark):
    from orderloom.operators import ranking
    rows = [(i, "a", 10 if i < 40 else 9 if i < 45 else i % 9) for i in range(100)] + [(200, "a", None), (201, "b", None)]
    df = spark.createDataFrame(rows, "id int, g string, v int")
    for kind in ("rank", "dense_rank"):
        for n in (1, 2, 3, 41, 46):
            want = ranking.ranked(df, "v", kind).filter(F.col("rnk") == n)
            got = ranking.nth_highest(df, "v", n, kind)
            assert sorted(r.id for r in got.collect()) == sorted(r.id for r in want.collect()), (kind, n)
        want = ranking.ranked(df, "v", kind, ["g"]).filter("rnk <= 2")
        got = ranking.top_n_per_group(df, ["g"], "v", 2, kind)
        assert sorted(map(tuple, got.select("id", "rnk").collect())) == sorted(map(tuple, want.select("id", "rnk").collect()))
