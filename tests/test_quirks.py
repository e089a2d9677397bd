
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions import casts
from orderloom.functions.time import published_time_strict, utc_instant, event_time_triplet
from orderloom.operators.dedupe import latest_per_key
from orderloom.operators.explode import explode_items, flatten_distinct
from orderloom.plans import charges as ch
from orderloom.plans import release
from orderloom.schemas import CHARGE_ARRAY, CHARGE_PRIMARY_KEY, CHARGE_SORT_COLUMN

ITEM = "struct<releaseLineNumber:string,product:struct<skuNumber:string>>"
EVT = f"data struct<releaseEventDetails:struct<id:string,releaseItems:array<{ITEM}>>>"


def _events(spark, rows):
    """``rows``: ``(release_id, items)`` pairs."""
    return spark.createDataFrame([(((rid, items),),) for rid, items in rows], EVT)


def test_k1_correlated_explode(spark):
    ev = _events(spark, [("R1", [("1", ("A",)), ("2", ("B",))])])
    correlated = release.release_lines(ev)
    assert correlated.count() == 2
    assert sorted(r[0] for r in correlated.select("release_item.product.skuNumber").collect()) == ["A", "B"]


def test_k2_null_and_empty_arrays(spark):
    ev = _events(spark, [("R1", None), ("R2", [])])
    assert release.release_lines(ev).count() == 0
    outer = release.release_lines(ev, outer=True)
    assert sorted(r[0] for r in outer.select("data.releaseEventDetails.id").collect()) == ["R1", "R2"]


def test_k4_orphan_only_in_anti_join(spark):
    ev = _events(spark, [("R1", [("1", ("A",)), ("2", ("ZZ",))])])
    sku = spark.createDataFrame([("A", "SKU-A")], "sku_number string, sku_id string")
    lines = release.release_lines(ev)
    joined = lines.join(sku, F.col("release_item.product.skuNumber") == F.col("sku_number"))
    assert [r.sku_number for r in joined.collect()] == ["A"]
    orphans = release.orphan_items(ev, sku).collect()
    assert [(r.release_id, r.sku_number) for r in orphans] == [("R1", "ZZ")]


def _charge_source(spark, kind, rows):
    schema = T.StructType([
        T.StructField("processed_timestamp", T.TimestampType()), T.StructField("processed_by", T.StringType()),
        T.StructField("epoch_id", T.LongType()), T.StructField("latency", T.DoubleType()),
        T.StructField("invoice_id", T.StringType()),
        T.StructField(f"{kind}_convenience_charge", CHARGE_ARRAY),
        T.StructField("order_id", T.StringType()), T.StructField("order_date", T.DateType()),
        T.StructField("order_datetime", T.StringType()), T.StructField("order_datetime_utc", T.TimestampNTZType()),
        T.StructField("invoiced_on_date", T.DateType()), T.StructField("invoiced_on_datetime", T.StringType()),
        T.StructField("invoiced_on_datetime_utc", T.TimestampNTZType()),
        T.StructField("published_time", T.StringType()),
        T.StructField("failed_rule_id", T.ArrayType(T.StringType())),
        T.StructField("dq_processed_timestamp", T.TimestampType()),
    ])
    full = [(None, "t", 0, 0.0, inv, charges, oid, None, None, None, None, None, None, pub, [], None)
            for inv, charges, oid, pub in rows]
    return spark.createDataFrame(full, schema)


def test_k5_duplicate_order_rows_do_not_duplicate_charges(spark):
    c = [("fee", "cat", Decimal("1.00"), Decimal("1.000000"))]
    src = {"ship_preference": _charge_source(spark, "ship_preference",
                                             [("I1", c, "O1", "2023-01-05T23:30:00.000-0800")])}
    orders = spark.createDataFrame([("O1",), ("O1",)], "order_id string")
    out = ch.convenience_charges(orders, src)
    assert out.count() == 1


def test_k6_time_forms(spark):
    forms = ["2023-01-05T23:30:00-0800", "2023-01-05T23:30:00-08:00", "2023-01-05T23:30:00Z",
             "2023-01-05T23:30:00+05:30", "2023-01-05T23:30:00", "2023-01-05T23:30:00-08", None]
    df = spark.createDataFrame([(f,) for f in forms], "t string")
    rows = df.select(published_time_strict("t").alias("s"), utc_instant("t").alias("r")).collect()
    base = dt.datetime(2023, 1, 5, 23, 30)
    h = dt.timedelta(hours=1)
    assert [r.s for r in rows] == [base + 8 * h, base + 8 * h, None, None, None,
                                   base + 8 * h + dt.timedelta(minutes=8), None]
    assert [r.r for r in rows] == [base + 8 * h, base + 8 * h, base, base - 5.5 * h, base, base + 8 * h, None]


def test_k7_local_date_vs_utc_instant(spark):
    df = spark.createDataFrame([("2023-01-05T23:30:00-0800",)], "t string")
    r = df.select(*event_time_triplet("t", "x")).first()
    assert r.x_date == dt.date(2023, 1, 5)
    assert r.x_datetime_utc == dt.datetime(2023, 1, 6, 7, 30)
    assert r.x_datetime == "2023-01-05T23:30:00-0800"


def test_k9_positional_union_takes_first_names(spark):
    a = spark.createDataFrame([([("n", "c", Decimal("1.00"), Decimal("1.000000"))],)], f"c {CHARGE_ARRAY.simpleString()}")
    other = "array<struct<name:string,category:string,amt:decimal(13,2),amt_long:decimal(13,6)>>"
    b = spark.createDataFrame([([("m", "d", Decimal("2.00"), Decimal("2.000000"))],)], f"c {other}")
    u = a.union(b)
    names = [f.name for f in u.schema["c"].dataType.elementType.fields]
    assert names[0] == "convenience_charge_name"
    assert explode_items(u, "c", "x").count() == 2


def test_k17_null_key_part_delivered_twice(spark):
    rows = [("GiftPreference", "I1", "cat", None, dt.datetime(2023, 1, 1), Decimal("1.00"))] * 2
    df = spark.createDataFrame(rows, "convenience_charge_type string, invoice_id string, "
                               "convenience_charge_category string, convenience_charge_name string, "
                               "published_time_utc timestamp_ntz, convenience_charge_amount decimal(13,2)")
    assert latest_per_key(df, CHARGE_PRIMARY_KEY, CHARGE_SORT_COLUMN).count() == 1


def test_k18_overflow_is_detected_for_quarantine(spark):
    raw = "array<struct<a:string,b:string,c:string,d:string>>"
    df = spark.createDataFrame([([("n", "c", "123456789012345", "123456789012345")],),
                                ([("n", "c", "2.12", "2.123457")],)], f"x {raw}")
    src_type = T._parse_datatype_string(raw)
    out = df.select(casts.charges("x").alias("y"),
                    casts.cast_lost("x", casts.charges("x"), src_type, CHARGE_ARRAY).alias("lost")).collect()
    assert out[0].y[0].amount is None and out[0].lost is True
    assert out[1].lost is False


def test_k19_short_and_long_amounts_kept(spark):
    raw = "array<struct<a:string,b:string,c:string,d:string>>"
    df = spark.createDataFrame([([("n", "c", "2.12", "2.123457")],)], f"x {raw}")
    y = df.select(casts.charges("x").alias("y")).first().y[0]
    assert y.amount == Decimal("2.12") and y.convenience_charge_amount == Decimal("2.123457")


def test_half_up_rounding(spark):
    raw = "array<struct<a:string,b:string,c:string,d:string>>"
    df = spark.createDataFrame([([("n", "c", "1.005", "1.0000005")],)], f"x {raw}")
    y = df.select(casts.charges("x").alias("y")).first().y[0]
    assert y.amount == Decimal("1.01") and y.convenience_charge_amount == Decimal("1.000001")


def test_rank_kinds_with_three_way_tie(spark):
    from orderloom.operators.ranking import nth_highest, ranked
    df = spark.createDataFrame([(i, s) for i, s in enumerate([600, 500, 500, 500, 200, 100])], "id int, salary int")
    r = {k: [x.rnk for x in ranked(df, "salary", k, tie_break=["id"] if k == "row_number" else [])
                  .orderBy("rnk", "id").collect()]
         for k in ("rank", "dense_rank", "row_number")}
    assert r["rank"] == [1, 2, 2, 2, 5, 6]
    assert r["dense_rank"] == [1, 2, 2, 2, 3, 4]
    assert r["row_number"] == [1, 2, 3, 4, 5, 6]
    assert nth_highest(df, "salary", 3, "rank").count() == 0   # rank 3 is skipped
    assert [x.salary for x in nth_highest(df, "salary", 5, "rank").collect()] == [200]


def test_flatten_distinct(spark):
    df = spark.createDataFrame([([[1], [2], [2, 3], [4], [5], [5, 6]],)], "a array<array<int>>")
    assert df.select(flatten_distinct("a").alias("x")).first().x == [1, 2, 3, 4, 5, 6]


def test_k18_invoice_overflow_row_fails_dq(spark):
    from orderloom.operators import quality as dq
    from orderloom.plans import invoice
    from orderloom.sources import events as ev
    from orderloom.sources.tables import load
    sf = "/root/testdata/sf0.001"
    events = ev.invoice_events(load(spark, sf, "orders"), load(spark, sf, "lineitem"))
    path = "invoiceEventDetail.giftPreference.convenienceCharges"
    target = (events.filter(F.size(f"data.{path}") > 0)
              .select("data.invoiceEventDetail.id").first()[0])
    first = F.col("data.invoiceEventDetail.id") == target
    broken = events.withColumn("data", F.when(first, F.col("data").withField(
        path, F.transform(F.col(f"data.{path}"),
                          lambda x: x.withField("chargeAmount", F.lit("123456789012345")))))
        .otherwise(F.col("data")))
    tagged = dq.tag_rows(broken, invoice.cast_rules(broken, "giftPreference"))
    bad = dq.quarantined(tagged)
    assert bad.count() == 1
    assert bad.first().failed_rule_id == ["charge_values_fit"]


def test_k9_union_aligns_a_source_with_other_field_names(spark):
    other = T.ArrayType(T.StructType([T.StructField(n, t) for n, t in (
        ("name", T.StringType()), ("category", T.StringType()),
        ("amt", T.DecimalType(13, 2)), ("amt_long", T.DecimalType(13, 6)))]))
    c = [("fee", "cat", Decimal("1.00"), Decimal("1.000000"))]
    a = _charge_source(spark, "ship_preference", [("I1", c, "O1", "2023-01-05T23:30:00.000-0800")])
    b = _charge_source(spark, "gift_preference", [("I2", c, "O2", "2023-01-05T23:30:00.000-0800")])
    b = b.withColumn("gift_preference_convenience_charge", F.col("gift_preference_convenience_charge").cast(other))
    out = ch.convenience_charges(None, {"ship_preference": a, "gift_preference": b})
    got = sorted((r.convenience_charge_type, r.convenience_charge_name) for r in out.collect())
    assert got == [("GiftPreference", "fee"), ("ShipmentPreference", "fee")]
