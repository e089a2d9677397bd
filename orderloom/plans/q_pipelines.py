"""Registered queries over the curation pipelines, with DuckDB oracles.

Every query derives its raw events from the driver tables (see
``orderloom.sources.events``), runs the library pipeline and returns flat
columns.  Housekeeping columns are left out of the registered output (they
carry run times); nested arrays are either exploded to rows or rendered as
sorted text so that both engines compare them by value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.functions.time import published_time_strict, utc_instant
from orderloom.operators import quality as dq
from orderloom.operators.audit import stamp_audit
from orderloom.operators.explode import explode_items
from orderloom.operators.shape import drop_columns, rename
from orderloom.plans import charges as ch
from orderloom.plans import invoice, release
from orderloom.schemas import CHARGE_PRIMARY_KEY, CHARGE_SORT_COLUMN, CHARGE_STRUCT, HOUSEKEEPING_COLUMNS, TAX_STRUCT
from orderloom.sources import events as ev
from orderloom.sources.tables import load
from orderloom.streaming import pipelines as jobs


def _release_events(spark: SparkSession, sf: str) -> DataFrame:
    return ev.release_events(load(spark, sf, "orders"), load(spark, sf, "lineitem"))


def _invoice_events(spark: SparkSession, sf: str) -> DataFrame:
    return ev.invoice_events(load(spark, sf, "orders"), load(spark, sf, "lineitem"))


def _tagged_releases(spark: SparkSession, sf: str, headers: bool = False) -> DataFrame:
    """Release events tagged with the release rules, as the jobs do first."""
    events = ev.release_headers(load(spark, sf, "orders")) if headers else _release_events(spark, sf)
    return dq.tag_rows(events, jobs.release_rules() + ([] if headers else release.price_rules()))


def _stocked(spark: SparkSession, sf: str) -> DataFrame:
    return ev.stocked_skus(load(spark, sf, "part"))


def _sku(spark: SparkSession, sf: str) -> DataFrame:
    return ev.sku_dimension(load(spark, sf, "part"))



def _count(arr) -> F.Column:
    """Element count, 0 for a null array (whatever ``size(NULL)`` returns
    under the session's ANSI setting)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.when(a.isNull(), F.lit(0)).otherwise(F.size(a)).cast("bigint")


def failed_rules() -> F.Column:
    """The ids of the data-quality rules that a row fails, as text."""
    return F.array_join("failed_rule_id", ",").alias("failed_rules")


def array_text(c: str, struct: T.StructType) -> F.Column:
    """All values of an array of structs: fields joined with ``:``, elements
    in order with ``|``; a null array is empty text."""
    def element(x):
        return F.concat_ws(":", *[F.coalesce(x[f.name].cast("string"), F.lit("")) for f in struct.fields])
    return F.coalesce(F.array_join(F.transform(F.col(c), element), "|"), F.lit(""))


def describe_text(c) -> F.Column:
    """``locale:description`` pairs joined with ``|`` (array order kept)."""
    return F.array_join(F.transform(c, lambda x: F.concat(x["locale_code"], F.lit(":"),
                                                          x["description"])), "|")


# ---------------------------------------------------------------------------
# release
# ---------------------------------------------------------------------------

def q_release_flatten(spark, sf):
    out = release.release_flatten(_tagged_releases(spark, sf, headers=True))
    return out.select(*[c for _, c in release.RELEASE_COLUMNS], failed_rules())


def q_release_item_explode(spark, sf):
    lines = release.release_lines(_release_events(spark, sf))
    i = "release_item"
    return lines.select(
        F.col("data.releaseEventDetails.id").alias("release_id"),
        F.col(f"{i}.releaseLineNumber").alias("release_line_number"),
        F.col(f"{i}.quantity").alias("item_quantity"),
        F.col(f"{i}.shipNode").alias("ship_node"),
        F.col(f"{i}.isBackOrder").alias("is_backorder"),
        F.col(f"{i}.releaseAdjustStatus.releaseAdjustType").alias("adjustment_type"),
        F.col(f"{i}.releaseAdjustStatus.releaseAdjustDate").alias("adjustment_date"),
        F.col(f"{i}.product.skuNumber").alias("sku_number"),
    )


def q_array_field_project(spark, sf):
    e = _release_events(spark, sf)
    skus = F.col("data.releaseEventDetails.releaseItems.product.skuNumber")
    return e.select(F.col("data.releaseEventDetails.id").alias("release_id"),
                    _count(skus).alias("line_count"),
                    F.array_join(F.array_sort(skus), ",").alias("sku_numbers"))


def q_release_line_counts(spark, sf):
    """Lines of each release, and how many rows two independent explodes of
    them would give (quirk K1), without making those."""
    items = F.col("data.releaseEventDetails.releaseItems")
    n = F.size(items).cast("bigint")
    return (_release_events(spark, sf).filter(F.size(items) > 0)
            .select(F.col("data.releaseEventDetails.id").alias("release_id"),
                    n.alias("correlated_rows"), (n * n).alias("cross_rows")))


def q_release_item_sku_join(spark, sf):
    return release.release_items(_release_events(spark, sf), _stocked(spark, sf)).select(
        "release_id", "release_line_number", "sku_number", "sku_id")


def q_release_item_pipeline(spark, sf):
    out = release.release_items(_tagged_releases(spark, sf), _stocked(spark, sf))
    arrays = ["product_style_descriptions", "item_descriptions", "item_size_descriptions",
              "product_color_descriptions"]
    keep = [c for c in out.columns if c not in HOUSEKEEPING_COLUMNS]
    return out.select(*[describe_text(c).alias(c) if c in arrays else F.col(c) for c in keep], failed_rules())


def q_orphan_items_anti(spark, sf):
    return release.orphan_items(_release_events(spark, sf), _stocked(spark, sf))


def q_price_decimal_cast(spark, sf):
    return release.release_items(_release_events(spark, sf), _sku(spark, sf)).select(
        "release_id", "release_line_number", "sku_number",
        "current_price", "paid_price", "list_price", "retail_price")


def q_description_array_cast(spark, sf):
    out = release.release_items(_release_events(spark, sf), _sku(spark, sf))
    d = explode_items(out.select("release_id", "release_line_number", "sku_number",
                                 "item_descriptions"), "item_descriptions", "d")
    return d.select("release_id", "release_line_number", "sku_number",
                    F.col("d.locale_code").alias("locale_code"),
                    F.col("d.description").alias("description"))


def q_drop_columns(spark, sf):
    return drop_columns(_sku(spark, sf), HOUSEKEEPING_COLUMNS + ["not_a_column"])


def q_rename_column(spark, sf):
    co = ev.customer_orders(load(spark, sf, "orders"))
    return rename(co, "order_id", "cust_order_id").select("cust_order_id", "order_date")


# ---------------------------------------------------------------------------
# invoice sections
# ---------------------------------------------------------------------------

def _section_query(spark, sf, section):
    events = _invoice_events(spark, sf)
    tagged = dq.tag_rows(events, jobs.invoice_rules(section) + invoice.cast_rules(events, section))
    out = invoice.preference_flatten(tagged, section)
    prefix, _ = invoice.SECTIONS[section]
    arr_c, arr_t = f"{prefix}convenience_charge", f"{prefix}convenience_charge_tax"
    keep = [c for c in out.columns if c not in HOUSEKEEPING_COLUMNS + [arr_c, arr_t]]
    return out.select(*keep,
                      array_text(arr_c, CHARGE_STRUCT).alias("charges"),
                      array_text(arr_t, TAX_STRUCT).alias("taxes"), failed_rules())


def q_gift_preference_flatten(spark, sf):
    return _section_query(spark, sf, "giftPreference")


def q_shipment_adjustment_flatten(spark, sf):
    return _section_query(spark, sf, "shipmentPreferenceAdjustment")


def q_shipment_preference_flatten(spark, sf):
    return _section_query(spark, sf, "shipmentPreference")


def q_gift_adjustment_flatten(spark, sf):
    return _section_query(spark, sf, "giftPreferenceAdjustment")


def q_charge_array_cast(spark, sf):
    g = invoice.gift_preference(_invoice_events(spark, sf))
    x = explode_items(g.select("invoice_id", "gift_preference_convenience_charge"),
                      "gift_preference_convenience_charge", "c")
    return x.select("invoice_id", "c.convenience_charge_name", "c.convenience_charge_category",
                    "c.amount", "c.convenience_charge_amount")


def q_tax_array_cast(spark, sf):
    g = invoice.gift_preference(_invoice_events(spark, sf))
    x = explode_items(g.select("invoice_id", "gift_preference_convenience_charge_tax"),
                      "gift_preference_convenience_charge_tax", "t")
    return x.select("invoice_id", "t.*")


def q_audit_columns(spark, sf):
    g = invoice.gift_preference(_invoice_events(spark, sf))
    s = stamp_audit(g, "gift_preference_job", epoch_id=7, published_utc="published_time_utc",
                    processed_at=F.lit("2024-01-01 00:00:00").cast("timestamp"))
    return s.select("invoice_id", F.col("processed_timestamp").cast("timestamp_ntz").alias("processed_timestamp"),
                    "processed_by", "epoch_id", "latency")


# ---------------------------------------------------------------------------
# convenience charges
# ---------------------------------------------------------------------------

def _feed(spark, sf):
    return ev.charge_feed(load(spark, sf, "events"))


CHARGE_OUT = ["convenience_charge_type", "invoice_id", "convenience_charge_category",
              "convenience_charge_name", "convenience_charge_amount",
              "convenience_charge_amount_full", "order_id", "order_date", "order_datetime",
              "order_datetime_utc", "invoiced_on_date", "invoiced_on_datetime",
              "invoiced_on_datetime_utc", "published_time", "published_time_utc"]


def q_convenience_charge_pipeline(spark, sf):
    """Invoice events -> the four sections' charge arrays (one projection)
    -> stacked charge rows -> left join to orders -> latest per key."""
    return _invoiced_charges(spark, sf, load(spark, sf, "lineitem")).select(*CHARGE_OUT, failed_rules())


def _invoiced_charges(spark, sf, lineitem) -> DataFrame:
    orders = load(spark, sf, "orders")
    wide = invoice.charge_sources_flatten(ev.invoice_events(orders, lineitem))
    tagged = dq.tag_rows(ch.stacked_rows(wide), jobs.charge_rules(retyped=True))
    return ch.finish_charges(tagged, ev.customer_orders(orders), latest=True)


# Lines of every such supplier are priced so many times higher;
# their charges fit the short amount and overflow the long one.
DEAR_SUPPLIER, DEAR_FACTOR = 13, 100_000


def q_charge_overflow_tagged(spark, sf):
    """Charges whose long amount does not fit its decimal: the value is null
    and the row is tagged, in all four sections (K18)."""
    dear = F.col("l_suppkey") % DEAR_SUPPLIER == 0
    lines = load(spark, sf, "lineitem").withColumn(
        "l_extendedprice", F.when(dear, F.col("l_extendedprice") * DEAR_FACTOR).otherwise(F.col("l_extendedprice")))
    return _invoiced_charges(spark, sf, lines).select(
        *CHARGE_PRIMARY_KEY, "convenience_charge_amount", "convenience_charge_amount_full", failed_rules())


def q_charge_union(spark, sf):
    u = ch.charge_union(_feed(spark, sf))
    return u.select("convenience_charge_type", "invoice_id",
                    F.col("charge.convenience_charge_category").alias("convenience_charge_category"),
                    F.col("charge.convenience_charge_name").alias("convenience_charge_name"),
                    F.col("charge.amount").alias("convenience_charge_amount"),
                    F.col("charge.convenience_charge_amount").alias("convenience_charge_amount_full"),
                    "order_id", "published_time")


def q_union_positional_struct(spark, sf):
    """Positional ``union`` of two sources whose charge structs differ in names.

    The second source's struct is renamed (same types, other names); a
    positional union keeps the first branch's names (K9).
    """
    feed = _feed(spark, sf)
    a = feed["ship_preference"].select("invoice_id", F.col("ship_preference_convenience_charge").alias("c"))
    other = "struct<name:string,category:string,amt:decimal(13,2),amt_long:decimal(13,6)>"
    b = feed["gift_preference"].select(
        "invoice_id", F.col("gift_preference_convenience_charge").cast(f"array<{other}>").alias("c"))
    u = a.union(b)
    x = explode_items(u, "c", "charge")
    return x.select("invoice_id", *[F.col(f"charge.{f.name}").alias(f.name) for f in CHARGE_STRUCT.fields])


def q_charge_order_left_join(spark, sf):
    u = ch.charge_union(_feed(spark, sf))
    keys = ch.order_keys(ev.customer_orders(load(spark, sf, "orders")))
    j = u.join(keys, F.col("order_id") == F.col("cust_order_id"), "left")
    return j.select("convenience_charge_type", "invoice_id",
                    F.col("charge.convenience_charge_category").alias("convenience_charge_category"),
                    F.col("charge.convenience_charge_name").alias("convenience_charge_name"),
                    "order_id", F.col("cust_order_id").isNotNull().alias("order_known"))


def charges_from_feed(spark, sf) -> DataFrame:
    """Base+2 charges from the ``events`` feed, read once (wide form)."""
    co = ev.customer_orders(load(spark, sf, "orders"))
    feed = ch.stacked_rows(ev.charge_feed_wide(load(spark, sf, "events")))
    return ch.finish_charges(dq.tag_rows(feed, jobs.charge_rules()), co)


def q_charge_latest_per_key(spark, sf):
    return ch.latest_charges(charges_from_feed(spark, sf)).select(*CHARGE_OUT, failed_rules())


def q_published_time_normalise(spark, sf):
    return _time_texts(spark, sf).select(
        "event_id", "published_time",
        published_time_strict("published_time").alias("published_time_utc"))


def q_published_time_robust(spark, sf):
    return _time_texts(spark, sf).select(
        "event_id", "published_time", utc_instant("published_time").alias("published_time_utc"))


def q_event_time_triplet(spark, sf):
    from orderloom.functions.time import event_time_triplet
    return _time_texts(spark, sf).select("event_id", *event_time_triplet("published_time", "published"))


def _time_texts(spark, sf) -> DataFrame:
    e = load(spark, sf, "events")
    form = F.element_at(F.array(*[F.lit(s) for s in ev.OFFSET_FORMS]),
                        (F.pmod(F.col("event_id"), F.lit(len(ev.OFFSET_FORMS))) + 1).cast("int"))
    return e.select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS"),
                                         form).alias("published_time"))


QUERIES = {
    "release_flatten": q_release_flatten,
    "release_item_explode": q_release_item_explode,
    "array_field_project": q_array_field_project,
    "release_line_counts": q_release_line_counts,
    "release_item_sku_join": q_release_item_sku_join,
    "release_item_pipeline": q_release_item_pipeline,
    "orphan_items_anti": q_orphan_items_anti,
    "price_decimal_cast": q_price_decimal_cast,
    "description_array_cast": q_description_array_cast,
    "drop_columns": q_drop_columns,
    "rename_column": q_rename_column,
    "gift_preference_flatten": q_gift_preference_flatten,
    "shipment_adjustment_flatten": q_shipment_adjustment_flatten,
    "shipment_preference_flatten": q_shipment_preference_flatten,
    "gift_adjustment_flatten": q_gift_adjustment_flatten,
    "charge_array_cast": q_charge_array_cast,
    "tax_array_cast": q_tax_array_cast,
    "audit_columns": q_audit_columns,
    "convenience_charge_pipeline": q_convenience_charge_pipeline,
    "charge_overflow_tagged": q_charge_overflow_tagged,
    "charge_union": q_charge_union,
    "union_positional_struct": q_union_positional_struct,
    "charge_order_left_join": q_charge_order_left_join,
    "charge_latest_per_key": q_charge_latest_per_key,
    "published_time_normalise": q_published_time_normalise,
    "published_time_robust": q_published_time_robust,
    "event_time_triplet": q_event_time_triplet,
}

# ---------------------------------------------------------------------------
# DuckDB oracles (same tables, same column names)
# ---------------------------------------------------------------------------

_TS = "'%Y-%m-%dT%H:%M:%S'"
_TSMS = "'%Y-%m-%dT%H:%M:%S.%g'"

_RELEASE_SQL = f"""
SELECT 'R' || o_orderkey AS release_id, 'v' || o_custkey AS event_version_id,
  'ReleaseCreated' AS event_name, strftime(o_orderdate, {_TSMS}) || '-0800' AS event_published_time,
  strftime(o_orderdate, {_TS}) AS event_created_on, 'order-service' AS event_created_by,
  strftime(o_orderdate, {_TS}) AS release_created_on, CAST(o_orderkey AS VARCHAR) AS order_id,
  strftime(o_orderdate, '%Y-%m-%d') AS order_date, 'INV' || o_orderkey AS invoice_id,
  o_orderpriority AS market, 'US' AS country_code, 'N' || o_custkey AS parent_ship_node,
  strftime(o_orderdate + INTERVAL 7 DAY, '%Y-%m-%d') AS in_home_delivery_date,
  '1' AS stock_order_download_version, o_orderstatus AS release_status,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN '' ELSE 'release_status_known' END AS failed_rules
FROM orders"""

_LINES = """
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey"""

_ITEM_SQL = f"""
SELECT 'R' || l_orderkey || '-' || l_suppkey AS release_id, CAST(l_linenumber AS VARCHAR) AS release_line_number,
  'v' || o_custkey AS event_version_id, CAST(l_linenumber AS VARCHAR) AS order_line_number,
  CAST(l_quantity AS INTEGER) AS item_quantity, 'S' || l_suppkey AS ship_node,
  l_linestatus = 'O' AS is_backorder, l_returnflag AS adjustment_type,
  strftime(l_shipdate, '%Y-%m-%d') AS adjustment_date, CAST(l_partkey AS VARCHAR) AS sku_number,
  'SKU' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS sku_id, 'T' || l_linestatus AS product_type_name,
  l_partkey || '-' || l_suppkey AS style_number, 'B' || l_suppkey AS sku_brand,
  'en_US:style ' || l_partkey AS product_style_descriptions,
  'en_US:item ' || l_partkey || '|fr_FR:article ' || l_partkey AS item_descriptions,
  'en_US:size ' || CAST(l_quantity AS INTEGER) AS item_size_descriptions,
  'en_US:colour ' || l_returnflag AS product_color_descriptions,
  CAST(l_extendedprice AS DECIMAL(13,4)) AS current_price,
  CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(13,4)) AS paid_price,
  CAST(l_extendedprice * (1 + l_tax) AS DECIMAL(13,4)) AS list_price,
  CAST(l_extendedprice AS DECIMAL(13,4)) AS retail_price,
  CASE WHEN o_orderstatus IN ('F', 'O') THEN '' ELSE 'release_status_known' END AS failed_rules
{_LINES} JOIN part p ON l.l_partkey = p.p_partkey"""
_STOCKED_SQL = f"{_ITEM_SQL} AND p.p_type IS DISTINCT FROM 'PROMO'"

_AMT = "CAST(l_extendedprice AS DECIMAL(15,2)) * CAST(l_discount AS DECIMAL(15,2))"


# Lines of one invoice are in the order of their raw columns.
_LINE_ORDER = "l_linenumber, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"
_PCT = "CAST(l_tax AS DECIMAL(15,2)) * 100"
_TAX = f"{_AMT} * CAST(l_tax AS DECIMAL(15,2))"


def _two(x: str) -> str:
    return f"CAST({x} AS DECIMAL(13,2)) || ':' || CAST({x} AS DECIMAL(13,6))"


_CHARGE_TEXT = f"'line-' || l_linenumber || ':FLAG_' || l_returnflag || ':' || {_two(_AMT)}"
_TAX_TEXT = f"""'SALES:line-' || l_linenumber || ':' || {_two(_AMT)} || ':TAX_' || l_linestatus || ':'
  || {_two(_PCT)} || ':' || {_two(_TAX)}"""


def _section_sql(k: int, prefix: str, gift: bool) -> str:
    if gift:
        scalars = f"""o_orderpriority LIKE '1-%' AS {prefix}gift_indicator,
  'wrap ' || o_orderpriority AS {prefix}premium_gift_wrap_description,
  1 AS {prefix}complimentary_box_quantity, o_orderstatus AS {prefix}tax_code,
  CAST(o_custkey AS VARCHAR) AS {prefix}premium_gift_wrap_sku_number,
  'Hello' AS {prefix}instruction_header, 'Thanks' AS {prefix}instruction_footer,
  o_orderpriority AS {prefix}instruction_body, 'GIFT' AS {prefix}instruction_type"""
    else:
        scalars = f"""'N' || o_custkey AS {prefix}fulfilled_from_node_id, 7 AS {prefix}maximum_days_to_deliver,
  2 AS {prefix}minimum_days_to_deliver, o_orderstatus = 'F' AS {prefix}is_business_day,
  true AS {prefix}is_within_cutoff, o_orderpriority AS {prefix}method, 'STD' AS {prefix}shipping_group,
  CAST(NULL AS VARCHAR) AS {prefix}ship_charge_override_reason,
  'Hello' AS {prefix}instruction_header, 'Thanks' AS {prefix}instruction_footer,
  o_orderpriority AS {prefix}instruction_body, 'SHIP' AS {prefix}instruction_type"""
    return f"""
SELECT 'INV' || o_orderkey || '-' || COALESCE(l_suppkey, 0) AS invoice_id, {scalars},
  CAST(o_orderkey AS VARCHAR) AS order_id, 'ov' || o_custkey AS order_version_id,
  CAST(o_orderdate AS DATE) AS order_date, strftime(o_orderdate, {_TS}) || '-0800' AS order_datetime,
  o_orderdate + INTERVAL 8 HOUR AS order_datetime_utc,
  CAST(o_orderdate + INTERVAL 47 HOUR + INTERVAL 30 MINUTE AS DATE) AS invoiced_on_date,
  strftime(o_orderdate + INTERVAL 47 HOUR + INTERVAL 30 MINUTE, {_TS}) || '-0800' AS invoiced_on_datetime,
  o_orderdate + INTERVAL 55 HOUR + INTERVAL 30 MINUTE AS invoiced_on_datetime_utc,
  'v' || o_custkey AS version_id,
  strftime(o_orderdate + INTERVAL 47 HOUR + INTERVAL 35 MINUTE, {_TSMS}) || '-0800' AS published_time,
  o_orderdate + INTERVAL 55 HOUR + INTERVAL 35 MINUTE AS published_time_utc,
  COALESCE(c.charges, '') AS charges, COALESCE(c.taxes, '') AS taxes,
  CASE WHEN c.charges IS NULL THEN 'charges_present' ELSE '' END AS failed_rules
FROM orders LEFT JOIN (SELECT l_orderkey, l_suppkey,
    string_agg(charge, '|' ORDER BY {_LINE_ORDER}) FILTER (l_linenumber % 4 = {k}) AS charges,
    string_agg(tax, '|' ORDER BY {_LINE_ORDER}) FILTER (l_linenumber % 4 = {k}) AS taxes
  FROM (SELECT *, {_CHARGE_TEXT} AS charge, {_TAX_TEXT} AS tax FROM lineitem) GROUP BY l_orderkey, l_suppkey) c
  ON c.l_orderkey = o_orderkey"""


# Charges from the events feed: two charges per event, kind = event_id mod 4.
_FEED_SQL = f"""
WITH e AS (
  SELECT * REPLACE (ts + to_days(CAST(event_id % 180 AS INTEGER)) AS ts), CASE event_id % 4 WHEN 0 THEN 'ShipmentPreference' WHEN 1 THEN 'GiftPreference'
              WHEN 2 THEN 'ShipmentPreferenceAdjustment' ELSE 'GiftPreferenceAdjustment' END AS kind
  FROM events),
c AS (
  SELECT kind, 'INV' || user_id AS invoice_id, event_type AS cat, 'convenience_fee' AS name,
         CAST(value AS DECIMAL(13,2)) AS amt, CAST(value AS DECIMAL(13,6)) AS amt_full, e.* FROM e
  UNION ALL
  SELECT kind, 'INV' || user_id, event_type, 'handling_fee',
         CAST(json_extract_string(props, '$.k') AS DECIMAL(13,2)),
         CAST(CAST(json_extract_string(props, '$.k') AS DECIMAL(13,2)) AS DECIMAL(13,6)), e.* FROM e)"""

# Offset spellings by event, and the instants they stand for.
_FORM = """CASE event_id % 6 WHEN 0 THEN '-0800' WHEN 1 THEN '-08:00' WHEN 2 THEN 'Z' WHEN 3 THEN '+05:30'
  WHEN 4 THEN '' ELSE '-08' END"""
_UTC = """date_trunc('milliseconds', ts) + CASE event_id % 6 WHEN 2 THEN INTERVAL 0 MINUTE
  WHEN 3 THEN INTERVAL (-330) MINUTE WHEN 4 THEN INTERVAL 0 MINUTE ELSE INTERVAL 480 MINUTE END"""

_FEED_COLS = f"""kind AS convenience_charge_type, invoice_id, cat AS convenience_charge_category,
  name AS convenience_charge_name, amt AS convenience_charge_amount,
  amt_full AS convenience_charge_amount_full, CAST(user_id AS VARCHAR) AS order_id,
  CAST(ts AS DATE) AS order_date, strftime(ts, {_TS}) || '-0800' AS order_datetime,
  ts + INTERVAL 8 HOUR AS order_datetime_utc, CAST(ts AS DATE) AS invoiced_on_date,
  strftime(ts, {_TS}) || '-0800' AS invoiced_on_datetime,
  ts + INTERVAL 8 HOUR AS invoiced_on_datetime_utc,
  strftime(ts, {_TSMS}) || {_FORM} AS published_time, {_UTC} AS published_time_utc,
  CASE WHEN amt > 0 THEN '' ELSE 'charge_amount_positive' END AS failed_rules"""

_LATEST_ORDER = "ORDER BY " + ", ".join(f"{c} DESC NULLS LAST" for c in [CHARGE_SORT_COLUMN, *ch.CHARGE_TIE_BREAK])

CHARGE_LATEST_SQL = f"""{_FEED_SQL}
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(CHARGE_PRIMARY_KEY)} {_LATEST_ORDER}) AS rn
  FROM (SELECT {_FEED_COLS} FROM c))
WHERE rn = 1"""

_PIPE_SQL = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(CHARGE_PRIMARY_KEY)} {_LATEST_ORDER}) AS rn
  FROM (
    SELECT CASE l_linenumber % 4 WHEN 0 THEN 'ShipmentPreference' WHEN 1 THEN 'GiftPreference'
             WHEN 2 THEN 'ShipmentPreferenceAdjustment' ELSE 'GiftPreferenceAdjustment' END
             AS convenience_charge_type,
      'INV' || l_orderkey || '-' || l_suppkey AS invoice_id, 'FLAG_' || l_returnflag AS convenience_charge_category,
      'line-' || l_linenumber AS convenience_charge_name,
      CAST({_AMT} AS DECIMAL(13,2)) AS convenience_charge_amount,
      CAST({_AMT} AS DECIMAL(13,6)) AS convenience_charge_amount_full,
      CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_orderdate AS DATE) AS order_date,
      strftime(o_orderdate, {_TS}) || '-0800' AS order_datetime,
      o_orderdate + INTERVAL 8 HOUR AS order_datetime_utc,
      CAST(o_orderdate + INTERVAL 47 HOUR + INTERVAL 30 MINUTE AS DATE) AS invoiced_on_date,
      strftime(o_orderdate + INTERVAL 47 HOUR + INTERVAL 30 MINUTE, {_TS}) || '-0800' AS invoiced_on_datetime,
      o_orderdate + INTERVAL 55 HOUR + INTERVAL 30 MINUTE AS invoiced_on_datetime_utc,
      strftime(o_orderdate + INTERVAL 47 HOUR + INTERVAL 35 MINUTE, {_TSMS}) || '-0800' AS published_time,
      o_orderdate + INTERVAL 55 HOUR + INTERVAL 35 MINUTE AS published_time_utc,
      CASE WHEN CAST({_AMT} AS DECIMAL(13,2)) > 0 THEN '' ELSE 'charge_amount_positive' END AS failed_rules
    {_LINES}))
WHERE rn = 1"""

_TIME_TEXT = f"""
WITH t AS (SELECT event_id, ts, event_id % 6 AS f,
  strftime(ts, {_TSMS}) || CASE event_id % 6 WHEN 0 THEN '-0800' WHEN 1 THEN '-08:00' WHEN 2 THEN 'Z'
     WHEN 3 THEN '+05:30' WHEN 4 THEN '' ELSE '-08' END AS published_time FROM events)"""

_MS = "date_trunc('milliseconds', ts)"

ORACLES = {
    "release_flatten": _RELEASE_SQL,
    "release_item_explode": f"""
SELECT 'R' || l_orderkey || '-' || l_suppkey AS release_id, CAST(l_linenumber AS VARCHAR) AS release_line_number,
  CAST(l_quantity AS INTEGER) AS item_quantity, 'S' || l_suppkey AS ship_node,
  l_linestatus = 'O' AS is_backorder, l_returnflag AS adjustment_type,
  strftime(l_shipdate, '%Y-%m-%d') AS adjustment_date, CAST(l_partkey AS VARCHAR) AS sku_number
{_LINES}""",
    "array_field_project": """
SELECT 'R' || o_orderkey || '-' || COALESCE(l_suppkey, 0) AS release_id, COALESCE(n, 0) AS line_count,
  skus AS sku_numbers
FROM orders LEFT JOIN (SELECT l_orderkey, l_suppkey, count(*) AS n,
    array_to_string(list_sort(list(CAST(l_partkey AS VARCHAR))), ',') AS skus
  FROM lineitem GROUP BY l_orderkey, l_suppkey) g ON g.l_orderkey = o_orderkey""",
    "release_line_counts": """
SELECT 'R' || l_orderkey || '-' || l_suppkey AS release_id, count(*) AS correlated_rows,
  count(*) * count(*) AS cross_rows
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey GROUP BY l_orderkey, l_suppkey""",
    "release_item_sku_join": f"SELECT release_id, release_line_number, sku_number, sku_id FROM ({_STOCKED_SQL})",
    "release_item_pipeline": _STOCKED_SQL,
    "orphan_items_anti": f"""
SELECT 'R' || l_orderkey || '-' || l_suppkey AS release_id, CAST(l_linenumber AS VARCHAR) AS release_line_number,
  CAST(l_partkey AS VARCHAR) AS sku_number
{_LINES}
WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey
                  AND p.p_type IS DISTINCT FROM 'PROMO')""",
    "price_decimal_cast": f"""SELECT release_id, release_line_number, sku_number, current_price, paid_price,
  list_price, retail_price FROM ({_ITEM_SQL})""",
    "description_array_cast": f"""
SELECT 'R' || l_orderkey || '-' || l_suppkey AS release_id, CAST(l_linenumber AS VARCHAR) AS release_line_number,
  CAST(l_partkey AS VARCHAR) AS sku_number, d.locale_code, d.description
{_LINES} JOIN part p ON l.l_partkey = p.p_partkey
CROSS JOIN LATERAL (SELECT 'en_US' AS locale_code, 'item ' || l.l_partkey AS description
                    UNION ALL SELECT 'fr_FR', 'article ' || l.l_partkey) d""",
    "drop_columns": """
SELECT CAST(p_partkey AS VARCHAR) AS sku_number, 'SKU' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS sku_id
FROM part""",
    "rename_column": "SELECT CAST(o_orderkey AS VARCHAR) AS cust_order_id, CAST(o_orderdate AS DATE) AS order_date FROM orders",
    "gift_preference_flatten": _section_sql(1, "gift_preference_", True),
    "shipment_adjustment_flatten": _section_sql(2, "ship_preference_adjustment_", False),
    "shipment_preference_flatten": _section_sql(0, "ship_preference_", False),
    "gift_adjustment_flatten": _section_sql(3, "gift_preference_adjustment_", True),
    "charge_array_cast": f"""
SELECT 'INV' || l_orderkey || '-' || l_suppkey AS invoice_id, 'line-' || l_linenumber AS convenience_charge_name,
  'FLAG_' || l_returnflag AS convenience_charge_category, CAST({_AMT} AS DECIMAL(13,2)) AS amount,
  CAST({_AMT} AS DECIMAL(13,6)) AS convenience_charge_amount
{_LINES} WHERE l_linenumber % 4 = 1""",
    "tax_array_cast": f"""
SELECT 'INV' || l_orderkey || '-' || l_suppkey AS invoice_id, 'SALES' AS tax_charge_category,
  'line-' || l_linenumber AS tax_charge_name, CAST({_AMT} AS DECIMAL(13,2)) AS taxable_amount,
  CAST({_AMT} AS DECIMAL(13,6)) AS charge_taxable_amount, 'TAX_' || l_linestatus AS tax_name,
  CAST(CAST(l_tax AS DECIMAL(15,2)) * 100 AS DECIMAL(13,2)) AS tax_percentage,
  CAST(CAST(l_tax AS DECIMAL(15,2)) * 100 AS DECIMAL(13,6)) AS charge_tax_percentage,
  CAST({_AMT} * CAST(l_tax AS DECIMAL(15,2)) AS DECIMAL(13,2)) AS tax_amount,
  CAST({_AMT} * CAST(l_tax AS DECIMAL(15,2)) AS DECIMAL(13,6)) AS charge_tax_amount
{_LINES} WHERE l_linenumber % 4 = 1""",
    "audit_columns": """
SELECT 'INV' || o_orderkey || '-' || COALESCE(l_suppkey, 0) AS invoice_id, TIMESTAMP '2024-01-01 00:00:00' AS processed_timestamp,
  'gift_preference_job' AS processed_by, CAST(7 AS BIGINT) AS epoch_id,
  epoch(TIMESTAMP '2024-01-01 00:00:00') - epoch(o_orderdate + INTERVAL 55 HOUR + INTERVAL 35 MINUTE) AS latency
FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem) s ON s.l_orderkey = o_orderkey""",
    "convenience_charge_pipeline": _PIPE_SQL,
    "charge_union": f"""{_FEED_SQL}
SELECT kind AS convenience_charge_type, invoice_id, cat AS convenience_charge_category,
  name AS convenience_charge_name, amt AS convenience_charge_amount,
  amt_full AS convenience_charge_amount_full, CAST(user_id AS VARCHAR) AS order_id,
  strftime(ts, {_TSMS}) || {_FORM} AS published_time FROM c""",
    "union_positional_struct": f"""{_FEED_SQL}
SELECT invoice_id, name AS convenience_charge_name, cat AS convenience_charge_category,
  amt AS amount, amt_full AS convenience_charge_amount
FROM c WHERE kind IN ('ShipmentPreference', 'GiftPreference')""",
    "charge_order_left_join": f"""{_FEED_SQL}
SELECT kind AS convenience_charge_type, invoice_id, cat AS convenience_charge_category,
  name AS convenience_charge_name, CAST(user_id AS VARCHAR) AS order_id,
  k.o IS NOT NULL AS order_known
FROM c LEFT JOIN (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS o FROM orders) k
  ON k.o = CAST(c.user_id AS VARCHAR)""",
    "charge_latest_per_key": CHARGE_LATEST_SQL,
    "published_time_normalise": f"""{_TIME_TEXT}
SELECT event_id, published_time,
  CASE f WHEN 0 THEN {_MS} + INTERVAL 8 HOUR WHEN 1 THEN {_MS} + INTERVAL 8 HOUR
         WHEN 5 THEN {_MS} + INTERVAL 8 HOUR + INTERVAL 8 MINUTE END AS published_time_utc
FROM t""",
    "published_time_robust": f"""{_TIME_TEXT}
SELECT event_id, published_time,
  CASE f WHEN 0 THEN {_MS} + INTERVAL 8 HOUR WHEN 1 THEN {_MS} + INTERVAL 8 HOUR
         WHEN 2 THEN {_MS} WHEN 3 THEN {_MS} - INTERVAL 5 HOUR - INTERVAL 30 MINUTE
         WHEN 4 THEN {_MS} ELSE {_MS} + INTERVAL 8 HOUR END AS published_time_utc
FROM t""",
    "event_time_triplet": f"""{_TIME_TEXT}
SELECT event_id, CAST(ts AS DATE) AS published_date, published_time AS published_datetime,
  CASE f WHEN 0 THEN {_MS} + INTERVAL 8 HOUR WHEN 1 THEN {_MS} + INTERVAL 8 HOUR
         WHEN 2 THEN {_MS} WHEN 3 THEN {_MS} - INTERVAL 5 HOUR - INTERVAL 30 MINUTE
         WHEN 4 THEN {_MS} ELSE {_MS} + INTERVAL 8 HOUR END AS published_datetime_utc
FROM t""",
}

_DEAR_AMT = _AMT.replace("CAST(l_extendedprice AS", f"CAST(l_extendedprice * CASE WHEN l_suppkey % {DEAR_SUPPLIER} = 0 THEN {DEAR_FACTOR} ELSE 1 END AS")
_DEAR_FULL = f"TRY_CAST({_DEAR_AMT} AS DECIMAL(13,6))"
ORACLES["charge_overflow_tagged"] = f"""
SELECT {', '.join(CHARGE_PRIMARY_KEY)}, convenience_charge_amount, convenience_charge_amount_full, failed_rules FROM (
  SELECT *, row_number() OVER (PARTITION BY {', '.join(CHARGE_PRIMARY_KEY)}
                               ORDER BY published_time_utc DESC, convenience_charge_amount DESC NULLS LAST,
                                        convenience_charge_amount_full DESC NULLS LAST) AS rn
  FROM (
    SELECT CASE l_linenumber % 4 WHEN 0 THEN 'ShipmentPreference' WHEN 1 THEN 'GiftPreference'
             WHEN 2 THEN 'ShipmentPreferenceAdjustment' ELSE 'GiftPreferenceAdjustment' END AS convenience_charge_type,
      'INV' || l_orderkey || '-' || l_suppkey AS invoice_id, 'FLAG_' || l_returnflag AS convenience_charge_category,
      'line-' || l_linenumber AS convenience_charge_name,
      CAST({_DEAR_AMT} AS DECIMAL(13,2)) AS convenience_charge_amount, {_DEAR_FULL} AS convenience_charge_amount_full,
      o_orderdate AS published_time_utc,
      concat_ws(',', CASE WHEN CAST({_DEAR_AMT} AS DECIMAL(13,2)) > 0 THEN NULL ELSE 'charge_amount_positive' END,
                CASE WHEN {_DEAR_FULL} IS NULL THEN 'charge_values_fit' END) AS failed_rules
    {_LINES}))
WHERE rn = 1"""
