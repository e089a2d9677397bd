"""Raw nested events and base tables derived from the driver tables.

The curated jobs read nested order events (a ``data`` envelope with arrays of
lines, charges and taxes).  The driver ships flat TPC-H-style tables, so these
builders derive the raw layer from them with Spark only: every event is a
deterministic function of ``orders`` / ``lineitem`` / ``part`` / ``events``
rows and grows with them.

An order is released and invoiced once for each ship node (supplier) of its
lines, so an event holds the lines of one (order, ship node) whatever the
size of the order.  Nesting the lines is the only grouping step.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.schemas import CHARGE_KINDS

_TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss"
_TS_TEXT_MS = "yyyy-MM-dd'T'HH:mm:ss.SSS"
# Fixed value: the feed publishes local (US Pacific standard) time with offset.
FEED_OFFSET = "-0800"
# Offset spellings that the charge feed's publishers use (K6).
OFFSET_FORMS = ["-0800", "-08:00", "Z", "+05:30", "", "-08"]
# The charge feed covers this many days, whatever the days of ``events``.
FEED_DAYS = 180


def _dec_text(c: Column, scale: int = 2) -> Column:
    """Exact decimal text of a double money / rate value."""
    return c.cast(T.DecimalType(15, scale))


def nest_children(children: DataFrame, keys: list[str], items_name: str,
                  shuffle_by: list[str] | None = None) -> DataFrame:
    """``children`` grouped into ``(*keys, items_name)`` arrays.

    Each array element is a struct of the child's remaining (raw) columns,
    sorted, so arrays are deterministic; callers shape the elements with
    ``transform`` afterwards (collecting narrow primitive structs is several
    times cheaper than collecting the final nested ones), after any join: what
    is shuffled is the raw columns alone.  Rows are shuffled by key before they
    are grouped: nearly every row of a map task has a key of its own, so arrays
    begun there save nothing and are sorted and spilled by the size of a split.

    ``shuffle_by`` (some of the keys) is what rows are shuffled by, all keys if
    not given.  Where the result is joined on some of the keys, shuffling by
    those serves the join too, so arrays are not shuffled again.
    """
    item = F.struct(*[F.col(c) for c in children.columns if c not in keys])
    dealt = children.repartition(*(shuffle_by or keys))
    return dealt.groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias(items_name))


def _housekeeping(ts: Column) -> list[Column]:
    """Audit + DQ columns as a base table carries them (deterministic)."""
    return [
        ts.cast("timestamp").alias("processed_timestamp"),
        F.lit("loader").alias("processed_by"),
        F.lit(0).cast("bigint").alias("epoch_id"),
        F.lit(0.0).alias("latency"),
        F.array().cast("array<string>").alias("failed_rule_id"),
        F.lit(None).cast("timestamp").alias("dq_processed_timestamp"),
    ]


# ---------------------------------------------------------------------------
# Release events (orders header + lineitem lines)
# ---------------------------------------------------------------------------

def _descriptions(*pairs: tuple[str, Column]) -> Column:
    return F.array(*[F.struct(F.lit(loc).alias("locale"), txt.alias("text")) for loc, txt in pairs])


def release_item_struct(r) -> Column:
    """Release line built from one raw lineitem element ``r``."""
    def l(name):
        return r[name]
    return F.struct(
        l("l_linenumber").cast("string").alias("releaseLineNumber"),
        l("l_linenumber").cast("string").alias("orderLineNumber"),
        l("l_quantity").cast("int").alias("quantity"),
        F.concat(F.lit("S"), l("l_suppkey")).alias("shipNode"),
        (l("l_linestatus") == "O").alias("isBackOrder"),
        F.struct(
            l("l_returnflag").alias("releaseAdjustType"),
            F.date_format(l("l_shipdate"), "yyyy-MM-dd").alias("releaseAdjustDate"),
        ).alias("releaseAdjustStatus"),
        F.struct(
            l("l_partkey").cast("string").alias("skuNumber"),
            F.concat(F.lit("T"), l("l_linestatus")).alias("productTypeName"),
            F.concat_ws("-", l("l_partkey"), l("l_suppkey")).alias("itemStyleNumber"),
            F.concat(F.lit("B"), l("l_suppkey")).alias("skuBrand"),
            _descriptions(("en_US", F.concat(F.lit("style "), l("l_partkey")))).alias("itemStyleDescriptions"),
            _descriptions(("en_US", F.concat(F.lit("item "), l("l_partkey"))),
                          ("fr_FR", F.concat(F.lit("article "), l("l_partkey")))).alias("itemDescriptions"),
            _descriptions(("en_US", F.concat(F.lit("size "), l("l_quantity").cast("int")))).alias("itemSizeDescriptions"),
            _descriptions(("en_US", F.concat(F.lit("colour "), l("l_returnflag")))).alias("itemColorDescriptions"),
            F.struct(
                l("l_extendedprice").alias("currentPrice"),
                (l("l_extendedprice") * (F.lit(1) - l("l_discount"))).alias("paidPrice"),
                (l("l_extendedprice") * (F.lit(1) + l("l_tax"))).alias("listPrice"),
                l("l_extendedprice").alias("retailPrice"),
            ).alias("price"),
        ).alias("product"),
    )


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def _release_data(release_id: Column, items: Column | None) -> Column:
    created = F.date_format("o_orderdate", _TS_TEXT)
    return F.struct(
        F.concat(F.lit("v"), F.col("o_custkey")).alias("versionId"),
        F.lit("ReleaseCreated").alias("eventName"),
        F.concat(F.date_format("o_orderdate", _TS_TEXT_MS), F.lit(FEED_OFFSET)).alias("publishedTime"),
        created.alias("createdOn"),
        F.lit("order-service").alias("createdBy"),
        F.struct(
            release_id.alias("id"),
            created.alias("createdOn"),
            F.col("o_orderkey").cast("string").alias("orderId"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("orderDate"),
            F.concat(F.lit("INV"), F.col("o_orderkey")).alias("invoiceId"),
            F.col("o_orderpriority").alias("market"),
            F.lit("US").alias("countryCode"),
            F.concat(F.lit("N"), F.col("o_custkey")).alias("parentShipNode"),
            F.date_format(F.date_add(F.col("o_orderdate").cast("date"), 7), "yyyy-MM-dd").alias("inHomeDeliveryDate"),
            F.lit("1").alias("stockOrderDownloadVersion"),
            F.col("o_orderstatus").alias("releaseStatus"),
            *([items.alias("releaseItems")] if items is not None else []),
        ).alias("releaseEventDetails"),
    )


def release_headers(orders: DataFrame) -> DataFrame:
    """The announcement of each order's release: header fields, no lines."""
    data = _release_data(F.concat(F.lit("R"), F.col("o_orderkey")), None)
    return orders.select(*_housekeeping(F.col("o_orderdate")), data.alias("data"))


def release_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One release event per (order, ship node), with its lines.

    Orders without lines carry a null ``releaseItems`` (quirk K2 input).
    """
    raw = nest_children(
        lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
                        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus",
                        "l_shipdate", F.col("l_suppkey").alias("_node")),
        ["l_orderkey", "_node"], "lines", shuffle_by=["l_orderkey"])
    o = orders.select(*_ORDER_COLUMNS)
    ev = o.join(raw, o["o_orderkey"] == raw["l_orderkey"], "left")
    data = _release_data(_event_id("R"), F.transform("lines", release_item_struct))
    return ev.select(*_housekeeping(F.col("o_orderdate")), data.alias("data"))


def _event_id(prefix: str) -> Column:
    """Order and ship node; node 0 stands for an order without lines."""
    return F.concat(F.lit(prefix), F.col("o_orderkey"), F.lit("-"), F.coalesce(F.col("_node"), F.lit(0)))


def sku_dimension(part: DataFrame) -> DataFrame:
    """SKU catalogue from ``part``, one row per part."""
    return part.select(
        *_housekeeping(F.lit(None).cast("timestamp_ntz")),
        F.col("p_partkey").cast("string").alias("sku_number"),
        F.concat(F.lit("SKU"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("sku_id"),
    )


def stocked_skus(part: DataFrame) -> DataFrame:
    """The catalogue without promotional parts (``p_type = 'PROMO'``): their
    release lines have no SKU (orphans, quirk K4).  A null type is stocked."""
    return sku_dimension(part.filter(~F.col("p_type").eqNullSafe("PROMO")))


# ---------------------------------------------------------------------------
# Invoice events (orders header + four preference sections from lineitem)
# ---------------------------------------------------------------------------

def _line_amount(r) -> Column:
    return _dec_text(r["l_extendedprice"]) * _dec_text(r["l_discount"])


def _charge(r) -> Column:
    """Charge built from one raw lineitem element ``r``."""
    amount = _line_amount(r).cast("string")
    return F.struct(
        F.concat(F.lit("line-"), r["l_linenumber"]).alias("chargeName"),
        F.concat(F.lit("FLAG_"), r["l_returnflag"]).alias("chargeCategory"),
        amount.alias("chargeAmount"),
        amount.alias("chargeAmountLong"),
    )


def _tax(r) -> Column:
    """Tax on the charge of one raw lineitem element ``r``."""
    amount = _line_amount(r)
    tax = (amount * _dec_text(r["l_tax"])).cast("string")
    percent = (_dec_text(r["l_tax"]) * 100).cast("string")
    return F.struct(
        F.lit("SALES").alias("taxCategory"),
        F.concat(F.lit("line-"), r["l_linenumber"]).alias("taxChargeName"),
        amount.cast("string").alias("taxable"),
        amount.cast("string").alias("taxableLong"),
        F.concat(F.lit("TAX_"), r["l_linestatus"]).alias("taxName"),
        percent.alias("percent"),
        percent.alias("percentLong"),
        tax.alias("taxAmount"),
        tax.alias("taxAmountLong"),
    )


def _instruction(kind: str) -> Column:
    return F.struct(
        F.lit("Hello").alias("header"),
        F.lit("Thanks").alias("footer"),
        F.col("o_orderpriority").alias("body"),
        F.lit(kind).alias("type"),
    )


def _section_arrays(k: int) -> tuple[Column, Column]:
    mine = F.filter("lines", lambda r: F.pmod(r["l_linenumber"], F.lit(4)) == k)
    return (F.transform(mine, _charge).alias("convenienceCharges"),
            F.transform(mine, _tax).alias("convenienceTaxes"))


def _gift_section(k: int) -> Column:
    charges, taxes = _section_arrays(k)
    return F.struct(
        F.col("o_orderpriority").startswith("1-").alias("isGiftIndicator"),
        F.concat(F.lit("wrap "), F.col("o_orderpriority")).alias("premiumGiftWrapDescription"),
        F.lit(1).alias("complimentaryBoxQuantity"),
        F.col("o_orderstatus").alias("taxCode"),
        F.col("o_custkey").cast("string").alias("premiumGiftWrapSkuNumber"),
        _instruction("GIFT").alias("instruction"),
        charges, taxes,
    )


def _ship_section(k: int) -> Column:
    charges, taxes = _section_arrays(k)
    return F.struct(
        F.concat(F.lit("N"), F.col("o_custkey")).alias("fulfilledFromNodeId"),
        F.lit(7).alias("maximumDaysToDeliver"),
        F.lit(2).alias("minimumDaysToDeliver"),
        (F.col("o_orderstatus") == "F").alias("isBusinessDay"),
        F.lit(True).alias("withinCutoff"),
        F.col("o_orderpriority").alias("shipMethod"),
        F.lit("STD").alias("shippingGroup"),
        F.lit(None).cast("string").alias("shipChargeOverrideReason"),
        _instruction("SHIP").alias("instruction"),
        charges, taxes,
    )


# Invoice-event section names and the kind (line number mod 4)
# each one takes its charges from; order follows CHARGE_KINDS.
INVOICE_SECTIONS = [
    ("shipmentPreference", 0, _ship_section),
    ("giftPreference", 1, _gift_section),
    ("shipmentPreferenceAdjustment", 2, _ship_section),
    ("giftPreferenceAdjustment", 3, _gift_section),
]


def invoice_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """One invoice event per (order, ship node).

    Times are local text with offset: ``orderDate`` at midnight, ``invoicedOn``
    at 23:30 the next day (so its local date and UTC instant disagree, K7),
    ``publishedTime`` five minutes later with milliseconds.
    """
    lines = nest_children(
        lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount", "l_tax",
                        "l_returnflag", "l_linestatus", F.col("l_suppkey").alias("_node")),
        ["l_orderkey", "_node"], "lines", shuffle_by=["l_orderkey"])
    o = orders.select(*_ORDER_COLUMNS)
    ev = o.join(lines, o["o_orderkey"] == lines["l_orderkey"], "left")
    invoiced = F.col("o_orderdate") + F.expr("INTERVAL 47 HOURS 30 MINUTES")
    published = invoiced + F.expr("INTERVAL 5 MINUTES")
    detail = F.struct(
        _event_id("INV").alias("id"),
        F.struct(F.col("o_orderkey").cast("string").alias("id"),
                 F.concat(F.lit("ov"), F.col("o_custkey")).alias("versionId")).alias("order"),
        F.concat(F.date_format("o_orderdate", _TS_TEXT), F.lit(FEED_OFFSET)).alias("orderDate"),
        F.concat(F.date_format(invoiced, _TS_TEXT), F.lit(FEED_OFFSET)).alias("invoicedOn"),
        *[builder(k).alias(name) for name, k, builder in INVOICE_SECTIONS],
    )
    data = F.struct(
        F.concat(F.lit("v"), F.col("o_custkey")).alias("versionId"),
        F.concat(F.date_format(published, _TS_TEXT_MS), F.lit(FEED_OFFSET)).alias("publishedTime"),
        detail.alias("invoiceEventDetail"),
    )
    return ev.select(*_housekeeping(F.col("o_orderdate")), data.alias("data"))


def customer_orders(orders: DataFrame) -> DataFrame:
    """Conformed customer-order table (base+2 side of the charge join)."""
    return orders.select(
        *_housekeeping(F.col("o_orderdate")),
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        F.col("o_orderstatus").alias("order_status"),
    )


# ---------------------------------------------------------------------------
# Charge feed from ``events``: many publications per charge key
# ---------------------------------------------------------------------------

def _charge_feed_base(events: DataFrame) -> DataFrame:
    """One row per event: kind, housekeeping, invoice, ``_charges`` and tail.

    Event days are spread over ``FEED_DAYS`` days by the event id, so a
    charge key is published in several months.
    """
    ts = F.col("ts") + F.make_dt_interval(days=F.pmod(F.col("event_id"), F.lit(FEED_DAYS)).cast("int"))
    form = F.element_at(F.array(*[F.lit(s) for s in OFFSET_FORMS]),
                        (F.pmod(F.col("event_id"), F.lit(len(OFFSET_FORMS))) + 1).cast("int"))
    handling = F.get_json_object("props", "$.k").cast("decimal(13,2)")
    charges = F.array(
        F.struct(F.lit("convenience_fee").alias("convenience_charge_name"),
                 F.col("event_type").alias("convenience_charge_category"),
                 F.col("value").cast("decimal(13,2)").alias("amount"),
                 F.col("value").cast("decimal(13,6)").alias("convenience_charge_amount")),
        F.struct(F.lit("handling_fee").alias("convenience_charge_name"),
                 F.col("event_type").alias("convenience_charge_category"),
                 handling.alias("amount"),
                 handling.cast("decimal(13,6)").alias("convenience_charge_amount")),
    )
    return events.select(
        F.pmod(F.col("event_id"), F.lit(4)).alias("_kind"),
        *_housekeeping(ts),
        F.concat(F.lit("INV"), F.col("user_id")).alias("invoice_id"),
        charges.alias("_charges"),
        F.col("user_id").cast("string").alias("order_id"),
        ts.cast("date").alias("order_date"),
        F.concat(F.date_format(ts, _TS_TEXT), F.lit(FEED_OFFSET)).alias("order_datetime"),
        (ts + F.expr("INTERVAL 8 HOURS")).alias("order_datetime_utc"),
        ts.cast("date").alias("invoiced_on_date"),
        F.concat(F.date_format(ts, _TS_TEXT), F.lit(FEED_OFFSET)).alias("invoiced_on_datetime"),
        (ts + F.expr("INTERVAL 8 HOURS")).alias("invoiced_on_datetime_utc"),
        F.concat(F.date_format(ts, _TS_TEXT_MS), form).alias("published_time"),
    )


def charge_feed(events: DataFrame) -> dict[str, DataFrame]:
    """Four base+1 charge-source tables derived from ``events``.

    Each event is one publication of an invoice's charges: invoice = user,
    charge category = event type, two charges (a fee of ``value`` and a
    handling fee of ``props.k``), kind = ``event_id mod 4``.  The same key is
    published many times, so latest-wins has real work to do.
    """
    base = _charge_feed_base(events)
    out = {}
    for k, (kind, _label) in enumerate(CHARGE_KINDS):
        out[kind] = (base.filter(F.col("_kind") == k)
                     .withColumnRenamed("_charges", f"{kind}_convenience_charge")
                     .drop("_kind"))
    return out


def charge_feed_wide(events: DataFrame) -> DataFrame:
    """The same feed as one table: each event's charges sit in the column of
    its kind (the other three are null), so a batch job reads ``events``
    once instead of once per kind (see ``charges.stacked_rows``)."""
    base = _charge_feed_base(events)
    arrays = [F.when(F.col("_kind") == k, F.col("_charges")).alias(f"{kind}_convenience_charge")
              for k, (kind, _label) in enumerate(CHARGE_KINDS)]
    return base.select(*[c for c in base.columns if c not in ("_kind", "_charges")], *arrays)


# ---------------------------------------------------------------------------
# Ship confirmations (one event per line shipped)
# ---------------------------------------------------------------------------

def ship_confirmations(lineitem: DataFrame) -> DataFrame:
    """The confirmation that a line was shipped, published at its ship time."""
    data = F.struct(
        F.concat(F.date_format("l_shipdate", _TS_TEXT_MS), F.lit(FEED_OFFSET)).alias("publishedTime"),
        F.struct(
            F.concat_ws("-", F.lit("C"), "l_orderkey", "l_linenumber", "l_suppkey").alias("id"),
            F.col("l_orderkey").cast("string").alias("orderId"),
            F.col("l_linenumber").cast("string").alias("releaseLineNumber"),
            F.concat(F.lit("S"), F.col("l_suppkey")).alias("shipNode"),
            F.col("l_quantity").cast("int").alias("quantity"),
        ).alias("shipConfirmation"),
    )
    return lineitem.select(*_housekeeping(F.col("l_shipdate")), data.alias("data"))
