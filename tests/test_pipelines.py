
from pyspark.sql import types as T

from orderloom.plans import charges as ch
from orderloom.plans import invoice, release
from orderloom.schemas import AUDIT_COLUMNS, CHARGE_ARRAY, DQ_COLUMNS, TAX_ARRAY
from orderloom.sources import events as ev
from orderloom.sources.tables import load

SF = "/root/testdata/sf0.001"


def _release_events(spark):
    return ev.release_events(load(spark, SF, "orders"), load(spark, SF, "lineitem"))


def _invoice_events(spark):
    return ev.invoice_events(load(spark, SF, "orders"), load(spark, SF, "lineitem"))


def test_release_contract(spark):
    out = release.release_flatten(_release_events(spark))
    assert out.columns == AUDIT_COLUMNS + [
        "release_id", "event_version_id", "event_name", "event_published_time", "event_created_on",
        "event_created_by", "release_created_on", "order_id", "order_date", "invoice_id", "market",
        "country_code", "parent_ship_node", "in_home_delivery_date", "stock_order_download_version",
        "release_status"] + DQ_COLUMNS
    assert out.schema["order_date"].dataType == T.StringType()  # text at this layer
    headers = release.release_flatten(ev.release_headers(load(spark, SF, "orders")))
    assert headers.columns == out.columns and headers.count() == load(spark, SF, "orders").count()


def test_release_item_contract(spark):
    out = release.release_items(_release_events(spark), ev.sku_dimension(load(spark, SF, "part")))
    assert out.columns == AUDIT_COLUMNS + [
        "release_id", "release_line_number", "event_version_id", "order_line_number", "item_quantity",
        "ship_node", "is_backorder", "adjustment_type", "adjustment_date", "sku_number", "sku_id",
        "product_type_name", "style_number", "sku_brand", "product_style_descriptions",
        "item_descriptions", "item_size_descriptions", "product_color_descriptions", "current_price",
        "paid_price", "list_price", "retail_price"] + DQ_COLUMNS
    for c in ("current_price", "paid_price", "list_price", "retail_price"):
        assert out.schema[c].dataType == T.DecimalType(13, 4)
    desc = out.schema["item_descriptions"].dataType.elementType
    assert [f.name for f in desc.fields] == ["locale_code", "description"]


def test_gift_preference_contract(spark):
    out = invoice.gift_preference(_invoice_events(spark))
    p = "gift_preference_"
    assert out.columns == AUDIT_COLUMNS + ["invoice_id"] + [p + c for c in (
        "gift_indicator", "premium_gift_wrap_description", "complimentary_box_quantity", "tax_code",
        "premium_gift_wrap_sku_number", "instruction_header", "instruction_footer", "instruction_body",
        "instruction_type", "convenience_charge", "convenience_charge_tax")] + [
        "order_id", "order_version_id", "order_date", "order_datetime", "order_datetime_utc",
        "invoiced_on_date", "invoiced_on_datetime", "invoiced_on_datetime_utc", "version_id",
        "published_time", "published_time_utc"] + DQ_COLUMNS
    assert out.schema[p + "convenience_charge"].dataType == CHARGE_ARRAY
    assert out.schema[p + "convenience_charge_tax"].dataType == TAX_ARRAY
    assert out.schema["order_date"].dataType == T.DateType()
    assert out.schema["published_time_utc"].dataType == T.TimestampNTZType()


def test_shipment_adjustment_contract(spark):
    out = invoice.shipment_preference_adjustment(_invoice_events(spark))
    p = "ship_preference_adjustment_"
    expect = [p + c for c in (
        "fulfilled_from_node_id", "maximum_days_to_deliver", "minimum_days_to_deliver",
        "is_business_day", "is_within_cutoff", "method", "shipping_group",
        "ship_charge_override_reason", "instruction_header", "instruction_footer",
        "instruction_body", "instruction_type", "convenience_charge", "convenience_charge_tax")]
    assert out.columns[len(AUDIT_COLUMNS) + 1: len(AUDIT_COLUMNS) + 1 + len(expect)] == expect


def test_convenience_charge_contract_and_compat_view(spark):
    events = _invoice_events(spark)
    wide = invoice.charge_sources_flatten(events)
    out = ch.finish_charges(ch.stacked_rows(wide), ev.customer_orders(load(spark, SF, "orders")),
                            latest=True)
    assert out.columns == AUDIT_COLUMNS + [
        "convenience_charge_type", "invoice_id", "convenience_charge_category",
        "convenience_charge_name", "convenience_charge_amount", "convenience_charge_amount_full",
        "order_id", "order_date", "order_datetime", "order_datetime_utc", "invoiced_on_date",
        "invoiced_on_datetime", "invoiced_on_datetime_utc", "published_time",
        "published_time_utc"] + DQ_COLUMNS
    assert "external_customer_id" in ch.compatibility_view(out).columns
    types = {r[0] for r in out.select("convenience_charge_type").distinct().collect()}
    assert types == {"ShipmentPreference", "GiftPreference", "ShipmentPreferenceAdjustment",
                     "GiftPreferenceAdjustment"}


def test_four_sources_equal_stacked_form(spark):
    """The union of four section tables and the one-pass stacked form agree."""
    events = _invoice_events(spark)
    sections = {kind: invoice.preference_flatten(events, section)
                for (kind, _), (section, _k, _b) in zip(
                    [("ship_preference", 0), ("gift_preference", 1), ("ship_preference_adjustment", 2),
                     ("gift_preference_adjustment", 3)], ev.INVOICE_SECTIONS)}
    a = ch.convenience_charges(None, ch.sources_from_invoices(sections))
    b = ch.finish_charges(ch.stacked_rows(invoice.charge_sources_flatten(events)), None)
    cols = ["convenience_charge_type", "invoice_id", "convenience_charge_name", "convenience_charge_amount"]
    assert a.select(cols).exceptAll(b.select(cols)).count() == 0
    assert a.count() == b.count()
