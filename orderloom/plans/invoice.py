"""Invoice preference sections flattened to base+1 tables.

The same function serves all four sections of an invoice event (shipment
preference, gift preference and their adjustments); a section's scalar
fields, its charge array and its tax array are re-typed positionally, and the
order / invoice / published times become date + text + UTC triplets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import casts
from orderloom.functions.time import event_time_triplet, utc_instant
from orderloom.operators.shape import flatten
from orderloom.schemas import CHARGE_ARRAY, TAX_ARRAY

_D = "data.invoiceEventDetail"

# Scalar fields per section shape (source field -> suffix).
GIFT_FIELDS = [
    ("isGiftIndicator", "gift_indicator"),
    ("premiumGiftWrapDescription", "premium_gift_wrap_description"),
    ("complimentaryBoxQuantity", "complimentary_box_quantity"),
    ("taxCode", "tax_code"),
    ("premiumGiftWrapSkuNumber", "premium_gift_wrap_sku_number"),
]
SHIP_FIELDS = [
    ("fulfilledFromNodeId", "fulfilled_from_node_id"),
    ("maximumDaysToDeliver", "maximum_days_to_deliver"),
    ("minimumDaysToDeliver", "minimum_days_to_deliver"),
    ("isBusinessDay", "is_business_day"),
    ("withinCutoff", "is_within_cutoff"),
    ("shipMethod", "method"),
    ("shippingGroup", "shipping_group"),
    ("shipChargeOverrideReason", "ship_charge_override_reason"),
]
INSTRUCTION_FIELDS = ["header", "footer", "body", "type"]

# Section name -> (curated prefix, field list).
SECTIONS = {
    "shipmentPreference": ("ship_preference_", SHIP_FIELDS),
    "giftPreference": ("gift_preference_", GIFT_FIELDS),
    "shipmentPreferenceAdjustment": ("ship_preference_adjustment_", SHIP_FIELDS),
    "giftPreferenceAdjustment": ("gift_preference_adjustment_", GIFT_FIELDS),
}


# The common tail of every section table.  Plain columns, then
# time texts expanded to ``<name>_date`` / ``<name>_datetime`` /
# ``<name>_datetime_utc``, then the event version and publication time.
TAIL_COLUMNS = [(f"{_D}.order.id", "order_id"), (f"{_D}.order.versionId", "order_version_id")]
TAIL_TIMES = [(f"{_D}.orderDate", "order"), (f"{_D}.invoicedOn", "invoiced_on")]
TAIL_EVENT = [("data.versionId", "version_id"), ("data.publishedTime", "published_time")]


def _tail() -> list:
    mapping = list(TAIL_COLUMNS)
    for text, name in TAIL_TIMES:
        date_c, text_c, utc_c = event_time_triplet(text, name)
        mapping += [(date_c, f"{name}_date"), (text_c, f"{name}_datetime"),
                    (utc_c, f"{name}_datetime_utc")]
    return mapping + TAIL_EVENT + [(utc_instant("data.publishedTime"), "published_time_utc")]


def charge_sources_flatten(events: DataFrame) -> DataFrame:
    """The four sections' charge arrays side by side, one row per invoice.

    One projection of the invoice events feeds all four charge kinds of the
    base+2 table (``charges.stacked_rows``) without scanning them four times.
    The arrays are as published; each charge is re-typed when it is a row.
    """
    mapping = [(f"{_D}.id", "invoice_id")]
    mapping += [(f"{_D}.{section}.convenienceCharges", f"{prefix}convenience_charge")
                for section, (prefix, _fields) in SECTIONS.items()]
    return flatten(events, mapping + _tail())


def preference_flatten(events: DataFrame, section: str) -> DataFrame:
    """Base+1 table of one invoice section (names per ``SECTIONS``)."""
    prefix, fields = SECTIONS[section]
    s = f"{_D}.{section}"
    mapping = [(f"{_D}.id", "invoice_id")]
    mapping += [(f"{s}.{src}", prefix + dst) for src, dst in fields]
    mapping += [(f"{s}.instruction.{f}", f"{prefix}instruction_{f}") for f in INSTRUCTION_FIELDS]
    mapping += [(casts.charges(f"{s}.convenienceCharges"), f"{prefix}convenience_charge"),
                (casts.taxes(f"{s}.convenienceTaxes"), f"{prefix}convenience_charge_tax"),
                ]
    return flatten(events, mapping + _tail())


def cast_rules(events: DataFrame, section: str) -> list:
    """DQ rules failing rows whose charge / tax values do not fit their target
    decimals (K18): the safe cast nulls such a leaf, so a row fails when the
    cast result has more null leaves than its source."""
    detail = events.schema["data"].dataType["invoiceEventDetail"].dataType
    sec = detail[section].dataType
    base = f"{_D}.{section}"
    out = []
    for field, target, rid in (("convenienceCharges", CHARGE_ARRAY, "charge_values_fit"),
                               ("convenienceTaxes", TAX_ARRAY, "tax_values_fit")):
        out.append((rid, ~casts.elements_lost(f"{base}.{field}", sec[field].dataType, target)))
    return out


def gift_preference(events: DataFrame) -> DataFrame:
    return preference_flatten(events, "giftPreference")


def shipment_preference_adjustment(events: DataFrame) -> DataFrame:
    return preference_flatten(events, "shipmentPreferenceAdjustment")
