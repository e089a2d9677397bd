"""Target types and column lists of the curated tables.

The names and types below are fixed values: they must equal the published
contract of the curated tables, so they are stated here once, in order.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Audit and data-quality columns (neutral names, our choice of
# types).  Audit columns lead every curated table, DQ columns close it.
# ---------------------------------------------------------------------------
AUDIT_COLUMNS = ["processed_timestamp", "processed_by", "epoch_id", "latency"]
DQ_COLUMNS = ["failed_rule_id", "dq_processed_timestamp"]
# Columns dropped from a dimension / order side before a join so that they
# cannot clash with the fact side.
HOUSEKEEPING_COLUMNS = AUDIT_COLUMNS + DQ_COLUMNS

# ---------------------------------------------------------------------------
# Nested target types (field order = source field order; the
# cast is positional, names come from these types).
# ---------------------------------------------------------------------------
CHARGE_STRUCT = T.StructType([
    T.StructField("convenience_charge_name", T.StringType()),
    T.StructField("convenience_charge_category", T.StringType()),
    T.StructField("amount", T.DecimalType(13, 2)),
    T.StructField("convenience_charge_amount", T.DecimalType(13, 6)),
])
CHARGE_ARRAY = T.ArrayType(CHARGE_STRUCT, True)

TAX_STRUCT = T.StructType([
    T.StructField("tax_charge_category", T.StringType()),
    T.StructField("tax_charge_name", T.StringType()),
    T.StructField("taxable_amount", T.DecimalType(13, 2)),
    T.StructField("charge_taxable_amount", T.DecimalType(13, 6)),
    T.StructField("tax_name", T.StringType()),
    T.StructField("tax_percentage", T.DecimalType(13, 2)),
    T.StructField("charge_tax_percentage", T.DecimalType(13, 6)),
    T.StructField("tax_amount", T.DecimalType(13, 2)),
    T.StructField("charge_tax_amount", T.DecimalType(13, 6)),
])
TAX_ARRAY = T.ArrayType(TAX_STRUCT, True)

DESCRIPTION_STRUCT = T.StructType([
    T.StructField("locale_code", T.StringType()),
    T.StructField("description", T.StringType()),
])
DESCRIPTION_ARRAY = T.ArrayType(DESCRIPTION_STRUCT, True)

PRICE_TYPE = T.DecimalType(13, 4)

# ---------------------------------------------------------------------------
# Convenience-charge sources, in union order, with the
# discriminator literal each one carries.
# ---------------------------------------------------------------------------
CHARGE_KINDS = [
    ("ship_preference", "ShipmentPreference"),
    ("gift_preference", "GiftPreference"),
    ("ship_preference_adjustment", "ShipmentPreferenceAdjustment"),
    ("gift_preference_adjustment", "GiftPreferenceAdjustment"),
]

# Primary key and ordering column of the convenience-charge table.
CHARGE_PRIMARY_KEY = [
    "convenience_charge_type",
    "invoice_id",
    "convenience_charge_category",
    "convenience_charge_name",
]
CHARGE_SORT_COLUMN = "published_time_utc"

# Common tail of every charge source table (base+1 output, K8: one name,
# ``invoiced_on_*``).
CHARGE_SOURCE_TAIL = [
    "order_id",
    "order_date",
    "order_datetime",
    "order_datetime_utc",
    "invoiced_on_date",
    "invoiced_on_datetime",
    "invoiced_on_datetime_utc",
    "published_time",
]
