"""Convenience charges (base+2): four charge sources -> one charge table.

Each source is a base+1 table with an array of charges.  Per source: explode
(inner, K2) and tag the kind once (K12); then a name-aligned union (K9), the
published time normalised, a left join to the customer-order keys (K5, K13)
and the final projection.  ``latest`` keeps one row per primary key, the
newest by ``published_time_utc`` -- the batch half of the upsert.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.functions import casts
from orderloom.functions.time import published_time_strict, utc_instant
from orderloom.operators.dedupe import latest_per_key
from orderloom.schemas import (AUDIT_COLUMNS, CHARGE_ARRAY, CHARGE_KINDS, CHARGE_PRIMARY_KEY,
                               CHARGE_SORT_COLUMN, CHARGE_SOURCE_TAIL, DQ_COLUMNS)

# Tie-break after the sort column: every other column of the contract, so that
# equal publication times still pick one row deterministically.
CHARGE_TIE_BREAK = ["convenience_charge_amount", "convenience_charge_amount_full", "order_id",
                    "order_date", "order_datetime", "order_datetime_utc",
                    "invoiced_on_date", "invoiced_on_datetime", "invoiced_on_datetime_utc",
                    "published_time"]


def exploded_source(src: DataFrame, kind: str, label: str) -> DataFrame:
    """One source aligned to the shared charge shape, one row per charge.

    The charge array is re-typed to the shared struct by position first
    (K9), so a source whose producer names the fields differently still
    lines up; for sources already in the shared type the cast is a no-op.
    """
    charges = F.col(f"{kind}_convenience_charge")
    if src.schema[f"{kind}_convenience_charge"].dataType != CHARGE_ARRAY:
        charges = casts.charges(charges)
    return src.select(
        *AUDIT_COLUMNS,
        F.lit(label).alias("convenience_charge_type"),
        "invoice_id",
        F.explode(charges).alias("charge"),
        *CHARGE_SOURCE_TAIL,
        *DQ_COLUMNS,
    )


def charge_union(sources: dict[str, DataFrame]) -> DataFrame:
    """UNION ALL of the four exploded sources, aligned by name."""
    parts = [exploded_source(sources[kind], kind, label) for kind, label in CHARGE_KINDS
             if kind in sources]
    return reduce(lambda a, b: a.unionByName(b), parts)


def stacked_rows(wide: DataFrame) -> DataFrame:
    """Same rows as ``charge_union`` when all four charge arrays sit on one
    row (``<kind>_convenience_charge`` columns of one wide table).

    One scan and two narrow explodes instead of four scans and a union: the
    four (type, array) pairs are exploded first, then each array (inner, K2).
    """
    pairs = F.array(*[F.struct(F.lit(label).alias("t"), F.col(f"{kind}_convenience_charge").alias("a"))
                      for kind, label in CHARGE_KINDS])
    by_kind = wide.select(*AUDIT_COLUMNS, "invoice_id", F.explode(pairs).alias("_k"),
                          *CHARGE_SOURCE_TAIL, *DQ_COLUMNS)
    rows = by_kind.select(
        *AUDIT_COLUMNS,
        F.col("_k.t").alias("convenience_charge_type"),
        "invoice_id",
        F.explode("_k.a").alias("charge"),
        *CHARGE_SOURCE_TAIL,
        *DQ_COLUMNS,
    )
    published = rows.schema["charge"].dataType
    if published == CHARGE_ARRAY.elementType:
        return rows
    charge = casts.typed("charge", CHARGE_ARRAY.elementType)
    return rows.withColumns({"charge": charge, "charge_lost": casts.cast_lost(
        "charge", charge, published, CHARGE_ARRAY.elementType)})


def order_keys(customer_order: DataFrame) -> DataFrame:
    """Only the join key of the order side, one row per key (K5, K13)."""
    return customer_order.select(F.col("order_id").alias("cust_order_id")).distinct()


def convenience_charges(customer_order: DataFrame | None, sources: dict[str, DataFrame],
                        strict_time: bool = False, latest: bool = False) -> DataFrame:
    """The base+2 charge table from four source tables.

    Times in every ISO offset form are parsed; ``strict_time`` uses the
    published normaliser instead (K6).  ``customer_order=None`` skips the left join, which adds
    no column and, with a de-duplicated key side, no row either.
    """
    return finish_charges(charge_union(sources), customer_order, strict_time, latest)


def finish_charges(u: DataFrame, customer_order: DataFrame | None, strict_time: bool = False,
                   latest: bool = False) -> DataFrame:
    """Left join to the order keys, final projection, optional latest-wins."""
    if customer_order is not None:
        u = u.join(order_keys(customer_order), F.col("order_id") == F.col("cust_order_id"), "left")
    pub = published_time_strict("published_time") if strict_time else utc_instant("published_time")
    out = u.select(
        *AUDIT_COLUMNS,
        "convenience_charge_type",
        "invoice_id",
        F.col("charge.convenience_charge_category").alias("convenience_charge_category"),
        F.col("charge.convenience_charge_name").alias("convenience_charge_name"),
        F.col("charge.amount").alias("convenience_charge_amount"),
        F.col("charge.convenience_charge_amount").alias("convenience_charge_amount_full"),
        "order_id",
        "order_date", "order_datetime", "order_datetime_utc",
        "invoiced_on_date", "invoiced_on_datetime", "invoiced_on_datetime_utc",
        "published_time",
        pub.alias("published_time_utc"),
        *DQ_COLUMNS,
    )
    if latest:
        out = latest_charges(out)
    return out


def latest_charges(df: DataFrame) -> DataFrame:
    return latest_per_key(df, CHARGE_PRIMARY_KEY, CHARGE_SORT_COLUMN, CHARGE_TIE_BREAK)


def compatibility_view(df: DataFrame) -> DataFrame:
    """Published column name for the order id (K10)."""
    return df.withColumnRenamed("order_id", "external_customer_id")


def sources_from_invoices(invoice_base1: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Charge sources from the four flattened invoice sections (K8 names)."""
    out = {}
    for kind, _label in CHARGE_KINDS:
        df = invoice_base1[kind]
        out[kind] = df.select(*AUDIT_COLUMNS, "invoice_id", f"{kind}_convenience_charge",
                              *CHARGE_SOURCE_TAIL, *DQ_COLUMNS)
    return out
