"""The curation jobs: stream scan -> quality -> pipeline -> sink.

A plain dict of functions (``PIPELINES``) replaces a name-to-class registry.
Each job takes an immutable ``JobConfig`` whose ``source_paths`` are read as
streams (static for the snapshot side), tags rows with the DQ
rules, runs the same DataFrame function as the batch path and starts the
sink.  Jobs return the ``StreamingQuery``; with ``trigger_once`` it stops by
itself after the available input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from orderloom.functions.time import utc_instant
from orderloom.operators import quality as dq
from orderloom.operators.audit import stamp_audit
from orderloom.plans import charges as ch
from orderloom.plans import invoice, release
from orderloom.plans.shipments import shipped_in_time
from orderloom.schemas import CHARGE_KINDS, CHARGE_PRIMARY_KEY, CHARGE_SORT_COLUMN
from orderloom.sources.files import stream_csv_checked
from orderloom.sources.tables import read_table
from orderloom.streaming import upsert as up
from orderloom.streaming.dedupe import first_deliveries
from orderloom.streaming.jobs import (JobConfig, append_stream, batch_folder_stream, corrupt_split_stream,
                                      curated_stream, foreach_batch_stream, split_rows)
from orderloom.streaming.metrics import observe_counts


# Largest snapshot that is broadcast (through the driver) in every micro-batch.
BATCH_BROADCAST_BYTES = 4 * 1024 * 1024


def release_rules() -> list[dq.Rule]:
    d = F.col("data.releaseEventDetails")
    return [("release_id_present", d["id"].isNotNull()),
            ("order_id_present", d["orderId"].isNotNull()),
            ("release_status_known", d["releaseStatus"].isin("F", "O"))]


def invoice_rules(section: str) -> list[dq.Rule]:
    d = F.col("data.invoiceEventDetail")
    return [("invoice_id_present", d["id"].isNotNull()),
            ("published_time_parses", F.col("data.publishedTime").try_cast("timestamp").isNotNull()),
            ("charges_present", F.size(d[section]["convenienceCharges"]) > 0)]


def charge_rules(retyped: bool = False) -> list[dq.Rule]:
    """``retyped``: rows come from arrays that were re-typed on the way, and
    ``charge_lost`` tells which lost a value (K18)."""
    return [("invoice_id_present", F.col("invoice_id").isNotNull()),
            ("published_time_present", F.col("published_time").isNotNull()),
            ("charge_amount_positive", F.col("charge.amount") > 0),
            *([("charge_values_fit", ~F.col("charge_lost"))] if retyped else [])]


def _stream(spark: SparkSession, cfg: JobConfig, i: int) -> DataFrame:
    return read_table(spark, cfg.source_paths[i], stream=True,
                      max_files_per_trigger=cfg.max_files_per_trigger)


def _finish(df: DataFrame, cfg: JobConfig, published_utc=None) -> DataFrame:
    """Audit stamp (latency from the published instant when there is one)
    and observed row / failed-row counts."""
    df = stamp_audit(df, cfg.processed_by, published_utc=published_utc)
    return observe_counts(df, f"{cfg.name}_metrics")


def release_event_keys() -> list[tuple[str, Column]]:
    """An event is the same if its release, version and ship node are."""
    d = F.col("data.releaseEventDetails")
    return [("release", d["id"]), ("version", F.col("data.versionId")), ("node", d["parentShipNode"])]


def release_job(spark: SparkSession, cfg: JobConfig, redelivered_within: str | None = None) -> StreamingQuery:
    """Release header job.  Rows are tagged, not dropped (every curated table
    carries the DQ columns); ``cfg.split_bad_rows`` sends failing rows to
    ``cfg.bad_records_location`` instead, as in every job here.  With
    ``redelivered_within`` an event that comes again within that time is
    written once (``first_deliveries``)."""
    events = _stream(spark, cfg, 0)
    if redelivered_within:
        events = first_deliveries(events, release_event_keys(), utc_instant("data.publishedTime"), redelivered_within)
    tagged = dq.tag_rows(events, release_rules())
    out = _finish(release.release_flatten(tagged), cfg, utc_instant("event_published_time"))
    return curated_stream(out, cfg)


def release_item_job(spark: SparkSession, cfg: JobConfig, sku: DataFrame | None = None,
                     fresh_sku: bool = False) -> StreamingQuery:
    """Release stream x SKU snapshot (``source_paths[1]`` read as a batch
    table unless ``sku`` is given).

    A file-backed static side keeps the file list it had when the stream
    started.  ``fresh_sku`` re-reads the catalogue in every micro-batch
    instead (inside ``foreachBatch``), so SKUs added while a long-running
    job is up are joined from the next batch on; as each batch would broadcast
    it anew, only one of ``BATCH_BROADCAST_BYTES`` at most is broadcast.
    """
    tagged = dq.tag_rows(_stream(spark, cfg, 0), release_rules() + release.price_rules())
    if fresh_sku and sku is None:
        sku_path = cfg.source_paths[1]

        def per_batch(batch: DataFrame, _batch_id: int):
            items = stamp_audit(release.release_items(batch, read_table(spark, sku_path), BATCH_BROADCAST_BYTES), cfg.processed_by)
            return split_rows(items, cfg) if cfg.quarantine else [(items, cfg.output_path)]
        return batch_folder_stream(tagged, cfg, per_batch, outputs=2 if cfg.quarantine else 1)
    dim = sku if sku is not None else read_table(spark, cfg.source_paths[1])
    return curated_stream(_finish(release.release_items(tagged, dim), cfg), cfg)


def shipment_job(spark: SparkSession, cfg: JobConfig, release_delay: str, shipment_delay: str) -> StreamingQuery:
    """Release announcements (``source_paths[0]``) joined with ship
    confirmations (``source_paths[1]``), both streams, appended as matched.

    A delay is how far its feed may be out of order; no row within it is
    late.  A release is kept in state until the confirmations' watermark has
    passed its 60 days, a confirmation until the releases' has passed it.
    """
    return append_stream(shipped_in_time(_stream(spark, cfg, 0), _stream(spark, cfg, 1), release_delay, shipment_delay), cfg)


def raw_csv_job(spark: SparkSession, cfg: JobConfig, schema: T.StructType) -> StreamingQuery:
    """Raw CSV files to a typed table; records that do not fit the schema go
    to ``cfg.bad_records_location`` as raw text."""
    return corrupt_split_stream(stream_csv_checked(spark, cfg.source_paths[0], schema, cfg.max_files_per_trigger), cfg)


def invoice_section_job(spark: SparkSession, cfg: JobConfig, section: str) -> StreamingQuery:
    """One invoice section to its base+1 table; rows whose charge or tax
    values overflow their decimals fail ``charge_values_fit`` /
    ``tax_values_fit`` (K18)."""
    stream = _stream(spark, cfg, 0)
    tagged = dq.tag_rows(stream, invoice_rules(section) + invoice.cast_rules(stream, section))
    return curated_stream(_finish(invoice.preference_flatten(tagged, section), cfg, "published_time_utc"), cfg)


def convenience_charge_job(spark: SparkSession, cfg: JobConfig,
                           buckets: int | None = None) -> StreamingQuery:
    """Four charge streams (``source_paths[0..3]``) and the customer-order
    table (``source_paths[4]``, re-read in every micro-batch so it is never
    stale) -> latest-wins upsert into ``output_path``."""
    streams = {kind: _stream(spark, cfg, i) for i, (kind, _label) in enumerate(CHARGE_KINDS)}
    tagged = dq.tag_rows(ch.charge_union(streams), charge_rules())
    charges = _finish(ch.finish_charges(tagged, None), cfg, "published_time_utc")
    up.create_if_absent(spark, cfg.output_path, charges.schema)
    orders_path = cfg.source_paths[4]

    def with_order_check(batch: DataFrame, batch_id: int) -> DataFrame:
        if cfg.quarantine:  # a folder a batch: a retried batch replaces its own
            dq.quarantined(batch).write.mode("overwrite").parquet(f"{cfg.quarantine}/batch_id={batch_id}")
            batch = dq.passed(batch)
        keys = ch.order_keys(read_table(spark, orders_path))
        return (batch.join(keys, F.col("order_id") == F.col("cust_order_id"), "left")
                .drop("cust_order_id"))

    writer = up.upsert_writer(cfg.output_path, CHARGE_PRIMARY_KEY, CHARGE_SORT_COLUMN,
                              ch.CHARGE_TIE_BREAK, buckets, prepare=with_order_check)
    return foreach_batch_stream(charges, cfg, writer)


PIPELINES = {
    "release": release_job,
    "release_item": release_item_job,
    "gift_preference": lambda s, c: invoice_section_job(s, c, "giftPreference"),
    "shipment_preference_adjustment":
        lambda s, c: invoice_section_job(s, c, "shipmentPreferenceAdjustment"),
    # the two other sections feed the charge union through the same function
    "shipment_preference": lambda s, c: invoice_section_job(s, c, "shipmentPreference"),
    "gift_preference_adjustment":
        lambda s, c: invoice_section_job(s, c, "giftPreferenceAdjustment"),
    "convenience_charge": convenience_charge_job,
}
