"""Redelivered events removed from a stream with bounded state (K17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame


def first_deliveries(df: DataFrame, keys: Sequence[tuple[str, Column]], event_time: Column, horizon: str) -> DataFrame:
    """``df`` without the rows whose keys came within ``horizon`` before.

    ``keys`` are (name, expression) pairs; null parts are equal to each other.
    State holds the keys alone and each only until the watermark, which lags
    the newest ``event_time`` by ``horizon``, has passed it.  A feed may be
    out of order by as much as ``horizon``: an event that is older than the
    watermark is dropped as late, so choose it no shorter than the feed's
    disorder.  On a table there is no watermark and all its repeats go.
    """
    named = {f"_key_{name}": c for name, c in keys}
    keyed = df.withColumns({**named, "_event_time": event_time.cast("timestamp")})
    if df.isStreaming:
        kept = keyed.withWatermark("_event_time", horizon).dropDuplicatesWithinWatermark(list(named))
    else:
        kept = keyed.dropDuplicates(list(named))
    return kept.drop(*named, "_event_time")
