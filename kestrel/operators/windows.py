"""Date-window plans and volumes (B2, A15, R4 batch twin).

Windows are regular (fixed length, contiguous), so a record's window is
computed arithmetically from its date: counting records per window is a
plain aggregation, with no range join between records and windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (
    CHUNK_DAYS, HIGH_VOLUME_LOOKBACK_DAYS, NO_WATERMARK_START, WINDOW_RECORD_CEILING,
)


def window_start_rule(key: Column, watermark: Column, until: Column, high_volume: Sequence[str],
                      lookback_days: int = HIGH_VOLUME_LOOKBACK_DAYS) -> Column:
    """Start of a key's replay: its watermark, else ``until`` minus the look-back for
    high-volume keys, else 1900-01-01."""
    return F.coalesce(
        watermark,
        F.when(key.isin(*high_volume), F.date_sub(until, lookback_days)),
        F.lit(NO_WATERMARK_START).cast("date"),
    )


def date_windows(keys: DataFrame, key: str, since: str, until: str, chunk_days: int = CHUNK_DAYS) -> DataFrame:
    """B2: windows [s, min(s + chunk, until)] per key, next s = end + 1, while s < until.

    ``since`` is a DATE column of ``keys``; ``until`` a 'yyyy-MM-dd' literal.
    Output: (key, window_no, window_start, window_end).
    """
    u = F.lit(until).cast("date")
    s = F.col(since)
    starts = F.when(s < u, F.sequence(s, F.date_sub(u, 1), F.expr(f"INTERVAL {chunk_days + 1} DAYS")))
    out = keys.select(key, F.posexplode(starts).alias("window_no", "window_start"))
    return out.select(key, F.col("window_no").cast("long").alias("window_no"), "window_start",
                      F.least(F.date_add("window_start", chunk_days), u).alias("window_end"))


def window_volume(records: DataFrame, key: str, date_col: str, since: Column, until: str,
                  chunk_days: int = CHUNK_DAYS, ceiling: int = WINDOW_RECORD_CEILING) -> DataFrame:
    """Records per key per replay window, flagged when over the paging ceiling.

    ``since`` is a per-row DATE expression (the key's replay start). Records
    outside [since, until] or with no date fall outside every window.
    """
    u = F.lit(until).cast("date")
    step = chunk_days + 1
    d = F.col(date_col)
    r = records.withColumn("_since", since).filter(d.isNotNull() & (d >= F.col("_since")) & (d <= u))
    idx = F.floor(F.datediff(d, F.col("_since")) / step).cast("int")
    r = r.withColumn("window_start", F.date_add(F.col("_since"), idx * step))
    counts = r.groupBy(key, "window_start").agg(F.count(F.lit(1)).alias("n_records"))
    return counts.select(key, "window_start", F.least(F.date_add("window_start", chunk_days), u).alias("window_end"),
                         "n_records", (F.col("n_records") > ceiling).alias("over_ceiling"))


def event_windows(events: DataFrame, ts: str, key: str, duration: str = "1 day",
                  ceiling: int = WINDOW_RECORD_CEILING) -> DataFrame:
    """R4 batch twin: tumbling event-time counts per key, with the ceiling flag."""
    counts = events.groupBy(F.window(F.col(ts), duration).alias("w"), key).agg(F.count(F.lit(1)).alias("n_events"))
    return counts.select(key, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                         "n_events", (F.col("n_events") > ceiling).alias("over_ceiling"))
