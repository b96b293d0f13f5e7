"""Extension: anchored alignment of an event stream. The batch library has no streaming counterpart to match.

A marker event is joined with the events of its entity inside a bounded window around it; both sides carry
watermarks, so state is dropped once the window has passed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def align_stream(events: DataFrame, key: str, ts: str, marker: str, before: str = "2 hours", after: str = "10 minutes", late: str = "10 minutes") -> DataFrame:
    """key, anchor_ts, the event's columns and t_ms, for streams and batches alike."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    a = e.where(marker).select(F.col(key).alias("_k"), F.col(ts).alias("anchor_ts"))
    if events.isStreaming:
        e, a = e.withWatermark(ts, late), a.withWatermark("anchor_ts", late)
    near = F.expr(f"{key} = _k and {ts} >= anchor_ts - interval {before} and {ts} <= anchor_ts + interval {after}")
    out = e.join(a, near).drop("_k")
    return out.withColumn("t_ms", (F.unix_micros(ts) - F.unix_micros("anchor_ts")) / F.lit(1000.0))
