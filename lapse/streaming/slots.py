"""Per-slot statistics of a live play stream (Structured Streaming).

The batch pipeline is the reference behaviour; this is the same slot grid
over an unbounded stream of parsed plays: an event-time tumbling window of
the slot width, anchored at the 06:00 day start, with a watermark so late
plays are still counted and closed slots leave the state store.  The
in-slot statistics (counts, means, standard deviations, per-type counts,
skip ratio) match the batch slot features with ``fanout="none"``; the
cross-slot carry-overs (running totals, ``iat`` of the first play of a
slot) are left to the batch job, which sees each user's whole history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lapse.conf import Settings
from lapse.operators.steps import secs_by_type
from lapse.schema import SECS_COLS, SECS_IN_DAY, TOP_TYPES


def slot_window(s: Settings) -> F.Column:
    w = s.windows
    if SECS_IN_DAY % s.timesplits:
        raise ValueError("streaming slots need timesplits dividing 86400 (equal slot widths)")
    start = w.first_start % w.width
    return F.window("event_time", f"{w.width} seconds", f"{w.width} seconds", f"{start} seconds")


def slot_stats_stream(parsed: DataFrame, s: Settings, watermark: str = "8 hours") -> DataFrame:
    """Streaming (or batch) parsed plays -> per (user, slot) statistics."""
    ev = parsed.withColumn("event_time", F.timestamp_seconds("timestampp")).withWatermark("event_time", watermark)
    aggs = [F.count(F.lit(1)).alias("total_streams"),
            F.avg(F.col("skipped").cast("int")).alias("skip_ratio")]
    for c in SECS_COLS:
        v = secs_by_type(c)
        aggs += [F.avg(v).alias(c), F.stddev_samp(v).alias(f"{c}_std")]
    for t in TOP_TYPES:
        aggs.append(F.sum(F.when(F.col("top_type") == F.lit(t), 1).otherwise(0)).cast("bigint")
                    .alias(f"total_streams_{t.lower()}"))
    g = ev.groupBy("user_id", slot_window(s).alias("slot")).agg(*aggs)
    out = {f"{c}_std": F.coalesce(F.col(f"{c}_std"), F.lit(0.0)) for c in SECS_COLS}
    out["unique_top_types"] = sum((F.col(f"total_streams_{t.lower()}") > 0).cast("bigint") for t in TOP_TYPES)
    out["time"] = F.unix_seconds(F.col("slot.start"))
    return g.withColumns(out).drop("slot")


def start_slot_stats(parsed_stream: DataFrame, s: Settings, sink_path: str, checkpoint: str,
                     watermark: str = "8 hours", trigger: dict | None = None) -> StreamingQuery:
    """Append closed slots to a parquet sink; state and progress live in
    ``checkpoint`` (a shared folder, so the query survives restarts)."""
    q = (slot_stats_stream(parsed_stream, s, watermark).writeStream
         .outputMode("append").format("parquet")
         .option("path", sink_path).option("checkpointLocation", checkpoint))
    q = q.trigger(**(trigger or {"processingTime": "1 minute"}))
    return q.start()
