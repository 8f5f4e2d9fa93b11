"""Streaming queries: the stream's final answer equals the batch aggregate."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources.tables import table
from tessera.streaming.events import lossless_delay, read_windows, run_available_now


@query("stream_window_counts", """
SELECT date_trunc('hour', ts) AS window_start, date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end,
       event_type, count(*) AS n, round(sum(value), 6) AS total_value
FROM events GROUP BY 1, 2, 3
""")
def stream_window_counts(spark, sf):
    """Hourly counts and value sums per event type, computed by a file stream."""
    src = f"{sf.rstrip('/')}/events*.parquet"  # a glob: the file source watches a directory
    events = table(spark, sf, "events")
    path = run_available_now(spark, src, events.schema, "ts", "event_type", "value", scratch_path(spark, "stream-out"),
                             scratch_path(spark, "stream-checkpoint"), "1 hour", lossless_delay(events, "ts"))
    return read_windows(spark, path, "event_type").withColumn("total_value", F.round("total_value", 6))
